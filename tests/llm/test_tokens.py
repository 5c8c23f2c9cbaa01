"""Token ids, shard files, packing and section counts against encoding whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluice.llm import packing, queries, token_counts, token_output
from sluice.llm.tokens import Encoder, pack_ids, unpack_ids
from sluice.workspace import new_dir

from .helpers import documents, empty, odd_texts

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False)


def _crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_pieces_give_the_ids_of_whole_texts(whole):
    encoder = Encoder(PATH, limit=50)  # small caches, so that entries leave them
    for text in odd_texts():
        assert encoder.encode((text or "").encode()) == np.array(whole(text).ids, dtype="<u4").tobytes()


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text(text):
    tokenizer, encoder = _both()
    assert encoder.encode(text.encode()) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert _spans().of(text).tolist() == [list(o) for o in tokenizer.encode(text, add_special_tokens=False).offsets]


_made = {}


def _both():
    if "both" not in _made:
        _made["both"] = Tokenizer.from_file(PATH), Encoder(PATH)
    return _made["both"]


def _spans():
    if "spans" not in _made:
        _made["spans"] = token_counts.Spans(PATH)
    return _made["spans"]


@given(st.lists(st.integers(0, (1 << 32) - 1), max_size=300))
def test_value_code_round_trip(values):
    control, data = token_output.encode_values(np.array(values, dtype="<u4"))
    assert len(control) == -(-len(values) // 4)
    back = token_output.decode_values(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(values))
    assert back.tolist() == values
    assert unpack_ids(pack_ids(np.array(values, dtype="<u4"))).tolist() == values


def test_shards_hold_all_ids_in_order(spark, whole):
    docs = documents(spark)
    path = new_dir(spark, "tests")
    token_output.write_shards(docs, path, PATH, end_id=1, shard_tokens=500)  # many shards
    found = token_output.read_shards(spark, path).orderBy("start").collect()
    want = [(r.doc_id, [*whole(r.text).ids, 1]) for r in docs.collect()]
    want.sort(key=lambda x: (x[0] is not None, x[0], len(x[1]), _crc(x[1])))
    assert [r.doc_id for r in found] == [d for d, _ in want]
    assert [r.start for r in found] == np.cumsum([0, *(len(i) for _, i in want)])[:-1].tolist()
    assert [bytes(r.ids) for r in found] == [np.array(i, "<u4").tobytes() for _, i in want]
    ranks = [r.n for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()]
    assert ranks == sorted(ranks, reverse=True)


def test_registered_shards(spark, whole):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    found = queries.op1_token_output(spark, SF).orderBy("start").collect()
    ids = [[*whole(r.text).ids, 1] for r in docs]
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in found] == [(d.doc_id, len(i), _crc(i)) for d, i in zip(docs, ids)]


def _valid(rows, whole, texts, capacity, end_id):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, mine in by_doc.items():
        ids = [*whole(texts[doc_id]).ids, end_id]
        for r in mine:
            assert r.start == r.piece * capacity and r.length == len(ids[r.start : r.start + capacity])
            assert r.ids_crc32 == _crc(ids[r.start : r.start + capacity])
    return len(places)


def test_registered_packing(spark, whole):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op4_pack(spark, SF).collect()
    used = _valid(rows, whole, texts, 2048, 0)
    assert {r.doc_id for r in rows} == set(texts)
    assert used <= -(-sum(r.length for r in rows) // 2048) * 1.02 + 1


def test_packing_odd_documents(spark, whole):
    docs = documents(spark)
    rows = packing.pack(docs, PATH, end_id=0, capacity=64).collect()
    tokens = sum(len(whole(r.text).ids) + 1 for r in docs.collect())
    assert sum(r.length for r in rows) == tokens
    assert all(len(r.ids) == 4 * r.length and 0 < r.length <= 64 for r in rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=200))
def test_sum_of_squares_places_where_the_sum_is_least(lengths):
    packer, gaps = packing.SumOfSquares(32), {}
    for n in lengths:
        counts = np.bincount([g for g in gaps.values() if g], minlength=33)
        options = {}
        for g in {*(g for g in gaps.values() if g >= n), 32}:
            c = counts.copy()
            if g < 32:
                c[g] -= 1
            if g > n:
                c[g - n] += 1
            options[g] = int((c.astype(np.int64) ** 2).sum())
        sequence, offset = packer.place(n)
        chosen = gaps.get(sequence, 32)
        assert offset == 32 - chosen and options[chosen] == min(options.values())
        gaps[sequence] = chosen - n


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 31), max_size=300))
def test_all_lengths_have_a_place(lengths):
    sequence, offset, made = packing.place_all(np.array(lengths, dtype=np.int64), 32)
    assert sorted(set(sequence.tolist())) == list(range(made))
    for k in range(made):
        parts = sorted((offset[i], lengths[i]) for i in np.flatnonzero(sequence == k))
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist()
        assert sum(n for _, n in parts) <= 32
    packer = packing.SumOfSquares(32)
    for n in sorted(lengths, reverse=True):
        packer.place(n)
    assert made <= packer.made  # never worse than one round


def test_section_counts_add_up(spark, whole):
    docs = documents(spark)
    rows = token_counts.count_tokens(docs, PATH, section_chars=50).collect()
    assert sum(r.n_tokens for r in rows) == sum(len(whole(r.text).ids) for r in docs.collect())
    texts = {r.doc_id: r.text or "" for r in docs.filter("doc_id is not null").collect()}
    for r in rows:
        if r.doc_id is not None:
            assert r.end - r.start <= 50 and "\n" not in texts[r.doc_id][r.start : r.end]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_crossing_tokens_follow_the_rule(rule):
    spans = np.array([[0, 4], [5, 9], [9, 12], [14, 20]])
    sections = np.array([[0, 6], [6, 10], [12, 15], [15, 30]])  # 10..12 lies in none
    counts, crossing = token_counts.allocate(spans, sections, rule)
    want = {"most": [1, 2, 0, 1], "first": [2, 1, 1, 0]}[rule]
    assert counts.tolist() == want and crossing.sum() == 3


def test_own_sections(spark):
    docs = spark.sql(
        "SELECT 1L AS doc_id, 'title here\\nand a body' AS text, array(named_struct('name', 'title', 'start', 0, 'end', 10), "
        "named_struct('name', 'body', 'start', 11, 'end', 21)) AS sections UNION ALL SELECT 2L, NULL, NULL"
    )
    rows = token_counts.count_tokens(docs, PATH, own_sections=True).collect()
    assert [(r.name, r.n_tokens) for r in sorted(rows, key=lambda r: r.section)] == [("title", 2), ("body", 3)]
    with pytest.raises(ValueError):
        token_counts.count_tokens(docs, PATH, rule="other")


def _allocated(spans, sections, rule):
    """Tokens and crossing tokens of each section (pairs or None), token by token."""
    counts, crossing = [0] * len(sections), [0] * len(sections)
    order = sorted((s[0], s[1], k) for k, s in enumerate(sections) if s and None not in s and s[0] < s[1])
    for a, b in spans:
        best = None
        for start, end, k in order:
            overlap = min(b, end) - max(a, start)
            if overlap <= 0:
                continue
            value = overlap if rule == "most" else -max(a, start)
            if best is None or value > best[0]:
                best = value, k, a < start or b > end
        if best:
            counts[best[1]] += 1
            crossing[best[1]] += best[2]
    return counts, crossing


def test_registered_counts_section_by_section(spark, whole):
    found = {}
    for r in queries.op6_token_counts(spark, SF).collect():
        found.setdefault(r.doc_id, []).append((r.section, r.start, r.end, r.n_tokens, r.n_crossing))
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert set(found) == {r.doc_id for r in docs}
    for r in docs:
        text, sections, at = r.text or "", [], 0
        for line in text.split("\n"):
            sections += [(at + i, at + min(i + 1000, len(line))) for i in range(0, max(1, len(line)), 1000)]
            at += len(line) + 1
        counts = _allocated(whole(text).offsets, sections, "most")
        assert sorted(found[r.doc_id]) == [(k, *s, n, c) for k, (s, n, c) in enumerate(zip(sections, *counts))]


SECTION = st.one_of(st.none(), st.tuples(*[st.one_of(st.none(), st.integers(-2, 30))] * 2))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), max_size=12), st.lists(SECTION, max_size=8), st.sampled_from(token_counts.RULES))
def test_sections_in_any_order(lengths, sections, rule):
    ends = np.cumsum([n + k % 2 for k, n in enumerate(lengths)])
    spans = np.array([(e - n, e) for e, n in zip(ends, lengths)], dtype=np.int64).reshape(-1, 2)
    given_ = [s and {"name": None, "start": s[0], "end": s[1]} for s in sections]
    found = token_counts.allocate_any(spans, given_, rule)
    assert tuple(x.tolist() for x in found) == _allocated(spans.tolist(), sections, rule)


def test_odd_sections(spark):
    kind = "doc_id long, text string, sections array<struct<name: string, start: int, end: int>>"
    text = "title here\nand a body"
    rows = [
        (1, text, [("b", 11, 21), None, ("a", 0, 10), (None, None, 5), ("x", 4, None), ("y", 7, 7)]),
        (2, text, None), (3, text, []), (4, None, [("n", 0, 9)]), (5, text, [("all", 0, 21), ("a", 0, 10)]),
    ]
    found = {}
    for r in token_counts.count_tokens(spark.createDataFrame(rows, kind), PATH, own_sections=True).collect():
        found.setdefault(r.doc_id, {})[r.section] = (r.name, r.start, r.end, r.n_tokens)
    assert found[1] == {0: ("b", 11, 21, 3), 1: (None, None, None, 0), 2: ("a", 0, 10, 2), 3: (None, None, 5, 0),
                        4: ("x", 4, None, 0), 5: ("y", 7, 7, 0)}
    assert set(found) == {1, 4, 5} and found[4] == {0: ("n", 0, 9, 0)}
    assert [found[5][k][3] for k in (0, 1)] == [3, 2]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_tokenizer_file(name):
    """A file whose words are not independent is left to the library, ids and spans alike."""
    path = public_tokenizers.path(name)
    tokenizer, encoder, spans = Tokenizer.from_file(path), Encoder(path), token_counts.Spans(path)
    texts = [t for t in odd_texts() if t is not None and len(t) < 5000]
    plain = [tokenizer.encode(t, add_special_tokens=False) for t in texts]
    assert [i.tolist() for i in encoder.encode_all([t.encode() for t in texts])] == [e.ids for e in plain]
    assert all(spans.of(t).tolist() == [list(o) for o in e.offsets] for t, e in zip(texts, plain))


def test_empty_tables(spark):
    none = empty(spark)
    path = new_dir(spark, "tests")
    token_output.write_shards(none, path, PATH, end_id=1)
    assert token_output.read_shards(spark, path).count() == 0
    assert packing.pack(none, PATH, end_id=0, capacity=2048).count() == 0
    assert token_counts.count_tokens(none, PATH).count() == 0
