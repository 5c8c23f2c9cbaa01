"""Near duplicates and repeated strings against brute force."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import near_dedup, queries, suffix_dedup
from sluice.llm.components import components
from sluice.llm.suffix import suffix_array

from .helpers import documents, empty, near_classes, odd_texts, repeated_bytes, sentence, shingle_set, without_repeats

SF = "/root/testdata/sf0.01"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80))
def test_suffix_array(symbols):
    order, rank = suffix_array(np.array(symbols))
    assert order.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])
    assert rank[order].tolist() == list(range(len(symbols)))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab", min_size=3, max_size=30), min_size=1, max_size=6, unique=True))
def test_maximal_repeats_with_all_occurrences(strings):
    raw = [s.encode() for s in strings]
    found = {}
    for which, offsets, length in suffix_dedup.maximal_repeats(raw, 3):
        places = set(zip(which.tolist(), offsets.tolist()))
        text = {raw[i][o : o + length] for i, o in places}
        assert len(text) == 1
        found[text.pop()] = places
    every = {}
    for i, s in enumerate(raw):
        for o in range(len(s)):
            for e in range(o + 3, len(s) + 1):
                every.setdefault(s[o:e], set()).add((i, o))
    for text, places in every.items():
        lefts = {raw[i][o - 1] if o else (i, "start") for i, o in places}
        rights = {raw[i][o + len(text)] if o + len(text) < len(raw[i]) else (i, "end") for i, o in places}
        if len(places) > 1 and len(lefts) > 1 and len(rights) > 1:
            assert found.pop(text) == places
    assert not found


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 3), (7, 8), (5, 5), *[(100 + i, 101 + i) for i in range(60)], *[(40, 200 + i) for i in range(50)]]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[x] for x in (1, 2, 3, 9)} == {1} and found[7] == found[8] == 7
    assert {found[100 + i] for i in range(61)} == {100} and {found[200 + i] for i in range(50)} == {40}
    assert 5 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block_bytes", [16 << 20, 4000])
def test_classes_of_odd_documents(spark, block_bytes):
    """Also with blocks cut into parts: no link may go."""
    texts = odd_texts()
    words = sentence(50, 150).split(" ")
    for k in range(40):  # a star: each differs from the first in another place
        copy = list(words)
        copy[3 * k] = f"w{k}"
        copy[(3 * k + 75) % 150] = f"v{k}"
        texts.append(" ".join(copy))
    docs = documents(spark, texts, repeat=False)
    rows = docs.collect()
    want = near_classes([r.doc_id for r in rows], [shingle_set(r.text) for r in rows])
    found = {r.doc_id: r for r in near_dedup.classes(docs, block_bytes=block_bytes).collect()}
    assert {d: r.component_id for d, r in found.items()} == want
    assert all(r.kept == (r.component_id == d) and r.n_shingles == len(shingle_set(texts[d])) for d, r in found.items())


def test_large_block_of_near_copies_is_not_searched_in_pairs(spark, monkeypatch):
    """A group that one cluster connects leaves no pair of parts; stragglers meet every part."""
    words = sentence(90, 200).split(" ")
    texts = []
    for k in range(120):
        copy = list(words)
        copy[k] = f"w{k}"
        texts.append(" ".join(copy))
    sent = []
    whole = near_dedup.open_pairs

    def open_pairs(*given):
        found = whole(*given)
        sent.append(found.count())
        return found

    monkeypatch.setattr(near_dedup, "open_pairs", open_pairs)
    # Only half of each straggler is the copies' text: they share a block at times, never a link.
    for strange in (0, 30):
        more = [" ".join(words[: 170 - k] + [f"s{k}x{i}" for i in range(45)]) for k in range(strange)]
        docs = documents(spark, texts + more, repeat=False)
        rows = docs.collect()
        want = near_classes([r.doc_id for r in rows], [shingle_set(r.text) for r in rows])
        found = near_dedup.classes(docs, block_bytes=40_000).collect()  # a part holds some 25 sets
        assert {r.doc_id: r.component_id for r in found} == want
    assert len(sent) == 2 and sent[0] == 0


def test_null_and_repeated_ids(spark):
    docs = documents(spark)
    rows = near_dedup.classes(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    kept = near_dedup.deduplicate(docs)
    assert kept.schema == docs.schema
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 2 and len(set(ids)) == len(ids) - 1
    want = near_classes([r.doc_id for r in docs.collect() if r.doc_id is not None], [shingle_set(r.text) for r in docs.collect() if r.doc_id is not None])
    assert {i for i in ids if i is not None} == {d for d, c in want.items() if d == c}


@pytest.mark.parametrize("block_bytes", [16 << 20, 4000])
def test_texts_that_share_an_id_meet_their_own_row(spark, block_bytes, monkeypatch):
    words = sentence(91, 80).split(" ")
    rows = [(7, " ".join([*words[:k], f"x{k}", *words[k + 1 :]])) for k in range(20)] + [(7, sentence(92, 60))]
    rows += [(9, sentence(92, 60) + " end"), (11, sentence(93, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    read, found = [], near_dedup.read_sets
    monkeypatch.setattr(near_dedup, "read_sets", lambda *given: read.append(found(*given)) or read[-1])
    got = near_dedup.classes(docs, block_bytes=block_bytes).collect()
    assert len(got) == len(rows) and {(r.doc_id, r.component_id) for r in got} == {(7, 7), (9, 7), (11, 11)}
    assert read[0].count() == 22  # one a set


@pytest.mark.parametrize("doc_id", [None, 5])
def test_runs_of_texts_that_share_an_id_are_read_once(spark, doc_id):
    docs = spark.createDataFrame([(doc_id, sentence(k, 30)) for k in range(20)], "doc_id long, text string")
    names = [hashlib.md5(sentence(k, 30).encode()).digest() for k in range(20)]
    run = [(1, 0, 0, False)]
    kind = "text_hash binary, stands long, runs array<struct<anchor:long,start:long,last:long,hot:boolean>>"
    runs = suffix_dedup.read_runs(docs, spark.createDataFrame([(n, doc_id, run) for n in names], kind))
    assert sorted(bytes(r.text_hash) for r in runs.collect()) == sorted(names)
    join = next(x for x in runs._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x)
    assert "text_hash" in join and "_name" in join


def test_registered_near_dedup(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = near_classes([r.doc_id for r in docs], [shingle_set(r.text) for r in docs])
    assert {r.doc_id: r.component_id for r in queries.op5_near_dedup(spark, SF).collect()} == want


def _digest(text: bytes, flags: bytearray):
    runs = sum(1 for i, f in enumerate(flags) if f and (i == 0 or not flags[i - 1]))
    kept = bytes(b for b, f in zip(text, flags) if not f)
    return len(text), sum(flags), runs, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("hot_runs", [2_000, 0])
def test_repeats_of_odd_documents(spark, hot_runs):
    """With ``hot_runs`` 0 every anchor takes the path of the hot ones."""
    docs = documents(spark)
    rows = docs.collect()
    texts = [(r.text or "").encode() for r in rows]
    want = sorted(_digest(t, f) for t, f in zip(texts, repeated_bytes(texts, suffix_dedup.LENGTH)))
    found = suffix_dedup.remove(docs, hot_runs=hot_runs).collect()
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept or b"").hexdigest()) for r in found)
    assert got == want and any(w[1] for w in want)


def test_windows_spread_where_hashes_are_too_many_to_broadcast(spark):
    runs = suffix_dedup.describe(documents(spark))
    assert runs.count()
    rows = [(bytes([k]) * 16, 10 * k, bytes(range(256)) * 2) for k in range(3)]
    table = spark.createDataFrame(rows, "text_hash binary, start long, string binary")
    repeated = suffix_dedup.count_windows(table)
    few = sorted(map(tuple, suffix_dedup.mark_windows(table, repeated).collect()))
    many = suffix_dedup.mark_windows(table, repeated, broadcast_windows=0).collect()
    for name, s, e in few:
        starts = sorted(r.start for r in many if bytes(r.text_hash) == bytes(name))
        assert starts == list(range(s, e - suffix_dedup.LENGTH + 1))


def test_long_text_taken_in_parts(monkeypatch):
    text = sentence(9, 3000).encode()
    whole = suffix_dedup.anchors([text, b"short", text[:450]])
    monkeypatch.setattr(suffix_dedup, "_BUFFER", 1000)
    parts = suffix_dedup.anchors([text, b"short", text[:450]])

    def of(found, i, n):
        starts, hashes = found[i]
        at = np.arange(n - suffix_dedup.LENGTH + 1)
        return hashes[np.searchsorted(starts, at, side="right") - 1].tolist() if len(starts) else []

    for i, t in enumerate([text, b"", text[:450]]):
        assert of(whole, i, max(len(t), suffix_dedup.LENGTH - 1)) == of(parts, i, max(len(t), suffix_dedup.LENGTH - 1))


def test_registered_repeats(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    texts = [(r.text or "").encode() for r in docs]
    flags = repeated_bytes(texts, 400)
    want = [(d.doc_id, *_digest(t, f)) for d, t, f in zip(docs, texts, flags)]
    found = queries.op10_suffix_dedup(spark, sf).orderBy("doc_id").collect()
    assert [tuple(r)[:5] for r in found] == want
    for r, t, f in zip(found, texts, flags):  # the further column is what is left, to read
        left = bytes(b for b, gone in zip(t, f) if not gone)
        assert r.text == left.decode() if left.decode("utf-8", "ignore").encode() == left else "\ufffd" in r.text


def test_strip_keeps_characters_and_columns(spark):
    passage = "ñé" * 150
    docs = documents(spark, [f"ab {passage}x", f"{passage}y cd", "z" * 1000, "z" * 1000, ""], repeat=False)
    rows = {r.doc_id: r for r in suffix_dedup.strip(docs).collect()}
    assert set(rows) == {0, 1, 4}  # nothing is left of the other two
    assert rows[0].text == "ab x" and rows[1].text == "y cd" and rows[4].text == ""
    assert rows[0].n_chars == 4 and suffix_dedup.strip(docs).schema == docs.schema


@pytest.mark.parametrize("hot_runs", [2_000, 0])
def test_repeated_words_of_odd_documents(spark, hot_runs):
    """Passages of 51 words and more, most of them under 400 bytes; 50 words stay."""
    short = [f"{c}{k % 7}" for c, k in zip("abcdefghijklmnopqrstuvwxyz" * 3, range(78))]
    passages = [short[:51], short[20:71], short[5:55], ["kalo"] * 51, sentence(31, 60).split()[:52]]
    texts = odd_texts()
    for k, p in enumerate(passages):
        texts.append(f"{sentence(60 + k, 20)} {' '.join(p)} {sentence(70 + k, 20)}")
        texts.append(f"{sentence(80 + k, 9)}\n{'  '.join(p)}\n")
    texts += [" ".join(short[:60])] * 2
    docs = documents(spark, texts)
    raw = [(r.text or "").encode() for r in docs.collect()]
    found = suffix_dedup.remove(docs, hot_runs=hot_runs, words=51).collect()
    want = without_repeats(raw, 51)
    assert sorted(bytes(r.kept or b"") for r in found) == sorted(want)
    assert sum(map(len, want)) < sum(bytes(r.kept or b"") != b"" and len(r.kept) for r in suffix_dedup.remove(docs).collect())


@pytest.mark.parametrize("hot_runs", [2_000, 0])
def test_words_of_repeated_passages_are_counted(spark, hot_runs):
    """Planted passages of 51 words and 305 bytes; 50 words, and texts without them, count 0."""
    short = [f"{c}{k:04d}" for k, c in zip(range(51), "abcdefghijklmnopqrstuvwxyz" * 2)]
    texts = [f"{sentence(1, 60)} {' '.join(short)} {sentence(2, 60)}", f"{sentence(3, 60)}\n{'  '.join(short)}"]
    texts += [f"{sentence(5, 60)} {' '.join(short[:50])} {sentence(6, 60)}", sentence(7, 200), None]
    texts += [sentence(8, 70), sentence(8, 70), sentence(9, 50), sentence(9, 50)]
    docs = documents(spark, texts, repeat=False)
    found = suffix_dedup.remove(docs, hot_runs=hot_runs, words=51, count=True).collect()
    assert {r.doc_id: r.n_passage_words for r in found} == {0: 51, 1: 51, 2: 0, 3: 0, 4: 0, 5: 70, 6: 70, 7: 0, 8: 0}
    plain = {r.doc_id: r for r in suffix_dedup.remove(docs, hot_runs=hot_runs).collect()}
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept) == tuple(plain[r.doc_id][c] for c in ("n_bytes", "n_removed", "n_spans", "kept")) for r in found)


def test_registered_query_counts_words_of_passages(spark, tmp_path):
    passage = " ".join(f"{c}{k:04d}" for k, c in zip(range(51), "abcdefghijklmnopqrstuvwxyz" * 2))
    texts = [f"{sentence(1, 60)} {passage} {sentence(2, 60)}", f"{sentence(3, 60)} {passage}", sentence(4, 90)]
    documents(spark, texts, repeat=False).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op10_suffix_dedup(spark, str(tmp_path)).collect()}
    assert [found[k].n_passage_words for k in range(3)] == [51, 51, 0]
    assert all(found[k].n_removed == 0 for k in range(3))  # 305 bytes: the contract's columns keep it


def test_words_of_long_texts_are_cut_at_blanks(monkeypatch):
    texts = [sentence(9, 3000).encode(), b"", b" \t ", ("x" * 2500 + "  " + sentence(3, 40) + "\n").encode(), b"one"]
    whole = suffix_dedup.word_places(texts)
    monkeypatch.setattr(suffix_dedup, "_BUFFER", 1000)
    parts = suffix_dedup.word_places(texts)
    assert all(a.tolist() == b.tolist() for a, b in zip(whole, parts))
    hashes, starts, ends, n = whole
    assert n.tolist() == [len(t.split()) for t in texts]
    words = [t[s:e] for t, s, e in zip(np.repeat(np.array(texts, object), n), starts.tolist(), ends.tolist())]
    assert words == [w for t in texts for w in t.split()]
    assert len(set(hashes.tolist())) == len(set(words))


def test_empty_tables(spark):
    none = empty(spark)
    assert near_dedup.classes(none).count() == 0 and near_dedup.deduplicate(none).count() == 0
    assert suffix_dedup.remove(none).count() == 0 and suffix_dedup.strip(none).count() == 0
