"""Language-model scores, and the pipeline's stages against brute force."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import lm_score, queries, quality_rules
from sluice.llm.tokens import encoder

from .helpers import contamination, documents, empty, near_classes, sentence, shingle_set, without_repeats

SF = "/root/testdata/sf0.001"


def _base(texts, held):
    tokens = [[*(t or "").encode().lower().split(), b""] for t in texts]
    counts = collections.Counter()
    for t, h in zip(tokens, held):
        if not h:
            counts.update(t)
    total = sum(counts.values())
    low = np.log10(total + 0.1 * (len(counts) + 1))
    scores = [sum(np.log10(counts.get(w, 0) + 0.1) - low for w in t) for t in tokens]
    return tokens, counts, total, scores


def test_registered_scores(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    held = [zlib.crc32(str(d.doc_id).encode()) % 10 == 0 for d in docs]
    tokens, counts, total, base = _base([d.text for d in docs], held)
    rows = queries.op9_lm_score(spark, sf).orderBy("doc_id").collect()
    assert [(r.doc_id, r.held_out, r.n_tokens, r.train_tokens) for r in rows] == [
        (d.doc_id, h, len(t), total) for d, h, t in zip(docs, held, tokens)]
    assert [r.n_known for r in rows] == [sum(w in counts for w in t) for t in tokens]
    assert np.allclose([r.base_score for r in rows], base)
    unseen = [r for r in rows if r.held_out]
    gain = sum(r.score - r.base_score for r in unseen) / sum(r.n_tokens for r in unseen)
    assert gain > 0.15  # log10 a token, on documents the model has not seen


def test_probabilities_sum_to_one():
    words = [(f"w{k:03d}".encode(), 2000 - k) for k in range(600)] + [(lm_score.END, 900)]
    rare = [(b"zz%d" % k, 1) for k in range(50)]
    mass = collections.Counter()
    for w, n in words + rare:
        if w:
            mass[w[-2:]] += n + 0.1
    total = sum(n for _, n in words + rare)
    vocab = lm_score.Vocabulary(words, list(mass.items()), total, len(words + rare))
    model = lm_score.LogBilinear.fresh(vocab.share)
    normaliser = model.normalisers()
    one, two = 5, lm_score.EVENTS
    predicted = model.context[one] @ model.first + model.context[two] @ model.second
    p = np.exp(predicted @ model.vectors.T + model.bias - normaliser[one, two])
    assert p.sum() == pytest.approx(1, abs=1e-3)
    inside = np.zeros(lm_score.EVENTS)
    for w, n in words + rare:
        e = vocab.look_up([w])[0][0]
        inside[e] += 1 if e <= lm_score.SHORT else (n + 0.1) / vocab.weight[e]
    used = inside > 0
    assert np.allclose((inside + np.where(np.arange(lm_score.EVENTS) > lm_score.SHORT, 0.1 / vocab.weight, 0))[used], 1)


def test_gradient_is_the_loss_s():
    random = np.random.default_rng(3)
    share = random.random(lm_score.EVENTS)
    share /= share.sum()
    model = lm_score.LogBilinear.fresh(share)
    model = lm_score.LogBilinear((model.weights + random.normal(0, 0.1, len(model.weights))).astype(np.float64))
    one, two, target = (random.integers(0, lm_score.EVENTS, 7) for _ in range(3))
    noise, k, ln_share = random.integers(0, lm_score.EVENTS, 5), 6.0, np.log(share)

    def loss(w):
        m = lm_score.LogBilinear(w)
        h = m.context[one] @ m.first + m.context[two] @ m.second
        own = (h * m.vectors[target]).sum(1) + m.bias[target] - ln_share[target] - np.log(k)
        other = h @ m.vectors[noise].T + m.bias[noise] - ln_share[noise] - np.log(k)
        return (np.log1p(np.exp(-own)).sum() + k / 5 * np.log1p(np.exp(other)).sum()) / 7

    got = model.gradient(one, two, target, noise, ln_share, k)
    for i in np.argsort(-np.abs(got))[:: len(got) // 40][:40]:
        step = np.zeros_like(model.weights)
        step[i] = 1e-5
        want = (loss(model.weights + step) - loss(model.weights - step)) / 2e-5
        assert got[i] == pytest.approx(want, rel=2e-3, abs=1e-6)


def test_scores_of_odd_documents(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "FREQUENT", 0.01)  # most words take the path of rare ones
    docs = documents(spark)
    held = F.coalesce(F.col("doc_id") % 4 == 1, F.lit(True))
    rows = docs.collect()
    flags = [True if r.doc_id is None else r.doc_id % 4 == 1 for r in rows]
    tokens, counts, total, base = _base([r.text for r in rows], flags)
    found = lm_score.score(docs, held).collect()
    key = lambda i, n, b: (i is not None, i or 0, n, round(b, 6))
    got = sorted((key(r.doc_id, r.n_tokens, r.base_score), r.n_known) for r in found)
    want = sorted((key(r.doc_id, len(t), b), sum(w in counts for w in t)) for r, t, b in zip(rows, tokens, base))
    assert got == want and all(np.isfinite(r.score) and r.train_tokens == total for r in found)
    none = lm_score.score(docs, F.lit(True)).collect()
    assert len(none) == len(rows) and all(r.train_tokens == 0 and r.score == r.base_score for r in none)
    assert lm_score.score(empty(spark), F.lit(False)).count() == 0


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    schema = docs.schema
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_rules"](spark, docs, SF)
    assert good.schema == schema
    kept = {r.doc_id for r in quality_rules.verdicts(docs).filter("kept").collect()}
    rows = good.collect()
    assert {r.doc_id for r in rows} == kept
    first = stages["near_dedup"](spark, good, SF)
    classes = near_classes([r.doc_id for r in rows], [shingle_set(r.text) for r in rows])
    single = first.collect()
    assert first.schema == schema and {r.doc_id for r in single} == {d for d, c in classes.items() if c == d}
    stripped = stages["suffix_dedup"](spark, first, SF)
    # Repeated strings of 400 bytes and runs of 51 words go, whole characters at a time.
    want = dict(zip([r.doc_id for r in single], without_repeats([r.text.encode() for r in single], 51)))
    before = {r.doc_id: r.text for r in single}
    left = stripped.collect()
    assert stripped.schema == schema and len(left) == len({r.doc_id for r in left})
    assert {r.doc_id for r in left} >= {d for d, t in want.items() if t}
    for r in left:
        mine, whole = r.text.encode(), want[r.doc_id]
        assert mine == whole or mine in whole and len(whole) - len(mine) <= 6 * (1 + len(before[r.doc_id]) // 400)
        assert r.n_chars == len(r.text) or r.text == before[r.doc_id]
    clean = stages["decontaminate"](spark, stripped, SF)
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    cleaned = clean.collect()
    assert clean.schema == schema and len(cleaned) == len(left)
    assert not any(any(f) for _, f, _ in contamination([r.text for r in cleaned], items))
    packed = stages["pack"](spark, clean, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in cleaned}
    # The whole run gives the same rows but for the numbers of sequences.
    ran = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, ran)) == sorted(map(key, packed))


def test_stages_on_odd_and_empty_documents(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for docs in (documents(spark), empty(spark)):
        schema = docs.schema
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert docs.schema == schema, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() >= docs.count()


def test_pipeline_cuts_passages_of_51_words(spark):
    """Planted in documents that are otherwise different; the passage has 305 bytes."""
    passage = " ".join(f"{c}{k:04d}" for k, c in zip(range(51), "abcdefghijklmnopqrstuvwxyz" * 2))
    texts = [f"{sentence(1, 60)} {passage} {sentence(2, 60)}", f"{sentence(3, 60)} {passage}\n{sentence(4, 60)}"]
    texts.append(f"{sentence(5, 60)} {passage.rsplit(' ', 1)[0]} {sentence(6, 60)}")  # 50 words stay
    found = dict(corpus_pipeline.STAGES)["suffix_dedup"](spark, documents(spark, texts, repeat=False), SF)
    got = {r.doc_id: r.text for r in found.collect()}
    assert got == {0: f"{sentence(1, 60)}  {sentence(2, 60)}", 1: f"{sentence(3, 60)} \n{sentence(4, 60)}", 2: texts[2]}


def test_last_stages_against_brute_force(spark):
    """From near-dedup's result on: all repeats are cut, and the run gives what the stages give."""
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    single = stages["near_dedup"](spark, stages["quality_rules"](spark, docs, SF), SF)
    rows = single.collect()
    want = dict(zip([r.doc_id for r in rows], without_repeats([r.text.encode() for r in rows], 51)))
    stripped = stages["suffix_dedup"](spark, single, SF)
    left = {r.doc_id: r.text.encode() for r in stripped.collect()}
    assert stripped.schema == docs.schema and set(left) >= {d for d, t in want.items() if t}
    assert all(left[d] in want[d] and len(want[d]) - len(left[d]) <= 12 for d in left)  # but for parts of characters
    clean = stages["decontaminate"](spark, stripped, SF)
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    cleaned = clean.collect()
    assert clean.schema == docs.schema and {r.doc_id for r in cleaned} == set(left)
    assert not any(any(f) for _, f, _ in contamination([r.text for r in cleaned], items))
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    packed = stages["pack"](spark, clean, SF).collect()
    assert sorted(map(key, corpus_pipeline.run(spark, SF).collect())) == sorted(map(key, packed))


def test_pipeline_gives_the_token_ids(spark):
    docs = documents(spark)
    enc = encoder(queries.word_tokenizer())
    texts = sorted([*enc.encode_all([(r.text or "").encode()])[0].tolist(), 0] for r in docs.collect())
    whole = collections.defaultdict(list)
    seen = collections.Counter()
    for r in sorted(corpus_pipeline.packed(spark, docs, SF).collect(), key=lambda r: (r.doc_id or -1, r.piece)):
        ids = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert len(ids) == r.length and r.ids_crc32 == zlib.crc32(r.ids)
        seen[r.doc_id, r.piece] += 1
        whole[r.doc_id, seen[r.doc_id, r.piece]].append((r.start, ids))
    for key, parts in list(whole.items()):
        assert [s for s, _ in parts] == np.cumsum([0, *(len(i) for _, i in parts[:-1])]).tolist(), key
    assert sorted([i for _, ids in parts for i in ids] for parts in whole.values()) == texts
    assert "ids" in corpus_pipeline.run(spark, SF).columns
