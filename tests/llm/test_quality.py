"""Quality rules, the pairwise ranker, licenses and contamination."""

import collections
import hashlib
import math
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import decontaminate, license_scan, quality_classifier, quality_rules, queries, text_stats
from sluice.llm.fm_index import FMIndex

from .helpers import WORD, contamination, documents, empty, odd_texts, sentence

SF = "/root/testdata/sf0.01"


def _counts(text):
    text = text or ""
    w = WORD.findall(text)
    windows = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered, seen, dup = set(), set(), 0
    for i in range(len(w) - 4):
        if windows[tuple(w[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    for x in lines:
        dup += x in seen
        seen.add(x)
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines), "n_dup_lines": dup, "n_repeat_words": len(covered),
        "n_upper": sum("A" <= c <= "Z" for c in text), "n_digits": sum("0" <= c <= "9" for c in text),
        "n_same_words": sum(a == b for a, b in zip(w, w[1:])), "n_distinct_words": len(set(w)),
    }


def test_counts_of_odd_texts():
    texts = odd_texts()
    found = text_stats.counts([(t or "").encode() for t in texts])
    for i, t in enumerate(texts):
        for name, value in _counts(t).items():
            assert found[name][i] == value, (name, t and t[:50])


def test_registered_quality_rules(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op2_quality_rules(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    wrong = collections.Counter()
    for r in rows:
        want = _counts(docs[r.doc_id].text)
        assert all(r[c] == want[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        failed = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert r.base_failed == failed and not (failed and r.kept)
        if r.doc_id in labels and not failed:
            wrong[labels[r.doc_id], r.kept] += 1
    assert wrong[1, False] == 0 and wrong[0, True] <= 0.05 * wrong[0, False]


def test_quality_of_odd_documents(spark):
    docs = documents(spark)
    rows = quality_rules.verdicts(docs).collect()
    assert len(rows) == docs.count()
    verdict = {r.doc_id: r for r in rows}
    assert not verdict[0].kept and not verdict[1].kept and verdict[0].n_words == 0
    assert not verdict[18].kept  # symbols
    assert verdict[6].kept and verdict[15].kept and verdict[19].kept
    good = quality_rules.keep_good(docs)
    assert good.schema == docs.schema
    assert sorted((r.doc_id or -1) for r in good.collect()) == sorted((r.doc_id or -1) for r in rows if r.kept)
    assert quality_rules.verdicts(empty(spark)).count() == 0 and quality_rules.keep_good(empty(spark)).count() == 0


def _buckets(shares):
    return [0 if x <= 2.0**-30 else math.floor(math.log(x / 2.0**-30) / math.log(1.02)) + 1 for x in shares]


def _quantile(shares, q):
    ordered = sorted(_buckets(shares))
    number = ordered[max(0, math.ceil(q * len(ordered) - 1e-9) - 1)]
    return 2.0**-30 * 1.02 ** (number - 0.5) if number else 0.0


def brute_verdicts(rows, reach=4.0, least=100):
    """(kept, broken) of each (lang, source, text), from plain counts and sorted lists."""
    rules = {"symbols": ("n_symbols", "word_chars"), "capitals": ("n_upper", "word_chars"),
             "stutter": ("n_same_words", "n_words"), "dup_lines": ("n_dup_lines", "n_lines")}
    counted = [_counts(t) for _, _, t in rows]
    groups = collections.defaultdict(list)
    for (lang, source, _), c in zip(rows, counted):
        if c["n_words"]:
            for key in ((lang, source), lang, "all of them"):
                groups[key].append(c)
    levels = {}

    def level(key, r):
        if (key, r) not in levels:
            a, b = rules[r]
            shares = [c[a] / max(1, c[b]) for c in groups[key]]
            low, mid, high = (_quantile(shares, q) for q in (0.1, 0.5, 0.95))
            levels[key, r] = mid + reach * (mid - low), high, _quantile([c[b] for c in groups[key]], 0.5)
        return levels[key, r]

    out = []
    for (lang, source, _), c in zip(rows, counted):
        broken = []
        for r, (a, b) in rules.items():
            if not groups[lang, source]:
                continue
            wide, high, size = level(lang, r)
            most = max(wide, high)
            if len(groups[lang]) < least:
                wide, _, size = level("all of them", r)
                most = wide
            ordinary = wide
            if len(groups[lang, source]) >= least:
                ordinary, _, size = level((lang, source), r)
                ordinary = min(ordinary, most)
            part = min(1.0, size / max(1, c[b]))
            if 2 * (math.sqrt(c[a] * part + 0.375) - math.sqrt(ordinary * c[b] * part + 0.375)) > reach:
                broken.append(r)
        failed = c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]
        out.append((not failed and not broken, broken))
    return out


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_registered_verdicts_against_brute_force(spark, scale):
    sf = f"/root/testdata/sf{scale}"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    rows = queries.op2_quality_rules(spark, sf).orderBy("doc_id").collect()
    want = brute_verdicts([(d.lang, d.source, d.text) for d in docs])
    assert [(r.kept, r.broken) for r in rows] == [(k, ",".join(b)) for k, b in want]


def _two_sources():
    """Ordinary documents with no symbols, ordinary documents with many, junk with more, in one
    language; a small group of another one."""
    marked = lambda i, n: sentence(i, 60).replace(" ", "# ", n)
    rows = [(i, sentence(i, 40 + i % 30), "en", "a", 0) for i in range(200)]
    rows += [(1000 + i, marked(500 + i, 10 + i % 5), "en", "b", 0) for i in range(200)]
    rows += [(2000 + i, marked(900 + i, 59), "en", "ab"[i % 2], 0) for i in range(12)]
    rows += [(3000 + i, marked(950 + i, 12), "en", "a", 0) for i in range(8)]
    rows += [(4000 + i, sentence(980 + i, 30), None, "c", 0) for i in range(5)]
    return rows


def test_levels_follow_their_groups_and_runs_repeat(spark):
    rows = _two_sources()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    want = {r[0]: v for r, v in zip(rows, brute_verdicts([(r[2], r[3], r[1]) for r in rows]))}
    for parts in (1, 5, 13):
        docs = spark.createDataFrame(rows, schema).repartition(parts)
        found = {r.doc_id: (r.kept, r.broken) for r in quality_rules.verdicts(docs).collect()}
        assert found == want
    limits = {(r.lang, r.source): r.level_symbols for r in quality_rules.levels(text_stats.with_counts(docs)).collect()}
    assert limits["en", "a"] == 0 and 0.03 < limits["en", "b"] < 0.1 < limits[None, "c"]  # too few rows: all of them
    kept = {d for d, (k, _) in want.items() if k}
    assert kept == {r[0] for r in rows if r[0] < 2000 or r[0] >= 4000}  # what is ordinary in b is junk in a


def test_source_full_of_junk_does_not_excuse_itself(spark):
    rows = [(i, sentence(i, 50), "en", "a", 0) for i in range(4000)]
    rows += [(9000 + i, sentence(i, 50).replace(" ", "# ", 49), "en", "b", 0) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in quality_rules.verdicts(docs).filter("kept").collect()}
    assert kept == set(range(4000))


def test_sketch_quantiles_are_near_and_merge(spark):
    df = spark.range(20000).select((F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / (1 << 30)).alias("x"), (F.col("id") % 7).alias("g"))
    each = df.groupBy("g", F.lit("r").alias("rule"), quality_rules.bucket(F.col("x")).alias("bucket")).agg(F.count("*").alias("n"))
    whole = quality_rules.quantiles(quality_rules.merged(each), [], {"q1": 0.1, "q5": 0.5, "q9": 0.95}).first()
    values = np.sort(np.array([r.x for r in df.collect()]))
    for got, q in ((whole.q1, 0.1), (whole.q5, 0.5), (whole.q9, 0.95)):
        assert abs(got / values[int(q * 20000)] - 1) < 0.011
    assert whole.n == 20000


def test_ranker_orders_pairs():
    random = np.random.default_rng(1)
    good, bad = random.normal(0, 1, (500, 4)), random.normal(0, 1, (80, 4)) + [1.5, 0, -1, 0]
    ranker = quality_classifier.fit(good, bad, 80 / 580)
    a, b = ranker.raw(good), ranker.raw(bad)
    assert (a[:, None] > b[None]).mean() > 0.85
    at_cut = ranker.score(np.concatenate([good, bad]))
    assert abs((at_cut < quality_classifier.CUT).mean() - 80 / 580) < 0.02
    assert quality_classifier.fit(good, bad[:0], 0.0) is None


def _labelled(spark, n_good, n_bad, copies):
    random = np.random.default_rng(3)
    x = [*random.normal(0, 1, (n_good, 3)).tolist(), *(random.normal(0, 1, (n_bad, 3)) + [1.5, 0, -1]).tolist()]
    rows = [(i, x[i % len(x)]) for i in range(copies * len(x))]
    marks = [(i, int(i % len(x) < n_good)) for i, _ in rows]
    featured = spark.createDataFrame(rows, "doc_id long, x array<double>")
    return np.array(x), featured, spark.createDataFrame(marks, "doc_id long, quality int")


@pytest.mark.parametrize("copies", [1, 3])
def test_every_labelled_row_is_learned_from(spark, copies):
    """As by all pairs in memory while there is one group; copies change nothing but counts."""
    x, featured, labels = _labelled(spark, 700, 90, copies)
    got = quality_classifier.train(featured, labels, F.lit(True))
    want = quality_classifier.fit(np.tile(x[:700], (copies, 1)), np.tile(x[700:], (copies, 1)), 90 / 790)
    for name in ("mean", "spread", "weights", "scale"):
        assert np.allclose(getattr(got, name), getattr(want, name), rtol=1e-4, atol=1e-6), name
    scores = np.sort(np.tile(got.raw(x), copies))
    assert got.cut == pytest.approx(scores[90 * copies - 1 : 90 * copies + 1].mean())


def test_groups_hold_every_row_and_both_labels(spark, monkeypatch):
    """More than 20,000 rows of a label, none left out; few rows of the other stand in many groups."""
    x, featured, labels = _labelled(spark, 20_500, 40, 1)
    rows = featured.join(labels, "doc_id").select((F.col("quality") == 1).alias("good"), "x", F.lit(1).cast("long").alias("n"))
    found = quality_classifier.dealt(rows, {True: 20_500, False: 40}).groupBy("group").agg(F.sum(F.col("good").cast("int")).alias("good"), F.count("*").alias("n")).collect()
    assert sum(r.good for r in found) == 20_500 and len(found) == 21
    assert all(r.n > r.good and r.good < 2 * quality_classifier.GROUP for r in found)
    ranker = quality_classifier.train(featured, labels, F.lit(True))
    assert np.allclose(ranker.mean, x.mean(axis=0)) and np.allclose(ranker.spread, x.std(axis=0))
    assert ranker.cut == pytest.approx(np.sort(ranker.raw(x))[39:41].mean())
    assert (ranker.raw(x[:20_500])[:, None] > ranker.raw(x[20_500:])[None]).mean() > 0.85


@pytest.mark.parametrize("most", [1, 7, 10_000])
def test_value_at_a_rank(spark, most):
    values = [(float(v * v) - 3, 1 + v % 3) for v in range(60)]
    table = spark.createDataFrame(values, "raw double, n long")
    each = [v for v, n in values for _ in range(n)]
    for rank in (1, 2, 37, 60, len(each) - 1, len(each)):
        assert quality_classifier.value_at(table, rank, most) == each[rank - 1]


def test_registered_classifier(spark):
    rows = {r.doc_id: r for r in queries.op8_quality_classifier(spark, SF).collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    labels = [(r.quality, rows[r.doc_id]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    held = [(q, r.predicted) for q, r in labels if r.held_out]
    assert sum(q == p for q, p in held) >= 0.95 * len(held)


def test_scores_do_not_depend_on_other_columns(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(6, 1), (9, 1), (10, 1), (18, 0), (17, 0), (7, None)], "doc_id long, quality int")
    held = F.col("doc_id") == 9
    rows = quality_classifier.classify(docs, labels, held).collect()
    assert len(rows) == docs.count()
    by_text = collections.defaultdict(set)
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    for r in rows:
        if r.doc_id is not None:
            by_text[texts[r.doc_id] or ""].add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert all(r.score == 0.5 for r in quality_classifier.classify(docs, labels.limit(0), held).collect())
    assert quality_classifier.classify(empty(spark), labels, held).count() == 0


def test_registered_licenses(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(license_scan.oracle()).df().sort_values("doc_id").reset_index(drop=True)
    got = queries.op7_license_scan(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False)


def test_licenses_of_odd_documents(spark):
    long = "Permission is hereby granted, free of charge, to any person " + sentence(3, 25) + " Released under the MIT license!"
    texts = [None, "", "released UNDER the, mit: license", "released under the mit", long, license_scan.NOTICES["gpl-header"] * 3]
    rows = license_scan.scan(documents(spark, texts, repeat=False)).orderBy("doc_id").collect()
    assert [[x.name for x in r.licenses] for r in rows] == [[], [], ["mit"], [], ["mit"], ["gpl-header"]]
    assert [r.n_windows for r in rows][:4] == [0, 0, 1, 0]
    edited = license_scan.NOTICES["mit-text"].replace("obtaining", "who gets")
    found = license_scan.scan(documents(spark, [edited], repeat=False), containment=0.7).first().licenses
    assert found[0].name == "mit-text" and 0.7 <= found[0].containment < 1
    with pytest.raises(ValueError):
        license_scan.scan(documents(spark), {"short": "two words"})
    assert license_scan.scan(documents(spark), {}).filter("size(licenses) > 0").count() == 0
    assert license_scan.scan(empty(spark)).count() == 0


def test_license_scan_stays_in_the_jvm(spark):
    plan = queries.op7_license_scan(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=120), st.lists(st.integers(1, 5), min_size=1, max_size=3))
def test_fm_index_finds_every_occurrence(symbols, phrase):
    index = FMIndex(np.array(symbols), 5, sample=4)
    low, high = index.search(np.array([phrase]))
    at = sorted(index.locate(np.arange(low[0], high[0])).tolist())
    assert at == [i for i in range(len(symbols)) if symbols[i : i + len(phrase)] == phrase]


def _benchmark(spark):
    items = [(1, sentence(10, 30)), (2, "only four words here"), (3, None), (4, " - "), (None, sentence(11, 12)), (1, sentence(12, 10))]
    return spark.createDataFrame(items, "item_id long, text string")


def _contaminated():
    a = sentence(10, 30).split(" ")
    return [
        *odd_texts(), " ".join(a[:9]), " ".join(a[3:13]).upper(), "x, " + "; ".join(a[:14]) + " end", "ONLY four-words HERE",
        sentence(11, 12) + "\n" + sentence(10, 30), " ".join([*a[5:10], sentence(12, 10), *a[10:15]]),
    ]


@pytest.mark.parametrize("block_bytes", [8 << 20, 100])
def test_contamination_of_odd_documents(spark, block_bytes):
    """Also with the benchmark in several blocks."""
    docs, benchmark = documents(spark, _contaminated()), _benchmark(spark)
    rows = decontaminate.search(docs, benchmark, block_bytes=block_bytes).collect()
    items = [("null" if r.item_id is None else str(r.item_id), r.text) for r in benchmark.collect()]
    for r, (n, flags, names) in zip(rows, contamination([(bytes(r.text).decode() if r.text else r.text) for r in rows], items)):
        hit = [False] * n
        for s in r.hit_words:
            hit[s.start : s.end] = [True] * (s.end - s.start)
        assert (r.n_words, hit, set(r.items)) == (n, flags, names)
    cleaned = decontaminate.remove(docs, benchmark, block_bytes=block_bytes)
    assert cleaned.schema == docs.schema
    left = cleaned.collect()
    assert all(not any(f) for _, f, _ in contamination([r.text for r in left], items))
    before = {r.doc_id: r.text for r in docs.collect()}
    hit = {r.doc_id for r in rows if r.hit_words}
    assert all(r.text == before[r.doc_id] for r in left if r.doc_id not in hit and r.doc_id is not None)
    assert all(r.n_chars == len(r.text) for r in left if r.text is not None)


@pytest.mark.parametrize("block_bytes", [8 << 20, 100, 40])
def test_cut_texts_do_not_depend_on_blocks(spark, monkeypatch, block_bytes):
    """Phrases of several items overlap, and what is left reads as another one."""
    monkeypatch.setattr(decontaminate, "BLOCKS_AT_ONCE", 2)
    w = [f"w{i:02d}x" for i in range(60)]
    items = [(k, " ".join(w[a : a + 10])) for k, a in enumerate((0, 5, 12, 20))]
    items += [(9, " ".join([*w[40:45], *w[50:55]])), (10, " ".join(w[45:50])), (11, "start the end")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    texts = [
        "start here  " + " ".join(w[:30]) + "  the end",  # overlapping items
        " ".join([*w[40:55], "stays"]),  # 45-50 goes, then what is around it
        "x " + " ".join(w[3:13]) + " y",
        None,
        "start " + " ".join(w[45:50]) + " the end",  # nothing is left
    ]
    docs = documents(spark, texts, repeat=False)
    left = {r.doc_id: r.text for r in decontaminate.remove(docs, benchmark, block_bytes=block_bytes).collect()}
    assert left[0] == "start here    the end" and left[1] == "  stays".replace("  ", " ")
    assert left[2] == texts[2] and left[3] is None and left[4] == ""


def test_no_benchmark_and_no_documents(spark):
    none = _benchmark(spark).limit(0)
    assert decontaminate.search(documents(spark), none).filter("size(items) > 0").count() == 0
    assert decontaminate.search(empty(spark), _benchmark(spark)).count() == 0
    assert decontaminate.remove(empty(spark), _benchmark(spark)).count() == 0


def test_registered_decontamination(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = queries.op3_decontaminate(spark, SF).orderBy("doc_id").collect()
    for r, d, (n, flags, names) in zip(rows, docs, contamination([d.text for d in docs], items), strict=True):
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        assert tuple(r) == (d.doc_id, n, sum(flags), len(names), digest, any(flags))
    assert any(r.contaminated for r in rows)
