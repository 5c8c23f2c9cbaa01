"""Quality scores learned from preference pairs (Bradley-Terry), cut at a score quantile.

A document's features are shares of its ``text_stats`` counts and nothing else; labels, lang,
source and doc_id never enter a score. From labelled documents, a pair prefers one of label 1
to one of label 0; the weights minimise the logistic loss of the difference of the two
feature vectors, log(1 + exp(-w (x_good - x_bad))). The cut is the quantile of the training
scores at the share of label 0 (mid-way between its neighbours), and scores are mapped so
that the cut gets ``CUT``: score = 1 / (1 + exp(-(s - cut) / scale) * (1 - CUT) / CUT).

Features are written once for all documents. Every labelled row is learned from: equal ones
are collapsed and counted, the others dealt by their hash into groups of about ``GROUP``, in
which each preferred row is paired with each other one (the rarer label's rows stand in as many
groups as give each ``RARER`` of them on average). A pass over the groups sums the loss, its
gradient and its curvature in the tasks; the driver takes Newton's steps from these sums. Means,
spreads, the cut (an exact order statistic) and the scale are those of all labelled rows too.

Null and empty texts have all-zero shares and a score like any other. Unlabelled and repeated
rows are scored like any other; a label that is null is left out; several labels of one doc_id
are all used. Without labels of both kinds every score is 0.5. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sluice.llm.common import groups, store
from sluice.llm.text_stats import with_counts

CUT = 0.3

#: Share of which count in which.
_SHARES = (
    ("n_symbols", "word_chars"),
    ("n_upper", "word_chars"),
    ("n_marks", "word_chars"),
    ("n_digits", "word_chars"),
    ("n_dup_lines", "n_lines"),
    ("n_repeat_words", "n_words"),
    ("n_same_words", "n_words"),
)


def features() -> Column:
    shares = [F.col(a) / F.greatest(F.col(b), F.lit(1)) for a, b in _SHARES]
    # The same shares on a scale on which small ones differ, the variety of words, lengths.
    roots = [F.sqrt(s) for s in shares]
    variety = F.log1p(F.col("n_distinct_words")) / F.greatest(F.log1p("n_words"), F.lit(1e-9))
    length = F.least(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1)), F.lit(20)) / 20
    return F.array(*shares, *roots, variety, length, F.least(F.log1p("n_words") / 10, F.lit(1.0))).cast("array<double>")


class Ranker:
    """Bradley-Terry weights, and the mapping of raw scores to 0..1."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray, cut: float, scale: float):
        self.mean, self.spread, self.weights, self.cut, self.scale = mean, spread, weights, cut, scale

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((self.raw(x) - self.cut) / self.scale, -50, 50)
        return 1 / (1 + np.exp(-z) * (1 - CUT) / CUT)


#: Distinct labelled rows of a group, and the least number of the rarer label's among them.
GROUP, RARER = 1024, 32


def pair_sums(good: np.ndarray, n_good: np.ndarray, bad: np.ndarray, n_bad: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number, loss, gradient and curvature, in one row, of all pairs of two sets of rows, each
    row counted as often as it occurs."""
    margin = (good @ w)[:, None] - (bad @ w)[None, :]
    weight = n_good[:, None] * n_bad[None, :]
    wrong = 1 / (1 + np.exp(np.clip(margin, -500, 500)))
    pull, bend = weight * wrong, weight * wrong * (1 - wrong)
    gradient = pull.sum(axis=0) @ bad - pull.sum(axis=1) @ good
    across = good.T @ (bend @ bad)
    curvature = (good.T * bend.sum(axis=1)) @ good + (bad.T * bend.sum(axis=0)) @ bad - across - across.T
    return np.concatenate([[weight.sum(), (weight * np.logaddexp(0, -margin)).sum()], gradient, curvature.ravel()])


def descend(sums: Callable[[np.ndarray], np.ndarray], width: int, penalty: float, rounds: int = 30) -> np.ndarray:
    """The weights with the least mean loss of all pairs (``sums`` as of ``pair_sums``) plus
    penalty / 2 times their squares: Newton's steps, halved until the loss falls."""

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        found = sums(w)
        mean = found[1:] / found[0]
        curvature = mean[1 + width :].reshape(width, width) + penalty * np.eye(width)
        return mean[0] + penalty / 2 * w @ w, mean[1 : 1 + width] + penalty * w, curvature

    w = np.zeros(width)
    loss, gradient, curvature = at(w)
    while rounds > 0 and np.abs(gradient).max() > 1e-6:
        step = np.linalg.solve(curvature, gradient)
        while rounds > 0:
            rounds -= 1
            there = at(w - step)
            if there[0] <= loss:
                w, (loss, gradient, curvature) = w - step, there
                break
            step = step / 2
    return w


def _scaled(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / spread, -8, 8)


def fit(good: np.ndarray, bad: np.ndarray, share_bad: float, penalty: float = 1e-4) -> Ranker | None:
    """The ranker of preferred rows ``good`` over ``bad``, arrays in memory, from all their pairs;
    None unless there are both."""
    if not len(good) or not len(bad):
        return None
    both = np.concatenate([good, bad])
    mean, spread = both.mean(axis=0), np.maximum(both.std(axis=0), 1e-6)
    a, b = (_scaled(x, mean, spread) for x in (good, bad))
    w = descend(lambda w: pair_sums(a, np.ones(len(a)), b, np.ones(len(b)), w), a.shape[1], penalty)
    goods, bads = a @ w, b @ w
    # The quantile at the share of label 0 among all labelled rows, each label weighed by it.
    scores = np.concatenate([goods, bads])
    weight = np.concatenate([np.full(len(a), (1 - share_bad) / len(a)), np.full(len(b), share_bad / len(b))])
    order = np.argsort(scores, kind="stable")
    k = min(int(np.searchsorted(np.cumsum(weight[order]), share_bad)), len(order) - 1)
    cut = float(scores[order][k] + scores[order][min(k + 1, len(order) - 1)]) / 2
    return Ranker(mean, spread, w, cut, max(float(np.std(goods)), 1e-6))


def dealt(rows: DataFrame, sizes: dict[bool, int]) -> DataFrame:
    """``rows`` (good, x, n; ``sizes`` of each label) with their group; a row of the rarer label
    stands in several groups where there are too few of them."""
    rarer = sizes[True] < sizes[False]
    n_groups = -(-sum(sizes.values()) // GROUP)
    copies = min(n_groups, -(-RARER * n_groups // sizes[rarer]))
    k = F.explode(F.sequence(F.lit(0), F.when(F.col("good") == rarer, copies - 1).otherwise(0)))
    return rows.withColumn("k", k).withColumn("group", F.pmod(F.xxhash64("x") + F.col("k"), F.lit(n_groups))).drop("k")


def value_at(values: DataFrame, rank: int, most: int = 10_000) -> float:
    """The ``rank``-th (from 1) of the ascending ``raw`` of ``values`` (raw, n: distinct, and how
    often each occurs). The range is narrowed bin by bin until at most ``most`` values are left."""
    left, before = values, 0
    while True:
        seen = left.agg(F.min("raw").alias("low"), F.max("raw").alias("high"), F.count("*").alias("many")).first()
        place = F.col("raw")
        if seen["many"] > most:
            place = F.least(F.floor((F.col("raw") - seen["low"]) / (seen["high"] - seen["low"]) * 1024), F.lit(1023))
        bins = left.groupBy(place.alias("place")).agg(F.sum("n").alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high"))
        for r in sorted(bins.collect(), key=lambda r: r["low"]):
            if before + r["n"] >= rank:
                break
            before += r["n"]
        if seen["many"] <= most:
            return r["low"]
        left = values.filter(F.col("raw").between(r["low"], r["high"]))


def train(featured: DataFrame, labels: DataFrame, training: Column, penalty: float = 1e-4) -> Ranker | None:
    """Fit on all labelled rows of ``featured`` (doc_id, x) that satisfy ``training``."""
    marked = labels.filter("quality is not null").select("doc_id", (F.col("quality") == 1).alias("good"))
    joined = featured.filter(training).join(marked, "doc_id")
    rows = store(joined.groupBy("good", "x").agg(F.count("*").alias("n")), "labelled")
    found = {r["good"]: r for r in rows.groupBy("good").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()}
    if len(found) < 2:
        return None
    each = rows.select("n", F.posexplode("x").alias("i", "v")).groupBy("i")
    first = each.agg((F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("mean"))
    mean = np.array([r["mean"] for r in sorted(first.collect())])
    apart = F.transform("x", lambda v, i: v - F.get(F.array(*map(F.lit, mean.tolist())), i))
    off = rows.select("n", F.posexplode(apart).alias("i", "v")).groupBy("i")
    second = off.agg((F.sum(F.col("n") * F.col("v") * F.col("v")) / F.sum("n")).alias("square"))
    spread = np.maximum(np.sqrt([r["square"] for r in sorted(second.collect())]), 1e-6)
    width = len(mean)
    grouped = store(dealt(rows, {k: r["rows"] for k, r in found.items()}), "groups")
    grouped = grouped.repartition("group").sortWithinPartitions("group")

    def matrix(table) -> np.ndarray:
        x = table.column("x").combine_chunks() if isinstance(table, pa.Table) else table.column("x")
        return _scaled(np.asarray(x.flatten()).reshape(len(x), -1), mean, spread)

    def sums(w: np.ndarray) -> np.ndarray:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(2 + width + width * width)
            for group in groups(batches, ["group"]):
                x, n = matrix(group), np.asarray(group.column("n")).astype(float)
                good = np.asarray(group.column("good"))
                total += pair_sums(x[good], n[good], x[~good], n[~good], w)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["sums"])

        return np.sum([r["sums"] for r in grouped.mapInArrow(work, "sums array<double>").collect()], axis=0)  # a row a task

    w = descend(sums, width, penalty)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = pa.array(matrix(batch) @ w)
                yield pa.RecordBatch.from_arrays([batch.column("good"), batch.column("n"), raw], names=["good", "n", "raw"])

    scored = store(rows.select("good", "n", "x").mapInArrow(score, "good boolean, n long, raw double"), "labelled-scores")
    values = store(scored.groupBy("raw").agg(F.sum("n").alias("n")), "score-counts")
    # Mid-way between the scores on both sides of the share of label 0.
    n_bad = found[False]["n"]
    cut = (value_at(values, n_bad) + value_at(values, n_bad + 1)) / 2
    n, off = F.col("n"), F.col("raw") - cut
    r = scored.filter("good").agg((F.sum(n * off) / F.sum(n)).alias("mean"), (F.sum(n * off * off) / F.sum(n)).alias("square")).first()
    return Ranker(mean, spread, w, cut, max(float(np.sqrt(max(0.0, r["square"] - r["mean"] ** 2))), 1e-6))


def classify(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from ``CUT`` on) of every document; rows that
    are held out are not learned from."""
    counted = with_counts(docs.select("doc_id", held_out.alias("held_out"), "text")).drop("text")
    featured = store(counted.select("doc_id", "held_out", features().alias("x")), "features")
    ranker = train(featured, labels, ~F.col("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(ranker)
    kept = featured.schema.fields[:2]
    schema = StructType([*kept, StructField("score", DoubleType())])

    def work(batches):
        for batch in batches:
            x = batch.column("x")
            x = np.asarray(x.flatten()).reshape(len(x), -1) if len(x) else np.zeros((0, 1))
            score = shared.value.score(x) if shared.value and len(x) else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score)], names=["doc_id", "held_out", "score"]
            )

    scored = featured.mapInArrow(work, schema)
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
