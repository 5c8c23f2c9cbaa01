"""Quality rules whose cut-offs follow the corpus: quantile sketches per language and source.

Each rule is a count that junk raises, out of a size (``RULES``): a share. A quantile sketch of
each share is kept for each (lang, source) group: the number of documents in each of some hundred
logarithmic buckets (a relative error of 1 percent). Sketches merge by adding their buckets, so a
task folds its rows first, a group's sketches make its language's one and those make the whole
corpus's; they are the same however the rows are dealt, so runs repeat.

The ordinary level of a group is the median of the share plus ``reach`` times the distance from
its lower decile to the median: the half of the documents that junk cannot reach says how much
the share varies. A document breaks the rule if its count is more than ``reach`` standard
deviations above what that level explains for its size, as counts vary by chance (the square
root of a count has a standard deviation of one half, whatever the count). Of a document that is
longer than the group's median (of another sketch), as much counts as that length would have, as
a long text's share needs no less excess than an ordinary one's. No share is fixed: a source
that is written with many symbols has a high level, one without has none, and short documents
get the room that few words need.

Groups of fewer than ``least`` documents use their language's sketch, small languages the
corpus's; a group's level is never above what 95 percent of its language's documents have (or the
language's own level), so that a source full of junk doesn't excuse itself. Documents join the
levels on (lang, source).

Besides, a document fails the base rule with fewer than ``MIN_WORDS`` words or more than
``MAX_REPEAT_PERCENT`` percent of its words in repeated 5-word windows. Null or empty texts
therefore fail. A null lang or source is a group of its own. Repeated rows count as often as
they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import store
from sluice.llm.text_stats import COUNTS, with_counts

MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Rule: what is counted, and out of how many.
RULES = {
    "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_upper", "word_chars"),
    "stutter": ("n_same_words", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
}
_SIZES = sorted({size for _, size in RULES.values()})
#: Standard deviations, and distances from lower decile to median.
REACH = 4.0
#: Ratio of neighbouring buckets of a sketch, and the least share that is told from none.
_RATIO, _LEAST_SHARE = 1.02, 2.0**-30


def base_failed() -> Column:
    too_few = F.col("n_words") < MIN_WORDS
    return too_few | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def bucket(share: Column) -> Column:
    """Bucket of a share (or size) of 0 or more: 0 for none."""
    nth = F.floor(F.log(share / _LEAST_SHARE) / F.log(F.lit(_RATIO))) + 1
    return F.when(share > _LEAST_SHARE, nth).otherwise(0).cast("int")


def bucket_value(number: Column) -> Column:
    """The middle of a bucket's shares."""
    return F.when(number > 0, _LEAST_SHARE * F.pow(F.lit(_RATIO), number - 0.5)).otherwise(0.0)


def sketches(counted: DataFrame) -> DataFrame:
    """lang, source, rule, bucket, n: the sketches of all groups. Documents without words, which
    the base rule rejects, are left out."""
    shares = [
        F.struct(F.lit(r).alias("rule"), bucket(F.col(a) / F.greatest(F.col(b), F.lit(1))).alias("bucket"))
        for r, (a, b) in RULES.items()
    ]
    shares += [F.struct(F.lit(b).alias("rule"), bucket(F.col(b)).alias("bucket")) for b in _SIZES]
    each = counted.filter("n_words > 0").select("lang", "source", F.explode(F.array(*shares)).alias("s"))
    return each.groupBy("lang", "source", "s.rule", "s.bucket").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, *groups: str) -> DataFrame:
    """The sketches of wider groups: buckets are added."""
    return sketch.groupBy(*groups, "rule", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, groups: list[str], wanted: dict[str, float]) -> DataFrame:
    """``groups``, rule, n (documents) and a column for each of the ``wanted`` quantiles."""
    window = Window.partitionBy(*groups, "rule")  # as many rows as a sketch has buckets
    upto = sketch.withColumn("upto", F.sum("n").over(window.orderBy("bucket"))).withColumn("all", F.sum("n").over(window))
    lowest = [bucket_value(F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("bucket")))).alias(c) for c, q in wanted.items()]
    return upto.groupBy(*groups, "rule").agg(F.max("all").alias("n"), *lowest)


def levels(counted: DataFrame, reach: float = REACH, least: int = 100) -> DataFrame:
    """lang, source, the ordinary level of each rule's share (level_<rule>) and the median of each
    size (size_<count>); one row a group."""
    own = store(sketches(counted), "sketches")
    half = {"low": 0.1, "mid": 0.5}
    level = (F.col("mid") + reach * (F.col("mid") - F.col("low"))).alias("level")
    mine = quantiles(own, ["lang", "source"], half).select("lang", "source", "rule", "n", "mid", level)
    theirs = quantiles(merged(own, "lang"), ["lang"], half | {"high": 0.95}).select(
        F.col("lang").alias("of_lang"), F.col("rule").alias("of_rule"), F.col("n").alias("l_n"), level.alias("l_level"), "high", F.col("mid").alias("l_mid")
    )
    every = quantiles(merged(own), [], half).select(F.col("rule").alias("a_rule"), level.alias("a_level"), F.col("mid").alias("a_mid"))  # a row a rule
    joined = mine.join(theirs, mine["lang"].eqNullSafe(theirs["of_lang"]) & (mine["rule"] == theirs["of_rule"]))
    joined = joined.join(F.broadcast(every), joined["rule"] == every["a_rule"])
    wide = F.when(F.col("l_n") >= least, F.col("l_level")).otherwise(F.col("a_level"))
    most = F.when(F.col("l_n") >= least, F.greatest("high", "l_level")).otherwise(F.col("a_level"))
    chosen = F.when(F.col("n") >= least, F.least("level", most)).otherwise(wide)
    size = F.when(F.col("n") >= least, F.col("mid")).otherwise(F.when(F.col("l_n") >= least, F.col("l_mid")).otherwise(F.col("a_mid")))
    pick = lambda r, c: F.max(F.when(F.col("rule") == r, F.col(c)))
    by_rule = [pick(r, "chosen").alias(f"level_{r}") for r in RULES] + [pick(b, "size").alias(f"size_{b}") for b in _SIZES]
    return joined.withColumn("chosen", chosen).withColumn("size", size).groupBy("lang", "source").agg(*by_rule)


def excess(rule: str) -> Column:
    """Standard deviations by which a rule's count is above what its level explains."""
    count, size = (F.col(c) for c in RULES[rule])
    part = F.least(F.lit(1.0), F.col(f"size_{RULES[rule][1]}") / F.greatest(size, F.lit(1)))
    root = lambda c: F.sqrt(c + 0.375)  # noqa: E731  the 3/8 steadies small counts
    return 2 * (root(count * part) - root(F.col(f"level_{rule}") * size * part))


def judge(counted: DataFrame, limits: DataFrame, reach: float = REACH, broadcast_rows: int = 50_000) -> DataFrame:
    """``counted`` with base_failed, kept and ``broken`` (names of the rules broken).

    ``limits`` is stored and counted first: it is broadcast up to ``broadcast_rows`` groups,
    beyond that Spark chooses the join (and splits a hot group's rows).
    """
    found = [*(f"level_{r}" for r in RULES), *(f"size_{b}" for b in _SIZES)]
    limits = store(limits.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), *found), "levels")
    side = F.broadcast(limits) if limits.count() <= broadcast_rows else limits
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    joined = counted.drop("base_failed", "kept", "broken").join(side, same, "left")
    broken = F.array_compact(F.array(*[F.when(excess(r) > reach, F.lit(r)) for r in RULES]))
    judged = joined.withColumn("base_failed", base_failed()).withColumn("broken", broken)
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
    return judged.drop("of_lang", "of_source", *found)


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed, broken and kept; one row a document."""
    counted = store(with_counts(docs.select("doc_id", "lang", "source", "text")).drop("text"), "counts")
    return judge(counted, levels(counted))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns. The counts are written once, beside the
    texts, so that these needn't be joined by an id that rows may share."""
    rest = [c for c in docs.columns if c != "text"]
    beside = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("row")
    counted = store(with_counts(docs.select("lang", "source", "text", beside)), "counted")
    kept = judge(counted, levels(counted.select("lang", "source", *COUNTS))).filter("kept")
    return kept.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
