"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """node, label: the least node reachable, for every node of ``edges`` (columns a, b: long).

    Each round points every node's larger neighbours at its least neighbour and then its
    smaller ones too, which takes a number of rounds that grows with the logarithm of the
    largest component. Rounds are written to the shared folder, so none is repeated when an
    executor is lost; only a count and a checksum reach the driver. Loops are ignored.
    """
    high, low = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    now = store(edges.filter("a <> b").select(high, low).distinct(), "components")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = store(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "components")
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
