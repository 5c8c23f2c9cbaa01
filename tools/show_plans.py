"""Print the physical plans of the load path, from the library's own frames: staging pass,
rows by key, batch summary, one-month merge.

Usage: python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from sluice.operators import clean
    from sluice.operators import load as L
    from sluice.plans import run as R
    from sluice.plans import tables as TB
    from sluice.sources import feeds
    from sluice.sources.delimited import read_feed
    from sluice.workspace import new_dir

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = SparkSession.builder.master("local[8]").config(map={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spec = TB.FT_BALANCE_F

    source = feeds.materialize_feed(spark, sf, spec.name)
    rows, _ = clean.accepted_observed(read_feed(spark, spec, source), spec)
    print("=" * 30, "1. staging pass (scan → parse → count → filter → count → write)")
    rows.explain("formatted")

    batch, _ = R.stage_accepted(spark, spec, source, new_dir(spark, "plans"))
    keyed = L.keyed_rows(batch, spec, distinct_rows=True)
    print("=" * 30, "2. rows by key (the one shuffle of the batch)")
    keyed.explain("formatted")

    target = new_dir(spark, "plans") + "/" + spec.name
    L.upsert(spark, spec, batch, target, batch_is_distinct=False)
    part = L.partition_column(spec)
    month = batch.select(L.partition_value(spec).alias(part)).agg(F.max(part)).first()[0]
    day = batch.filter(L.partition_value(spec) == F.lit(month))
    summary = L.check_batch(spec, day, batch_is_distinct=False)
    print("=" * 30, "3. one-month merge (touched folders, anti join, union)")
    L.merged_rows(spark, spec, target, summary).explain("formatted")


if __name__ == "__main__":
    main()
