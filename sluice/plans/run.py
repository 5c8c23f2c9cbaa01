"""Loading one table (D7) and a whole run of tables (D8), journaled.

``load_table`` reads the feed once: the scan, the typed projection and the filter run
in one map-only job that writes the accepted rows to a staging folder of the run, with
the input and accepted counters observed on that write (exact even with retried
tasks, since no shuffle precedes the write). Everything after — key check, distinct,
merge or overwrite — reads the staged Parquet, never the text again. A successful load
drops its staging folder; a failed one leaves it, so a rerun or an inspection can
start from it.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Iterable, Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluice.operators import journal
from sluice.operators.clean import MALFORMED, Counters, accepted_observed, align
from sluice.operators.load import check_batch, check_overwrite, merge_batch, remove_path, write_overwrite
from sluice.plans.tables import RUN_ORDER
from sluice.sources.delimited import read_feed
from sluice.spec import TableSpec
from sluice.workspace import new_dir


def stage_accepted(spark: SparkSession, spec: TableSpec, source: str, stage_dir: str) -> tuple[DataFrame, Counters]:
    """The one pass over the text: accepted rows → ``stage_dir/accepted``; counters, among
    them the rows that break NOT NULL or a length, the reasons of rejected rows and the malformed
    records."""
    raw = read_feed(spark, spec, source, malformed=MALFORMED)
    rows, counters = accepted_observed(raw, spec)
    # Amounts hardly repeat: a dictionary of them is built for nothing.
    plain = {f"parquet.enable.dictionary#{f.name}": "false" for f in spec.fields if f.dtype == "double"}
    rows.write.mode("overwrite").options(**plain).parquet(f"{stage_dir}/accepted")
    staged = spark.read.schema(rows.schema).parquet(f"{stage_dir}/accepted")
    return align(staged, spec), counters


def prepare_table(spark: SparkSession, spec: TableSpec, source: str, stage_dir: str) -> dict:
    """Everything before the target is touched: the text pass and the checks.

    Stages the accepted rows (counters observed on that write) and runs the batch
    checks (keys, NOT NULL, lengths; touched partitions). Raises on a refused batch.
    Reads no target and writes only ``stage_dir``, so tables can be prepared side by
    side without changing what a failed run leaves behind.
    """
    batch, counters = stage_accepted(spark, spec, source, stage_dir)
    stats = {**counters.get(), "rows_malformed": counters.malformed(), "reject_reasons": counters.rejects()}
    if spec.mode == "overwrite":
        batch = batch.dropDuplicates() if spec.distinct else batch
        check = check_overwrite(spec, batch, counters.violations())  # counted by the staging write
    else:
        check = check_batch(spec, batch, batch_is_distinct=not spec.distinct, work_dir=stage_dir)
        if spec.distinct:
            # No key conflicts: one distinct row per key.
            stats["rows_output"] = check["keys"]
    return {"spec": spec, "batch": batch, "stats": stats, "check": check, "stage": stage_dir}


def commit_table(spark: SparkSession, prepared: dict, target: str, *, keep_stage: bool = False) -> dict:
    """Write a prepared batch into its target; drop the staging folder after success."""
    spec, batch, stats = prepared["spec"], prepared["batch"], prepared["stats"]
    if spec.mode == "overwrite":
        load = write_overwrite(spark, spec, batch, target, prepared["check"])
        if spec.distinct:
            stats["rows_output"] = load["rows_loaded"]
    else:
        load = merge_batch(spark, spec, target, prepared["check"])
    load["stage"] = prepared["stage"] if keep_stage else None
    if not keep_stage:
        remove_path(spark, prepared["stage"])
    return {"table": spec.name, "transform": stats, "load": load}


def load_table(
    spark: SparkSession,
    spec: TableSpec,
    source: str,
    target: str,
    *,
    stage_dir: Optional[str] = None,
    keep_stage: bool = False,
) -> dict:
    """Extract, clean and load one table; returns ``{table, transform, load}``.

    The staging folder is dropped once the load has succeeded (``keep_stage`` keeps
    it); a failed load leaves it for inspection or a rerun.
    """
    stage_dir = stage_dir or new_dir(spark, f"stage/{spec.name}")
    return commit_table(spark, prepare_table(spark, spec, source, stage_dir), target, keep_stage=keep_stage)


def run_all(
    spark: SparkSession,
    sources: dict[str, str],
    targets: dict[str, str],
    journal_path: str,
    *,
    specs: Iterable[TableSpec] = RUN_ORDER,
    run_id: Optional[str] = None,
    parallelism: int = 4,
) -> dict:
    """Load every table in order, journaled; the first failure ends the run.

    Journal events: ``Started`` before the first table, then ``Success`` with the
    per-table counters and the Spark version, or ``Failed`` with the error, the table
    that failed, its staging folder, the tables committed before it and the traceback (the
    exception is re-raised).

    Preparing a table (text pass, staging, checks) touches no target, so up to
    ``parallelism`` tables are prepared at once from driver threads (Spark schedules
    their jobs side by side). Commits run one table after another in ``specs`` order;
    the first table whose preparation or commit fails ends the run, and no later table
    is committed — the same targets as a strictly sequential run. Spark jobs of
    preparations that are still under way are cancelled then.
    """
    specs = list(specs)
    run_id = run_id or uuid.uuid4().hex
    run_dir = new_dir(spark, "runs")
    journal.log_start(spark, journal_path, run_id)
    tables: dict[str, dict] = {}

    tag = f"sluice-prepare-{uuid.uuid4().hex}"

    def prepare(spec: TableSpec) -> dict:
        if parallelism > 1:  # a thread of the pool; its jobs carry the tag
            spark.sparkContext.addJobTag(tag)
        return prepare_table(spark, spec, sources[spec.feed_name], f"{run_dir}/{spec.name}")

    step = "start"
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism), thread_name_prefix="sluice-prepare") as pool:
            # parallelism 1: each table is prepared only when its turn comes.
            pending = [pool.submit(prepare, spec) for spec in specs] if parallelism > 1 else [None] * len(specs)
            try:
                for i, spec in enumerate(specs):
                    step = spec.name
                    prepared = pending[i].result() if pending[i] is not None else prepare(spec)
                    tables[spec.name] = commit_table(spark, prepared, targets[spec.name])
            except BaseException:
                for fut in pending:  # preparations not started yet are dropped
                    if fut is not None:
                        fut.cancel()
                if parallelism > 1:  # and those under way end with their jobs
                    spark.sparkContext.cancelJobsWithTag(tag)
                raise
    except Exception as exc:
        detail = {**journal.failure_detail(exc, step), "stage": f"{run_dir}/{step}", "committed": list(tables)}
        journal.log_finish(spark, journal_path, run_id, False, error_message=str(exc), extra=detail)
        raise
    result = {"run_id": run_id, "tables": tables, "spark_version": spark.version}
    journal.log_finish(spark, journal_path, run_id, True, extra={"tables": tables, "spark_version": spark.version})
    return result


COUNTER_SCHEMA = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("rows_input", T.LongType()),
        T.StructField("rows_after_filter", T.LongType()),
        T.StructField("rows_output", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
    ]
)


def counters_frame(spark: SparkSession, tables: dict[str, dict]) -> DataFrame:
    """Per-table counters of a run as a DataFrame (a handful of rows, one per table)."""
    rows = [
        (name, r["transform"]["rows_input"], r["transform"]["rows_after_filter"], r["transform"]["rows_output"],
         r["transform"]["rows_rejected"])
        for name, r in tables.items()
    ]
    return spark.createDataFrame(rows, COUNTER_SCHEMA)
