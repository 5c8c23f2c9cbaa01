"""Continuous ingestion of a feed folder with Structured Streaming.

New CSV files dropped into a folder are picked up by the file source and go through the
same cleaning and keyed load as a batch run. What waits for one trigger may hold several
drops; they are loaded one after the other, in the order of their numbers in the stream's
ledger (``streaming.ledger``: file time, then path, at first sight), so a key that two drops
update gets the later drop's values, however the files are spread over triggers. A drop is the
folder a file lies in (``drops="folders"``, for a folder of drops such as ``inbox/*``) or the
file itself (``drops="files"``).

The cleaning is stateless, so no streaming state is kept; the checkpoint only records which
files were consumed. A retried micro-batch stages into the same folder and its upserts are
idempotent (merging a batch twice equals merging it once). A drop of several files may span
triggers; its rows keep the drop's place in the order.

Full replacement is refused: a micro-batch need not hold a whole drop, and replacing the
target by part of one would lose rows. Load such tables with ``plans.run.load_table``.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.operators import journal
from sluice.operators.clean import accepted_observed, align
from sluice.operators.load import remove_path, upsert
from sluice.sources.delimited import SEPARATOR
from sluice.spec import TableSpec
from sluice.streaming.ledger import DROP, KEEP, Ledger, drop_of


def read_feed_stream(spark: SparkSession, spec: TableSpec, folder: str, max_files: Optional[int] = None) -> DataFrame:
    """Streaming all-string scan of the spec's source columns; each file's header is checked."""
    reader = (
        spark.readStream.schema(spec.raw_schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", SEPARATOR)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(folder)


def load_micro_batch(
    spark: SparkSession, spec: TableSpec, target: str, work: str, journal_path: Optional[str], ledger: Ledger
):
    """A ``foreachBatch`` function loading each micro-batch's drops into ``target``, in order.

    The batch is staged once, a folder a drop; each drop's load reads its own folder alone."""

    def run(batch: DataFrame, batch_id: int) -> None:
        run_id = journal.new_run_id(f"{spec.name}:{batch_id}")
        if journal_path:
            journal.log_start(spark, journal_path, run_id)
        try:
            stage = f"{work}/stage/{batch_id}"  # fixed per batch: a retry rewrites it
            rows, counters = accepted_observed(batch, spec, keep=(DROP,))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(DROP).parquet(stage)
            staged = spark.read.schema(rows.schema).parquet(stage)
            stats, loads = counters.get(), []
            waiting = [r[0] for r in staged.select(DROP).distinct().collect()]  # one row a drop
            numbers = ledger.order(batch_id, waiting)
            for drop in sorted(waiting, key=numbers.__getitem__):
                mine = align(staged.filter(F.col(DROP) == drop), spec)  # PartitionFilters
                mine = ledger.admit(spec, mine, numbers[drop], batch_id, stats["rows_after_filter"])
                loads.append(upsert(spark, spec, mine, target, batch_is_distinct=not spec.distinct))
            ledger.forget(spec)
            if spec.distinct:
                stats["rows_output"] = sum(load["rows_batch"] for load in loads)
        except Exception as exc:
            if journal_path:
                journal.log_finish(spark, journal_path, run_id, False, str(exc), journal.failure_detail(exc, spec.name))
            raise
        remove_path(spark, stage)  # the batch is loaded; a failed one keeps its stage
        if journal_path:
            journal.log_finish(spark, journal_path, run_id, True, extra={"transform": stats, "loads": loads})

    return run


def stream_feed(
    spark: SparkSession,
    spec: TableSpec,
    folder: str,
    target: str,
    checkpoint: str,
    *,
    journal_path: Optional[str] = None,
    available_now: bool = True,
    processing_time: Optional[str] = None,
    max_files: Optional[int] = None,
    drops: Optional[str] = None,
    keep_keys: int = KEEP,
) -> StreamingQuery:
    """Start a query that merges every new file of ``folder`` into ``target``.

    ``drops`` says what one drop is; by default a folder pattern (``inbox/*``) means folders,
    a plain folder means files. The ledger of drops lies below ``checkpoint`` and holds the keys
    of the last ``keep_keys`` drops.

    ``available_now`` processes what is there and stops (scheduled runs); otherwise
    ``processing_time`` (e.g. ``"1 minute"``) keeps it running.
    """
    if spec.mode != "upsert":
        raise ValueError(f"{spec.name}: a stream of files cannot replace a table; load whole drops instead")
    rows = read_feed_stream(spark, spec, folder, max_files)
    drops = drops or ("folders" if "*" in folder else "files")
    ledger = Ledger(spark, f"{checkpoint}/ledger", folder, drops, keep_keys)
    writer = (
        rows.select(*rows.columns, drop_of(drops))
        .writeStream.foreachBatch(load_micro_batch(spark, spec, target, checkpoint, journal_path, ledger))
        .option("checkpointLocation", f"{checkpoint}/offsets")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.queryName(f"sluice_{spec.name}").start()
