"""Load journal: an append-only event dataset folded into one state row per run.

Events are (run_id, at, event, error_message, extra): ``Started`` when an attempt begins,
``Success`` or ``Failed`` when it ends. The journal is only ever appended to, so
concurrent writers and retried tasks never rewrite each other's files. The current
state of each run is a single partially aggregated ``groupBy(run_id)``:

* ``started_at``  — the last ``Started`` event: a run that is started again is open again
  (a run without one is not a run: dropped);
* ``status``, ``finished_at``, ``error_message``, ``extra`` come from the last finish, but
  only if it happened at or after that start — a finish recorded before is a no-op, like an
  update of a row not yet inserted. Of finishes at one instant the greatest
  (event, error_message, extra) counts, NULLs least, so the state is the same on every read.

Writers give every attempt a fresh id (``new_run_id``), so attempts do not share a row.

Compaction keeps the number of files small. The state of a run depends on two of its events
alone, the last start and the last finish, and taking maxima again changes nothing. So a
compacted file holds those two events, as events: reading it together with newer ones, or even
with the events that it stands for, gives the same state. ``compact`` first writes the compacted
file and then deletes the files that it covers, so a reader finds every event at least once at
any moment, and a compaction that is lost half-way only leaves more files. Files are kept in
levels: when a level holds ``FAN_IN`` files they become one file of the next, so an event is
rewritten a logarithmic number of times and a journal of n events has about
``FAN_IN`` x log(n) files.
"""

from __future__ import annotations

import json
import traceback
import uuid
from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STARTED, SUCCESS, FAILED = "Started", "Success", "Failed"  # fixed values: run states

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("at", T.TimestampType(), False),
        T.StructField("event", T.StringType(), False),
        T.StructField("error_message", T.StringType(), True),
        T.StructField("extra", T.StringType(), True),
    ]
)

#: Files of a level that are compacted into one of the next.
FAN_IN = 32
_LEVEL = "level"  # folder of compacted files: level-1, level-2, ...

STATE_COLUMNS = ["run_id", "started_at", "finished_at", "status", "error_message", "extra"]


def _append(spark: SparkSession, path: str, run_id: str, event: str, error: Optional[str], extra: Optional[str]) -> None:
    """One event row, stamped with ``current_timestamp()`` (fixed once per query by the
    optimizer), appended as one small file; the fold reads them all."""
    row = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("at"),
        F.lit(event).alias("event"),
        F.lit(error).cast("string").alias("error_message"),
        F.lit(extra).cast("string").alias("extra"),
    )
    row.write.mode("append").parquet(path)


def new_run_id(name: str = "run") -> str:
    """An id no other attempt has: ``name:`` and a random part."""
    return f"{name}:{uuid.uuid4().hex}"


def log_start(spark: SparkSession, path: str, run_id: str) -> str:
    _append(spark, path, run_id, STARTED, None, None)
    return run_id


def detail_json(extra: Optional[dict]) -> Optional[str]:
    """Run detail as JSON text; an empty detail is NULL."""
    return json.dumps(extra, sort_keys=True, default=str) if extra else None


def detail_column(**parts: Column) -> Column:
    """Run detail as JSON text, encoded where the rows are."""
    return F.to_json(F.struct(*[c.alias(name) for name, c in parts.items()]))


def log_finish(
    spark: SparkSession,
    path: str,
    run_id: str,
    success: bool,
    error_message: Optional[str] = None,
    extra: Optional[dict] = None,
) -> None:
    _append(spark, path, run_id, SUCCESS if success else FAILED, error_message, detail_json(extra))
    try:
        spark.sparkContext  # no file system to list without it (Spark Connect): files stay as they are
    except Exception:
        return
    compact(spark, path)


def failure_detail(exc: BaseException, failed_step: str) -> dict:
    """Failure payload: error type, failed step, traceback."""
    return {
        "error_type": type(exc).__name__,
        "failed_step": failed_step,
        "traceback": "".join(traceback.format_exception(type(exc), exc, exc.__traceback__)),
    }


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The events of all levels; of compacted runs the two that count."""
    return spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", True).parquet(path)


def last_events(events: DataFrame) -> DataFrame:
    """The last start and the last finish of each run, as events (see ``fold`` for ties)."""
    rest = F.struct("at", "event", "error_message", "extra")
    is_start = F.col("event") == STARTED
    agg = events.groupBy("run_id").agg(
        F.max(F.when(is_start, rest)).alias("start"), F.max(F.when(~is_start, rest)).alias("finish")
    )
    both = agg.select("run_id", F.explode(F.array("start", "finish")).alias("e")).filter("e is not null")
    return both.select("run_id", "e.*")


def _data_files(fs, folder: str) -> list[str]:
    return [f"{folder}/{n}" for n in fs.names(folder, folders=False) if n.endswith(".parquet")]


def compact(spark: SparkSession, path: str, fan_in: int = FAN_IN) -> int:
    """Compacts every level of the journal that has ``fan_in`` files or more; returns the number
    of files that are gone. Events appended meanwhile are left alone."""
    from sluice.operators.swap import FileSystem

    fs, path, gone = FileSystem(spark, path), path.rstrip("/"), 0
    level = 0
    while True:
        folder = path if level == 0 else f"{path}/{_LEVEL}-{level}"
        files = _data_files(fs, folder)
        if level and not files and not fs.exists(folder):
            return gone
        if len(files) >= fan_in:
            kept = last_events(spark.read.schema(EVENT_SCHEMA).parquet(*files))
            # One file below some hundred thousand runs; a level's files are read in parallel.
            kept.coalesce(max(1, sum(map(fs.size, files)) >> 27)).write.mode("append").parquet(f"{path}/{_LEVEL}-{level + 1}")
            for name in files:
                fs.delete(name)
            gone += len(files) - 1
        level += 1


def fold(events: DataFrame) -> DataFrame:
    """Current state per run: one ``groupBy(run_id)`` with partial aggregation."""
    is_start = F.col("event") == STARTED
    is_finish = F.col("event").isin(SUCCESS, FAILED)
    agg = events.groupBy("run_id").agg(
        F.max(F.when(is_start, F.col("at"))).alias("started_at"),
        F.max(F.when(is_finish, F.struct("at", "event", "error_message", "extra"))).alias("_last"),
    )
    done = F.col("_last.at") >= F.col("started_at")
    return agg.filter(F.col("started_at").isNotNull()).select(
        "run_id",
        "started_at",
        F.when(done, F.col("_last.at")).alias("finished_at"),
        F.when(done, F.col("_last.event")).otherwise(F.lit(STARTED)).alias("status"),
        F.when(done, F.col("_last.error_message")).alias("error_message"),
        F.when(done, F.col("_last.extra")).alias("extra"),
    )


def open_runs(state: DataFrame) -> DataFrame:
    """Runs that started and have not finished."""
    return state.filter((F.col("status") == STARTED) & F.col("finished_at").isNull())


def is_open(spark: SparkSession, path: str, run_id: str) -> bool:
    """Is ``run_id`` started and unfinished?"""
    events = read_events(spark, path).filter(F.col("run_id") == run_id)
    return not open_runs(fold(events)).isEmpty()
