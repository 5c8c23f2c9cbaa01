"""Loading cleaned batches into Parquet targets: keyed upsert and full overwrite.

Upsert (the keyed merge the feed contract asks for): matched keys get every non-key
column from the batch (NULLs included), new keys are inserted, keys absent from the
batch are untouched. Targets are partitioned by the month (or day) of the key's date
column and, if the spec asks, by a bucket of the key: functions of the key, so a row
never changes partition and only partitions the batch touches are read and rewritten.
Rewritten partitions are swapped in at once (``operators.swap``). A batch holding one key
twice is refused before anything is written.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from typing import Optional

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators import bucketed, swap
from sluice.operators.checks import violation_flags
from sluice.spec import TableSpec
from sluice.workspace import new_dir

# Defaults of call parameters. They choose an access path or a file layout; the rows that
# are written do not depend on them.
#: ``max_partition_list``: above this many touched partitions the driver holds no list of
#: them; the touched ones are found by a range and a semi join.
MAX_PARTITION_LIST = 10_000
#: ``read_folders_up_to``: a merge touching at most this many partitions reads their folders
#: directly instead of listing the whole table (the slow part on object stores).
READ_FOLDERS_UP_TO = 64
#: ``spread_above``: a merge touching at most this many partitions is written without the
#: rebalance shuffle; each task then writes at most this many files, and the touched side
#: keeps its scan layout when the batch keys are broadcast.
SPREAD_ABOVE_PARTITIONS = 8
#: Above this many keys a join with a batch's keys shuffles both sides. A broadcast passes
#: through the driver, and Spark's choice goes by compressed file sizes, which say little of it.
BROADCAST_KEYS = 100_000

KEY_BUCKET = "key_bucket"


class KeyConflictError(ValueError):
    """The batch holds more than one row for some primary key (``keys`` of them)."""

    def __init__(self, message: str, keys: int = 0):
        super().__init__(message)
        self.keys = keys


class ConstraintError(ValueError):
    """The batch breaks a NOT NULL (``not_null`` rows) or length (``too_long``) constraint."""

    def __init__(self, message: str, not_null: int = 0, too_long: int = 0):
        super().__init__(message)
        self.not_null, self.too_long = not_null, too_long


def _refuse_violations(spec: TableSpec, not_null: int, too_long: int) -> None:
    if not_null or too_long:
        raise ConstraintError(
            f"{spec.name}: {not_null} row(s) with NULL in a NOT NULL column, "
            f"{too_long} row(s) with text longer than its column",
            not_null,
            too_long,
        )


def partition_column(spec: TableSpec) -> Optional[str]:
    """The date partition column (``None`` for an unpartitioned target)."""
    if not spec.partition_date:
        return None
    return f"{spec.partition_date}_{spec.partition_grain}"


def partition_columns(spec: TableSpec) -> list[str]:
    """All partition columns: the date's, then the key bucket's if the spec has buckets."""
    part = partition_column(spec)
    if not part:
        return []
    return [part, KEY_BUCKET] if spec.key_buckets > 1 else [part]


def partition_value(spec: TableSpec) -> Column:
    c = F.col(spec.partition_date)
    return F.trunc(c, "month") if spec.partition_grain == "month" else c


def partition_values(spec: TableSpec) -> dict[str, Column]:
    """Partition column → expression over the row (functions of the key, both)."""
    out = {}
    if partition_column(spec):
        out[partition_column(spec)] = partition_value(spec)
    if len(partition_columns(spec)) > 1:
        out[KEY_BUCKET] = F.pmod(F.xxhash64(*spec.primary_key), F.lit(spec.key_buckets)).cast("int")
    return out


def target_schema(spec: TableSpec) -> T.StructType:
    kinds = [T.DateType(), T.IntegerType()]
    added = [T.StructField(c, kinds[i], True) for i, c in enumerate(partition_columns(spec))]
    return T.StructType(spec.schema.fields + added)


def _file_system(spark: SparkSession, path: str):
    """(file system, path) through the session's JVM, or ``None`` where there is no JVM
    handle (Spark Connect). Errors of the file system itself are raised, never swallowed."""
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # Spark Connect refuses the attribute
        return None
    if jvm is None:
        return None
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist on its file system (local, HDFS, object store)?

    Only "not found" means no; any other failure (permissions, network) is raised, since
    a partition that only seems absent would be overwritten by the batch alone.
    """
    handle = _file_system(spark, path)
    if handle is not None:
        return bool(handle[0].exists(handle[1]))
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` recursively; False if there is no JVM handle or nothing to delete."""
    handle = _file_system(spark, path)
    return bool(handle[0].delete(handle[1], True)) if handle is not None else False


def swap_under_way(spark: SparkSession, path: str) -> Optional[dict]:
    """The note of a swap that a load has decided but not completed (``operators.swap``)."""
    return swap.note_of(spark, path) if _file_system(spark, path) is not None else None


def _parquet(spark: SparkSession, spec: TableSpec, base: str, paths: list[str]) -> DataFrame:
    return spark.read.schema(target_schema(spec)).option("basePath", base).parquet(*paths)


def _settled(spark: SparkSession, spec: TableSpec, path: str, note: dict, folders: Optional[list[str]] = None) -> DataFrame:
    """The target (or some partition folders of it) as it will be after the swap ``note``."""
    fs = swap.FileSystem(spark, path)
    there = swap.leaf_folders(fs, path, len(partition_columns(spec)))
    same = [f for f in there if f not in note["folders"] and (folders is None or f in folders)]
    found = [(path, [f"{path.rstrip('/')}/{f}" for f in same])]
    found += swap.visible_files(spark, path, note, folders).items()
    frames = [_parquet(spark, spec, base, paths) for base, paths in found if paths]
    return reduce(DataFrame.unionByName, frames, spark.createDataFrame([], target_schema(spec)))


def read_target(spark: SparkSession, spec: TableSpec, path: str) -> Optional[DataFrame]:
    """The target with its declared schema, or ``None`` if it was never written. Where a load was
    broken off in the middle of its swap, the rows are those after it."""
    if not path_exists(spark, path):
        return None
    note = swap_under_way(spark, path)
    if note is not None:
        return _settled(spark, spec, path, note)
    return spark.read.schema(target_schema(spec)).parquet(path)


def partition_folder(spec: TableSpec, values) -> str:
    """Folder below the target of one partition: a date, or a (date, bucket) tuple."""
    values = values if isinstance(values, tuple) else (values,)
    return "/".join(f"{c}={v}" for c, v in zip(partition_columns(spec), values))


def read_partitions(spark: SparkSession, spec: TableSpec, path: str, values: list) -> Optional[DataFrame]:
    """Only the given partitions of the target (``None`` if none of them exists yet).

    Each folder is checked with one file-system call and read with ``basePath`` set, so
    the partition columns keep their values and no other partition is listed.
    """
    note = swap_under_way(spark, path)
    if note is not None:
        return _settled(spark, spec, path, note, [partition_folder(spec, v) for v in values])
    folders = [f"{path.rstrip('/')}/{partition_folder(spec, v)}" for v in values]
    present = [f for f in folders if path_exists(spark, f)]
    if not present:
        return None
    return _parquet(spark, spec, path, present)


def read_table(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    date_from: Optional[dt.date] = None,
    date_to: Optional[dt.date] = None,
) -> DataFrame:
    """The loaded table in the spec's columns; an absent target reads as empty.

    ``date_from`` and ``date_to`` (both included) keep rows of that range of the partition
    date; the partition column is filtered along, so other partitions are not opened.
    """
    df = read_target(spark, spec, path)
    if df is None:
        return spark.createDataFrame([], spec.schema)
    for bound, op in ((date_from, "__ge__"), (date_to, "__le__")):
        if bound is not None:
            if not partition_column(spec):
                raise ValueError(f"{spec.name} has no partition date to select by")
            first = bound.replace(day=1) if spec.partition_grain == "month" else bound
            df = df.filter(getattr(F.col(spec.partition_date), op)(F.lit(bound)))
            df = df.filter(getattr(F.col(partition_column(spec)), op)(F.lit(first)))
    return df.select(*spec.columns)


def _spread(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Lay rows out for a partitioned write: few files per partition, no hot task.

    With adaptive execution on (Spark's default), the ``rebalance`` hint groups rows of
    a partition in few tasks, splits a hot partition into advisory-sized tasks and
    merges small ones, without a sampling job. With it off (read, never set, here), a
    range repartition on (partition, key) gives the same balance at the cost of one
    sampling pass.
    """
    parts = partition_columns(spec)
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true":
        return df.hint("rebalance", *parts)
    return df.repartitionByRange(*parts, *(spec.primary_key or spec.columns))


def _replace(df: DataFrame, spec: TableSpec, path: str, *, spread: bool = True, replace_all: bool = False) -> None:
    """Replace exactly the partitions ``df`` has rows of, or the whole target (``replace_all``).

    The new files are written beside the old ones and take their place at once
    (``operators.swap``): a load that is lost on the way leaves the old rows or the new, never
    some of both. Without the session's file system (Spark Connect) the write is a dynamic
    partition overwrite, which cannot promise that; its mode is a write option, so the
    session's setting has no say.
    """
    parts = partition_columns(spec)
    spark = df.sparkSession
    out = _spread(df, spec) if parts and spread and not spec.store_buckets else df
    if _file_system(spark, path) is None:
        if replace_all and parts:
            raise RuntimeError("replacing a partitioned table needs the session's file system (no Spark Connect)")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
        return
    pending = swap.new_pending(spark, path)
    if spec.store_buckets:
        bucketed.write(df.select(*spec.columns, *parts), spec, pending, parts)
    else:
        out.write.partitionBy(*parts).parquet(pending)
    swap.decide(spark, path, pending, len(parts), replace_all=replace_all or not parts)
    swap.finish(spark, path)


def complete_swap(spark: SparkSession, path: str) -> bool:
    """Completes the swap of a load that was lost in the middle of it; False if there is none."""
    return _file_system(spark, path) is not None and swap.finish(spark, path)


def check_overwrite(spec: TableSpec, df: DataFrame, violations: Optional[tuple[int, int]] = None) -> dict:
    """NOT NULL and length check of a full replacement; raises ``ConstraintError`` (nothing is
    replaced). ``violations`` are the counts where the staging write has observed them
    already; otherwise one column-pruned aggregate counts them."""
    if violations is None:
        nn, ln = violation_flags(spec)
        bad = df.select(*spec.columns).agg(
            F.coalesce(F.sum(nn.cast("long")), F.lit(0)), F.coalesce(F.sum(ln.cast("long")), F.lit(0))
        ).first()
        violations = (bad[0], bad[1])
    _refuse_violations(spec, *violations)
    return {"not_null": 0, "too_long": 0}


def write_overwrite(spark: SparkSession, spec: TableSpec, df: DataFrame, path: str, check: dict) -> dict:
    """Replace the target by ``df`` (already checked); the read-back count is returned.

    The new files take the place of all old ones at once (``operators.swap``); partition
    folders the new data does not have go too, however many there are. The frame must not
    read the target it replaces.
    """
    out = df.select(*spec.columns).withColumns(partition_values(spec))
    _replace(out, spec, path, replace_all=True)
    loaded = spark.read.schema(target_schema(spec)).parquet(path).count()  # answered from Parquet footers
    return {"table": spec.name, "status": "overwritten", "rows_loaded": int(loaded)}


def overwrite(spark: SparkSession, spec: TableSpec, df: DataFrame, path: str) -> dict:
    """Full replacement: ``check_overwrite`` (a failing batch replaces nothing), then
    ``write_overwrite``."""
    return write_overwrite(spark, spec, df, path, check_overwrite(spec, df))


def joined_by_key(keys: DataFrame, at_most: int) -> DataFrame:
    """``keys`` (``at_most`` of them) as one side of a join: too many are never broadcast."""
    return keys if at_most <= BROADCAST_KEYS else keys.hint("merge")


def keyed_rows(batch: DataFrame, spec: TableSpec, *, distinct_rows: bool) -> DataFrame:
    """One row per key, with its partition, ``_conflict`` and its violation counts.

    One shuffle by key, after partial aggregation: exact copies, even a hot one, leave each
    map task as one row. A key conflicts if it holds more than one row or, for
    ``distinct_rows``, two different rows, told apart by two 64-bit hashes of the row.
    """
    pk, columns = list(spec.primary_key), spec.columns
    nn, ln = violation_flags(spec)
    marks = [F.xxhash64(F.lit(k), *columns) for k in (1, 2)]
    if distinct_rows:
        conflict = reduce(lambda a, b: a | b, [F.min(m) != F.max(m) for m in marks])
    else:
        conflict = F.count(F.lit(1)) > 1
    per_key = batch.groupBy(*pk).agg(
        *[F.first(c).alias(c) for c in columns if c not in pk],
        conflict.alias("_conflict"),
        F.max(nn.cast("int")).alias("_nn"),
        F.max(ln.cast("int")).alias("_ln"),
    )
    return per_key.select(*columns, "_conflict", "_nn", "_ln").withColumns(partition_values(spec))


def batch_summary(keyed: DataFrame, spec: TableSpec, max_partition_list: Optional[int] = None) -> dict:
    """Keys, conflicting keys, violations and touched partitions of ``keyed_rows``, in one job.

    Partial counts per partition, then one row: the list of partitions is in it when there
    are at most ``max_partition_list`` of them, else only their number and range.
    """
    most = MAX_PARTITION_LIST if max_partition_list is None else max_partition_list
    parts = partition_columns(spec)
    per_part = keyed.groupBy(*parts).agg(
        F.count(F.lit(1)).alias("keys"), F.sum(F.col("_conflict").cast("long")).alias("conflicts"),
        F.sum("_nn").alias("not_null"), F.sum("_ln").alias("too_long"),
    )
    t = per_part.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("keys", "conflicts", "not_null", "too_long")],
        F.min(parts[0]).alias("lo"), F.max(parts[0]).alias("hi"), F.count(F.lit(1)).alias("n"),
        F.when(F.count(F.lit(1)) <= most, F.sort_array(F.collect_list(F.struct(*parts)))).alias("partitions"),
    ).first()
    listed = t["partitions"]
    if listed is not None:
        listed = [tuple(r) if len(parts) > 1 else r[0] for r in listed]
    return {**{c: int(t[c]) for c in ("keys", "conflicts", "not_null", "too_long")}, "partitions": listed,
            "lo": t["lo"], "hi": t["hi"], "n_partitions": int(t["n"])}


def check_batch(
    spec: TableSpec,
    batch: DataFrame,
    *,
    batch_is_distinct: bool = True,
    work_dir: Optional[str] = None,
    max_partition_list: Optional[int] = None,
) -> dict:
    """One pass over the batch; raises before any target is written.

    The batch is scanned and shuffled once: its rows are brought together by key and
    written, one a key, below ``work_dir`` (a fresh staging folder by default). Everything
    after — the summary here, the merge — reads that. Key check (N2): any key with two
    different rows (or two rows at all for a spec without distinct) refuses the batch; NOT
    NULL and length checks (N1, N3) too. The summary (keys, touched partitions, the
    ``keyed`` folder) is what ``merge_batch`` needs.
    """
    if spec.mode != "upsert":
        raise ValueError(f"{spec.name} is not an upsert table")
    if partition_column(spec) is None:
        raise ValueError(f"{spec.name}: an upsert target needs partition_date")
    spark = batch.sparkSession
    folder = f"{work_dir or new_dir(spark, f'stage/{spec.name}')}/keyed"
    keyed = keyed_rows(batch.select(*spec.columns), spec, distinct_rows=not batch_is_distinct and spec.distinct)
    if spec.store_buckets:
        remove_path(spark, folder)  # of an earlier attempt
        bucketed.write(keyed, spec, folder, [])
    else:
        keyed.write.mode("overwrite").parquet(folder)
    summary = batch_summary(spark.read.schema(keyed.schema).parquet(folder), spec, max_partition_list)
    summary["keyed"] = folder
    try:
        if summary["conflicts"]:
            raise KeyConflictError(
                f"{spec.name}: {summary['conflicts']} key(s) of {tuple(spec.primary_key)} occur more than once in the batch",
                summary["conflicts"],
            )
        _refuse_violations(spec, summary["not_null"], summary["too_long"])
    except ValueError:
        remove_path(spark, folder)
        raise
    return summary


def merged_rows(
    spark: SparkSession, spec: TableSpec, path: str, summary: dict, read_folders_up_to: Optional[int] = None
) -> DataFrame:
    """``touched ▷ batch keys ∪ batch``: what the touched partitions hold after the merge.

    The batch is read back one row a key, once for its rows and once for its keys alone;
    neither is shuffled unless the join asks for it. Up to ``BROADCAST_KEYS`` keys the join
    strategy is Catalyst's and AQE's choice.
    """
    most = READ_FOLDERS_UP_TO if read_folders_up_to is None else read_folders_up_to
    parts, pk = partition_columns(spec), list(spec.primary_key)
    batch = spark.read.schema(target_schema(spec)).parquet(summary["keyed"])
    values = summary["partitions"]
    if not path_exists(spark, path):
        return batch
    if values is not None and len(values) <= most:
        touched = read_partitions(spark, spec, path, values)
        if touched is None:  # only new partitions: nothing to keep
            return batch
    else:
        touched = _touched(read_target(spark, spec, path), batch, spec, summary)
    kept = touched.join(joined_by_key(batch.select(*pk), summary["keys"]), pk, "left_anti")
    return kept.select(*spec.columns, *parts).unionByName(batch)


def _touched(target: DataFrame, batch: DataFrame, spec: TableSpec, summary: dict) -> DataFrame:
    """Rows of the partitions that the batch touches: PartitionFilters, and a semi join where
    these alone would take in more."""
    parts, values = partition_columns(spec), summary["partitions"]
    if values is None:
        target = target.filter(F.col(parts[0]).between(summary["lo"], summary["hi"]))
        return target.join(batch.select(*parts).distinct(), parts, "left_semi")
    dates = sorted({v[0] if isinstance(v, tuple) else v for v in values})
    target = target.filter(F.col(parts[0]).isin(dates))
    if len(parts) > 1:  # buckets of those dates that the batch has no key of stay as they are
        target = target.join(batch.select(*parts).distinct(), parts, "left_semi")
    return target


def _merge_bucketed(spark: SparkSession, spec: TableSpec, path: str, summary: dict) -> None:
    """A wide merge into a target stored in buckets: the table's rows stay in their tasks."""
    parts = partition_columns(spec)
    keyed = spark.read.parquet(summary["keyed"]).schema
    pending = swap.new_pending(spark, path)
    with (
        bucketed.table(spark, spec, path, target_schema(spec), parts) as target,
        bucketed.table(spark, spec, summary["keyed"], keyed, []) as batch,
    ):
        batch = spark.table(batch)
        kept = bucketed.kept_rows(_touched(spark.table(target), batch, spec, summary), batch, spec)
        bucketed.write(kept.select(*spec.columns, *parts), spec, pending, parts, dealt=True)
        bucketed.write(batch.select(*spec.columns, *parts), spec, pending, parts)
    swap.decide(spark, path, pending, len(parts), replace_all=False)
    swap.finish(spark, path)


def merge_batch(
    spark: SparkSession,
    spec: TableSpec,
    path: str,
    summary: dict,
    *,
    read_folders_up_to: Optional[int] = None,
    spread_above: Optional[int] = None,
) -> dict:
    """Write what the touched partitions hold after the merge of a batch that ``check_batch``
    accepted and swap them in (``operators.swap``): untouched partitions are neither read nor
    rewritten. The batch's keyed rows are dropped after the write."""
    result = {"table": spec.name, "status": "upserted", "rows_batch": summary["keys"],
              "partitions": summary["n_partitions"]}
    if summary["keys"] == 0:
        result["status"] = "empty batch"
    else:
        complete_swap(spark, path)  # of a load that was lost; the merge reads the target itself
        above = SPREAD_ABOVE_PARTITIONS if spread_above is None else spread_above
        spread = summary["n_partitions"] > above or not path_exists(spark, path)
        folders = READ_FOLDERS_UP_TO if read_folders_up_to is None else read_folders_up_to
        if spec.store_buckets and summary["n_partitions"] > folders and path_exists(spark, path):
            _merge_bucketed(spark, spec, path, summary)
        else:
            _replace(merged_rows(spark, spec, path, summary, read_folders_up_to), spec, path, spread=spread)
    remove_path(spark, summary["keyed"])
    return result


def upsert(spark: SparkSession, spec: TableSpec, batch: DataFrame, path: str, *, batch_is_distinct: bool = True) -> dict:
    """Merge ``batch`` (spec columns) into the target at ``path``: ``check_batch`` (a refused
    batch writes nothing), then ``merge_batch``."""
    return merge_batch(spark, spec, path, check_batch(spec, batch, batch_is_distinct=batch_is_distinct))
