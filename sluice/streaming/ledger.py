"""The ledger of a stream's drops: which came first, and which keys each has loaded.

A drop gets a sequence number when the ledger first sees it: of the drops that are new then, in
the order of the earliest file time in each, then of their paths. The folder is listed whole,
whatever part of it a micro-batch brings, so the numbers do not depend on how many files a
trigger takes. Numbers are never changed.

The order holds across triggers too. Each load records its keys and a hash of their rows under
the drop's number. Rows of a drop that come when a later drop has loaded the same key are left
out, as they would have been overwritten; and two different rows for one key of one drop are a
conflict, whether they come in one trigger or in several. Keys of the last ``keep`` drops are
held; a late row of a drop that is older than those is refused, never guessed.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.load import KeyConflictError, joined_by_key, path_exists, remove_path
from sluice.spec import TableSpec

DROP = "_drop"
#: Drops whose keys are held for files that come late.
KEEP = 1000


class LateDropError(ValueError):
    """Rows of a drop that is older than all drops whose keys are still held."""


def drop_of(drops: str) -> Column:
    """The drop a row belongs to: its file's path, or its file's folder."""
    if drops not in ("folders", "files"):
        raise ValueError("drops is 'folders' or 'files'")
    path = F.col("_metadata.file_path")
    return (F.regexp_replace(path, "/[^/]*$", "") if drops == "folders" else path).alias(DROP)


class Ledger:
    """Sequence numbers (``order``) and loaded keys of the drops of ``folder``, kept at ``path``.

    One stream writes to it, one batch after the other; a batch that is retried writes the same
    again."""

    def __init__(self, spark: SparkSession, path: str, folder: str, drops: str, keep: int = KEEP):
        self.spark, self.path, self.folder, self.drops, self.keep = spark, path.rstrip("/"), folder, drops, keep

    def _known(self) -> DataFrame:
        schema = f"{DROP} string, seq long"
        if not path_exists(self.spark, f"{self.path}/drops"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/drops")

    def order(self, batch_id: int, waiting: list[str]) -> dict[str, int]:
        """The numbers of the drops ``waiting`` in this batch, after numbering all new ones."""
        listed = self.spark.read.format("binaryFile").load(self.folder)  # names and times; no content is read
        listed = listed.select(drop_of(self.drops), F.col("_metadata.file_modification_time").alias("at"))
        # A file may be gone when its batch is retried; its drop is new all the same.
        gone = self.spark.createDataFrame([(d, None) for d in waiting], f"{DROP} string, at timestamp")
        known = self._known()
        first = listed.unionByName(gone).groupBy(DROP).agg(F.min("at").alias("at"))
        fresh = first.join(known, DROP, "left_anti").orderBy(F.asc_nulls_first("at"), DROP).collect()  # as many as drops arrived
        if fresh:
            begin = (known.agg(F.max("seq")).first()[0] or 0) + 1
            made = self.spark.createDataFrame([(r[DROP], begin + i) for i, r in enumerate(fresh)], f"{DROP} string, seq long")
            made.coalesce(1).write.mode("append").parquet(f"{self.path}/drops")
        wanted = self.spark.createDataFrame([(d,) for d in waiting], f"{DROP} string")
        return {r[DROP]: r["seq"] for r in self._known().join(wanted, DROP).collect()}

    def _loaded(self, spec: TableSpec) -> Optional[DataFrame]:
        """The key columns, h1, h2 (of the row), seq and batch of what has been loaded."""
        if not path_exists(self.spark, f"{self.path}/keys"):
            return None
        keys = [f"`{f.name}` {f.dtype}" for f in spec.fields if f.name in spec.primary_key]
        return self.spark.read.schema(", ".join([*keys, "h1 long, h2 long, seq long, batch long"])).parquet(f"{self.path}/keys")

    def admit(self, spec: TableSpec, rows: DataFrame, seq: int, batch_id: int, at_most: int) -> DataFrame:
        """The rows of a drop's part (``at_most`` so many) that are to be merged, and a note of
        their keys."""
        pk = list(spec.primary_key)
        marked = rows.select("*", *[F.xxhash64(F.lit(k), *spec.columns).alias(f"h{k}") for k in (1, 2)])
        mine = marked.select(*pk, "h1", "h2").distinct()
        loaded = self._loaded(spec)
        if loaded is not None:
            known = self._seqs(loaded)
            if len(known) >= self.keep and seq < known[-self.keep]:
                raise LateDropError(f"{spec.name}: drop {seq} is older than the last {self.keep} drops, whose keys are held")
            earlier = loaded.filter((F.col("seq") == seq) & (F.col("batch") != batch_id))
            if seq in known:
                same = earlier.select(*pk, F.col("h1").alias("o1"), F.col("h2").alias("o2"))
                clash = joined_by_key(mine, at_most).join(same, pk).filter("h1 <> o1 OR h2 <> o2").select(*pk).distinct().count()
                if clash:
                    raise KeyConflictError(f"{spec.name}: {clash} key(s) of {tuple(pk)} occur more than once in a drop", clash)
            if known and known[-1] > seq:
                later = loaded.filter(F.col("seq") > seq).select(*pk)
                later = joined_by_key(later.distinct(), later.count())  # counted by the Parquet footers
                rows = rows.join(later, pk, "left_anti").select(*rows.columns)
        mine.write.mode("overwrite").parquet(f"{self.path}/keys/seq={seq}/batch={batch_id}")
        return rows

    @staticmethod
    def _seqs(loaded: DataFrame) -> list[int]:
        return sorted(r[0] for r in loaded.select("seq").distinct().collect())  # one a drop whose keys are held

    def forget(self, spec: TableSpec) -> None:
        """Drops the keys of all but the last ``keep`` drops."""
        loaded = self._loaded(spec)
        for seq in self._seqs(loaded)[: -self.keep] if loaded is not None else []:
            remove_path(self.spark, f"{self.path}/keys/seq={seq}")
