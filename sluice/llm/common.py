"""Helpers shared by the operators: Arrow batches in bounded pieces, words as 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.workspace import new_dir

#: Text bytes worked on at once inside a task; one longer document is taken alone.
PIECE_BYTES = 4 << 20

_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD],
    dtype=np.uint64,
)


def store(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = new_dir(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def binary_text(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and the text as UTF-8 bytes; no other column travels."""
    return docs.select(*columns, F.col("text").cast("binary").alias("text"))


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with at most ``limit`` bytes in ``column`` (or one row)."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    return [t or b"" for t in batch.column(column).to_pylist()]


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of bytes other than ASCII white space) of all texts, one after
    the other, and where each text's words begin (one more entry than texts)."""
    flat: list[bytes] = []
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    for i, t in enumerate(texts):
        flat += t.split()
        starts[i + 1] = len(flat)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, flat), dtype=np.uint64, count=len(flat)), starts


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finishing steps of a multiply-xorshift hash)."""
    h = h ^ (h >> np.uint64(32))
    h *= _MULTIPLIERS[0]
    h ^= h >> np.uint64(29)
    h *= _MULTIPLIERS[1]
    h ^= h >> np.uint64(32)
    return h


def shingles(words: np.ndarray, starts: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words that lies within one text, the text's number, and
    where in ``words`` the run begins.

    ``words`` and ``starts`` are as from ``hash_words``; texts with fewer words give none.
    """
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = words[:n] * _MULTIPLIERS[0]
    for k in range(1, width):
        h = h + words[k : k + n] * _MULTIPLIERS[k % 5] * np.uint64(2 * (k // 5) + 1)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    whole = np.flatnonzero(owner[:n] == owner[width - 1 :])
    return mix(h[whole]), owner[whole], whole


def rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key of batches that are sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in keys]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for s, e in zip(cuts, cuts[1:]):
            here = tuple(int(c[s]) for c in columns)
            if held and here != key:
                yield pa.Table.from_batches(held)
                held = []
            key = here
            held.append(batch.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)
