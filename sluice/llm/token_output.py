"""Token-id files: frequency-ranked ids in byte-aligned variable-length code.

Ids are replaced by their rank of frequency in the corpus (ties: smaller id first), so
common ids take one byte. A value takes 1 to 4 bytes; its length less one is two bits of a
control byte, and control bytes stand apart from the data bytes. A shard file is

    b"RVB1", then little-endian: partition u32, sequence u32, documents u64, tokens u64,
    data bytes u64, document ids i64 each (null: the least i64), tokens of each document
    u64, control bytes (four values each, lowest bits first), data bytes, and a line feed.

Files are written by Spark (one binary row a file, so the committer handles lost tasks and
any file system does) and read with Spark's ``binaryFile``. Documents are in ascending
order of doc_id (null first; of equal ids, by number of tokens and checksum). The table of ranks,
bounded by the tokenizer's vocabulary, lies beside the shards as Parquet.

Null or empty texts have only the end id; an empty table gives no shard and no rows; other
columns are ignored; repeated rows are written as often as they occur.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.llm.common import binary_text, pieces, rows, shuffle_partitions, store, texts_of
from sluice.llm.tokens import encoder, pack_ids, unpack_ids

_HEADER = struct.Struct("<4sIIQQQ")
_MAGIC = b"RVB1"
_NULL_ID = -(1 << 63)
#: Bytes of each of a control byte's four values.
_LENGTHS = 1 + ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    v = np.zeros(-(-len(values) // 4) * 4, dtype="<u4")
    v[: len(values)] = values
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    control = (extra.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    extra = extra[: len(values)]
    most = 1 + int(extra.max(initial=0))  # bytes beyond those of the longest value are not looked at
    used = np.arange(most, dtype=np.uint8) <= extra[:, None]
    return control.tobytes(), v[: len(values)].view(np.uint8).reshape(-1, 4)[:, :most][used].tobytes()


def decode_values(control: np.ndarray, data: np.ndarray, count: int) -> np.ndarray:
    """Values back from control and data bytes, by looking up the four lengths of each control byte."""
    lengths = _LENGTHS[control].ravel()[:count]
    most = int(lengths.max(initial=1))
    found = np.zeros((count, most), dtype=np.uint8)
    found[np.arange(most, dtype=np.uint8) < lengths[:, None]] = data
    out = np.zeros((count, 4), dtype=np.uint8)
    out[:, :most] = found
    return out.view("<u4").ravel()


def encode_shard(partition: int, sequence: int, doc_ids: list, values: list[np.ndarray]) -> bytes:
    control, data = encode_values(np.concatenate(values))
    sizes = np.array([len(v) for v in values], dtype="<u8")
    ids = np.array([_NULL_ID if d is None else d for d in doc_ids], dtype="<i8")
    head = _HEADER.pack(_MAGIC, partition, sequence, len(ids), int(sizes.sum()), len(data))
    return head + ids.tobytes() + sizes.tobytes() + control + data


def decode_shard(content: bytes) -> tuple[int, int, list, np.ndarray, np.ndarray]:
    """Partition, sequence, document ids, tokens of each document, and all values of a shard."""
    magic, partition, sequence, docs, tokens, size = _HEADER.unpack_from(content)
    if magic != _MAGIC:
        raise ValueError("not a shard of ranked ids")
    at = _HEADER.size
    ids = np.frombuffer(content, "<i8", docs, at)
    counts = np.frombuffer(content, "<u8", docs, at + 8 * docs).astype(np.int64)
    at += 16 * docs
    blocks = -(-tokens // 4)
    control = np.frombuffer(content, np.uint8, blocks, at)
    data = np.frombuffer(content, np.uint8, size, at + blocks)
    names = [None if i == _NULL_ID else int(i) for i in ids]
    return partition, sequence, names, counts, decode_values(control, data, tokens)


def tokenize(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, n_tokens (with the end id), crc and the packed ids of every text; and for each task
    a row with ``counts``, the ids that it has made (little-endian: all ids, then how often)."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("crc", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, total = encoder(tokenizer), np.zeros(0, dtype=np.int64)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for part in pieces(batch):
                ids = [np.concatenate([i, end]) for i in enc.encode_all(texts_of(part))]
                n = np.bincount(np.concatenate(ids), minlength=len(total))
                n[: len(total)] += total
                total = n
                yield rows(
                    schema,
                    doc_id=part.column("doc_id"),
                    n_tokens=[len(i) for i in ids],
                    crc=[zlib.crc32(i) for i in ids],
                    ids=[pack_ids(i) for i in ids],
                    counts=[None] * len(ids),
                )
        found = np.flatnonzero(total)
        made = np.concatenate([found, total[found]]).astype("<i8").tobytes()
        yield rows(schema, doc_id=[None], n_tokens=[None], crc=[None], ids=[None], counts=[made])

    return binary_text(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        work, "doc_id long, n_tokens long, crc long, ids binary, counts binary"
    )


def id_counts(tokens: DataFrame) -> DataFrame:
    """token_id, n: occurrences of each id, from the tasks' counts (a row a task)."""
    schema = pa.schema([("token_id", pa.int64()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for made in batch.column("counts").to_pylist():
                found, n = np.frombuffer(made, dtype="<i8").reshape(2, -1)
                yield rows(schema, token_id=found, n=n)

    counted = tokens.filter("counts is not null").select("counts").mapInArrow(work, "token_id long, n long")
    return counted.groupBy("token_id").agg(F.sum("n").alias("n"))


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_tokens: int = 4_000_000
) -> None:
    """Encode every text of ``docs`` and write shards below ``path`` and their ranks beside them."""
    spark = docs.sparkSession
    tokens = store(tokenize(docs, tokenizer, end_id), "tokens")
    # One row an id of the vocabulary: the driver holds no more than the tokenizer file does.
    counted = sorted(id_counts(tokens).collect(), key=lambda r: (-r["n"], r["token_id"]))
    ranks = [(k, r["token_id"], r["n"]) for k, r in enumerate(counted)]
    spark.createDataFrame(ranks, "rank long, token_id long, n long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max([0, *(r["token_id"] for r in counted)]) + 1, dtype="<u4")
    rank_of[[r[1] for r in ranks]] = np.arange(len(ranks))
    shared = spark.sparkContext.broadcast(rank_of)
    schema = pa.schema([("shard", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, sequence = TaskContext.get().partitionId(), 0
        ids, values, held = [], [], 0
        for batch in batches:
            for doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                values.append(shared.value[unpack_ids(packed)])
                held += len(values[-1])
                if held >= shard_tokens:
                    yield rows(schema, shard=[encode_shard(partition, sequence, ids, values)])
                    ids, values, held, sequence = [], [], 0, sequence + 1
        if ids:
            yield rows(schema, shard=[encode_shard(partition, sequence, ids, values)])

    ordered = (
        tokens.filter("ids is not null")
        .repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first(), "n_tokens", "crc")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n_tokens", "crc")
        .select("doc_id", "ids")
    )
    # A binary column cast to a string keeps its bytes; the writer adds a line feed.
    shards = ordered.mapInArrow(work, "shard binary").select(F.col("shard").cast("string"))
    shards.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(f"{path}/shards")


def read_shards(spark: SparkSession, path: str, broadcast_rows: int = 200_000) -> DataFrame:
    """doc_id, start, n_tokens and the ids (little-endian unsigned 32-bit) of each document in
    the shards; ``start`` counts the ids of all documents before it. The shards' first
    positions are broadcast up to ``broadcast_rows`` shards, so no ids are shuffled."""
    table = np.array(
        [r["token_id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], dtype="<u4"
    )
    shared = spark.sparkContext.broadcast(table)
    fields = [("partition", pa.int64()), ("sequence", pa.int64()), ("doc_id", pa.int64()), ("local", pa.int64())]
    schema = pa.schema([*fields, ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                partition, sequence, names, counts, values = decode_shard(content)
                ids, ends = shared.value[values], np.cumsum(counts)
                starts = ends - counts
                for at in range(0, len(names), 1000):
                    part = slice(at, at + 1000)
                    n = len(names[part])
                    yield rows(
                        schema,
                        partition=np.full(n, partition),
                        sequence=np.full(n, sequence),
                        doc_id=names[part],
                        local=starts[part],
                        n_tokens=counts[part],
                        ids=[ids[s:e].tobytes() for s, e in zip(starts[part], ends[part])],
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/shards")
    files = files.filter("length > 0")  # the writer leaves an empty file for an empty table
    documents = files.select("content").mapInArrow(
        work, "partition long, sequence long, doc_id long, local long, n_tokens long, ids binary"
    )

    heads = files.select(F.substring("content", 1, _HEADER.size).alias("head")).mapInArrow(
        _read_heads, "partition long, sequence long, tokens long"
    )
    # One row a shard of millions of tokens.
    before = Window.orderBy("partition", "sequence").rowsBetween(Window.unboundedPreceding, -1)
    offsets = store(heads.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))).drop("tokens"), "offsets")
    side = F.broadcast(offsets) if offsets.count() <= broadcast_rows else offsets
    return documents.join(side, ["partition", "sequence"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids"
    )


def _read_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("partition", pa.int64()), ("sequence", pa.int64()), ("tokens", pa.int64())])
    for batch in batches:
        heads = [_HEADER.unpack(h) for h in batch.column(0).to_pylist()]
        yield rows(schema, partition=[h[1] for h in heads], sequence=[h[2] for h in heads], tokens=[h[4] for h in heads])
