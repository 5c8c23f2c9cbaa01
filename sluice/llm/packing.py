"""Best-fit packing of whole documents into sequences by the sum-of-squares rule.

A document (its ids and an end id) longer than a sequence is cut into full pieces and a
rest. Every piece shorter than a sequence goes where the sum over all gaps of the squared
number of open sequences with that gap becomes smallest: putting a piece of length s into a
sequence with gap g takes one from N(g) and adds one to N(g - s); opening a new one adds one
to N(capacity - s). So no gap becomes common, and pieces find an exact fit. Ties go to the
smallest gap. A task places its pieces in descending length. Then it takes the sequences that
are not full apart and places their pieces again by the same rule, for as long as that
fills some and needs no more sequences; each round has far fewer pieces than the one before.

Full pieces are sequences of their own and pass through. A task holds the shorter pieces of
about ``task_documents`` documents, one a document at most, with their compressed ids.

Null or empty texts are one piece of the end id alone. Repeated rows are packed as often as
they occur. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import binary_text, pieces, rows, texts_of
from sluice.llm.tokens import encoder, pack_ids, unpack_ids


class SumOfSquares:
    """Places lengths into sequences of ``capacity``; ``place`` returns (sequence, offset)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, dtype=np.int64)  # open sequences by gap
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        c, n = self.capacity, self.counts
        # Change of the sum of squares if the piece goes into gap g = length..c-1, or a new one.
        change = 2 * n[: c - length + 1] + 1  # N(g - length) grows; a gap of 0 is closed for good
        change[0] = 0
        change[:-1] -= 2 * n[length:c] - 1  # N(g) shrinks
        usable = n[length:c] > 0
        best = np.where(usable, change[:-1], np.iinfo(np.int64).max)
        if len(best) and (k := int(best.argmin())) >= 0 and usable[k] and best[k] <= change[-1]:
            gap = length + k
            n[gap] -= 1
            sequence = self.open[gap].pop()
        else:
            gap, sequence = c, self.made
            self.made += 1
        left = gap - length
        if left:
            n[left] += 1
            self.open[left].append(sequence)
        return sequence, c - gap


def place_all(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each length (below ``capacity``), and how many sequences there are."""
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    left, made, most = np.argsort(-lengths, kind="stable"), 0, None
    while len(left):
        packer = SumOfSquares(capacity)
        found = np.array([packer.place(n) for n in lengths[left].tolist()])
        if most is not None and packer.made > most:
            break  # the round before was better
        sequence[left], offset[left] = made + found[:, 0], found[:, 1]
        used = np.bincount(found[:, 0], lengths[left], packer.made)
        full = int((used == capacity).sum())
        most = packer.made - full
        if not full:
            made += packer.made
            break
        # Full sequences keep the first numbers; the open ones' pieces go round again.
        number = np.empty(packer.made, dtype=np.int64)
        number[np.argsort(used != capacity, kind="stable")] = np.arange(packer.made)
        sequence[left] = made + number[found[:, 0]]
        left = left[used[found[:, 0]] != capacity]
        made += full
    else:
        return sequence, offset, made
    return sequence, offset, int(sequence.max()) + 1


def cut(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length and packed ids of each piece of each document."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]
    schema = pa.schema([*fields, ("ids", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], dtype="<u4")
        for batch in batches:
            for part in pieces(batch):
                out: dict[str, list] = {f.name: [] for f in schema}
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), enc.encode_all(texts_of(part))):
                    ids = np.concatenate([ids, end])
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        piece = ids[at : at + capacity]
                        for name, value in zip(out, (doc_id, k, at, len(piece), pack_ids(piece))):
                            out[name].append(value)
                yield rows(schema, **out)

    return binary_text(docs, F.col("doc_id").cast("long").alias("doc_id")).mapInArrow(
        work, "doc_id long, piece int, start long, length long, ids binary"
    )


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, task_documents: int = 40_000) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit), sequence_id, offset."""
    tasks = max(1, -(-docs.select("doc_id").count() // task_documents))
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]
    schema = pa.schema([*fields, ("ids", pa.binary()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        made, short = 0, []

        def result(batch: pa.RecordBatch, sequence: np.ndarray, offset: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                columns = {f.name: part.column(f.name) for f in schema if f.name in part.schema.names}
                columns["ids"] = [unpack_ids(p).tobytes() for p in part.column("ids").to_pylist()]
                yield rows(schema, **columns, sequence_id=sequence[at : at + 1000], offset=offset[at : at + 1000])

        for batch in batches:  # full pieces first, each a sequence
            full = int((np.asarray(batch.column("length")) == capacity).sum())
            yield from result(batch.slice(0, full), base + made + np.arange(full), np.zeros(full, dtype=np.int64))
            made += full
            if full < batch.num_rows:
                short.append(batch.slice(full))
        lengths = np.concatenate([np.zeros(0, np.int64), *(np.asarray(b.column("length")) for b in short)])
        sequence, offset, _ = place_all(lengths, capacity)
        at = 0
        for batch in short:
            mine = slice(at, at + batch.num_rows)
            yield from result(batch, base + made + sequence[mine], offset[mine])
            at += batch.num_rows

    dealt = cut(docs, tokenizer, end_id, capacity).repartition(tasks, F.xxhash64("doc_id", "piece", "ids"))
    # Longest first, and an order that a rerun of a lost task repeats.
    ordered = dealt.sortWithinPartitions(F.col("length").desc(), "doc_id", "piece", F.crc32("ids"))
    return ordered.mapInArrow(
        work, "doc_id long, piece int, start long, length long, ids binary, sequence_id long, offset long"
    )
