"""Benchmark decontamination with an FM-index of each training shard.

A word is a run of ASCII letters and digits and of non-ASCII characters, with A-Z in lower
case. A benchmark item's phrases are its windows of ``window`` words (an item of fewer, but
not none, is one phrase). Each piece of a task's documents is indexed: words the benchmark
lacks cannot be part of an occurrence, nor can runs too short for the shortest phrase, so
only the other runs enter the index, kept apart by a separator. All phrases are searched
backwards, occurrences are located from sampled suffix positions, and overlapping ones merge
into spans. Documents stay whole in one task, so nothing is shuffled.

The benchmark goes to every task in blocks of at most ``block_bytes`` (the bound of each
broadcast); several blocks are passes one after the other over the same row. Null texts
and empty texts have no words, items without words occur nowhere, a null item_id counts as
an item named "null"; an empty benchmark hits nothing; repeated rows are judged alike;
columns named like the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from sluice.llm.common import pieces, store, texts_of
from sluice.llm.fm_index import FMIndex

_LETTERS = b"".join(
    bytes([c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20])
    for c in range(256)
)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_SHARD_BYTES = 16 << 20
#: Blocks of the benchmark that are broadcast at the same time.
BLOCKS_AT_ONCE = 8


def words(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


class Phrases:
    """The phrases of some items: word numbers (from 2; 1 separates) and which items have each."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.numbers: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        place = {name: k for k, name in enumerate(self.names)}
        owners: dict[tuple[int, ...], set[int]] = {}
        for name, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 2) for w in words(text)]
            for at in range(max(1, len(ids) - window + 1) if ids else 0):
                owners.setdefault(tuple(ids[at : at + window]), set()).add(place[name])
        self.groups = []  # by length: phrases, and their items in one array with bounds
        for length in sorted({len(p) for p in owners}):
            mine = [p for p in owners if len(p) == length]
            bounds = np.cumsum([0, *(len(owners[p]) for p in mine)])
            flat = np.array([k for p in mine for k in sorted(owners[p])], dtype=np.int64)
            self.groups.append((np.array(mine, dtype=np.int64), bounds, flat))
        self.shortest = min((len(p) for p in owners), default=0)


def find(texts: list[bytes], phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hit flag of each word of all texts, where each text's words begin, and (text, item) pairs."""
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    number, flat = phrases.numbers.get, []
    for i, t in enumerate(texts):
        flat += [number(w, 0) for w in words(t)]
        starts[i + 1] = len(flat)
    ids = np.array(flat, dtype=np.int64)
    hit = np.zeros(len(ids) + 1, dtype=np.int64)
    pairs = [np.zeros((0, 2), dtype=np.int64)]
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    if phrases.groups and len(ids):
        # Runs of benchmark words within a text, long enough for the shortest phrase.
        known = ids > 0
        begins = known.copy()
        begins[1:] &= ~known[:-1] | (owner[1:] != owner[:-1])
        run = np.cumsum(begins) - 1
        long_enough = np.bincount(run[known], minlength=1) >= phrases.shortest
        kept = np.flatnonzero(known & long_enough[np.maximum(run, 0)])
        if len(kept):
            gap = np.cumsum(begins[kept]) - 1  # a separator before every run but the first
            text = np.ones(len(kept) + int(gap[-1]), dtype=np.int64)
            place = np.arange(len(kept)) + gap
            text[place] = ids[kept]
            word_at = np.zeros(len(text), dtype=np.int64)
            word_at[place] = kept
            index = FMIndex(text, len(phrases.numbers) + 1)
            for group, bounds, items in phrases.groups:
                low, high = index.search(group)
                count = high - low
                total = int(count.sum())
                if not total:
                    continue
                phrase = np.repeat(np.arange(len(group)), count)
                slot = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
                at = word_at[index.locate(slot)]
                np.add.at(hit, at, 1)
                np.add.at(hit, at + group.shape[1], -1)
                many = bounds[phrase + 1] - bounds[phrase]
                which = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                item = items[which + np.repeat(bounds[phrase], many)]
                pairs.append(np.unique(np.stack([np.repeat(owner[at], many), item], axis=1), axis=0))
    return np.cumsum(hit[:-1]) > 0, starts, *np.unique(np.concatenate(pairs), axis=0).T


def spans_of(flags: np.ndarray) -> np.ndarray:
    """[start, end) of each run of true flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def cut(text: bytes, hit: np.ndarray) -> bytes:
    """The text without its hit words and what stands between neighbouring ones."""
    bounds = np.array([m.span() for m in _WORD.finditer(text)], dtype=np.int64).reshape(-1, 2)
    out, at = [], 0
    for first, last in spans_of(hit):
        out.append(text[at : bounds[first, 0]])
        at = int(bounds[last - 1, 1])
    return b"".join([*out, text[at:]])


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )


def block_count(benchmark: DataFrame, block_bytes: int) -> int:
    size = _items(benchmark).agg(F.sum(F.length("text"))).first()[0] or 0
    return max(1, -(-size // block_bytes))


def blocks(benchmark: DataFrame, window: int, count: int) -> Iterator[Phrases]:
    """The benchmark's phrases, a bounded number of items at a time."""
    items = _items(benchmark)
    for k in range(count):
        mine = items.filter(F.pmod(F.xxhash64("name", "text"), F.lit(count)) == k) if count > 1 else items
        yield Phrases([(r["name"], bytes(r["text"])) for r in mine.collect()], window)


def search(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` (its text as bytes) with n_words, ``hit_words`` (merged [start, end) word spans)
    and ``items`` (names of the items with occurring phrases).

    At most ``BLOCKS_AT_ONCE`` blocks are broadcast at a time; in between, what has been found is
    written to the shared folder."""
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    added = {"n_words": LongType(), "hit_words": ArrayType(span), "items": ArrayType(StringType())}
    found = docs.drop(*added).withColumn("text", F.col("text").cast("binary"))
    schema = StructType([*found.schema.fields, *(StructField(k, t) for k, t in added.items())])
    arrow = to_arrow_schema(schema)
    count, alive = block_count(benchmark, block_bytes), []
    for k, phrases in enumerate(blocks(benchmark, window, count)):
        if len(alive) == BLOCKS_AT_ONCE:
            found = store(found, "marked")
            while alive:
                alive.pop().unpersist()
        shared = docs.sparkSession.sparkContext.broadcast(phrases)
        alive.append(shared)

        def work(batches, shared=shared, first=k == 0):
            for batch in batches:
                for part in pieces(batch, limit=_SHARD_BYTES):
                    hit, starts, text, item = find(texts_of(part), shared.value)
                    bounds = np.searchsorted(text, np.arange(part.num_rows + 1))
                    names = [[shared.value.names[i] for i in item[s:e]] for s, e in zip(bounds, bounds[1:])]
                    flags = [hit[s:e] for s, e in zip(starts, starts[1:])]
                    if not first:  # earlier blocks' finds join these
                        for f, old in zip(flags, part.column("hit_words").to_pylist()):
                            for x in old:
                                f[x["start"] : x["end"]] = True
                        names = [sorted({*a, *b}) for a, b in zip(names, part.column("items").to_pylist())]
                    spans = [[{"start": a, "end": b} for a, b in spans_of(f)] if f.any() else [] for f in flags]
                    columns = {n: part.column(n) for n in part.schema.names}
                    columns |= {"n_words": np.diff(starts), "hit_words": spans, "items": names}
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[f.name], f.type) if f.name in added else columns[f.name] for f in arrow],
                        schema=arrow,
                    )

        found = found.mapInArrow(work, schema)
    return found


def _cut_one_block(docs: DataFrame, phrases: Phrases) -> DataFrame:
    """``docs`` (text as bytes) without occurrences; each text is searched again while it changes."""
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    names = docs.schema.names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, limit=_SHARD_BYTES):
                texts = part.column("text").to_pylist()
                todo = list(range(len(texts)))
                while todo:
                    hit, starts, *_ = find([texts[i] or b"" for i in todo], shared.value)
                    left = []
                    for k, i in enumerate(todo):
                        flags = hit[starts[k] : starts[k + 1]]
                        if flags.any():
                            texts[i] = cut(texts[i], flags)
                            left.append(i)
                    todo = left
                columns = [pa.array(texts, pa.binary()) if n == "text" else part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return docs.mapInArrow(work, docs.schema)


def _cut_marked(marked: DataFrame) -> DataFrame:
    """text and row of ``search``'s result, the hit words cut out."""
    schema = marked.select("text", "row").schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i, (n, spans) in enumerate(zip(batch.column("n_words").to_pylist(), batch.column("hit_words").to_pylist())):
                hit = np.zeros(n, dtype=bool)
                for x in spans:
                    hit[x["start"] : x["end"]] = True
                texts[i] = cut(texts[i], hit)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), batch.column("row")], names=["text", "row"])

    return marked.mapInArrow(work, schema)


def remove(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 8 << 20) -> DataFrame:
    """``docs`` with the benchmark's occurrences cut out of the texts (again, where what is
    left reads as one); all columns stay, and n_chars, where there is one, follows.

    What all blocks find in a text is cut out at once, and texts that changed are searched again
    for all blocks until nothing is found, so the result does not depend on ``block_bytes``. With
    several blocks each round is written to the shared folder."""
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    todo = docs.select(F.col("text").cast("binary").alias("text"), row)
    count = block_count(benchmark, block_bytes)
    if count == 1:
        found = _cut_one_block(todo, next(blocks(benchmark, window, 1)))
    else:
        found = None
        while True:
            marked = store(search(todo, benchmark, window, block_bytes), "marked")
            clean = marked.filter("size(hit_words) = 0").select("text", "row")
            found = clean if found is None else found.unionByName(clean)
            hit = marked.filter("size(hit_words) > 0")
            if hit.isEmpty():
                break
            todo = store(_cut_marked(hit), "cut")
    found = found.withColumn("text", F.col("text").cast("string")).select("text", "row.*").drop("_")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.length("text").cast(kind))
    return found.select(docs.columns)
