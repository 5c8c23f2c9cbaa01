"""Exact repeated byte strings, found with enhanced suffix arrays of candidate regions.

Texts are UTF-8 bytes (null: empty). A byte is removed if a string of ``LENGTH`` bytes that
covers it also starts anywhere else, in the same text or another one. With ``words``, the bytes
of so many words in a row (runs of bytes other than ASCII white space) that also occur
anywhere else go too, whatever white space is between them, or are only counted; the steps
below are then taken for words (as 64-bit hashes) and bytes side by side (``Unit``).

1. Equal texts collapse by their MD5; if there are two or more of at least ``LENGTH`` bytes,
   all their bytes go, and one of them stands for them below.
2. Every window of ``LENGTH`` bytes belongs to its anchor, the string of ``GRAM`` bytes in it
   with the least hash. Equal windows have equal anchors, so only windows whose anchor is
   found in two runs or more can repeat; their runs of neighbouring windows are read again
   and dealt out by anchor.
3. A task takes the runs of some anchors, drops windows whose hash is alone, collapses equal
   strings of what is left, and builds the suffix array and common prefixes of the distinct
   ones. A stack scan gives the tree of common-prefix intervals; an interval of at least
   ``LENGTH`` whose occurrences are preceded by different bytes is a maximal repeat, and all its
   occurrences are removed.
4. Anchors of more than ``hot_runs`` runs are not gathered: window hashes are counted, summed
   in the tasks first and in buckets then, and the runs are marked where they lie by the
   repeated hashes.

Work and rows follow the input, not the squares of groups. An empty table gives no rows;
repeated rows are texts that occur twice; other columns are ignored, or kept by ``remove``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from sluice.llm.common import groups, mix, pieces, rows, shuffle_partitions, store, texts_of
from sluice.llm.suffix import suffix_array
from sluice.workspace import new_dir

LENGTH, GRAM = 400, 100
_BUFFER = 1 << 17  # bytes hashed at once; longer texts are taken in overlapping parts
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.random.default_rng(400).integers(1, 1 << 63, 1 << 9, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_IS_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class Unit(NamedTuple):
    """What strings are made of, bytes or words: ``length`` of them are a window, ``gram`` an
    anchor. Starts and ends of runs and spans count units."""

    length: int = LENGTH
    gram: int = GRAM
    words: bool = False

    def split(self, texts: list[bytes]) -> list[Sequence]:
        """The units of each text: its bytes, or its words' hashes."""
        if not self.words:
            return texts
        hashes, _, _, n = word_places(texts)
        return np.split(hashes, np.cumsum(n)[:-1]) if texts else []

    def letters(self, parts: list[Sequence]) -> np.ndarray:
        """A 64-bit number for each unit of all parts, one after the other."""
        if self.words:
            return np.concatenate([np.zeros(0, np.uint64), *parts])
        return _LETTERS[np.frombuffer(b"".join(parts), dtype=np.uint8)]

    def symbols(self, parts: list[Sequence]) -> np.ndarray:
        """As ``letters``, but small numbers that only equal units share."""
        if self.words:
            return np.unique(self.letters(parts), return_inverse=True)[1]
        return np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.int64)


BYTES = Unit()


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the largest n so far."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(max(n, 1 << 16), dtype=np.uint64)
        have[1:] = np.uint64(base)
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def prefix_hash(letters: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any substring follows (one more entry than letters)."""
    sums = np.zeros(len(letters) + 1, dtype=np.uint64)
    np.cumsum(letters * _power(_BASE, len(letters)), out=sums[1:])
    return sums


def substring_hash(sums: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    return mix((sums[start + length] - sums[start]) * _power(_INVERSE, len(sums))[start])


def window_hashes(letters: np.ndarray, length: int) -> np.ndarray:
    """Hash of every substring of ``length`` letters."""
    sums = prefix_hash(letters)
    n = len(letters) - length + 1
    return mix((sums[length:] - sums[:n]) * _power(_INVERSE, n))


def word_places(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end in its text of every word of all texts, one after the other, and
    the number of words of each text."""
    n = np.zeros(len(texts), dtype=np.int64)
    found: list[list[np.ndarray]] = [[np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        data = np.frombuffer(b" " + b" ".join(part for *_, part in held) + b" ", dtype=np.uint8)
        blank = _IS_BLANK[data]
        edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        start, end = edges[::2], edges[1::2]
        begins = np.cumsum([1, *(len(part) + 1 for *_, part in held)])
        words = np.diff(np.searchsorted(start, begins))
        np.add.at(n, [text for text, *_ in held], words)
        shift = np.repeat(begins[:-1] - [offset for _, offset, _ in held], words)
        sums = prefix_hash(_LETTERS[data])
        for out, value in zip(found, (substring_hash(sums, start, end - start), start - shift, end - shift)):
            out.append(value)
        held, size = [], 0

    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            stop = len(text)
            if stop - at > _BUFFER:  # a long text is cut at a blank
                cut = _BLANK.search(text, at + _BUFFER)
                stop = cut.start() if cut else stop
            held.append((i, at, text[at:stop]))
            size += stop - at
            at = stop
            if size >= _BUFFER:
                flush()
    if held:
        flush()
    hashes, starts, ends = map(np.concatenate, found)
    return hashes, starts, ends, n


def _sliding_minimum(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbouring keys, from running minima of blocks."""
    n = len(keys) - width + 1
    full = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    full[: len(keys)] = keys
    blocks = full.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors(texts: list[Sequence], unit: Unit = BYTES) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text, where runs of windows with one anchor begin and the anchors' hashes."""
    out: list[tuple[list, list]] = [([], []) for _ in texts]
    held: list[tuple[int, int, Sequence]] = []
    size = 0
    most = max(_BUFFER // 8, 1) if unit.words else _BUFFER  # a word takes more memory than a byte

    def flush() -> None:
        nonlocal held, size
        if held:
            data = unit.letters([part for *_, part in held])
            grams = window_hashes(data, unit.gram)
            bits = np.uint64((1 << len(data).bit_length()) - 1)
            least = _sliding_minimum((grams & ~bits) | np.arange(len(grams), dtype=np.uint64), unit.length - unit.gram + 1)
            anchor = (least & bits).astype(np.int64)
            changed = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            begin = 0
            for text, offset, part in held:
                last = begin + len(part) - unit.length
                s, e = np.searchsorted(changed, [begin + 1, last + 1])
                starts = np.concatenate([[begin], changed[s:e]])
                out[text][0].append(starts - begin + offset)
                out[text][1].append(grams[anchor[starts]])
                begin += len(part)
        held, size = [], 0

    for i, whole in enumerate(texts):
        for offset in range(0, max(0, len(whole) - unit.length + 1), most):
            part = whole[offset : offset + most + unit.length - 1]
            held.append((i, offset, part))
            size += len(part)
            if size >= most:
                flush()
    flush()
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return [(np.concatenate(s), np.concatenate(h)) if s else none for s, h in out]


def describe(docs: DataFrame, words: Unit | None = None) -> DataFrame:
    """doc_id, text_hash, size in bytes, and each run's first window and anchor hash; with
    ``words`` also word_size, word_starts and word_anchors."""
    fields = [("doc_id", pa.int64()), ("text_hash", pa.binary())]
    names = {"": BYTES} | ({"word_": words} if words else {})
    for p in names:
        fields += [(f"{p}size", pa.int64()), (f"{p}starts", pa.list_(pa.int64())), (f"{p}anchors", pa.list_(pa.int64()))]
    schema = pa.schema(fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                texts = texts_of(part)
                got = {"doc_id": part.column("doc_id"), "text_hash": [hashlib.md5(t).digest() for t in texts]}
                for p, unit in names.items():
                    split = unit.split(texts)
                    found = anchors(split, unit)
                    got[f"{p}size"] = [len(t) for t in split]
                    got[f"{p}starts"] = [s for s, _ in found]
                    got[f"{p}anchors"] = [h.view(np.int64) for _, h in found]
                yield rows(schema, **got)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    each = ", ".join(f"{p}size long, {p}starts array<long>, {p}anchors array<long>" for p in names)
    return texts.mapInArrow(work, f"doc_id long, text_hash binary, {each}")


def _spans_schema() -> pa.Schema:
    return pa.schema([("text_hash", pa.binary()), ("start", pa.int64()), ("end", pa.int64())])


_SPANS = "text_hash binary, start long, end long"


def common_prefixes(sums: np.ndarray, order: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix in order with the one before (the first: 0), by bisection
    over substring hashes; ``lengths``: symbols of each suffix up to its string's end."""
    if len(order) < 2:
        return np.zeros(len(order), dtype=np.int64)
    a, b = order[:-1], order[1:]
    low, high = np.zeros(len(a), dtype=np.int64), np.minimum(lengths[a], lengths[b])
    while (low < high).any():
        middle = (low + high + 1) // 2
        equal = substring_hash(sums, a, middle) == substring_hash(sums, b, middle)
        low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
    return np.concatenate([[0], low])


def maximal_repeats(
    strings: list[Sequence], least: int, unit: Unit = BYTES
) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(string numbers, offsets, length) of each maximal repeat of ``least`` units or more: all
    its occurrences, found by a stack scan over the common-prefix intervals of the enhanced
    suffix array. A string's beginning counts as a left neighbour of its own."""
    sizes = np.array([len(s) for s in strings])
    begins = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int(sizes.sum()) + len(strings), dtype=np.int64)
    owner = np.repeat(np.arange(len(strings)), sizes + 1)
    inside = np.ones(len(symbols), dtype=bool)
    inside[begins + sizes] = False
    symbols[inside] = unit.symbols(strings)
    symbols[~inside] = symbols.max() + 1 + np.arange(len(strings))  # each string ends in a symbol of its own
    order, _ = suffix_array(symbols)
    rest = begins[owner] + sizes[owner] - np.arange(len(symbols))
    long_enough = rest[order] >= least
    order = order[long_enough]
    prefix = common_prefixes(prefix_hash(mix(symbols.astype(np.uint64) + np.uint64(1))), order, rest)
    left = symbols[order - 1]
    left = np.where(order == begins[owner[order]], -1 - np.arange(len(order)), left)
    changes = np.concatenate([[0], np.cumsum(left[1:] != left[:-1])])
    stack: list[tuple[int, int]] = []  # open intervals: first slot and common prefix
    deep = np.concatenate([[False], prefix >= least, [False]])
    for slot in np.flatnonzero(deep[1:] | deep[:-1]).tolist():  # others neither open nor close one
        here = int(prefix[slot]) if slot < len(order) else 0
        first = slot - 1
        while stack and stack[-1][1] > here:
            first, length = stack.pop()
            mine = slice(first, slot)
            if changes[slot - 1] != changes[first]:
                at = order[mine]
                yield owner[at], at - begins[owner[at]], length
        if here >= least and (not stack or stack[-1][1] < here):
            stack.append((first, here))


def repeats(
    texts: list[bytes], starts: list[int], joined: list[bytes], unit: Unit = BYTES
) -> tuple[list, list, list]:
    """Spans (text, start, end) of the repeated windows of some runs: ``joined[i]`` stands at
    ``starts[i]`` of the text named ``texts[i]``."""
    strings, length = unit.split(joined), unit.length
    sizes = np.array([len(s) for s in strings])
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(strings)), sizes - length + 1)
    at = np.arange(len(owner)) + owner * (length - 1)  # every window of every string
    hashes = window_hashes(unit.letters(strings), length)[at]
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(at), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.ones(len(at), dtype=bool)
    edge[1:] = (owner[1:] != owner[:-1]) | ~twice[:-1]
    first = np.flatnonzero(twice & edge)
    edge = np.ones(len(at), dtype=bool)
    edge[:-1] = (owner[1:] != owner[:-1]) | ~twice[1:]
    last = np.flatnonzero(twice & edge)
    places: dict[bytes, list[tuple[bytes, int]]] = {}
    apart: list[Sequence] = []  # the distinct strings
    for s, e, i, low in zip(first.tolist(), last.tolist(), owner[first].tolist(), (at - begins[owner])[first].tolist()):
        string = strings[i][low : low + e - s + length]
        mine = places.setdefault(string.tobytes() if unit.words else string, [])
        if not mine:
            apart.append(string)
        mine.append((texts[i], starts[i] + low))
    # Spans within each distinct string; one that is found twice repeats as a whole.
    often = [k for k, p in enumerate(places.values()) if len(p) > 1]
    spans = [(np.array(often, np.int64), np.zeros(len(often), np.int64), np.array([len(apart[k]) for k in often], np.int64))]
    if apart:
        for which, offsets, common in maximal_repeats(apart, length, unit):
            spans.append((which, offsets, offsets + common))
    which, low, high = (np.concatenate(c) for c in zip(*spans))
    inside: list[list[tuple[int, int]]] = [[] for _ in apart]
    for k, s, e in zip(*(c.tolist() for c in union(which, low, high))):
        inside[k].append((s, e))
    found: tuple[list, list, list] = ([], [], [])
    for mine, here in zip(places.values(), inside):
        for s, e in here:
            for name, start in mine:
                found[0].append(name)
                found[1].append(start + s)
                found[2].append(start + e)
    return found


def union(which: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans (low, high) of the same ``which`` become one."""
    if not len(which):
        return which, low, high
    wide = int(high.max()) + 1
    order = np.argsort(which * wide + low, kind="stable")
    first, last = (which * wide + low)[order], (which * wide + high)[order]
    reach = np.maximum.accumulate(last)
    new = np.concatenate([[True], first[1:] > reach[:-1]])
    begin = np.flatnonzero(new)
    end = reach[np.concatenate([begin[1:] - 1, [len(first) - 1]])]
    return first[begin] // wide, first[begin] % wide, end % wide


def find_repeats(runs: DataFrame, words: Unit | None = None) -> DataFrame:
    """Spans of the repeated windows of ``runs`` (anchor, text_hash, start, string, and words:
    whether it is a run of words)."""
    schema = _spans_schema().append(pa.field("words", pa.bool_()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[bool, bytes, int], bytes] = {}
        size, anchor = 0, None
        for batch in batches:
            for h, text, start, string, kind in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if h != anchor and size >= _BUFFER:  # an anchor's runs stay together
                    yield from flush(held)
                    held, size = {}, 0
                anchor = h
                if (kind, text, start) not in held:
                    held[kind, text, start] = string
                    size += len(string)
        if held:
            yield from flush(held)

    def flush(held: dict[tuple[bool, bytes, int], bytes]) -> Iterator[pa.RecordBatch]:
        for kind in (False, True):
            if mine := [k for k in held if k[0] == kind]:
                found = repeats([t for _, t, _ in mine], [s for *_, s in mine], [held[k] for k in mine], words if kind else BYTES)
                yield rows(schema, text_hash=found[0], start=found[1], end=found[2], words=[kind] * len(found[0]))

    dealt = runs.select("anchor", "text_hash", "start", "string", "words").repartition(
        shuffle_partitions(runs.sparkSession), "anchor"
    )
    return dealt.sortWithinPartitions("anchor", "text_hash", "start").mapInArrow(work, f"{_SPANS}, words boolean")


def count_windows(runs: DataFrame, bucket_bytes: int = 32 << 20, unit: Unit = BYTES) -> DataFrame:
    """bucket, windows: hashes (64-bit integers in one binary value) of the windows that occur
    more than once in ``runs``.

    A task sums what it reads and sends one row a bucket with all hashes and counts of it;
    buckets follow the hashes' first bits and are as many as keep each small.
    """
    bits = max(4, int(runs.count() * 16 * (unit.length - unit.gram) // bucket_bytes).bit_length())
    schema = pa.schema([("bucket", pa.int64()), ("windows", pa.binary()), ("n", pa.binary())])
    repeated = pa.schema([("bucket", pa.int64()), ("windows", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "string"):
                strings = unit.split(part.column("string").to_pylist())
                hashes = [window_hashes(unit.letters([s]), unit.length) for s in strings]
                value, n = np.unique(np.concatenate(hashes), return_counts=True)
                bucket = (value >> np.uint64(64 - bits)).astype(np.int64)
                cuts = np.concatenate([np.flatnonzero(np.diff(bucket, prepend=-1)), [len(bucket)]]).tolist()
                spans = list(zip(cuts, cuts[1:]))
                yield rows(
                    schema,
                    bucket=[bucket[s] for s, _ in spans],
                    windows=[value[s:e].tobytes() for s, e in spans],
                    n=[n[s:e].astype(np.int64).tobytes() for s, e in spans],
                )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["bucket"]):
            value = np.frombuffer(b"".join(group.column("windows").to_pylist()), dtype=np.uint64)
            n = np.frombuffer(b"".join(group.column("n").to_pylist()), dtype=np.int64)
            order = np.argsort(value, kind="stable")
            first = np.flatnonzero(np.diff(value[order], prepend=~value[order[:1]]))
            often = np.add.reduceat(n[order], first) > 1
            yield rows(
                repeated, bucket=[group.column("bucket")[0].as_py()], windows=[value[order][first[often]].tobytes()]
            )

    sent = runs.select("string").mapInArrow(work, "bucket long, windows binary, n binary")
    dealt = sent.repartition(shuffle_partitions(runs.sparkSession), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(add, "bucket long, windows binary")


def mark_windows(
    runs: DataFrame, repeated: DataFrame, broadcast_windows: int = 2_000_000, unit: Unit = BYTES
) -> DataFrame:
    """Spans of the windows of ``runs`` whose hashes are in ``repeated``."""
    if (repeated.agg(F.sum(F.length("windows"))).first()[0] or 0) > 8 * broadcast_windows:
        schema = pa.schema([("text_hash", pa.binary()), ("start", pa.int64()), ("window", pa.int64())])

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                names, starts, strings = (batch.column(k).to_pylist() for k in range(3))
                for text, start, string in zip(names, starts, unit.split(strings)):
                    hashes = window_hashes(unit.letters([string]), unit.length).view(np.int64)
                    at = start + np.arange(len(hashes))
                    yield rows(schema, text_hash=[text] * len(at), start=at, window=hashes)

        def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for windows in batch.column(0).to_pylist():
                    yield rows(pa.schema([("window", pa.int64())]), window=np.frombuffer(windows, dtype=np.int64))

        each = runs.select("text_hash", "start", "string").mapInArrow(
            spread, "text_hash binary, start long, window long"
        )
        hit = each.join(repeated.select("windows").mapInArrow(unpack, "window long"), "window", "left_semi")
        return hit.select("text_hash", "start", (F.col("start") + unit.length).alias("end"))
    found = [np.frombuffer(r["windows"], dtype=np.int64) for r in repeated.toLocalIterator()]
    shared = runs.sparkSession.sparkContext.broadcast(np.sort(np.concatenate([np.zeros(0, np.int64), *found])))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: tuple[list, list, list] = ([], [], [])
            names, starts, strings = (batch.column(k).to_pylist() for k in range(3))
            for text, start, string in zip(names, starts, unit.split(strings)):
                hashes = window_hashes(unit.letters([string]), unit.length).view(np.int64)
                slot = np.minimum(np.searchsorted(shared.value, hashes), max(0, len(shared.value) - 1))
                hit = shared.value[slot] == hashes if len(shared.value) else np.zeros(len(hashes), bool)
                edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
                for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                    found[0].append(text)
                    found[1].append(start + s)
                    found[2].append(start + e - 1 + unit.length)
            yield rows(_spans_schema(), text_hash=found[0], start=found[1], end=found[2])

    return runs.select("text_hash", "start", "string").mapInArrow(work, _SPANS)


def read_runs(docs: DataFrame, wanted: DataFrame, words: Unit | None = None) -> DataFrame:
    """The strings of the wanted runs (doc_id, text_hash, runs of anchor, start, last window,
    hot and, with ``words``, words): one row a run, read from the document that stands for its
    text; runs of words from the first word's first byte to the last one's end."""
    fields = [("anchor", pa.int64()), ("text_hash", pa.binary()), ("start", pa.int64()), ("hot", pa.bool_())]
    schema = pa.schema([*fields, ("string", pa.binary()), *([("words", pa.bool_())] if words else [])])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                out: dict[str, list] = {f.name: [] for f in schema}
                size = 0
                texts = part.column("text").to_pylist()
                _, first, end, n = word_places(texts if words else [])
                begins = np.cumsum(n) - n if words else [0] * len(texts)
                for text, begin, name, runs in zip(texts, begins, part.column("text_hash").to_pylist(), part.column("runs").to_pylist()):
                    for run in runs:
                        if words and run["words"]:
                            string = text[first[begin + run["start"]] : end[begin + run["last"] + words.length - 1]]
                        else:
                            string = text[run["start"] : run["last"] + LENGTH]
                        for f, v in zip(out, (run["anchor"], name, run["start"], run["hot"], string, run.get("words"))):
                            out[f].append(v)
                        size += len(string)
                        if size > 4 * _BUFFER:
                            yield rows(schema, **out)
                            out, size = {f.name: [] for f in schema}, 0
                yield rows(schema, **out)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    # A text meets its own row only, however many share a doc_id or have none.
    texts = texts.withColumn("_name", F.unhex(F.md5("text")))
    same = texts["doc_id"].eqNullSafe(wanted["stands"]) & (texts["_name"] == wanted["text_hash"])
    return texts.join(wanted, same).select("text", "text_hash", "runs").mapInArrow(
        work, "anchor long, text_hash binary, start long, hot boolean, string binary" + ", words boolean" * bool(words)
    )


def removal_spans(
    docs: DataFrame, hot_runs: int = 1_000, broadcast_rows: int = 100_000, words: Unit | None = None
) -> DataFrame:
    """text_hash, whole (every byte goes) and spans (start, end; they may overlap) of the texts
    of which something is removed. With ``words`` also whole_words (the number of words of a
    text that repeats as a whole) and words (spans of words)."""
    described = store(describe(docs, words), "anchors")
    names = {"": BYTES} | ({"word_": words} if words else {})
    texts = store(
        described.groupBy("text_hash").agg(
            F.count("*").alias("copies"),
            F.min("doc_id").alias("stands"),
            *[F.first(p + c).alias(p + c) for p in names for c in ("size", "starts", "anchors")],
        ),
        "texts",
    )

    def runs_of(p: str, unit: Unit) -> Column:
        starts = F.col(f"{p}starts")
        last = F.concat(F.transform(F.slice(starts, 2, F.size(starts)), lambda s: s - 1), F.array(F.col(f"{p}size") - unit.length))
        zipped = F.arrays_zip(F.col(f"{p}anchors").alias("anchor"), starts.alias("start"), last.alias("last"))
        mine = F.transform(
            zipped, lambda r: F.struct(r["anchor"].alias("anchor"), r["start"].alias("start"), r["last"].alias("last"), F.lit(unit.words).alias("words"))
        )
        return F.when(F.size(starts) > 0, mine)

    none = F.array().cast("array<struct<anchor: bigint, start: bigint, last: bigint, words: boolean>>")
    found = F.concat(*[F.coalesce(runs_of(p, u), none) for p, u in names.items()])
    each = texts.select("text_hash", "stands", F.explode(found).alias("r")).select("text_hash", "stands", "r.*")
    repeated = store(each.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1"), "repeated-anchors")
    side = F.broadcast(repeated) if repeated.count() <= broadcast_rows else repeated
    run = F.struct("anchor", "start", "last", (F.col("n") > hot_runs).alias("hot"), "words")
    wanted = store(
        each.join(side, "anchor").groupBy("text_hash").agg(F.first("stands").alias("stands"), F.collect_list(run).alias("runs")),
        "wanted-runs",
    )
    path = new_dir(docs.sparkSession, "runs")
    runs = read_runs(docs, wanted, words)
    if not words:
        runs = runs.withColumn("words", F.lit(False))
    runs.write.partitionBy("hot", "words").parquet(path)
    runs = docs.sparkSession.read.schema(runs.schema).parquet(path)
    spans = find_repeats(runs.filter("not hot"), words)
    for unit in names.values():
        hot = runs.filter("hot").filter(F.col("words") == unit.words)
        if hot.limit(1).count():
            often = store(count_windows(hot, unit=unit), "repeated-windows")
            spans = spans.unionByName(mark_windows(hot, often, unit=unit).withColumn("words", F.lit(unit.words)))
    span = F.struct("start", "end")
    kinds = {"spans": ~F.col("words")} | ({"words": F.col("words")} if words else {})
    mine = spans.groupBy("text_hash").agg(*[F.collect_list(F.when(mine, span)).alias(c) for c, mine in kinds.items()])
    whole = {"whole": F.when(F.col("size") >= LENGTH, True)}
    if words:
        whole["whole_words"] = F.when(F.col("word_size") >= words.length, F.col("word_size"))
    copied = texts.filter("copies > 1").select("text_hash", *[v.alias(c) for c, v in whole.items()])
    return mine.join(copied.dropna("all", subset=list(whole)), "text_hash", "full")


def remove(
    docs: DataFrame,
    hot_runs: int = 1_000,
    broadcast_rows: int = 100_000,
    characters: bool = False,
    words: int | None = None,
    count: bool = False,
) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and, instead of the text, ``kept`` (its remaining
    bytes; null for a null text). With ``characters``, characters of which a byte goes go as
    a whole. With ``words``, runs of so many words that repeat go besides; with ``count`` they
    stay and n_passage_words has the number of their words."""
    unit = Unit(words, max(1, words // 4), True) if words else None
    spans = store(removal_spans(docs, hot_runs, broadcast_rows, unit), "removal-spans")
    if not words:
        spans = spans.withColumns({"whole_words": F.lit(None).cast("long"), "words": F.lit(None).cast(spans.schema["spans"].dataType)})
    names = {"text_hash": "_removal_of", "whole": "_removal_whole", "spans": "_removal_spans"}
    spans = spans.withColumnsRenamed(names | {"whole_words": "_removal_whole_words", "words": "_removal_words"})
    taken = ("_removal_text", "_removal_whole", "_removal_spans", "_removal_whole_words", "_removal_words")
    counted = ("n_bytes", "n_removed", "n_spans", *["n_passage_words"] * count)
    added = [StructField(c, LongType()) for c in counted] + [StructField("kept", BinaryType())]
    mine = docs.withColumnRenamed("text", taken[0]).withColumn(taken[0], F.col(taken[0]).cast("binary"))
    mine = mine.drop(*(f.name for f in added))
    schema = StructType([*(f for f in mine.schema.fields if f.name != taken[0]), *added])
    arrow = to_arrow_schema(schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, taken[0]):
                got: dict[str, list] = {f.name: [] for f in added}
                for text, whole, spans, whole_words, apart in zip(*(part.column(c).to_pylist() for c in taken)):
                    size = len(text or b"")
                    gone = [(0, size)] if whole or whole_words and not count else [(s["start"], s["end"]) for s in spans or []]
                    if count:
                        runs = merge([(s["start"], s["end"]) for s in apart or []])
                        got["n_passage_words"].append(whole_words or sum(e - s for s, e in runs))
                    elif apart:
                        at = [w.span() for w in _WORD.finditer(text)]
                        gone += [(at[s["start"]][0], at[s["end"] - 1][1]) for s in apart]
                    gone = merge(gone)
                    if characters:
                        gone = merge([_whole_characters(text, s, e) for s, e in gone])
                    got["kept"].append(cut(text, gone) if gone else text)
                    got["n_bytes"].append(size)
                    got["n_removed"].append(sum(e - s for s, e in gone))
                    got["n_spans"].append(len(gone))
                columns = [pa.array(got[f.name], f.type) if f.name in got else part.column(f.name) for f in arrow]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    key = F.unhex(F.md5(F.coalesce(F.col(taken[0]), F.lit("").cast("binary"))))
    joined = mine.withColumn("_removal_key", key).join(spans, F.col("_removal_key") == F.col("_removal_of"), "left")
    return joined.drop("_removal_key", "_removal_of").mapInArrow(work, schema)


def strip(docs: DataFrame, words: int | None = None) -> DataFrame:
    """``docs`` without repeated strings (and, with ``words``, without runs of so many words that
    repeat), whole characters at a time; documents of which nothing is left go. All columns stay; n_chars, where there is one, follows."""
    beside = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    left = remove(docs.select("doc_id", "text", beside), characters=True, words=words).filter("n_removed = 0 or length(kept) > 0")
    rows = left.select(F.col("kept").cast("string").alias("text"), "row").select("text", "row.*").drop("_")
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(docs.columns)


def _whole_characters(text: bytes, start: int, end: int) -> tuple[int, int]:
    while start and text[start] & 0xC0 == 0x80:
        start -= 1
    while end < len(text) and text[end] & 0xC0 == 0x80:
        end += 1
    return start, end


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans become one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def cut(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    at, out = 0, []
    for s, e in gone:
        out.append(text[at:s])
        at = e
    return b"".join([*out, text[at:]])
