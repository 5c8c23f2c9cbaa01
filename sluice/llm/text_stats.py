"""Counts of words, symbols, lines and repeated word windows of whole texts.

A word is a run of bytes other than ASCII white space, as written. Used by the quality
operators; every count is over the whole text. Null texts count as empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from sluice.llm.common import hash_words, mix, pieces, shingles, texts_of

SYMBOLS = b"#*$%&|<>"
#: Names of the counts, all long.
COUNTS = (
    "n_words",
    "word_chars",  # code points in words
    "n_symbols",  # characters of SYMBOLS
    "n_lines",  # lines with a word
    "n_dup_lines",  # those equal to an earlier line
    "n_repeat_words",  # words in 5-word windows found twice or more, first included
    "n_upper",  # A-Z
    "n_marks",  # ASCII punctuation
    "n_digits",
    "n_same_words",  # words equal to the word before
    "n_distinct_words",
)
_WHITE, _UPPER, _DIGITS = b" \t\n\r\x0b\x0c", bytes(range(0x41, 0x5B)), bytes(range(0x30, 0x3A))
_MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())


def _without(text: bytes, letters: bytes) -> int:
    return len(text) - len(text.translate(None, letters))


def counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Each of ``COUNTS`` for each text."""
    words, starts = hash_words(texts)
    n = len(texts)
    n_words = np.diff(starts)
    owner = np.repeat(np.arange(n), n_words)
    salt = mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    windows, text, at = shingles(words, starts)
    found = _repeated(windows ^ salt[text])
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, at[found], 1)
    np.add.at(cover, at[found] + 5, -1)
    repeated = np.cumsum(cover[:-1]) > 0
    key = np.sort(mix(words) ^ salt[owner]) if len(words) else words
    same = np.zeros(len(words), dtype=bool)
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
    order = np.argsort(mix(words) ^ salt[owner], kind="stable") if len(words) else np.zeros(0, np.int64)
    first = np.ones(len(words), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    lines, dup = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for i, t in enumerate(texts):
        full = [x for x in t.split(b"\n") if x.strip(_WHITE)]
        lines[i], dup[i] = len(full), len(full) - len(set(full))
    points = [len(t) - _without(t, _CONTINUATION) - _without(t, _WHITE) for t in texts]
    out = {
        "n_words": n_words,
        "word_chars": points,
        "n_symbols": [_without(t, SYMBOLS) for t in texts],
        "n_lines": lines,
        "n_dup_lines": dup,
        "n_repeat_words": np.bincount(owner[repeated], minlength=n),
        "n_upper": [_without(t, _UPPER) for t in texts],
        "n_marks": [_without(t, _MARKS) for t in texts],
        "n_digits": [_without(t, _DIGITS) for t in texts],
        "n_same_words": np.bincount(owner[same], minlength=n),
        "n_distinct_words": np.bincount(owner[order[first]], minlength=n),
    }
    return {k: np.asarray(v, dtype=np.int64) for k, v in out.items()}


_CONTINUATION = bytes(range(0x80, 0xC0))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    found = np.zeros(len(keys), dtype=bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with ``COUNTS``; columns that are named like them are replaced."""
    kept = docs.drop(*COUNTS)
    schema = StructType([*kept.schema.fields, *(StructField(c, LongType()) for c in COUNTS)])
    arrow = to_arrow_schema(schema)
    binary = dict(kept.dtypes)["text"] == "binary"

    def work(batches):
        for batch in batches:
            for part in pieces(batch):
                texts = texts_of(part) if binary else [(t or "").encode() for t in part.column("text").to_pylist()]
                got = counts(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[f.name]) if f.name in got else part.column(f.name) for f in arrow], schema=arrow
                )

    return kept.mapInArrow(work, schema)
