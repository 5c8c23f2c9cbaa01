"""Token counts of the sections of documents, from one encoding of each whole text.

Every token of a text has a span of characters. Sections are spans too: those of the
``sections`` column if asked for (array of struct name, start, end: in any order, and they may
overlap), or else the lines of the text, cut every ``section_chars`` characters where longer.
Tokens join the sections they overlap; one that overlaps several is allocated by ``rule``:

* "most": to the section with most of its characters, of equal ones to the first;
* "first": to the section with its first character that lies in any section, of several to the
  first.

The first of two sections is the one that starts first, then the one that ends first, then the
one named first. A token that no section overlaps is counted by none. So the counts of
sections that leave no gap add up to the text's tokens. A token is crossing if a part of it lies
outside the section that counts it. A section that is null, lacks a bound or does not end after
its start keeps its row, with what is given, and counts nothing; a null or empty list of sections
gives no row. Null or empty texts have one empty section without tokens (or their own sections,
with none); an empty table gives no rows; rows that are repeated are counted each; other columns
are ignored.

Texts are encoded piece by piece as in ``tokens``, which gives the tokens and spans of the whole
text; with a tokenizer file whose words are not independent of each other, as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm.common import binary_text, pieces, rows, texts_of
from sluice.llm.tokens import Cache, words_are_independent

RULES = ("most", "first")


class Spans:
    """Character spans of the tokens of whole texts."""

    def __init__(self, path: str, limit: int = 200_000):
        self._tokenizer = Tokenizer.from_file(path)
        self._by_words = words_are_independent(path)
        self._pieces = Cache(self._piece, limit)

    def _piece(self, piece: str) -> bytes:
        offsets = self._tokenizer.encode(piece, add_special_tokens=False).offsets
        return np.array(offsets, dtype="<i4").tobytes()

    def of(self, text: str) -> np.ndarray:
        if not self._by_words:
            offsets = self._tokenizer.encode(text, add_special_tokens=False).offsets
            return np.array(offsets, dtype=np.int64).reshape(-1, 2)
        parts = text.replace("\n", " ").split(" ")
        found = list(map(self._pieces.__getitem__, parts))
        begins = np.zeros(len(parts), dtype=np.int64)
        np.cumsum([len(p) + 1 for p in parts[:-1]], out=begins[1:])
        counts = np.array([len(f) for f in found]) // 8
        spans = np.frombuffer(b"".join(found), dtype="<i4").reshape(-1, 2).astype(np.int64)
        return spans + np.repeat(begins, counts)[:, None]


@lru_cache(maxsize=4)
def _spans(path: str) -> Spans:
    return Spans(path)


def line_sections(text: str, section_chars: int) -> np.ndarray:
    """[start, end) of the lines of a text, cut every ``section_chars`` characters."""
    out, at = [], 0
    for line in text.split("\n"):
        for s in range(0, max(1, len(line)), section_chars):
            out.append((at + s, at + min(len(line), s + section_chars)))
        at += len(line) + 1
    return np.array(out, dtype=np.int64)


def allocate_any(spans: np.ndarray, sections: list, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """``allocate`` for sections (dicts, null or not) in any order, which may overlap."""
    n = len(sections)
    counts, crossing = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    held = [
        (s["start"], s["end"], k)
        for k, s in enumerate(sections)
        if s is not None and s["start"] is not None and s["end"] is not None and s["start"] < s["end"]
    ]
    held.sort()
    bounds = np.array([h[:2] for h in held], dtype=np.int64).reshape(-1, 2)
    place = np.array([h[2] for h in held], dtype=np.int64)
    if np.all(bounds[1:, 0] >= bounds[:-1, 1]):
        counts[place], crossing[place] = allocate(spans, bounds, rule)
        return counts, crossing
    ahead, near = 0, []  # sections that have begun and not ended, in their order
    for start, end in spans.tolist():
        while ahead < len(held) and held[ahead][0] < end:
            near.append(held[ahead])
            ahead += 1
        near = [h for h in near if h[1] > start]
        mine = [h for h in near if min(h[1], end) > max(h[0], start)]
        if not mine:
            continue
        if rule == "most":
            chosen = max(mine, key=lambda h: min(h[1], end) - max(h[0], start))  # the first of equal ones
        else:
            chosen = min(mine, key=lambda h: max(h[0], start))
        counts[chosen[2]] += 1
        crossing[chosen[2]] += chosen[0] > start or chosen[1] < end
    return counts, crossing


def allocate(spans: np.ndarray, sections: np.ndarray, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them cross a boundary; sections are in order and
    do not overlap."""
    counts, crossing = np.zeros(len(sections), dtype=np.int64), np.zeros(len(sections), dtype=np.int64)
    if not len(sections) or not len(spans):
        return counts, crossing
    first = np.searchsorted(sections[:, 1], spans[:, 0], side="right")  # ends after the token's start
    last = np.searchsorted(sections[:, 0], spans[:, 1], side="left") - 1  # begins before its end
    inside = first <= last
    choice = first.copy()
    crosses = inside & ((spans[:, 0] < sections[np.minimum(first, len(sections) - 1), 0]) | (spans[:, 1] > sections[np.maximum(np.minimum(first, len(sections) - 1), 0), 1]))
    if rule == "most":
        for k in np.flatnonzero(inside & (first < last)):
            mine = sections[first[k] : last[k] + 1]
            overlap = np.minimum(mine[:, 1], spans[k, 1]) - np.maximum(mine[:, 0], spans[k, 0])
            choice[k] = first[k] + int(overlap.argmax())
    np.add.at(counts, choice[inside], 1)
    np.add.at(crossing, choice[crosses], 1)
    return counts, crossing


def count_tokens(
    docs: DataFrame, tokenizer: str, section_chars: int = 1000, rule: str = "most", own_sections: bool = False
) -> DataFrame:
    """doc_id, section (its number), name, start, end, n_tokens, n_crossing; a row a section.

    With ``own_sections``, those of the ``sections`` column."""
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    own = own_sections
    names = [("doc_id", pa.int64()), ("section", pa.int32()), ("name", pa.string()), ("start", pa.int64())]
    schema = pa.schema([*names, ("end", pa.int64()), ("n_tokens", pa.int64()), ("n_crossing", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = _spans(tokenizer)
        for batch in batches:
            for part in pieces(batch):
                out: dict[str, list] = {f.name: [] for f in schema}
                given = part.column("sections").to_pylist() if own else [None] * part.num_rows
                for doc_id, raw, mine in zip(part.column("doc_id").to_pylist(), texts_of(part), given):
                    text = raw.decode("utf-8", "replace")
                    if own:
                        mine = mine or []
                        counts, crossing = allocate_any(spans.of(text), mine, rule)
                        for field in ("name", "start", "end"):
                            out[field] += [s and s[field] for s in mine]
                    else:
                        sections = line_sections(text, section_chars)
                        counts, crossing = allocate(spans.of(text), sections, rule)
                        out["name"] += [None] * len(sections)
                        out["start"] += sections[:, 0].tolist()
                        out["end"] += sections[:, 1].tolist()
                    out["doc_id"] += [doc_id] * len(counts)
                    out["section"] += range(len(counts))
                    out["n_tokens"] += counts.tolist()
                    out["n_crossing"] += crossing.tolist()
                yield rows(schema, **out)

    columns = [F.col("doc_id").cast("long").alias("doc_id"), *(["sections"] if own else [])]
    return binary_text(docs, *columns).mapInArrow(
        work, "doc_id long, section int, name string, start long, end long, n_tokens long, n_crossing long"
    )
