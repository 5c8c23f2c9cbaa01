"""Documents with every odd case, and plain versions of the operators to hold them against."""

from __future__ import annotations

import collections
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Extra columns, named like things the operators use inside or return.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept string, spans string, row int, "
    "n_words string, items int, score string, start string, block long, _turn int, sections string"
)


def lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(65, 91)})


def sentence(seed: int, n: int) -> str:
    parts = ["ka", "lo", "mi", "ne", "ru", "so", "ti", "va", "ze", "é", "ñu", "ßo"]
    out, x = [], seed * 2654435761 % (1 << 32) + 1
    for _ in range(n):
        x = (x * 1664525 + 1013904223) % (1 << 32)
        out.append(parts[x >> 8 & 7] + parts[(x >> 12) % 12] + (parts[x >> 17 & 7] if x >> 21 & 1 else ""))
    return " ".join(out)


def odd_texts() -> list[str | None]:
    passage = sentence(77, 90)
    base = sentence(1, 120)
    near = base.replace(" ", "  ", 3).upper()
    words = base.split(" ")
    edited = " ".join([*words[:60], "changed", *words[61:]])
    return [
        None, "", " \n\t\x0b ", "one", "one two three four", "ONE two THREE four", base, base, near, edited,
        sentence(2, 200) + "\n" + passage + "\n" + sentence(3, 80),
        sentence(4, 20) + " " + passage,
        "x" * 1200, "y" * 399, "ab" * 700, sentence(5, 30000), "a\x85b c ́e <|endoftext|> İ ΣΑΣ ﬁn \U0001f600",
        "same line\nsame line\nsame line\n" + sentence(6, 40), "$$$ ### %%% &&& " * 30, sentence(7, 60),
    ]


def documents(spark, texts=None, repeat=True):
    texts = odd_texts() if texts is None else texts
    rows = [(i, t, [None, "en", "de"][i % 3], [None, "a"][i % 2], len(t or "")) for i, t in enumerate(texts)]
    if repeat and rows:
        rows += [rows[-1], rows[0], (None, sentence(8, 50), None, None, 1), (None, None, None, None, 0)]
    extra = ("k", "s", 1, "w", 2, "sc", "st", 3, 4, "se")
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text: str | None) -> frozenset:
    w = WORD.findall(lower(text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_classes(ids: list[int], sets: list[frozenset]) -> dict[int, int]:
    """Smallest id reachable over links, from all pairs that can be similar enough."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    frequency = collections.Counter(x for s in set(sets) for x in s)
    posting, first = collections.defaultdict(list), {}
    for i, s in zip(ids, sets):
        if not s:
            continue
        if s in first:
            join(first[s], i)
            continue
        first[s] = i
        ordered = sorted(s, key=lambda x: (frequency[x], x))
        others = set()
        for x in ordered[: len(s) - math.ceil(0.75 * len(s)) + 1]:
            others.update(posting[x])
            posting[x].append((i, s))
        for j, t in others:
            common = len(s & t)
            if 100 * common >= 75 * (len(s) + len(t) - common):
                join(i, j)
    return {i: find(i) for i in ids}


def repeated_bytes(texts: list[bytes], length: int) -> list[bytearray]:
    """Flags of the bytes that a string of ``length`` covers which starts somewhere else too."""
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        flags, end = bytearray(len(t)), 0
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                for k in range(max(i, end), i + length):
                    flags[k] = 1
                end = i + length
        out.append(flags)
    return out


def without_repeats(texts: list[bytes], words: int) -> list[bytes]:
    """Each text without its repeated strings of 400 bytes and runs of ``words`` words."""
    spans = [[w.span() for w in re.finditer(rb"[^\x20\x09-\x0D]+", t)] for t in texts]
    windows = [[tuple(t[a:b] for a, b in s[i : i + words]) for i in range(len(s) - words + 1)] for t, s in zip(texts, spans)]
    count = collections.Counter(w for ws in windows for w in ws)
    out = []
    for t, s, ws, flags in zip(texts, spans, windows, repeated_bytes(texts, 400)):
        for i, w in enumerate(ws):
            if count[w] > 1:
                a, b = s[i][0], s[i + words - 1][1]
                flags[a:b] = b"\1" * (b - a)
        if ws and texts.count(t) > 1:
            flags = b"\1" * len(t)
        out.append(bytes(b for b, f in zip(t, flags) if not f))
    return out


def contamination(texts: list[str | None], items: list[tuple[str, str | None]], window: int = 10):
    """(n_words, hit flags, item names) of each text."""
    phrases = collections.defaultdict(set)
    for name, text in items:
        w = ALNUM.findall(lower(text or ""))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases[tuple(w[i : i + window])].add(name)
    out = []
    for text in texts:
        w = ALNUM.findall(lower(text or ""))
        flags, names = [False] * len(w), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(w) - n + 1):
                if (p := tuple(w[i : i + n])) in phrases:
                    names |= phrases[p]
                    flags[i : i + n] = [True] * n
        out.append((len(w), flags, names))
    return out
