"""Weighted automata and phrases against plain counts."""

import collections
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import collocations, queries
from sluice.llm.automata import Automaton, build

from .helpers import documents, empty, lower, odd_texts, sentence

KEYS = st.dictionaries(st.lists(st.sampled_from([b"a", b"b", b"\xc3\xa9", b"\x01"]), max_size=4).map(tuple), st.integers(0, 99), max_size=40)


@settings(max_examples=200, deadline=None)
@given(KEYS, KEYS)
def test_automata(one, two):
    first, second = build(sorted(one.items())), build(sorted(two.items()))
    again = Automaton.load(first.dump())
    assert list(again.items()) == list(first.items()) == sorted(one.items())
    assert list(again.compose(second)) == sorted((k, n) for k, n in one.items() if k in two)


@settings(max_examples=100, deadline=None)
@given(KEYS)
def test_automata_are_minimal(one):
    """No two states accept the same rest with the same weights."""
    made = build(sorted(one.items()))
    rests = {}
    for n in range(len(made.states)):
        rest = tuple(Automaton(made.states[: n + 1]).items())
        assert rests.setdefault(rest, n) == n or n == len(made.states) - 1


def counts(rows):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    return f, n


def brute(rows, least=30, top=2000, percent=80):
    found, n = counts(rows)
    out = set()
    for lang, f in found.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = collections.Counter()
        for p, a in often.items():
            for i in range(len(p)):
                for e in range(i + 2, len(p) + 1):
                    if e - i < len(p):
                        inside[p[i:e]] = max(inside[p[i:e]], a)
        scored = []
        for p, a in often.items():
            if 100 * inside[p] >= percent * a:
                continue
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return out


def checked(df, want):
    found = [tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(found) == len(set(found)) and set(found) == want


def texts():
    pair = "New York, new york new york new york! "
    return [
        *odd_texts(), pair * 30, "a b c d " * 40, "a b. c d\nb c\tb  c;" * 35, "\x01x \x01x y\x1f z " * 33, "é É e " * 31,
        "of the " * 20 + "top of the hill, " * 31, " . , ;; \n\r\x0b\x0c ", "x\x00y x\x00y " * 30,
    ]


@pytest.mark.parametrize("least,top,shard,per_range", [(30, 2000, 8 << 20, 20_000), (2, 50, 3000, 7), (1, 9, 100, 3)])
def test_odd_documents_against_brute_force(spark, monkeypatch, least, top, shard, per_range):
    monkeypatch.setattr(collocations, "SHARD_BYTES", shard)
    monkeypatch.setattr(collocations, "RANGE_KEYS", per_range)
    some = texts() if least > 2 else [t for t in texts() if len(t or "") < 5000]
    docs = documents(spark, some)
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    checked(collocations.collocations(docs, least, top), brute(rows, least, top))


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_query_against_brute_force(spark, scale):
    sf = f"/root/testdata/sf{scale}"
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("lang", "text").collect()]
    checked(queries.op13_collocations(spark, sf), brute(rows))


def test_languages_and_empty_tables(spark):
    assert collocations.collocations(empty(spark)).count() == 0
    assert collocations.collocations(documents(spark, [None, "", " . "], repeat=False)).count() == 0
    rows = [(lang, "one two " * 30) for lang in ("a b\t", "und", None, "é", "")]
    checked(collocations.collocations(spark.createDataFrame(rows, "lang string, text string")), brute(rows))


def test_sentences_of_many_shards(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SHARD_BYTES", 2000)
    rows = [("en" if i % 3 else "de", sentence(i % 40, 80) + ". " + "the same phrase again " * (i % 2)) for i in range(400)]
    checked(collocations.collocations(spark.createDataFrame(rows, "lang string, text string").repartition(7)), brute(rows))
