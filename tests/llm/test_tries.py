"""The conversation tree against a plain one."""

import hashlib
import random
import zlib

import pytest

from sluice.llm import conversation_trie, queries
from sluice.llm.running import MODULUS, running

COLUMNS = "conv_id long, turn long, role string, text string, depth string, n int, length string, s1 string"


def brute(rows, base=None, head=None):
    """{(smallest member, depth): the other columns} of (conv_id, turn, role, text) rows."""
    original = {}
    for c, turn, role, text in rows:
        if c is not None:
            original.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    original = {c: [t[2:] for t in sorted(ts)] for c, ts in original.items()}
    made = original
    if base:
        made = {c: original.get(base(c), [])[: head(c)] + ts[head(c) :] for c, ts in original.items()}
    members, ends = {}, {}
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members.setdefault(tuple(made[c][:d]), []).append(c)
        ends.setdefault(tuple(made[c]), []).append(c)
    below = {p: [0, 0, 0] for p in members}  # children, leaves, saved
    for p in members:
        if p:
            below[p[:-1]][0] += 1
    for p, ms in members.items():
        saved = (len(ms) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            below[p[:d]][2] += saved
            below[p[:d]][1] += below[p][0] == 0
    out = {}
    for p, ms in members.items():
        digest = hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest()
        out[ms[0], len(p)] = (members[p[:-1]][0] if p else None, len(ms), *below[p], digest)
    return out


def rest(r):
    return r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256


def checked(df, want):
    found = df.collect()
    assert len(found) == len(want)
    assert {(r.conv_id, r.depth): rest(r) for r in found} == want


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], COLUMNS)


def odd_rows():
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["u", "a"]), rng.choice("abc")) for c in range(60) for t in range(rng.randrange(9))]
    rows += [(100 + c, t, "u", "same") for c in range(40) for t in range(12)]  # one path, many members
    rows += [(200, t, "u", f"é{t}") for t in range(90)]  # a long chain
    rows += [(201, t, "u", f"é{t}") for t in range(45)] + [(201, 45 + t, "u", "other") for t in range(20)]
    rows += [(300 + c, 0, "u", f"first {c}") for c in range(150)]  # many leaves of one node
    rows += [(-7, 0, "u", "below zero"), (-6, 0, None, ""), (-6, 1, "", None), (-5, None, "u", "no number"), (-5, 0, "u", "n")]
    rows += [(500, 1, "u", "tie"), (500, 1, "a", "tie"), (500, 1, "a", "tie"), (500, 1, "a", "sie"), (500, None, None, None)]
    rows += [(None, 0, "u", "nobody's"), (501, 3, "u", "x" * 100_000), (502, 3, "u", "x" * 100_000)]
    rng.shuffle(rows)
    return rows


def test_conversations_as_they_are(spark):
    rows = odd_rows()
    turns = conversation_trie.ranked(table(spark, rows))
    checked(conversation_trie.summary(*conversation_trie.sequences(turns)), brute(rows))
    nodes, _ = conversation_trie.trie(*conversation_trie.sequences(turns))
    texts = {(r.conv_id, r.depth): (r.role, r.text) for r in conversation_trie.last_turns(nodes, turns).collect()}
    assert texts[200, 90] == ("u", "é89") and texts[-6, 2] == ("", "") and texts[-7, 0] == (None, None)


def crc_head(c):
    return zlib.crc32(str(c).encode()) % 9


@pytest.mark.parametrize("name", ["odd", "sf0.001", "sf0.01"])
def test_query_against_brute_force(spark, name, workdir):
    path = f"/root/testdata/{name}"
    if name == "odd":
        path = workdir
        table(spark, odd_rows()).write.parquet(f"{path}/conversations.parquet")
    found = queries.op11_conversation_trie(spark, path)
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    checked(found, brute(rows, lambda c: c - (abs(c) % 5) * (1 if c >= 0 else -1), crc_head))


def test_no_conversations(spark):
    turns = conversation_trie.ranked(table(spark, []))
    assert conversation_trie.summary(*conversation_trie.sequences(turns)).count() == 0
    turns = conversation_trie.ranked(table(spark, [(None, 1, "u", "t")]))
    assert conversation_trie.summary(*conversation_trie.rebuilt(turns, *_own())).count() == 0


def _own():
    from pyspark.sql import functions as F

    return F.col("conv_id"), F.lit(0), 0


def test_running_sums_over_parts(spark):
    rng = random.Random(1)
    rows = [(g, i, rng.randrange(MODULUS), i) for g, n in ((5, 900), (6, 1), (7, 3), (-1, 40), (9, 500)) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g long, i long, v long, w long")
    found = {(r.g, r.i): (r.v, r.w) for r in running(df, "g", ["i"], ["v", "w"]).collect()}
    want, sums = {}, {}
    for g, i, v, w in sorted(rows):
        a, b = sums.get(g, (0, 0))
        want[g, i] = sums[g] = ((a + v) % MODULUS, b + w)
    assert found == want
    assert running(df.limit(0), "g", ["i"], ["v"]).count() == 0
