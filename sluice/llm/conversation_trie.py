"""The prefix tree of conversations, with totals of every subtree by parallel tree contraction.

A node stands for a distinct sequence of first turns (role and text) that some conversation
begins with; the root is the empty sequence. Steps:

1. ``ranked``: the turns of each conversation are numbered in their order.
2. ``rebuilt`` (optional): conversations that take their first turns from another one.
3. ``trie``: each turn gets the sum of the hashes of the turns so far (each hashed with its
   place), which names the node it stands at; rows are grouped by it. A node is addressed by its
   smallest member and its depth.
4. ``totals``: rounds of joins that alternately rake (all leaves give their sums to their parents
   and go) and compress (of each unary chain an independent set of nodes gives its sums upwards
   and is passed over), until nothing is left. Then the compressed nodes are expanded again, last
   round first: such a node's total is what it held plus the total of its only child. A round
   takes all leaves and, on average, a third of each chain's inner nodes.

Rows without conv_id belong to no conversation and are left out; a null role or text is empty;
turns without number come first, ties are ordered by role, then text, and equal rows are turns of
their own. Other columns are ignored. Without any conversation there is no node. Two sums of 60
bits stand for a sequence.

A conversation or a prefix may hold a third of all rows: turns are numbered and summed over range
partitions (``running``), nodes and messages are summed in the tasks first, and in a round each
node is joined with one row at most. Every round is written to the shared folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import rows, shuffle_partitions, store
from sluice.llm.running import MODULUS, running

#: Conversation ids in one row of ``ends``.
CHUNK = 1 << 16
_NODE = ["depth", "s1", "s2"]


def _bits(*columns) -> Column:
    return F.xxhash64(*columns).bitwiseAND(F.lit(MODULUS - 1))


def ranked(conversations: DataFrame) -> DataFrame:
    """conv_id, rank (long, from 1), role, text, t1, t2 (hashes of the two), n_bytes (of the text)."""
    empty = F.lit("")
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"),
    )
    turns = turns.select(
        "*",
        F.xxhash64(F.lit(1), "role", "text").alias("t1"),
        F.xxhash64(F.lit(2), "role", "text").alias("t2"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(1).cast("long").alias("rank"),
    )
    return running(turns, "conv_id", ["turn", "role", "text"], ["rank"]).drop("turn")


def sequences(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations as they are: (turns with place and whether it is the last, conversations
    with their lengths); ``turns`` as from ``ranked``."""
    lengths = turns.groupBy("conv_id").agg(F.max("rank").alias("length"))
    placed = turns.join(lengths, "conv_id").select(
        "conv_id", F.col("rank").alias("place"), (F.col("rank") == F.col("length")).alias("ends"), "t1", "t2", "n_bytes"
    )
    return placed, lengths


def rebuilt(turns: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """As ``sequences``, with each conversation made of the first ``head`` turns of conversation
    ``base`` (all, if it has fewer; none, if there is no such one) and its own turns after its
    first ``head``. ``base`` and ``head`` (0 to ``most``) are expressions of conv_id."""
    lengths = store(turns.groupBy("conv_id").agg(F.max("rank").alias("n")), "conversations")
    wanted = lengths.select("conv_id", "n", base.alias("base"), head.cast("long").alias("head"))
    of_base = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = wanted.join(of_base, "base", "left").select(
        "conv_id", "base", "head", F.least("head", F.coalesce("n_base", F.lit(0))).alias("taken"), "n"
    )
    plan = store(plan.withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0))), "conversations")
    last = (F.col("place") == F.col("length")).alias("ends")
    kept = ["conv_id", "place", last, "t1", "t2", "n_bytes"]
    early = turns.filter(F.col("rank") <= most).select(F.col("conv_id").alias("base"), F.col("rank").alias("place"), "t1", "t2", "n_bytes")
    heads = early.join(plan.select("conv_id", "base", "taken", "length"), "base").filter("place <= taken").select(*kept)
    own = turns.filter(F.col("rank") > head).join(plan.select("conv_id", "head", "taken", "length"), "conv_id")
    tails = own.withColumn("place", F.col("rank") - F.col("head") + F.col("taken")).select(*kept)
    return heads.unionByName(tails), plan.select("conv_id", "length")


def trie(placed: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends), of what ``sequences`` or ``rebuilt`` return.

    nodes: conv_id (the smallest member), depth, parent_conv_id, n_convs, n_bytes (of the last
    turn's text), s1, s2. ends: depth, s1, s2, first, conv_ids: the members whose last turn the
    node is, in order, in lists of up to ``CHUNK`` ids that begin with ``first``.
    """
    hashed = placed.select(
        "*", *[_bits(F.lit(k), "place", "t1", "t2").alias(f"p{k}") for k in (1, 2)]
    ).select("conv_id", "place", "ends", "n_bytes", "p1", "p2", F.col("p1").alias("s1"), F.col("p2").alias("s2"))
    summed = running(hashed, "conv_id", ["place"], ["s1", "s2"])
    before = [(F.col(f"s{k}") - F.col(f"p{k}")).bitwiseAND(F.lit(MODULUS - 1)).alias(f"u{k}") for k in (1, 2)]
    inner = summed.groupBy(F.col("place").alias("depth"), "s1", "s2").agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("n_bytes").alias("n_bytes"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
    )
    zero = F.lit(0).cast("long")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(
        zero.alias("depth"), zero.alias("s1"), zero.alias("s2"), "conv_id", "n_convs", zero.alias("n_bytes"),
        F.lit(None).cast("long").alias("u1"), F.lit(None).cast("long").alias("u2"),
    )
    found = store(inner.select(*_NODE, "conv_id", "n_convs", "n_bytes", *before).unionByName(root), "trie")
    above = found.select(
        (F.col("depth") + 1).alias("depth"), F.col("s1").alias("u1"), F.col("s2").alias("u2"), F.col("conv_id").alias("parent_conv_id")
    )
    nodes = found.join(above, ["depth", "u1", "u2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_bytes", "s1", "s2"
    )
    last = summed.filter("ends").select(F.col("place").alias("depth"), "s1", "s2", "conv_id")
    turnless = lengths.filter("length = 0").select(zero.alias("depth"), zero.alias("s1"), zero.alias("s2"), "conv_id")
    return store(nodes, "trie"), _listed(last.unionByName(turnless))


def _listed(members: DataFrame) -> DataFrame:
    """depth, s1, s2, first, conv_ids: sorted lists of bounded length, made from range partitions."""
    schema = pa.schema([*[(n, pa.int64()) for n in (*_NODE, "first")], ("conv_ids", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [np.asarray(batch.column(n)) for n in _NODE]
            new = np.ones(batch.num_rows, dtype=bool)
            new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
            begins = np.flatnonzero(new | (np.arange(batch.num_rows) % CHUNK == 0))
            ids = np.asarray(batch.column("conv_id"))
            ends = np.append(begins, batch.num_rows).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
            columns = [pa.array(c) for c in (*(k[begins] for k in keys), ids[begins])]
            yield pa.RecordBatch.from_arrays([*columns, lists], schema=schema)

    order = [*_NODE, "conv_id"]
    dealt = members.repartitionByRange(shuffle_partitions(members.sparkSession), *order).sortWithinPartitions(*order)
    return store(dealt.mapInArrow(work, "depth long, s1 long, s2 long, first long, conv_ids array<long>"), "trie-ends")


def digests(ends: DataFrame) -> DataFrame:
    """depth, s1, s2, ends_sha256: SHA-256 of the decimal ids of the node's lists, comma-joined.

    The lists of a node are streamed through one hash in order, one at a time."""
    schema = pa.schema([*[(n, pa.int64()) for n in _NODE], ("ends_sha256", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = None, None
        for batch in batches:
            done = []
            keys = zip(*(batch.column(n).to_pylist() for n in _NODE))
            for i, key in enumerate(keys):
                text = ",".join(map(str, batch.column("conv_ids")[i].values.to_pylist())).encode()
                if key == here:
                    state.update(b"," + text)
                    continue
                if here is not None:
                    done.append((*here, state.hexdigest()))
                here, state = key, hashlib.sha256(text)
            if done:
                yield rows(schema, **dict(zip(schema.names, zip(*done))))
        if here is not None:
            yield rows(schema, **{n: [v] for n, v in zip(schema.names, (*here, state.hexdigest()))})

    dealt = ends.repartition(shuffle_partitions(ends.sparkSession), *_NODE).sortWithinPartitions(*_NODE, "first")
    return dealt.mapInArrow(work, "depth long, s1 long, s2 long, ends_sha256 string")


def _left(state: DataFrame, told: DataFrame) -> DataFrame:
    """``state`` with the summed messages ``told`` (columns to_conv, to_depth, ...), a row a node."""
    match = (state["conv"] == told["to_conv"]) & (state["depth"] == told["to_depth"])
    return state.join(told, match, "left").drop("to_conv", "to_depth")


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _rake(state: DataFrame) -> DataFrame:
    """Without the leaves of ``state``; their parents have their sums."""
    told = (
        state.filter("n = 0 and up_conv is not null")
        .groupBy(F.col("up_conv").alias("to_conv"), F.col("up_depth").alias("to_depth"))
        .agg(
            F.count("*").alias("d_n"),
            F.bit_xor("conv").alias("x_conv"),
            F.bit_xor("depth").alias("x_depth"),
            F.sum("leaves").alias("d_leaves"),
            F.sum("saved").alias("d_saved"),
        )
    )
    return _left(state.filter("n > 0"), told).select(
        "conv", "depth", "up_conv", "up_depth",
        (F.col("n") - _or_zero("d_n")).alias("n"),
        F.col("kid_conv").bitwiseXOR(_or_zero("x_conv")).alias("kid_conv"),
        F.col("kid_depth").bitwiseXOR(_or_zero("x_depth")).alias("kid_depth"),
        (F.col("leaves") + _or_zero("d_leaves")).alias("leaves"),
        (F.col("saved") + _or_zero("d_saved")).alias("saved"),
    )


def _passed_over(turn: int) -> Column:
    """Unary nodes whose lot is smaller than their parent's and their child's: no two of them
    are next to each other. Such a node decides from its own row."""
    lot = lambda kind: F.xxhash64(F.lit(turn), F.col(f"{kind}conv"), F.col(f"{kind}depth"))
    chosen = (F.col("n") == 1) & F.col("up_conv").isNotNull() & (lot("") < lot("kid_")) & (lot("") < lot("up_"))
    return F.coalesce(chosen, F.lit(False))


def _compress(state: DataFrame, chosen: Column) -> DataFrame:
    """Without the ``chosen`` nodes: their parents have their sums, and their children as children."""
    gone = state.filter(chosen)
    none = F.lit(None).cast("long")
    upwards = gone.select(
        F.col("up_conv").alias("to_conv"), F.col("up_depth").alias("to_depth"),
        F.col("conv").bitwiseXOR(F.col("kid_conv")).alias("x_conv"),
        F.col("depth").bitwiseXOR(F.col("kid_depth")).alias("x_depth"),
        "leaves", "saved", none.alias("new_conv"), none.alias("new_depth"),
    )
    zero = F.lit(0).cast("long")
    downwards = gone.select(
        F.col("kid_conv").alias("to_conv"), F.col("kid_depth").alias("to_depth"),
        zero.alias("x_conv"), zero.alias("x_depth"), zero.alias("leaves"), zero.alias("saved"),
        F.col("up_conv").alias("new_conv"), F.col("up_depth").alias("new_depth"),
    )
    told = upwards.unionByName(downwards).groupBy("to_conv", "to_depth").agg(
        F.bit_xor("x_conv").alias("x_conv"),
        F.bit_xor("x_depth").alias("x_depth"),
        F.sum("leaves").alias("d_leaves"),
        F.sum("saved").alias("d_saved"),
        F.max("new_conv").alias("new_conv"),
        F.max("new_depth").alias("new_depth"),
    )
    return _left(state.filter(~chosen), told).select(
        "conv", "depth",
        F.coalesce("new_conv", "up_conv").alias("up_conv"),
        F.coalesce("new_depth", "up_depth").alias("up_depth"),
        "n",
        F.col("kid_conv").bitwiseXOR(_or_zero("x_conv")).alias("kid_conv"),
        F.col("kid_depth").bitwiseXOR(_or_zero("x_depth")).alias("kid_depth"),
        (F.col("leaves") + _or_zero("d_leaves")).alias("leaves"),
        (F.col("saved") + _or_zero("d_saved")).alias("saved"),
    )


def totals(nodes: DataFrame) -> DataFrame:
    """conv_id, depth, n_children, n_leaves, saved: of every node of ``nodes`` (conv_id, depth,
    parent_conv_id, saved: long) its children, and the childless nodes and the sum of ``saved``
    in its subtree, itself included."""
    kids = nodes.filter("parent_conv_id is not null").groupBy(
        F.col("parent_conv_id").alias("to_conv"), (F.col("depth") - 1).alias("to_depth")
    ).agg(F.count("*").alias("n"), F.bit_xor("conv_id").alias("kid_conv"), F.bit_xor("depth").alias("kid_depth"))
    own = nodes.select(
        F.col("conv_id").alias("conv"), "depth", F.col("parent_conv_id").alias("up_conv"),
        F.when(F.col("parent_conv_id").isNotNull(), F.col("depth") - 1).alias("up_depth"), "saved",
    )
    start = _left(own, kids).select(
        "conv", "depth", "up_conv", "up_depth", _or_zero("n").alias("n"), _or_zero("kid_conv").alias("kid_conv"),
        _or_zero("kid_depth").alias("kid_depth"), F.col("n").isNull().cast("long").alias("leaves"), "saved",
    )
    state = start = store(start, "contraction")
    sums = ["conv", "depth", "leaves", "saved"]
    known, chains, turn = [], [], 0
    while not state.isEmpty():
        known.append((turn, state.filter("n = 0").select(*sums)))
        state = store(_rake(state), "contraction")
        chosen = _passed_over(turn)
        chain = state.filter(chosen).select(*sums, "kid_conv", "kid_depth")
        if not chain.isEmpty():
            chains.append((turn, chain))
            state = store(_compress(state, chosen), "contraction")
        turn += 1
    for when, chain in reversed(chains):
        later = None  # the totals of all nodes that were left after the round: fewer with each round
        for t, part in known:
            if t > when:
                later = part if later is None else later.unionByName(part)
        later = later.select(
            F.col("conv").alias("kid_conv"), F.col("depth").alias("kid_depth"), F.col("leaves").alias("k_leaves"), F.col("saved").alias("k_saved")
        )
        whole = chain.join(later, ["kid_conv", "kid_depth"]).select(
            "conv", "depth", (F.col("leaves") + F.col("k_leaves")).alias("leaves"), (F.col("saved") + F.col("k_saved")).alias("saved")
        )
        known.append((when, store(whole, "contraction")))
    found = known[0][1] if known else start.select(*sums)
    for _, part in known[1:]:
        found = found.unionByName(part)
    children = start.select(F.col("conv").alias("conv_id"), "depth", F.col("n").alias("n_children"))
    found = found.select(F.col("conv").alias("conv_id"), "depth", F.col("leaves").alias("n_leaves"), "saved")
    return children.join(found, ["conv_id", "depth"])


def summary(placed: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (bytes of last texts that shared prefixes save in the subtree), ends_sha256."""
    nodes, ends = trie(placed, lengths)
    own = nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("n_bytes"))
    found = nodes.join(totals(own.select("conv_id", "depth", "parent_conv_id", "saved")), ["conv_id", "depth"])
    return found.join(digests(ends), _NODE, "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def last_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` of conversations as they are (``sequences``) with role and text of each node's
    last turn; the root has none."""
    of = turns.select("conv_id", F.col("rank").alias("depth"), "role", "text")
    return nodes.join(of, ["conv_id", "depth"], "left")
