"""Running sums within groups whose rows may fill many partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import shuffle_partitions, store

#: Sums are taken modulo this, so that adding two never leaves 64 bits (ANSI mode raises there).
MODULUS = 1 << 60
_PART, _EDGE = "_run_part", "_run_edge"


def _carries(edges: list, sums: list[str]) -> list[tuple]:
    """(part, group, what earlier parts hold of the group that the part begins with)."""
    firsts = {e["part"]: e for e in edges if e["edge"] & 1}
    lasts = {e["part"]: e for e in edges if e["edge"] & 2}
    out, before, carry = [], None, [0] * len(sums)
    for part in sorted(firsts):
        group = firsts[part]["group"]
        if before is None or before["group"] != group:
            carry = [0] * len(sums)
        else:
            whole = firsts[before["part"]]["group"] == group  # a part of this group alone passes its own carry on
            carry = [(before[s] + (c if whole else 0)) % MODULUS for s, c in zip(sums, carry)]
            out.append((part, group, *carry))
        before = lasts[part]
    return out


def running(df: DataFrame, group: str, order: list[str], sums: list[str]) -> DataFrame:
    """``df`` with each column of ``sums`` (long, 0 to 2^60 - 1, not null) replaced by the sum,
    modulo 2^60, of its values in the rows of the same ``group`` (long, not null) up to the row.

    Rows are range partitioned by group and ``order``, so a group that holds a third of all rows
    is spread over tasks; each part sums by itself, and what earlier parts hold of the group that
    a part begins with is added afterwards. Two rows a part reach the driver. Ties in ``order``
    get different places, which are fixed by the rows having been written.
    """
    spark = df.sparkSession
    fields = [(f.name, f.dataType.simpleString()) for f in df.schema]
    columns = [n for n, _ in fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held, begun = TaskContext.get().partitionId(), None, None, False
        totals = dict.fromkeys(sums, np.uint64(0))

        def mark(batch: pa.RecordBatch, first: bool, final: bool) -> pa.RecordBatch:
            edge = np.zeros(batch.num_rows, dtype=np.int32)
            edge[0] |= int(first)
            edge[-1] |= 2 * int(final)
            parts = pa.array(np.full(batch.num_rows, part, dtype=np.int32))
            return pa.RecordBatch.from_arrays([*batch.columns, parts, pa.array(edge)], names=[*columns, _PART, _EDGE])

        for batch in batches:
            if not batch.num_rows:
                continue
            g = np.asarray(batch.column(group))
            new = np.ones(len(g), dtype=bool)
            new[1:] = g[1:] != g[:-1]
            start = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
            goes_on = start == 0 if last is not None and g[0] == last else np.zeros(len(g), dtype=bool)
            made = {}
            for s in sums:
                v = np.asarray(batch.column(s)).astype(np.uint64)
                c = np.cumsum(v)  # wraps at 2^64, of which 2^60 is a divisor
                c = c - c[start] + v[start]
                c[goes_on] += totals[s]
                c &= np.uint64(MODULUS - 1)
                totals[s] = c[-1]
                made[s] = pa.array(c.astype(np.int64))
            last = g[-1]
            if held is not None:
                yield mark(held, not begun, False)
                begun = True
            held = pa.RecordBatch.from_arrays([made.get(n, batch.column(n)) for n in columns], names=columns)
        if held is not None:
            yield mark(held, not begun, True)

    schema = ", ".join(f"`{n}` {t}" for n, t in [*fields, (_PART, "int"), (_EDGE, "int")])
    dealt = df.repartitionByRange(shuffle_partitions(spark), group, *order).sortWithinPartitions(group, *order)
    made = store(dealt.mapInArrow(work, schema), "running")
    edges = made.filter(F.col(_EDGE) > 0).select(
        F.col(_PART).alias("part"), F.col(_EDGE).alias("edge"), F.col(group).alias("group"), *sums
    )
    carries = _carries(edges.collect(), sums)  # at most two rows a partition
    if not carries:
        return made.select(*columns)
    names = [f"_run_{i}" for i in range(len(sums))]
    more = spark.createDataFrame(carries, f"{_PART} int, _run_group long, " + ", ".join(f"{n} long" for n in names))
    same = (made[_PART] == more[_PART]) & (made[group] == more["_run_group"])
    joined = made.join(F.broadcast(more), same, "left")  # at most a row a partition

    def total(name: str):
        return (made[name] + F.coalesce(more[names[sums.index(name)]], F.lit(0))).bitwiseAND(F.lit(MODULUS - 1)).alias(name)

    return joined.select(*[total(n) if n in sums else made[n] for n in columns])
