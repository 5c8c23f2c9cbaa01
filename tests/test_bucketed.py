"""Targets stored in key buckets: the same rows, and wide merges that do not move the table."""

import dataclasses
import datetime as dt
import random

import pytest

from sluice.operators import bucketed, load, swap
from sluice.plans import tables as TB

BAL = "on_date date, account_rk bigint, currency_rk int, balance_out double"
SPEC = dataclasses.replace(TB.FT_BALANCE_F, store_buckets=5)
DAYS = [dt.date(2015 + m // 12, 1 + m % 12, 1 + m % 27) for m in range(30)]


def _batches(n=4):
    rng = random.Random(5)
    for k in range(n):
        days = DAYS if k % 2 == 0 else DAYS[:2]
        yield {(rng.choice(days), rng.randrange(40)): (rng.randrange(9), float(k)) for _ in range(300)}


def _rows(batch):
    return [(d, a, c, v) for (d, a), (c, v) in batch.items()]


@pytest.mark.parametrize("folders,listed", [(1, 10_000), (100, 10_000), (1, 3)])
def test_merges_give_the_same_rows(spark, workdir, monkeypatch, folders, listed):
    """Wide merges, narrow ones (two months) and more partitions than are listed."""
    monkeypatch.setattr(load, "READ_FOLDERS_UP_TO", folders)
    monkeypatch.setattr(load, "MAX_PARTITION_LIST", listed)
    want, t = {}, f"{workdir}/t"
    for batch in _batches():
        load.upsert(spark, SPEC, spark.createDataFrame(_rows(batch), BAL), t)
        want |= batch
    assert sorted(map(tuple, load.read_table(spark, SPEC, t).collect())) == sorted(_rows(want))
    files = swap.FileSystem(spark, t)
    names = [n for f in swap.leaf_folders(files, t, 1) for n in files.names(f"{t}/{f}", folders=False)]
    assert names and all(n.rpartition("_")[2][:5].isdigit() for n in names)  # every file is of one bucket
    assert not spark.catalog.listTables()


def test_wide_merge_shuffles_neither_side(spark, workdir):
    t = f"{workdir}/t"
    first, second = (spark.createDataFrame(_rows(b), BAL) for b in list(_batches(3))[::2])
    load.upsert(spark, SPEC, first, t)
    summary = load.check_batch(SPEC, second)
    keyed = spark.read.parquet(summary["keyed"]).schema
    with (
        bucketed.table(spark, SPEC, t, load.target_schema(SPEC), load.partition_columns(SPEC)) as target,
        bucketed.table(spark, SPEC, summary["keyed"], keyed, []) as batch,
    ):
        batch = spark.table(batch)
        kept = bucketed.kept_rows(load._touched(spark.table(target), batch, SPEC, summary), batch, SPEC)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2 and "PartitionFilters: [on_date_month" in plan
        assert kept.rdd.getNumPartitions() == SPEC.store_buckets
        n = kept.count()
    plain = dataclasses.replace(SPEC, store_buckets=0)
    other = load.merged_rows(spark, plain, t, summary, 1)
    assert "Exchange" in other._jdf.queryExecution().executedPlan().toString()
    assert other.count() == n + summary["keys"]


def test_lost_wide_merge_leaves_old_or_new(spark, workdir, monkeypatch):
    t = f"{workdir}/t"
    first, second = list(_batches(3))[::2]
    load.upsert(spark, SPEC, spark.createDataFrame(_rows(first), BAL), t)
    monkeypatch.setattr(load, "READ_FOLDERS_UP_TO", 1)
    for call, want in (("decide", first), ("finish", first | second)):
        with monkeypatch.context() as m:
            real = getattr(swap, call)
            seen = []

            def lost(*args, _seen=seen, _real=real, _call=call, **kw):
                _seen.append(args)
                if _call == "decide" or len(_seen) > 2:  # loads complete earlier swaps first, twice
                    raise KeyboardInterrupt
                return _real(*args, **kw)

            m.setattr(swap, call, lost)
            with pytest.raises(KeyboardInterrupt):
                load.upsert(spark, SPEC, spark.createDataFrame(_rows(second), BAL), t)
        assert sorted(map(tuple, load.read_table(spark, SPEC, t).collect())) == sorted(_rows(want))
    assert load.complete_swap(spark, t)
    assert sorted(map(tuple, load.read_table(spark, SPEC, t).collect())) == sorted(_rows(first | second))


def test_spec_says_where_buckets_are_possible():
    for wrong in (dict(key_buckets=2), dict(partition_date=None)):
        with pytest.raises(ValueError):
            dataclasses.replace(SPEC, **wrong)
    with pytest.raises(ValueError):
        dataclasses.replace(TB.FT_POSTING_F, store_buckets=4)
