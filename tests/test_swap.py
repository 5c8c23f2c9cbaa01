"""Loads that are broken off at any point of their swap: readers find old rows or new ones."""

import dataclasses
import datetime as dt

import pytest

from sluice.operators import load, swap
from sluice.plans import tables as TB

J1, F1, M1 = dt.date(2018, 1, 1), dt.date(2018, 2, 1), dt.date(2018, 3, 1)
BAL = "on_date date, account_rk bigint, currency_rk int, balance_out double"
POST = "oper_date date, credit_account_rk bigint, debet_account_rk bigint, credit_amount double, debet_amount double"
SPEC = TB.FT_BALANCE_F
BUCKETS = dataclasses.replace(SPEC, key_buckets=3)
PLAIN = dataclasses.replace(TB.FT_POSTING_F, partition_date=None)

OLD = [(J1, 1, 1, 1.0), (J1, 2, 1, 1.0), (F1, 3, 1, 1.0), (M1, 4, 1, 1.0)]
BATCH = [(J1, 2, 1, 9.0), (F1, 3, 1, 9.0), (F1, 5, 1, 9.0), (dt.date(2019, 1, 1), 6, 1, 9.0)]
NEW = sorted([(J1, 1, 1, 1.0), (M1, 4, 1, 1.0), *BATCH])


class Lost(Exception):
    """The driver is gone."""


def breaking(monkeypatch, call, after):
    """Lets ``after`` file-system calls of a kind through; the next one ends the load."""
    real, seen = getattr(swap.FileSystem, call), []

    def once(self, *args):
        seen.append(args)
        if len(seen) > after:
            raise Lost
        return real(self, *args)

    monkeypatch.setattr(swap.FileSystem, call, once)
    monkeypatch.setattr(swap, "CALLS", 1)


def rows(spark, spec, path):
    return sorted(map(tuple, load.read_table(spark, spec, path).collect()))


@pytest.mark.parametrize("spec", [SPEC, BUCKETS], ids=["months", "buckets"])
@pytest.mark.parametrize(
    "call,after,decided",
    [("write", 0, False), ("rename", 0, False), ("rename", 1, True), ("rename", 2, True), ("delete", 1, True), ("delete", 2, True)],
)
def test_upsert_broken_off(spark, workdir, monkeypatch, spec, call, after, decided):
    t = f"{workdir}/t"
    load.upsert(spark, spec, spark.createDataFrame(OLD, BAL), t)
    assert swap.note_of(spark, t) is None
    breaking(monkeypatch, call, after)
    with pytest.raises(Lost):
        load.upsert(spark, spec, spark.createDataFrame(BATCH, BAL), t)
    monkeypatch.undo()
    want = NEW if decided else sorted(OLD)
    assert rows(spark, spec, t) == want  # read while the swap stands still
    assert (swap.note_of(spark, t) is not None) == decided
    ranged = load.read_table(spark, spec, t, date_from=F1, date_to=dt.date(2018, 2, 28))
    assert sorted(map(tuple, ranged.collect())) == [r for r in want if r[0] == F1]
    folders = [v for v in [(F1, 0), (F1, 1), (F1, 2)]] if spec is BUCKETS else [F1]
    some = load.read_partitions(spark, spec, t, folders)
    assert sorted(tuple(r)[:4] for r in some.collect()) == [r for r in want if r[0] == F1]
    # The next load completes the swap first; the batch merged again changes nothing.
    load.upsert(spark, spec, spark.createDataFrame(BATCH, BAL), t)
    assert rows(spark, spec, t) == NEW and swap.note_of(spark, t) is None
    assert sorted(tuple(r)[:4] for r in spark.read.parquet(t).select(*spec.columns).collect()) == NEW  # any reader
    assert not load.path_exists(spark, f"{t}/{swap.PENDING}")


@pytest.mark.parametrize("spec", [TB.FT_POSTING_F, PLAIN], ids=["months", "plain"])
@pytest.mark.parametrize(
    "call,after,decided",
    [("write", 0, False), ("rename", 0, False), ("rename", 1, True), ("delete", 1, True), ("delete", 2, True)],
)
def test_overwrite_broken_off(spark, workdir, monkeypatch, spec, call, after, decided):
    old = [(J1, 1, 2, 1.0, 0.1), (F1, 2, 2, 1.0, 0.1), (M1, 3, 2, 1.0, 0.1)]
    new = [(F1, 7, 2, 1.0, 0.1), (dt.date(2019, 5, 1), 8, 2, 1.0, 0.1)]
    t = f"{workdir}/t"
    load.overwrite(spark, spec, spark.createDataFrame(old, POST).coalesce(1), t)
    breaking(monkeypatch, call, after)
    with pytest.raises(Lost):
        load.overwrite(spark, spec, spark.createDataFrame(new, POST).coalesce(1), t)
    monkeypatch.undo()
    assert rows(spark, spec, t) == (new if decided else old)
    assert load.complete_swap(spark, t) == decided
    assert rows(spark, spec, t) == (new if decided else old)
    assert load.overwrite(spark, spec, spark.createDataFrame(new, POST), t)["rows_loaded"] == 2
    assert rows(spark, spec, t) == new


def test_first_load_broken_off(spark, workdir, monkeypatch):
    t = f"{workdir}/t"
    breaking(monkeypatch, "write", 0)
    with pytest.raises(Lost):
        load.upsert(spark, SPEC, spark.createDataFrame(OLD, BAL), t)
    monkeypatch.undo()
    assert rows(spark, SPEC, t) == []
    load.upsert(spark, SPEC, spark.createDataFrame(OLD, BAL), t)
    assert rows(spark, SPEC, t) == sorted(OLD)


def test_completing_can_itself_be_broken_off(spark, workdir, monkeypatch):
    t = f"{workdir}/t"
    load.upsert(spark, SPEC, spark.createDataFrame(OLD, BAL), t)
    breaking(monkeypatch, "rename", 1)
    with pytest.raises(Lost):
        load.upsert(spark, SPEC, spark.createDataFrame(BATCH, BAL), t)
    for after in range(1, 4):
        monkeypatch.undo()
        assert rows(spark, SPEC, t) == NEW
        breaking(monkeypatch, "delete" if after > 1 else "rename", after - 1)
        try:
            load.complete_swap(spark, t)
        except Lost:
            pass
    monkeypatch.undo()
    load.complete_swap(spark, t)
    assert rows(spark, SPEC, t) == NEW and swap.note_of(spark, t) is None
