import datetime as dt

import pytest

from sluice.operators import journal
from sluice.operators.load import read_table
from sluice.plans import tables as TB
from sluice.sources.delimited import write_delimited
from sluice.streaming import stream_feed

RAW = "ON_DATE string, ACCOUNT_RK string, CURRENCY_RK string, BALANCE_OUT string"


def test_two_drops_are_merged(spark, workdir):
    folder, target, ckpt, jpath = f"{workdir}/in", f"{workdir}/ds", f"{workdir}/ckpt", f"{workdir}/journal"
    write_delimited(spark.createDataFrame([("1.1.2018", "1", "1", "10"), ("1.1.2018", "2", "1", "20")], RAW).coalesce(1),
                    f"{folder}/drop1")
    q = stream_feed(spark, TB.FT_BALANCE_F, f"{folder}/*", target, ckpt, journal_path=jpath)
    q.awaitTermination()
    write_delimited(spark.createDataFrame([("1.1.2018", "2", "1", "25"), ("2.2.2018", "3", "1", "30"),
                                           ("31.2.2018", "4", "1", "40")], RAW).coalesce(1), f"{folder}/drop2")
    q = stream_feed(spark, TB.FT_BALANCE_F, f"{folder}/*", target, ckpt, journal_path=jpath)
    q.awaitTermination()
    rows = sorted((r.account_rk, r.balance_out) for r in read_table(spark, TB.FT_BALANCE_F, target).collect())
    assert rows == [(1, 10.0), (2, 25.0), (3, 30.0)]
    state = journal.fold(journal.read_events(spark, jpath)).collect()
    assert sorted(r.status for r in state) == ["Success", "Success"]
    assert all(r.run_id.startswith("ft_balance_f:") for r in state)
    assert dt.date(2018, 2, 2) in {r.on_date for r in read_table(spark, TB.FT_BALANCE_F, target).collect()}


def _drop(spark, path, *rows):
    write_delimited(spark.createDataFrame(list(rows), RAW).coalesce(1), path)


@pytest.mark.parametrize("max_files", [None, 1])
def test_waiting_drops_are_loaded_in_order(spark, workdir, max_files):
    folder, target = f"{workdir}/in", f"{workdir}/ds"
    _drop(spark, f"{folder}/d1", ("1.1.2018", "1", "1", "10"), ("1.1.2018", "2", "1", "20"))
    _drop(spark, f"{folder}/d2", ("1.1.2018", "2", "1", "25"), ("1.1.2018", "3", "1", "30"))
    q = stream_feed(spark, TB.FT_BALANCE_F, f"{folder}/*", target, f"{workdir}/ckpt", max_files=max_files)
    q.awaitTermination()
    rows = sorted((r.account_rk, r.balance_out) for r in read_table(spark, TB.FT_BALANCE_F, target).collect())
    assert rows == [(1, 10.0), (2, 25.0), (3, 30.0)]


def test_files_of_a_plain_folder_are_drops(spark, workdir):
    folder, target = f"{workdir}/in", f"{workdir}/ds"
    for i, amount in enumerate(("10", "11")):
        _drop(spark, f"{workdir}/w{i}", ("1.1.2018", "1", "1", amount))
        spark.read.text(f"{workdir}/w{i}").coalesce(1).write.mode("append").text(folder)
    stream_feed(spark, TB.FT_BALANCE_F, folder, target, f"{workdir}/ckpt").awaitTermination()
    assert [r.account_rk for r in read_table(spark, TB.FT_BALANCE_F, target).collect()] == [1]


def test_full_replacement_is_refused(spark, workdir):
    with pytest.raises(ValueError, match="cannot replace"):
        stream_feed(spark, TB.FT_POSTING_F, f"{workdir}/in", f"{workdir}/ds", f"{workdir}/ckpt", max_files=1)


def _place(workdir, folder, name, text, at):
    """One CSV file with a file time of its own."""
    import os

    os.makedirs(f"{workdir}/{folder}", exist_ok=True)
    path = f"{workdir}/{folder}/{name}"
    with open(path, "w") as f:
        f.write("ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT\n" + text)
    os.utime(path, (at, at))


def _balances(spark, target):
    return sorted((r.account_rk, r.balance_out) for r in read_table(spark, TB.FT_BALANCE_F, target).collect())


@pytest.mark.parametrize("max_files", [None, 1, 2])
@pytest.mark.parametrize("drops", ["folders", "files"])
def test_order_is_by_file_time_whatever_a_trigger_takes(spark, workdir, max_files, drops):
    inbox = "in/drop9", "in/drop10", "in/drop11"
    if drops == "files":
        inbox = "in", "in", "in"
    _place(workdir, inbox[0], "a9.csv", "1.1.2018;1;1;111\n1.1.2018;2;1;111\n", 1_600_000_000)
    _place(workdir, inbox[1], "a10.csv", "1.1.2018;1;1;222\n1.1.2018;3;1;222\n", 1_600_000_100)
    _place(workdir, inbox[2], "a11.csv", "1.1.2018;4;1;333\n", 1_600_000_100)
    folder = f"{workdir}/in/*" if drops == "folders" else f"{workdir}/in"
    stream_feed(spark, TB.FT_BALANCE_F, folder, f"{workdir}/ds", f"{workdir}/ckpt", max_files=max_files).awaitTermination()
    assert _balances(spark, f"{workdir}/ds") == [(1, 222.0), (2, 111.0), (3, 222.0), (4, 333.0)]


@pytest.mark.parametrize("max_files", [None, 1])
def test_late_file_of_an_early_drop_overwrites_nothing(spark, workdir, max_files):
    _place(workdir, "in/a", "1.csv", "1.1.2018;1;1;10\n1.1.2018;2;1;10\n", 1_600_000_000)
    _place(workdir, "in/b", "1.csv", "1.1.2018;2;1;20\n1.1.2018;3;1;20\n", 1_600_000_100)
    _place(workdir, "in/a", "2.csv", "1.1.2018;3;1;10\n1.1.2018;4;1;10\n", 1_600_000_200)
    args = spark, TB.FT_BALANCE_F, f"{workdir}/in/*", f"{workdir}/ds", f"{workdir}/ckpt"
    stream_feed(*args, max_files=max_files).awaitTermination()
    assert _balances(spark, f"{workdir}/ds") == [(1, 10.0), (2, 20.0), (3, 20.0), (4, 10.0)]
    _place(workdir, "in/a", "3.csv", "1.1.2018;3;1;10\n1.1.2018;5;1;30\n", 1_600_000_300)  # in a later start
    _place(workdir, "in/c", "1.csv", "1.1.2018;1;1;40\n", 1_600_000_250)
    stream_feed(*args, max_files=max_files).awaitTermination()
    assert _balances(spark, f"{workdir}/ds") == [(1, 40.0), (2, 20.0), (3, 20.0), (4, 10.0), (5, 30.0)]


def test_conflicts_within_a_drop_across_triggers(spark, workdir):
    from pyspark.errors import StreamingQueryException

    _place(workdir, "in/a", "1.csv", "1.1.2018;1;1;10\n", 1_600_000_000)
    _place(workdir, "in/a", "2.csv", "1.1.2018;1;1;10\n1.1.2018;2;1;11\n", 1_600_000_100)
    args = spark, TB.FT_BALANCE_F, f"{workdir}/in/*", f"{workdir}/ds", f"{workdir}/ckpt"
    stream_feed(*args, max_files=1).awaitTermination()
    assert _balances(spark, f"{workdir}/ds") == [(1, 10.0), (2, 11.0)]  # equal rows are none
    _place(workdir, "in/a", "3.csv", "1.1.2018;2;1;12\n", 1_600_000_200)
    with pytest.raises(StreamingQueryException, match="more than once"):
        stream_feed(*args, max_files=1).awaitTermination()
    assert _balances(spark, f"{workdir}/ds") == [(1, 10.0), (2, 11.0)]


def test_rows_of_forgotten_drops_are_refused(spark, workdir):
    from pyspark.errors import StreamingQueryException

    for i, name in enumerate("abcd"):
        _place(workdir, f"in/{name}", "1.csv", f"1.1.2018;{i};1;{i}\n", 1_600_000_000 + i)
    args = spark, TB.FT_BALANCE_F, f"{workdir}/in/*", f"{workdir}/ds", f"{workdir}/ckpt"
    stream_feed(*args, keep_keys=2).awaitTermination()
    _place(workdir, "in/c", "2.csv", "1.1.2018;3;1;9\n1.1.2018;7;1;9\n", 1_600_000_100)
    stream_feed(*args, keep_keys=2).awaitTermination()
    assert _balances(spark, f"{workdir}/ds") == [(0, 0.0), (1, 1.0), (2, 2.0), (3, 3.0), (7, 9.0)]
    _place(workdir, "in/a", "2.csv", "1.1.2018;8;1;9\n", 1_600_000_200)
    with pytest.raises(StreamingQueryException, match="older than"):
        stream_feed(*args, keep_keys=2).awaitTermination()


def test_joins_of_many_keys_find_the_same(spark, workdir, monkeypatch):
    """Rows that a later drop has loaded, and conflicts, where no side of a join is broadcast."""
    from pyspark.errors import StreamingQueryException

    from sluice.operators import load

    joins = []
    real = load.joined_by_key
    monkeypatch.setattr("sluice.streaming.ledger.joined_by_key", lambda k, n: joins.append(n) or real(k, n), raising=False)
    monkeypatch.setattr(load, "BROADCAST_KEYS", 0)
    _place(workdir, "in/a", "1.csv", "1.1.2018;1;1;10\n1.1.2018;2;1;10\n", 1_600_000_000)
    _place(workdir, "in/b", "1.csv", "1.1.2018;2;1;20\n1.1.2018;3;1;20\n", 1_600_000_100)
    _place(workdir, "in/a", "2.csv", "1.1.2018;3;1;10\n1.1.2018;4;1;10\n", 1_600_000_200)
    args = spark, TB.FT_BALANCE_F, f"{workdir}/in/*", f"{workdir}/ds", f"{workdir}/ckpt"
    stream_feed(*args, max_files=1).awaitTermination()
    assert _balances(spark, f"{workdir}/ds") == [(1, 10.0), (2, 20.0), (3, 20.0), (4, 10.0)]
    assert joins == [2, 2]  # the part's rows, then the later drop's keys
    _place(workdir, "in/a", "3.csv", "1.1.2018;4;1;12\n", 1_600_000_300)
    with pytest.raises(StreamingQueryException, match="more than once"):
        stream_feed(*args, max_files=1).awaitTermination()
