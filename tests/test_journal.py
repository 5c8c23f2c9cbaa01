import datetime as dt

from sluice.operators import journal

T = lambda m: dt.datetime(2024, 1, 1, 0, m)


def test_fold_semantics(spark):
    events = [
        ("a", T(1), "Started", None, None), ("a", T(2), "Failed", "boom", None), ("a", T(3), "Success", None, '{"x":1}'),
        ("b", T(5), "Success", None, None), ("b", T(6), "Started", None, None),  # finish before start: no-op
        ("c", T(1), "Success", None, None),  # finish of an unknown run: dropped
        ("d", T(1), "Started", None, None), ("d", T(2), "Started", None, None),
    ]
    state = {r.run_id: r for r in journal.fold(spark.createDataFrame(events, journal.EVENT_SCHEMA)).collect()}
    assert set(state) == {"a", "b", "d"}
    assert (state["a"].status, state["a"].finished_at, state["a"].extra, state["a"].error_message) == (
        "Success", T(3), '{"x":1}', None)
    assert (state["b"].status, state["b"].finished_at) == ("Started", None)
    assert state["d"].started_at == T(2)
    opened = {r.run_id for r in journal.open_runs(journal.fold(spark.createDataFrame(events, journal.EVENT_SCHEMA))).collect()}
    assert opened == {"b", "d"}


def test_writer_round_trip(spark, workdir):
    path = f"{workdir}/journal"
    journal.log_start(spark, path, "r1")
    assert journal.is_open(spark, path, "r1")
    journal.log_finish(spark, path, "r1", False, "bad", journal.failure_detail(ValueError("bad"), "md_account_d"))
    assert not journal.is_open(spark, path, "r1")
    row = journal.fold(journal.read_events(spark, path)).collect()[0]
    assert row.status == "Failed" and '"failed_step": "md_account_d"' in row.extra
    assert journal.detail_json({}) is None


def test_restart_is_open_again_and_ties_have_one_answer(spark):
    events = [
        ("r", T(1), "Started", None, None), ("r", T(2), "Failed", "boom", None), ("r", T(3), "Started", None, None),
        ("t", T(1), "Started", None, None), ("t", T(4), "Failed", "x", None), ("t", T(4), "Success", None, "{}"),
        ("s", T(2), "Started", None, None), ("s", T(2), "Success", None, None),  # finished at once
    ]
    for order in (events, events[::-1]):
        state = {r.run_id: r for r in journal.fold(spark.createDataFrame(order, journal.EVENT_SCHEMA)).collect()}
        assert (state["r"].status, state["r"].started_at, state["r"].finished_at) == ("Started", T(3), None)
        assert (state["t"].status, state["t"].extra, state["t"].error_message) == ("Success", "{}", None)
        assert (state["s"].status, state["s"].finished_at) == ("Success", T(2))
    assert journal.new_run_id("a") != journal.new_run_id("a")


def test_compaction_keeps_the_state_and_few_files(spark, workdir, monkeypatch):
    path = f"{workdir}/journal"
    monkeypatch.setattr(journal.compact, "__defaults__", (3,))
    want = {}
    for i in range(14):
        run = f"r{i % 5}"
        journal.log_start(spark, path, run)
        want[run] = "Started"
        if i % 3:
            journal.log_finish(spark, path, run, bool(i % 2), None if i % 2 else f"bad {i}", {"i": i})
            want[run] = "Success" if i % 2 else "Failed"
    events = journal.read_events(spark, path)
    state = {r.run_id: r.status for r in journal.fold(events).collect()}
    assert state == want
    assert len(events.inputFiles()) <= 3 * 3 + 2
    assert {r.run_id for r in journal.open_runs(journal.fold(events)).collect()} == {r for r, s in want.items() if s == "Started"}


def test_compaction_lost_before_it_deletes(spark, workdir, monkeypatch):
    from sluice.operators import swap

    path = f"{workdir}/journal"
    events = [
        ("a", T(1), "Started", None, None), ("a", T(2), "Failed", "boom", None), ("a", T(2), "Success", None, "{}"),
        ("b", T(5), "Success", None, "x"), ("b", T(6), "Started", None, None), ("c", T(1), "Success", None, None),
    ]
    df = spark.createDataFrame(events, journal.EVENT_SCHEMA).repartition(6)
    df.write.parquet(path)
    want = sorted(map(repr, journal.fold(df).collect()))

    def lost(self, name):
        raise OSError("gone")

    monkeypatch.setattr(swap.FileSystem, "delete", lost)
    try:
        journal.compact(spark, path, fan_in=2)
    except OSError:
        pass
    assert sorted(map(repr, journal.fold(journal.read_events(spark, path)).collect())) == want
    monkeypatch.undo()
    assert journal.compact(spark, path, fan_in=2) > 0
    left = journal.read_events(spark, path)
    assert sorted(map(repr, journal.fold(left).collect())) == want and len(left.inputFiles()) <= 2
    assert journal.compact(spark, path, fan_in=3) == 0
    assert journal.compact(spark, f"{workdir}/none") == 0
