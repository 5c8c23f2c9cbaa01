"""Keyed upsert and overwrite on Parquet targets: the algebra of the merge."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from sluice.operators import load
from sluice.plans import tables as TB

BAL = "on_date date, account_rk bigint, currency_rk int, balance_out double"
SPEC = TB.FT_BALANCE_F
J1, F1, M1 = dt.date(2018, 1, 31), dt.date(2018, 2, 1), dt.date(2018, 3, 15)


def _rows(spark, path):
    return sorted(tuple(r) for r in load.read_table(spark, SPEC, path).collect())


def _local(path):
    return path.replace("file:", "")


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(_local(path)) for f in fs if f.endswith(".parquet")}


def test_first_load_then_update_insert_and_untouched(spark, workdir):
    t = f"{workdir}/bal"
    a = spark.createDataFrame([(J1, 1, 1, 10.0), (F1, 2, 1, 20.0), (M1, 3, 1, 30.0)], BAL)
    load.upsert(spark, SPEC, a, t)
    march = {p: m for p, m in _files(t).items() if "2018-03-01" in p}
    b = spark.createDataFrame([(J1, 1, None, None), (F1, 9, 2, 90.0)], BAL)  # update (NULLs win) + insert
    res = load.upsert(spark, SPEC, b, t)
    assert res["partitions"] == 2
    assert _rows(spark, t) == [(J1, 1, None, None), (F1, 2, 1, 20.0), (F1, 9, 2, 90.0), (M1, 3, 1, 30.0)]
    # The untouched month was neither rewritten nor removed.
    assert {p: m for p, m in _files(t).items() if "2018-03-01" in p} == march


def test_upsert_twice_equals_once_and_disjoint_is_union(spark, workdir):
    a = spark.createDataFrame([(J1, 1, 1, 10.0), (F1, 2, 1, 20.0)], BAL)
    b = spark.createDataFrame([(J1, 1, 5, 15.0), (M1, 3, 1, 30.0)], BAL)
    once, twice = f"{workdir}/once", f"{workdir}/twice"
    for t, n in ((once, 1), (twice, 2)):
        load.upsert(spark, SPEC, a, t)
        for _ in range(n):
            load.upsert(spark, SPEC, b, t)
    assert _rows(spark, once) == _rows(spark, twice) == [(J1, 1, 5, 15.0), (F1, 2, 1, 20.0), (M1, 3, 1, 30.0)]
    c = spark.createDataFrame([(M1, 4, 1, 40.0)], BAL)
    load.upsert(spark, SPEC, c, once)
    assert len(_rows(spark, once)) == 4


def test_conflicting_keys_refused_and_target_kept(spark, workdir):
    t = f"{workdir}/conf"
    load.upsert(spark, SPEC, spark.createDataFrame([(J1, 1, 1, 10.0)], BAL), t)
    bad = spark.createDataFrame([(J1, 1, 1, 11.0), (J1, 1, 1, 12.0)], BAL)
    with pytest.raises(load.KeyConflictError):
        load.upsert(spark, SPEC, bad, t)
    assert _rows(spark, t) == [(J1, 1, 1, 10.0)]
    # Exact copies are one row once duplicates are removed.
    copies = spark.createDataFrame([(J1, 1, 1, 13.0), (J1, 1, 1, 13.0)], BAL)
    load.upsert(spark, SPEC, copies, t, batch_is_distinct=False)
    assert _rows(spark, t) == [(J1, 1, 1, 13.0)]


def test_empty_batch_is_a_no_op(spark, workdir):
    t = f"{workdir}/empty"
    res = load.upsert(spark, SPEC, spark.createDataFrame([], BAL), t)
    assert res["status"] == "empty batch" and load.read_target(spark, SPEC, t) is None
    assert load.read_table(spark, SPEC, t).isEmpty()


def test_touched_scan_is_pruned_statically(spark, workdir):
    t = f"{workdir}/prune"
    load.upsert(spark, SPEC, spark.createDataFrame([(J1, 1, 1, 1.0), (M1, 2, 1, 1.0)], BAL), t)
    part = load.partition_column(SPEC)
    touched = load.read_target(spark, SPEC, t).filter(F.col(part).isin([dt.date(2018, 1, 1)]))
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(on_date_month" in plan and "2018-01-01" in plan
    assert touched.count() == 1


def test_overwrite_replaces_and_counts(spark, workdir):
    spec = TB.FT_POSTING_F
    t = f"{workdir}/post"
    schema = "oper_date date, credit_account_rk bigint, debet_account_rk bigint, credit_amount double, debet_amount double"
    r1 = load.overwrite(spark, spec, spark.createDataFrame([(J1, 1, 2, 1.0, 0.1)] * 3, schema), t)
    r2 = load.overwrite(spark, spec, spark.createDataFrame([(F1, 1, 2, 1.0, 0.1)], schema), t)
    assert (r1["rows_loaded"], r2["rows_loaded"]) == (3, 1)
    assert [r.oper_date for r in load.read_table(spark, spec, t).collect()] == [F1]


def test_parallel_run_equals_sequential(spark, workdir):
    from sluice.operators import journal
    from sluice.plans import run as R
    from sluice.sources import feeds

    sf = "/root/testdata/sf0.001"
    specs = [TB.MD_CURRENCY_D, TB.FT_BALANCE_F, TB.FT_POSTING_F]
    sources = {s.feed_name: feeds.materialize_feed(spark, sf, s.feed_name) for s in specs}
    seq = R.run_all(spark, sources, {s.name: f"{workdir}/seq/{s.name}" for s in specs}, f"{workdir}/j", specs=specs)
    par = R.run_all(spark, sources, {s.name: f"{workdir}/par/{s.name}" for s in specs}, f"{workdir}/j", specs=specs,
                    parallelism=3)
    assert [t["transform"] for t in seq["tables"].values()] == [t["transform"] for t in par["tables"].values()]
    for s in specs:
        a = sorted(map(tuple, load.read_table(spark, s, f"{workdir}/seq/{s.name}").collect()), key=repr)
        b = sorted(map(tuple, load.read_table(spark, s, f"{workdir}/par/{s.name}").collect()), key=repr)
        assert a == b
    assert {r.status for r in journal.fold(journal.read_events(spark, f"{workdir}/j")).collect()} == {"Success"}


def test_failed_run_is_journaled_and_stops(spark, workdir):
    from sluice.operators import journal
    from sluice.plans import run as R
    from sluice.sources.delimited import write_delimited

    raw = "CURRENCY_RK string, DATA_ACTUAL_DATE string, DATA_ACTUAL_END_DATE string, CURRENCY_CODE string, CODE_ISO_CHAR string"
    # Two rows for one key and no distinct on this table: the keyed load must refuse.
    write_delimited(spark.createDataFrame([("1", "2018-01-01", "", "810", "RUB"),
                                           ("1", "2018-01-01", "", "810", "RUB")], raw), f"{workdir}/cur")
    bal = "ON_DATE string, ACCOUNT_RK string, CURRENCY_RK string, BALANCE_OUT string"
    write_delimited(spark.createDataFrame([("1.1.2018", "1", "1", "1")], bal), f"{workdir}/bal")
    specs = [TB.MD_CURRENCY_D, TB.FT_BALANCE_F]
    targets = {s.name: f"{workdir}/ds/{s.name}" for s in specs}
    with pytest.raises(load.KeyConflictError):
        R.run_all(spark, {"md_currency_d": f"{workdir}/cur", "ft_balance_f": f"{workdir}/bal"}, targets,
                  f"{workdir}/j", specs=specs, run_id="r-fail")
    state = journal.fold(journal.read_events(spark, f"{workdir}/j")).collect()[0]
    assert (state.run_id, state.status) == ("r-fail", "Failed")
    assert '"failed_step": "md_currency_d"' in state.extra and '"error_type": "KeyConflictError"' in state.extra
    assert load.read_target(spark, TB.FT_BALANCE_F, targets["ft_balance_f"]) is None  # later tables not loaded


def test_hot_copy_collapses_before_the_shuffle(spark, workdir):
    hot = spark.range(30000).select(F.lit(J1).alias("on_date"), F.lit(7).cast("bigint").alias("account_rk"),
                                    F.lit(1).alias("currency_rk"), F.lit(1.5).alias("balance_out"))
    rest = spark.range(60000).select(F.lit(F1).alias("on_date"), F.col("id").alias("account_rk"),
                                     F.lit(1).alias("currency_rk"), F.col("id").cast("double").alias("balance_out"))
    batch = hot.unionByName(rest)
    plan = load.keyed_rows(batch, SPEC, distinct_rows=True)._jdf.queryExecution().executedPlan().toString()
    # A partial aggregate runs before the Exchange, so the 30,000 copies leave each map
    # task as one row.
    assert "partial_first" in plan[plan.find("Exchange"):] and plan.count("Exchange") == 1
    res = load.upsert(spark, SPEC, batch, f"{workdir}/hot", batch_is_distinct=False)
    assert res["rows_batch"] == 60001
    assert load.read_table(spark, SPEC, f"{workdir}/hot").count() == 60001


def test_load_reads_the_text_once(spark, workdir):
    """After staging, nothing reads the feed again: replacing it changes nothing."""
    from sluice.plans import run as R
    from sluice.sources.delimited import write_delimited

    raw = "ON_DATE string, ACCOUNT_RK string, CURRENCY_RK string, BALANCE_OUT string"
    feed = f"{workdir}/feed"
    write_delimited(spark.createDataFrame([("1.1.2018", "1", "1", "10"), ("1.1.2018", "1", "1", "10"),
                                           ("x", "2", "1", "20")], raw), feed)
    batch, counters = R.stage_accepted(spark, SPEC, feed, f"{workdir}/stage")
    stats = counters.get()
    write_delimited(spark.createDataFrame([("2.2.2019", "9", "9", "99")], raw), feed)  # a new drop arrives
    res = load.upsert(spark, SPEC, batch, f"{workdir}/t", batch_is_distinct=False)
    assert stats == {"rows_input": 3, "rows_after_filter": 2, "rows_output": 2, "rows_rejected": 1}
    assert res["rows_batch"] == 1
    assert _rows(spark, f"{workdir}/t") == [(dt.date(2018, 1, 1), 1, 1, 10.0)]


def test_write_layout_follows_adaptive_setting(spark):
    df = spark.createDataFrame([(J1, 1, 1, 1.0)], BAL).withColumn(load.partition_column(SPEC), F.lit(J1))
    assert "RebalancePartitions" in load._spread(df, SPEC)._jdf.queryExecution().analyzed().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "RepartitionByExpression" in load._spread(df, SPEC)._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_many_partitions_use_range_and_semi_join(spark, workdir, monkeypatch):
    import dataclasses

    daily = dataclasses.replace(SPEC, partition_grain="day")
    t = f"{workdir}/daily"
    days = [J1 + dt.timedelta(days=i) for i in range(12)]
    load.upsert(spark, daily, spark.createDataFrame([(d, i, 1, float(i)) for i, d in enumerate(days)], BAL), t)
    monkeypatch.setattr(load, "MAX_PARTITION_LIST", 3)  # force the path for very wide batches
    batch = spark.createDataFrame([(days[i], i, 2, -1.0) for i in (0, 5, 6, 7, 11)] + [(days[3], 99, 2, 0.0)], BAL)
    res = load.upsert(spark, daily, batch, t)
    assert res["partitions"] == 6
    got = {(r.on_date, r.account_rk): r.balance_out for r in load.read_table(spark, daily, t).collect()}
    want = {(d, i): float(i) for i, d in enumerate(days)}
    want.update({(days[i], i): -1.0 for i in (0, 5, 6, 7, 11)})
    want[(days[3], 99)] = 0.0
    assert got == want


def test_constraints_refuse_the_batch_before_writing(spark, workdir):
    from sluice.functions import rules as r
    from sluice.spec import Field, TableSpec

    # A spec whose text rule does not clamp, and a NOT NULL column the filter allows NULL in.
    unclamped = r.Rule(lambda c: c, "string", 3)
    spec = TableSpec(
        "codes",
        (Field("d", "D", r.date("yyyy-M-d"), nullable=False), Field("k", "K", r.integer(), nullable=False),
         Field("code", "CODE", unclamped), Field("note", "NOTE", r.text(10), nullable=False)),
        required=("d", "k"), primary_key=("d", "k"), partition_date="d",
    )
    schema = "d date, k int, code string, note string"
    t = f"{workdir}/codes"
    load.upsert(spark, spec, spark.createDataFrame([(J1, 1, "RUB", "ok")], schema), t)
    with pytest.raises(load.ConstraintError, match="1 row\\(s\\) with text longer"):
        load.upsert(spark, spec, spark.createDataFrame([(J1, 2, "RUBX", "ok")], schema), t)
    with pytest.raises(load.ConstraintError, match="1 row\\(s\\) with NULL"):
        load.upsert(spark, spec, spark.createDataFrame([(J1, 3, "USD", None)], schema), t)
    assert [tuple(x) for x in load.read_table(spark, spec, t).collect()] == [(J1, 1, "RUB", "ok")]
    over = dataclass_replace(spec, mode="overwrite", primary_key=())
    with pytest.raises(load.ConstraintError):
        load.overwrite(spark, over, spark.createDataFrame([(J1, 4, "EURO", "x")], schema), t)
    assert load.read_table(spark, spec, t).count() == 1  # not replaced


def test_staged_batch_is_scanned_and_shuffled_once(spark, workdir):
    """The check brings the batch together by key in one scan and one shuffle; the merge reads
    only what that wrote, and shuffles no row of it for a small merge."""
    from sluice.plans import run as R
    from sluice.sources import feeds

    source = feeds.materialize_feed(spark, "/root/testdata/sf0.001", SPEC.name)
    batch, _ = R.stage_accepted(spark, SPEC, source, f"{workdir}/stage")
    plan = load.keyed_rows(batch, SPEC, distinct_rows=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange") == 1
    load.upsert(spark, SPEC, batch, f"{workdir}/t", batch_is_distinct=False)
    day = batch.filter(F.col("on_date") == batch.agg(F.max("on_date")).first()[0])
    summary = load.check_batch(SPEC, day, batch_is_distinct=False)
    merged = load.merged_rows(spark, SPEC, f"{workdir}/t", summary)._jdf.queryExecution().executedPlan().toString()
    assert f"{workdir}/stage" not in merged
    assert merged.count("FileScan parquet") == 3  # touched folders, batch rows, batch keys
    assert "Exchange hashpartitioning" not in merged and "BroadcastHashJoin" in merged


def test_keys_of_a_large_batch_do_not_pass_through_the_driver(spark, workdir):
    """However small their files are: Spark would broadcast these by their compressed size."""
    t, rows = f"{workdir}/t", ("date'2018-01-31' AS on_date", "id AS account_rk", "1 AS currency_rk", "1.0D AS balance_out")
    load.upsert(spark, SPEC, spark.range(10).selectExpr(*rows), t)
    for n, broadcast in ((load.BROADCAST_KEYS, True), (load.BROADCAST_KEYS + 1, False)):
        summary = load.check_batch(SPEC, spark.range(5, 5 + n).selectExpr(*rows))
        merged = load.merged_rows(spark, SPEC, t, summary)
        assert ("BroadcastHashJoin" in merged._jdf.queryExecution().executedPlan().toString()) == broadcast
        assert merged.count() == n + 5


def test_delta_rewrites_one_key_bucket(spark, workdir):
    spec, t = TB.MD_ACCOUNT_D, f"{workdir}/acc"
    columns = "data_actual_date date, data_actual_end_date date, account_rk long, account_number string, char_type string, currency_rk int, currency_code string"
    rows = [(J1, J1, k, f"n{k}", "A", 1, "810") for k in range(200)]
    load.upsert(spark, spec, spark.createDataFrame(rows, columns), t)
    before = _files(t)
    assert len({f.split("key_bucket=")[1].split("/")[0] for f in before}) == spec.key_buckets
    res = load.upsert(spark, spec, spark.createDataFrame([(J1, F1, 7, "new", "A", 1, "810")], columns), t)
    after = _files(t)
    assert res["partitions"] == 1
    changed = {f.split("key_bucket=")[1].split("/")[0] for f in set(before.items()) ^ set(after.items()) for f in [f[0]]}
    assert len(changed) == 1
    table = {r.account_rk: r.account_number for r in load.read_table(spark, spec, t).collect()}
    assert len(table) == 200 and table[7] == "new" and table[8] == "n8"


@pytest.mark.parametrize("mode", ["dynamic", "static"])
def test_wide_overwrite_in_either_session_mode(spark, workdir, monkeypatch, mode):
    """Above every list limit: the second, smaller and different table is all that stays."""
    import dataclasses

    spec = dataclasses.replace(TB.FT_POSTING_F, partition_grain="day")
    monkeypatch.setattr(load, "MAX_PARTITION_LIST", 3)
    schema = "oper_date date, credit_account_rk bigint, debet_account_rk bigint, credit_amount double, debet_amount double"
    first = [(J1 + dt.timedelta(days=i), i, 2, 1.0, 0.1) for i in range(9)]
    second = [(J1 + dt.timedelta(days=i), i, 3, 1.0, 0.1) for i in (2, 20, 21, 22, 23)]
    t = f"{workdir}/wide"
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        assert load.overwrite(spark, spec, spark.createDataFrame(first, schema), t)["rows_loaded"] == 9
        assert load.overwrite(spark, spec, spark.createDataFrame(second, schema), t)["rows_loaded"] == 5
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert sorted(map(tuple, load.read_table(spark, spec, t).collect())) == second
    # Folders that something else left there go with the next load.
    spark.createDataFrame(first, schema).withColumns(load.partition_values(spec)).write.mode("append").partitionBy(
        "oper_date_day").parquet(t)
    assert load.overwrite(spark, spec, spark.createDataFrame(second, schema), t)["rows_loaded"] == 5
    assert sorted(map(tuple, load.read_table(spark, spec, t).collect())) == second


def test_empty_overwrite_empties_the_table(spark, workdir):
    spec, t = TB.FT_POSTING_F, f"{workdir}/none"
    schema = "oper_date date, credit_account_rk bigint, debet_account_rk bigint, credit_amount double, debet_amount double"
    load.overwrite(spark, spec, spark.createDataFrame([(J1, 1, 2, 1.0, 0.1)], schema), t)
    assert load.overwrite(spark, spec, spark.createDataFrame([], schema), t)["rows_loaded"] == 0
    assert load.read_table(spark, spec, t).isEmpty()
    assert load.overwrite(spark, spec, spark.createDataFrame([], schema), f"{workdir}/none2")["rows_loaded"] == 0


def test_storage_errors_are_raised_not_read_as_absent(spark, workdir, monkeypatch):
    t = f"{workdir}/store"
    load.upsert(spark, SPEC, spark.createDataFrame([(J1, 1, 1, 1.0)], BAL), t)

    class Broken:
        def exists(self, path):
            raise OSError("permission denied")

        def listStatus(self, path):
            raise OSError("permission denied")

        def delete(self, path, recursive):
            return True

    monkeypatch.setattr(load, "_file_system", lambda spark, path: (Broken(), path))
    with pytest.raises(OSError):
        load.upsert(spark, SPEC, spark.createDataFrame([(J1, 2, 1, 2.0)], BAL), t)
    monkeypatch.undo()
    assert _rows(spark, t) == [(J1, 1, 1, 1.0)]
    # Without a JVM handle only "path not found" means absent.
    monkeypatch.setattr(load, "_file_system", lambda spark, path: None)
    assert load.path_exists(spark, t) and not load.path_exists(spark, f"{workdir}/nowhere")
    with pytest.raises(RuntimeError):
        load.overwrite(spark, TB.FT_POSTING_F, spark.createDataFrame([], TB.FT_POSTING_F.schema), t)


def test_read_table_prunes_by_date_range(spark, workdir):
    t = f"{workdir}/range"
    load.upsert(spark, SPEC, spark.createDataFrame([(J1, 1, 1, 1.0), (F1, 2, 1, 1.0), (M1, 3, 1, 1.0)], BAL), t)
    some = load.read_table(spark, SPEC, t, date_from=F1, date_to=dt.date(2018, 2, 28))
    assert [r.account_rk for r in some.collect()] == [2]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "on_date_month" in plan[plan.index("PartitionFilters"):]


def test_failed_run_cancels_preparations_under_way(spark, workdir, monkeypatch):
    import time

    from sluice.plans import run as R

    seen = {}

    def prepare(session, spec, source, stage):
        if spec is TB.MD_CURRENCY_D:
            time.sleep(3)
            raise load.ConstraintError("refused")
        try:  # a long job of another table
            session.range(0, 40, 1, 4).select(F.expr("java_method('java.lang.Thread', 'sleep', 5000L)")).collect()
        except Exception as exc:
            seen["cancelled"] = str(exc)
        return {}

    monkeypatch.setattr(R, "prepare_table", prepare)
    specs = [TB.MD_CURRENCY_D, TB.FT_BALANCE_F]
    began = time.time()
    with pytest.raises(load.ConstraintError):
        R.run_all(spark, {s.feed_name: "" for s in specs}, {s.name: "" for s in specs}, f"{workdir}/j", specs=specs)
    assert "cancel" in seen["cancelled"].lower() and time.time() - began < 40


def dataclass_replace(obj, **kw):
    import dataclasses

    return dataclasses.replace(obj, **kw)


def test_stage_dropped_on_success_kept_on_failure(spark, workdir):
    from sluice.plans import run as R
    from sluice.sources.delimited import write_delimited

    raw = "ON_DATE string, ACCOUNT_RK string, CURRENCY_RK string, BALANCE_OUT string"
    write_delimited(spark.createDataFrame([("1.1.2018", "1", "1", "10")], raw), f"{workdir}/ok")
    write_delimited(spark.createDataFrame([("1.1.2018", "1", "1", "10"), ("1.1.2018", "1", "1", "11")], raw),
                    f"{workdir}/bad")
    R.load_table(spark, SPEC, f"{workdir}/ok", f"{workdir}/t", stage_dir=f"{workdir}/s1")
    assert not load.path_exists(spark, f"{workdir}/s1")
    with pytest.raises(load.KeyConflictError):
        R.load_table(spark, SPEC, f"{workdir}/bad", f"{workdir}/t", stage_dir=f"{workdir}/s2")
    assert load.path_exists(spark, f"{workdir}/s2/accepted")


def test_parallel_prepare_keeps_ordered_commits(spark, workdir):
    from sluice.operators import journal
    from sluice.plans import run as R
    from sluice.sources.delimited import write_delimited

    bal = "ON_DATE string, ACCOUNT_RK string, CURRENCY_RK string, BALANCE_OUT string"
    write_delimited(spark.createDataFrame([("1.1.2018", "1", "1", "1")], bal), f"{workdir}/bal")
    cur = "CURRENCY_RK string, DATA_ACTUAL_DATE string, DATA_ACTUAL_END_DATE string, CURRENCY_CODE string, CODE_ISO_CHAR string"
    write_delimited(spark.createDataFrame([("7", "2018-01-01", "", "1", "A")] * 2, cur), f"{workdir}/cur")
    specs = [TB.FT_BALANCE_F, TB.MD_CURRENCY_D]  # the later table is the one that fails
    targets = {s.name: f"{workdir}/ds/{s.name}" for s in specs}
    with pytest.raises(load.KeyConflictError):
        R.run_all(spark, {"ft_balance_f": f"{workdir}/bal", "md_currency_d": f"{workdir}/cur"}, targets,
                  f"{workdir}/j", specs=specs, run_id="r2", parallelism=4)
    assert load.read_table(spark, TB.FT_BALANCE_F, targets["ft_balance_f"]).count() == 1  # committed first
    assert load.read_target(spark, TB.MD_CURRENCY_D, targets["md_currency_d"]) is None
    state = journal.fold(journal.read_events(spark, f"{workdir}/j")).collect()[0]
    assert state.status == "Failed" and '"failed_step": "md_currency_d"' in state.extra


def test_small_merge_reads_only_touched_folders(spark, workdir):
    t = f"{workdir}/folders"
    load.upsert(spark, SPEC, spark.createDataFrame([(J1, 1, 1, 1.0), (F1, 2, 1, 1.0), (M1, 3, 1, 1.0)], BAL), t)
    part = load.partition_column(SPEC)
    df = load.read_partitions(spark, SPEC, t, [dt.date(2018, 2, 1), dt.date(2019, 1, 1)])  # one present, one new
    files = df.inputFiles()
    assert files and all(f"{part}=2018-02-01" in f for f in files)
    assert [(r.account_rk, r[part]) for r in df.collect()] == [(2, dt.date(2018, 2, 1))]
    assert load.read_partitions(spark, SPEC, t, [dt.date(2019, 1, 1)]) is None
