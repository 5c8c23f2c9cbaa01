"""Spec-driven cleaning: counters in one pass, filter, defaults, distinct, alignment."""

import datetime as dt

from pyspark.sql import types as T

from sluice.operators import clean
from sluice.plans import tables as TB
from sluice.sources.delimited import read_feed, read_raw, write_delimited

ACC_RAW = ["DATA_ACTUAL_DATE", "DATA_ACTUAL_END_DATE", "ACCOUNT_RK", "ACCOUNT_NUMBER", "CHAR_TYPE",
           "CURRENCY_RK", "CURRENCY_CODE"]


def _accounts(spark):
    rows = [
        ("2018-01-01", "2018-01-31", "1", "40817810000000000001", "А", "810", "810"),
        ("2018-01-01", None, "2", "40817810000000000002", "П", "840", "840"),  # end date defaults
        ("2018-01-01", None, "2", "40817810000000000002", "П", "840", "840"),  # exact copy
        ("2018-13-01", "2018-01-31", "3", "x", "А", "1", "1"),  # bad date: rejected
        ("2018-01-01", "2018-01-31", "4", "   ", "А", "978", "9780"),  # blank number kept as ''
        ("2018-01-01", "2018-01-31", "5.9", "n", None, "1", "1"),  # no char type: rejected
    ]
    return spark.createDataFrame(rows, T.StructType([T.StructField(c, T.StringType()) for c in ACC_RAW]))


def test_transform_and_counters(spark):
    df = clean.transform(_accounts(spark), TB.MD_ACCOUNT_D)
    rows = sorted(df.collect(), key=lambda r: r.account_rk)
    accepted, counters = clean.accepted_observed(_accounts(spark), TB.MD_ACCOUNT_D)
    assert accepted.count() == 4
    assert counters.get() == {"rows_input": 6, "rows_after_filter": 4, "rows_output": 4, "rows_rejected": 2}
    assert counters.violations() == (0, 0)
    assert [r.account_rk for r in rows] == [1, 2, 4]
    assert rows[1].data_actual_end_date == dt.date(2018, 1, 1)
    assert rows[2].account_number == "" and rows[2].currency_code == "978"
    assert df.columns == TB.MD_ACCOUNT_D.columns


def test_filter_stays_above_the_parsing_projection(spark):
    plan = clean.accepted(_accounts(spark), TB.MD_ACCOUNT_D)._jdf.queryExecution().optimizedPlan().toString()
    # The filter tests projected columns; it is not inlined below the projection.
    f = plan.index("Filter")
    m = plan.index("CollectMetrics")
    assert f < m < plan.index("Project", m)
    assert "regexp_replace" not in plan[f:m]


def test_nan_passes_required_filter(spark):
    rows = [("1.1.2018", "1", "2", "NaN")]
    raw = spark.createDataFrame(rows, "ON_DATE string, ACCOUNT_RK string, CURRENCY_RK string, BALANCE_OUT string")
    out = clean.transform(raw, TB.FT_BALANCE_F).collect()
    assert len(out) == 1 and out[0].balance_out != out[0].balance_out


def test_align_fills_typed_nulls(spark):
    df = spark.createDataFrame([(7, dt.date(2018, 1, 1))], "ledger_account int, start_date date")
    out = clean.align(df, TB.MD_LEDGER_ACCOUNT_S)
    assert out.columns == TB.MD_LEDGER_ACCOUNT_S.columns
    assert dict(out.dtypes)["is_resident"] == "int" and dict(out.dtypes)["pair_account"] == "string"


def test_csv_round_trip_keeps_blanks_and_nulls_empties(spark, workdir):
    df = spark.createDataFrame([(" a ", "", "x;y"), ("   ", None, 'q"z')], "A string, B string, C string")
    write_delimited(df, f"{workdir}/f")
    got = sorted(read_raw(spark, f"{workdir}/f").collect(), key=lambda r: r.C)
    assert [tuple(r) for r in got] == [("   ", None, 'q"z'), (" a ", None, "x;y")]


def test_read_feed_binds_by_header_name(spark, workdir):
    df = spark.createDataFrame([("x", "1", "1.1.2018", "2", "3.5")],
                               "EXTRA string, ACCOUNT_RK string, ON_DATE string, CURRENCY_RK string, BALANCE_OUT string")
    write_delimited(df, f"{workdir}/b")
    raw = read_feed(spark, TB.FT_BALANCE_F, f"{workdir}/b")
    assert raw.columns == ["ON_DATE", "ACCOUNT_RK", "CURRENCY_RK", "BALANCE_OUT"]
    out = clean.transform(raw, TB.FT_BALANCE_F).collect()
    assert out[0].on_date == dt.date(2018, 1, 1) and out[0].account_rk == 1


def test_reordered_file_in_a_drop_is_refused(spark, workdir):
    import pytest

    write_delimited(spark.createDataFrame([("1.1.2018", "1", "1", "1")],
                                          "ON_DATE string, ACCOUNT_RK string, CURRENCY_RK string, BALANCE_OUT string"),
                    f"{workdir}/drop/a")
    write_delimited(spark.createDataFrame([("1", "1.1.2018", "1", "1")],
                                          "ACCOUNT_RK string, ON_DATE string, CURRENCY_RK string, BALANCE_OUT string"),
                    f"{workdir}/drop/b")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_feed(spark, TB.FT_BALANCE_F, f"{workdir}/drop/*").collect()


def test_bom_and_blank_lines_in_a_feed(spark, workdir):
    import os

    folder = workdir.replace("file:", "") + "/bom"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/ft_balance_f.csv", "w", encoding="utf-8-sig") as fh:  # writes a BOM first
        fh.write("ON_DATE;ACCOUNT_RK;CURRENCY_RK;BALANCE_OUT\n31.12.2017;42;1;10.5\n\n1.1.2018;43;;\n")
    raw = read_feed(spark, TB.FT_BALANCE_F, folder)
    assert raw.columns[0] == "ON_DATE"
    out = sorted(clean.transform(raw, TB.FT_BALANCE_F).collect(), key=lambda r: r.account_rk)
    assert [(r.on_date, r.account_rk, r.currency_rk, r.balance_out) for r in out] == [
        (dt.date(2017, 12, 31), 42, 1, 10.5), (dt.date(2018, 1, 1), 43, None, None)]


def test_schema_bound_read_checks_the_header(spark, workdir):
    import pytest

    cols = "ON_DATE string, ACCOUNT_RK string, CURRENCY_RK string, BALANCE_OUT string"
    write_delimited(spark.createDataFrame([("1.1.2018", "1", "2", "3.5")], cols), f"{workdir}/inorder")
    raw = read_feed(spark, TB.FT_BALANCE_F, f"{workdir}/inorder", by_header=False)
    assert [tuple(r) for r in raw.collect()] == [("1.1.2018", "1", "2", "3.5")]
    swapped = "ACCOUNT_RK string, ON_DATE string, CURRENCY_RK string, BALANCE_OUT string"
    write_delimited(spark.createDataFrame([("1", "1.1.2018", "2", "3.5")], swapped), f"{workdir}/swapped")
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_feed(spark, TB.FT_BALANCE_F, f"{workdir}/swapped", by_header=False).collect()
