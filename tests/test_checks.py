import datetime as dt

from sluice.operators import checks
from sluice.plans import tables as TB

BAL = "on_date date, account_rk bigint, currency_rk int, balance_out double"


def test_not_null(spark):
    rows = [(dt.date(2018, 1, 1), dt.date(2018, 1, 1), 1, "n", "А", 1, "810"),
            (dt.date(2018, 1, 1), None, 2, "n", "А", 1, "810")]
    df = spark.createDataFrame(rows, "data_actual_date date, data_actual_end_date date, account_rk bigint, "
                                     "account_number string, char_type string, currency_rk int, currency_code string")
    assert [r.account_rk for r in checks.not_null_violations(df, TB.MD_ACCOUNT_D).collect()] == [2]


def test_pk_violations_plain_and_distinct_rows(spark):
    d = dt.date(2018, 1, 1)
    nan = float("nan")
    rows = [(d, 1, 1, 1.0), (d, 1, 1, 1.0), (d, 2, 1, nan), (d, 2, 1, nan), (d, 3, None, 0.0), (d, 3, None, -0.0),
            (d, 4, 1, 1.0), (d, 4, 2, 1.0)]
    df = spark.createDataFrame(rows, BAL)
    plain = {r.account_rk: r.n_rows for r in checks.pk_violations(df, TB.FT_BALANCE_F).collect()}
    assert plain == {1: 2, 2: 2, 3: 2, 4: 2}
    # Exact copies (NaN = NaN, 0.0 = -0.0, NULL = NULL) are not conflicts; key 4 is.
    distinct = [r.account_rk for r in checks.pk_violations(df, TB.FT_BALANCE_F, distinct_rows=True).collect()]
    assert distinct == [4]


def test_length_violations(spark):
    df = spark.createDataFrame([(1, "x" * 17, "ok"), (2, "short", "y" * 22)],
                               "ledger_account int, chapter_name string, subsection_name string")
    got = sorted(tuple(r) for r in checks.length_violations(df, TB.MD_LEDGER_ACCOUNT_S, ["ledger_account"]).collect())
    assert got == [(1, "chapter_name", 17, 16), (2, "subsection_name", 22, 21)]
