"""Parsing rules on the value table of the feed contract (lenient dates, truncating ints)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.functions import parse

D = dt.date


def _apply(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.v for r in df.select("i", build(F.col("s")).alias("v")).orderBy("i").collect()]


DATE_CASES = {
    "d.M.yyyy": [
        ("31.12.2017", D(2017, 12, 31)), ("1.1.2018", D(2018, 1, 1)), ("01.01.2018", D(2018, 1, 1)),
        ("31.02.2018", None), ("1-1-2018", None), ("", None), (None, None),
        ("1.1.2018abc", D(2018, 1, 1)), ("1.1.2018 10:00", D(2018, 1, 1)), (" 1.1.2018", D(2018, 1, 1)),
        ("1. 1. 2018", D(2018, 1, 1)), ("1.1.02018", D(2018, 1, 1)), ("1.1.20180", None),
        ("1.1.18", D(18, 1, 1)), ("1.13.2018", None), ("0.1.2018", None), ("29.2.2016", D(2016, 2, 29)),
        ("29.2.2017", None), ("x1.1.2018", None), ("1.1.0000", None),
    ],
    "d-M-yyyy": [
        ("5-3-2019", D(2019, 3, 5)), ("31-4-2019", None), ("2019-3-5", None), ("5-3-2019 00:00:00", D(2019, 3, 5)),
        ("5.3.2019", None),
    ],
    "yyyy-M-d": [
        ("2018-01-01", D(2018, 1, 1)), ("2018-1-1abc", D(2018, 1, 1)), ("2018-13-01", None),
        ("2018-02-29", None), ("2018/01/01", None), ("18-1-1", D(18, 1, 1)), ("20180-1-1", None),
        ("0002018-1-1", D(2018, 1, 1)), ("2018-001-05", D(2018, 1, 5)), ("2050-12-31", D(2050, 12, 31)),
        ("-2018-1-1", None), ("2018-+1-1", None),
    ],
}


@pytest.mark.parametrize("layout", list(DATE_CASES))
def test_dates(spark, layout):
    cases = DATE_CASES[layout]
    got = _apply(spark, [c[0] for c in cases], lambda c: parse.parse_date(c, layout))
    assert got == [c[1] for c in cases]


INT_CASES = [
    ("12", 12), ("12.7", 12), (".5", 0), ("-.5", 0), (".", 0), ("12.", 12), (" 12 ", 12), ("\t12\n", 12),
    ("+5", 5), ("0012", 12), ("-3.9", -3), ("1e3", None), ("0x10", None), ("abc", None), ("", None),
    ("4294967301", None), ("1,5", None), ("+.", None), (None, None),
]


def test_integers(spark):
    got = _apply(spark, [c[0] for c in INT_CASES], lambda c: parse.parse_integral(c, "int"))
    assert got == [c[1] for c in INT_CASES]


def test_bigints(spark):
    got = _apply(spark, ["4294967301", "12.7", "99999999999999999999"], lambda c: parse.parse_integral(c, "bigint"))
    assert got == [4294967301, 12, None]


def test_doubles(spark):
    got = _apply(spark, ["1e3", "1.5d", " 1.5 ", "1,5", "abc", "", "inf"], parse.parse_double)
    assert got == [1000.0, 1.5, 1.5, None, None, None, float("inf")]


def test_digits_key(spark):
    got = _apply(spark, ["RK-12", "-5", "12.7", "a1b2", "abc", "", "  ", "99999999999", "٣4"],
                 lambda c: parse.digits_key(c, "int"))
    assert got == [12, 5, 127, 12, None, None, None, None, 4]


def test_code3(spark):
    got = _apply(spark, ["USD", " usd ", "abUSd", "1USD2", "US", "ЕВР", "", None, "ab1cd"], parse.code3)
    assert got == ["USD", "USD", "ABU", "USD", None, None, None, None, None]


def test_text_rules(spark):
    assert _apply(spark, ["  МЕЖБАНК  ", "   ", "ab\t"], lambda c: parse.text_field(c, 3)) == ["МЕЖ", "", "ab\t"]
    assert _apply(spark, ["  ", "", " 0810 ", None], lambda c: parse.code_field(c, 3)) == [None, None, "081", None]


def _model_integral(s, bits):
    """Plain-Python statement of the truncating integer cast the feeds expect."""
    import re

    if s is None:
        return None
    t = s.strip("".join(chr(c) for c in range(0x21)) + "\x7f")
    lo, hi = -(2 ** (bits - 1)), 2 ** (bits - 1) - 1
    if re.fullmatch(r"[+-]?[0-9]+", t):
        v = int(t)
    else:
        m = re.fullmatch(r"([+-]?)([0-9]*)\.([0-9]*)", t)
        if not m:
            return None
        sign, whole, frac = m.groups()
        if whole == "":
            return 0 if (sign == "" or frac != "") else None
        v = int(sign + whole)
    return v if lo <= v <= hi else None


def test_control_characters_trimmed_like_the_cast(spark):
    got = _apply(spark, ["\x0112.7\x7f", "\x0112\x7f", "\x00.5"], lambda c: parse.parse_integral(c, "int"))
    assert got == [12, 12, 0]


def test_integral_matches_model_on_generated_text(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    piece = st.sampled_from(list("0123456789.+- \t\x01\x7fae,x") + ["", "12", "00", "99999999999", "2147483648"])
    texts = st.lists(st.lists(piece, max_size=6).map("".join), min_size=50, max_size=200)

    @settings(max_examples=4, deadline=None)
    @given(texts)
    def check(values):
        for type_name, bits in (("int", 32), ("bigint", 64)):
            got = _apply(spark, values, lambda c: parse.parse_integral(c, type_name))
            assert got == [_model_integral(v, bits) for v in values]

    check()


def test_key_and_code_rules_take_any_input_type(spark):
    df = spark.createDataFrame([(12, 810)], "k long, c int")
    row = df.select(parse.digits_key(F.col("k")).alias("k"), parse.code_field(F.col("c"), 3).alias("c")).first()
    assert (row.k, row.c) == (12, "810")


def test_rules_do_not_depend_on_ansi_mode(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    cases = ["12.7", "abc", "", "1e3", "4294967301", " 5 "]
    dates = ["2018-02-30", "2018-1-1abc", "x"]
    try:
        got = {}
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            got[mode] = (
                _apply(spark, cases, lambda c: parse.parse_integral(c, "int")),
                _apply(spark, cases, parse.parse_double),
                _apply(spark, dates, lambda c: parse.parse_date(c, "yyyy-M-d")),
            )
        assert got["true"] == got["false"]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.mark.parametrize("layout", list(parse.DATE_LAYOUTS))
def test_dates_are_cast_and_not_formatted(spark, layout):
    """A formatter costs as much as the rest of the row and raises inside for each bad date."""
    write = lambda y, m, d: layout.replace("yyyy", y).replace("d", d).replace("M", m)
    texts = [write("1998", "2", "7"), write("0007", "02", "01"), write("1998", "4", "31"), write("1998", "13", "1"), "--", "000--"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse.parse_date(F.col("t"), layout).alias("d"))
    assert "gettimestamp" not in df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {r.d for r in df.collect() if r.d} == {D(1998, 2, 7), D(7, 2, 1)}
