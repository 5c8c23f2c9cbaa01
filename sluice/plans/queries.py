"""Registered queries: one or more per operator of the inventory, each with its oracle.

Every query reads the driver's tables at ``sf_dir`` (or feeds Spark derives from
them) in full; the oracle is DuckDB SQL over the same tables that states the expected
result directly, without parsing text. Column names match between the two.
"""

from __future__ import annotations

import dataclasses
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import parse, rules
from sluice.operators import checks, clean, journal
from sluice.operators.load import ConstraintError, KeyConflictError, read_table, read_target, remove_path, upsert
from sluice.plans import expected as X
from sluice.plans import run as R
from sluice.plans import tables as TB
from sluice.sources import feeds
from sluice.sources.delimited import read_feed, read_raw, write_delimited
from sluice.spec import Field, TableSpec
from sluice.workspace import new_dir

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn

    return deco


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return feeds.table(spark, sf_dir, name)


def _cleaned_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spec = TB.SPECS[name]
    return clean.transform(read_feed(spark, spec, feeds.materialize_feed(spark, sf_dir, name)), spec)


# -- S1, S2: raw scan ----------------------------------------------------------------------
_RAW_ACCOUNTS_ORACLE = """
SELECT
  CASE WHEN k % 11 = 0 THEN '2018-1-1abc' WHEN k % 13 = 0 THEN '2018-13-01'
       WHEN k % 17 = 0 THEN '2018-01-01 00:00:00' ELSE '2018-01-01' END AS DATA_ACTUAL_DATE,
  CASE WHEN k % 7 = 0 THEN NULL WHEN k % 19 = 0 THEN '2018-02-29' ELSE '2018-01-31' END AS DATA_ACTUAL_END_DATE,
  CASE WHEN k % 23 = 0 THEN ' ' || k WHEN k % 29 = 0 THEN k || 'x' ELSE CAST(k AS VARCHAR) END AS ACCOUNT_RK,
  CASE WHEN k % 31 = 0 THEN acct || '99999' WHEN k % 37 = 0 THEN '   ' ELSE acct END AS ACCOUNT_NUMBER,
  CASE WHEN k % 41 = 0 THEN NULL WHEN k % 43 = 0 THEN ' ' || ch || 'x' ELSE ch END AS CHAR_TYPE,
  CASE WHEN k % 47 = 0 THEN c_nationkey || '.5' ELSE CAST(c_nationkey AS VARCHAR) END AS CURRENCY_RK,
  CASE WHEN k % 53 = 0 THEN cc || '0' ELSE cc END AS CURRENCY_CODE,
  k % 59 = 0 AS _dup
FROM (SELECT *, c_custkey AS k, '40817810' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS acct,
             CASE WHEN c_custkey % 3 = 0 THEN 'П' ELSE 'А' END AS ch,
             lpad(CAST(c_nationkey * 37 AS VARCHAR), 3, '0') AS cc FROM customer) t"""


@register("scan_raw_feed", X.with_dups(_RAW_ACCOUNTS_ORACLE))
def scan_raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accounts feed read back as all-string columns (empty → NULL, blanks kept)."""
    return read_raw(spark, feeds.materialize_feed(spark, sf_dir, "md_account_d"))


# -- C1–C4: dates --------------------------------------------------------------------------
# name: (layout, zero-padded pattern, wrong-separator pattern, pattern with blanks after
#        the separators, impossible-date text, text with a prefixed year digit {p})
_DATE_CASES = {
    "parse_dates_dotted": ("d.M.yyyy", "dd.MM.yyyy", "d-M-yyyy", "d. M. yyyy", "concat('31.02.', y)",
                           "concat(date_format(l_shipdate, 'd.M.'), '{p}', y)"),
    "parse_dates_dashed": ("d-M-yyyy", "dd-MM-yyyy", "d.M.yyyy", "d- M- yyyy", "concat('31-02-', y)",
                           "concat(date_format(l_shipdate, 'd-M-'), '{p}', y)"),
    "parse_dates_iso": ("yyyy-M-d", "yyyy-MM-dd", "yyyy/M/d", "yyyy- M- d", "concat(y, '-02-31')",
                        "concat('{p}', y, date_format(l_shipdate, '-M-d'))"),
}


def _date_text_sql(case: str) -> str:
    layout, padded, wrong, spaced, impossible, prefixed = _DATE_CASES[case]
    return f"""
SELECT l_orderkey, l_linenumber,
  CASE WHEN h % 7 = 0 THEN date_format(l_shipdate, '{padded}')
       WHEN h % 11 = 0 THEN concat(date_format(l_shipdate, '{layout}'), 'T99')
       WHEN h % 13 = 0 THEN {impossible}
       WHEN h % 17 = 0 THEN date_format(l_shipdate, '{wrong}')
       WHEN h % 19 = 0 THEN concat(' ', date_format(l_shipdate, '{spaced}'))
       WHEN h % 23 = 0 THEN ''
       WHEN h % 29 = 0 THEN {prefixed.format(p='0')}
       WHEN h % 31 = 0 THEN {prefixed.format(p='2')}
       ELSE date_format(l_shipdate, '{layout}') END AS raw
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS h, cast(year(l_shipdate) AS string) AS y FROM {{src}})"""


_DATE_ORACLE = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN h % 7 = 0 OR h % 11 = 0 THEN CAST(l_shipdate AS DATE)
       WHEN h % 13 = 0 OR h % 17 = 0 THEN NULL
       WHEN h % 19 = 0 THEN CAST(l_shipdate AS DATE)
       WHEN h % 23 = 0 THEN NULL
       WHEN h % 29 = 0 THEN CAST(l_shipdate AS DATE)
       WHEN h % 31 = 0 THEN NULL
       ELSE CAST(l_shipdate AS DATE) END AS parsed
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS h FROM lineitem) t"""


def _date_query(case: str) -> Query:
    layout = _DATE_CASES[case][0]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = spark.sql(_date_text_sql(case), src=_t(spark, sf_dir, "lineitem"))
        return text.select("l_orderkey", "l_linenumber", parse.parse_date(F.col("raw"), layout).alias("parsed"))

    q.__doc__ = f"C1–C4: lenient '{layout}' dates (padding, trailing text, blanks, bad days, 5-digit years)."
    return q


for _case in _DATE_CASES:
    register(_case, _DATE_ORACLE)(_date_query(_case))


# -- C7–C9: numbers ------------------------------------------------------------------------
_INT_TEXT = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN h % 7 = 0 THEN concat(v, '.7')
       WHEN h % 11 = 0 THEN concat(' ', v, ' ')
       WHEN h % 13 = 0 THEN concat('+', v)
       WHEN h % 17 = 0 THEN '1e3'
       WHEN h % 19 = 0 THEN 'abc'
       WHEN h % 23 = 0 THEN '.5'
       WHEN h % 29 = 0 THEN concat('0', v)
       WHEN h % 31 = 0 THEN '{overflow}'
       WHEN h % 37 = 0 THEN concat('-', v, '.9')
       WHEN h % 41 = 0 THEN ''
       ELSE cast(v AS string) END AS raw
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS h, {value} AS v FROM {{src}})"""

_INT_ORACLE = """
SELECT l_orderkey, l_linenumber,
  CAST(CASE WHEN h % 7 = 0 OR h % 11 = 0 OR h % 13 = 0 THEN v
            WHEN h % 17 = 0 OR h % 19 = 0 THEN NULL
            WHEN h % 23 = 0 THEN 0
            WHEN h % 29 = 0 THEN v
            WHEN h % 31 = 0 THEN NULL
            WHEN h % 37 = 0 THEN -v
            WHEN h % 41 = 0 THEN NULL
            ELSE v END AS {type}) AS parsed
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS h, {value} AS v FROM lineitem) t"""

_INTEGER_CASES = {
    # name: (Spark value, DuckDB value, out-of-range text, Spark type, DuckDB type)
    "parse_integers": ("cast(l_quantity AS int)", "CAST(l_quantity AS INTEGER)", "4294967301", "int", "INTEGER"),
    "parse_bigints": ("l_orderkey * 1000003 + l_linenumber", "l_orderkey * 1000003 + l_linenumber",
                      "99999999999999999999", "bigint", "BIGINT"),
}


def _integer_query(case: str) -> Query:
    spark_value, _, overflow, type_name, _ = _INTEGER_CASES[case]

    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = spark.sql(_INT_TEXT.format(value=spark_value, overflow=overflow), src=_t(spark, sf_dir, "lineitem"))
        return text.select(
            "l_orderkey", "l_linenumber", parse.parse_integral(F.col("raw"), type_name).alias("parsed")
        )

    q.__doc__ = f"C7/C8: {type_name} from text with truncating decimals; junk and overflow → NULL."
    return q


for _case, (_sv, _dv, _ov, _st, _dt) in _INTEGER_CASES.items():
    register(_case, _INT_ORACLE.format(value=_dv, type=_dt))(_integer_query(_case))


@register(
    "parse_doubles",
    """
SELECT l_orderkey, l_linenumber,
  CASE WHEN h % 7 = 0 THEN l_extendedprice WHEN h % 11 = 0 THEN CAST(1000 AS DOUBLE)
       WHEN h % 13 = 0 THEN NULL WHEN h % 17 = 0 THEN l_extendedprice
       WHEN h % 23 = 0 OR h % 29 = 0 THEN NULL ELSE l_extendedprice END AS parsed
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS h FROM lineitem) t""",
)
def parse_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles from blank-padded, exponent, suffixed, comma and junk text."""
    text = spark.sql(
        """
SELECT l_orderkey, l_linenumber,
  CASE WHEN h % 7 = 0 THEN concat(' ', l_extendedprice, ' ')
       WHEN h % 11 = 0 THEN '1e3'
       WHEN h % 13 = 0 THEN '1,5'
       WHEN h % 17 = 0 THEN concat(l_extendedprice, 'd')
       WHEN h % 23 = 0 THEN 'abc'
       WHEN h % 29 = 0 THEN ''
       ELSE cast(l_extendedprice AS string) END AS raw
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS h FROM {src})""",
        src=_t(spark, sf_dir, "lineitem"),
    )
    return text.select("l_orderkey", "l_linenumber", parse.parse_double(F.col("raw")).alias("parsed"))


# -- C10–C12, C16: digit-only keys ---------------------------------------------------------
@register(
    "clean_digit_key",
    """
SELECT c_custkey,
  CAST(CASE WHEN k % 7 = 0 THEN k * 10 + 7 WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN k
            WHEN k % 17 = 0 THEN NULL ELSE k END AS INTEGER) AS currency_rk
FROM (SELECT *, c_custkey AS k FROM customer) t""",
)
def clean_digit_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from the digits of ``Customer#…`` names; no digits or overflow → NULL."""
    text = spark.sql(
        """
SELECT c_custkey,
  CASE WHEN k % 7 = 0 THEN concat(c_name, '.7')
       WHEN k % 11 = 0 THEN 'N/A'
       WHEN k % 13 = 0 THEN concat('-', k)
       WHEN k % 17 = 0 THEN concat('99999', lpad(cast(k AS string), 6, '0'))
       WHEN k % 19 = 0 THEN concat(' RK ', k, ' ')
       ELSE c_name END AS raw
FROM (SELECT *, c_custkey AS k FROM {src})""",
        src=_t(spark, sf_dir, "customer"),
    )
    return text.select("c_custkey", parse.digits_key(F.col("raw"), "int").alias("currency_rk"))


# -- C13–C15, C17–C19: three-letter codes --------------------------------------------------
@register(
    "normalise_code3",
    """
SELECT c_custkey,
  CASE c_custkey % 6 WHEN 0 THEN substring(c_mktsegment, 1, 3) WHEN 1 THEN substring(c_mktsegment, 1, 3)
       WHEN 2 THEN substring(c_mktsegment, 2, 3) WHEN 4 THEN substring(c_mktsegment, 1, 3)
       ELSE NULL END AS code_iso_char
FROM customer""",
)
def normalise_code3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upper-cased first run of three Latin capitals; short or non-Latin → NULL."""
    text = spark.sql(
        """
SELECT c_custkey,
  CASE c_custkey % 6 WHEN 0 THEN c_mktsegment
       WHEN 1 THEN lower(c_mktsegment)
       WHEN 2 THEN concat('1', substring(c_mktsegment, 2, 3), '2')
       WHEN 3 THEN substring(c_mktsegment, 1, 2)
       WHEN 4 THEN concat('  ', substring(c_mktsegment, 1, 3), ' ')
       ELSE 'ЕВР' END AS raw
FROM {src}""",
        src=_t(spark, sf_dir, "customer"),
    )
    return text.select("c_custkey", parse.clamp(parse.code3(F.col("raw")), 3).alias("code_iso_char"))


# -- C5, C6, C20, P5: text -----------------------------------------------------------------
@register(
    "clamp_text",
    """
SELECT p_partkey,
  CASE p_partkey % 3 WHEN 1 THEN substring(p_name || ' ' || p_brand, 1, 8)
       ELSE substring(p_name, 1, 8) END AS name8
FROM part""",
)
def clamp_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trim blanks, then keep the first 8 characters."""
    text = spark.sql(
        """
SELECT p_partkey,
  CASE p_partkey % 3 WHEN 0 THEN concat('  ', p_name, '  ')
       WHEN 1 THEN concat(p_name, ' ', p_brand) ELSE p_name END AS raw
FROM {src}""",
        src=_t(spark, sf_dir, "part"),
    )
    return text.select("p_partkey", parse.text_field(F.col("raw"), 8).alias("name8"))


@register(
    "empty_to_null",
    """
SELECT p_partkey,
  CASE WHEN p_partkey % 4 IN (0, 1) THEN NULL ELSE substring(p_type, 1, 3) END AS type3,
  CAST(NULL AS INTEGER) AS missing
FROM part""",
)
def empty_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C20/P5: empty or blank text → NULL, else clamp; plus a typed NULL column."""
    text = spark.sql(
        """
SELECT p_partkey,
  CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN concat(' ', p_type)
       ELSE p_type END AS raw
FROM {src}""",
        src=_t(spark, sf_dir, "part"),
    )
    return text.select(
        "p_partkey", parse.code_field(F.col("raw"), 3).alias("type3"), rules.null_of("int")(F.col("raw")).alias("missing")
    )


# -- C21, P6: default end date -------------------------------------------------------------
@register(
    "default_end_date",
    """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date,
  CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_orderdate AS DATE) + 30
       ELSE CAST(o_orderdate AS DATE) END AS end_date
FROM orders""",
)
def default_end_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing or unparsable end date falls back to the start date."""
    text = spark.sql(
        """
SELECT o_orderkey, date_format(o_orderdate, 'yyyy-M-d') AS s,
  CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'n/a'
       ELSE date_format(date_add(o_orderdate, 30), 'yyyy-M-d') END AS e
FROM {src}""",
        src=_t(spark, sf_dir, "orders"),
    )
    spec = TableSpec(
        "periods",
        (Field("o_orderkey", "o_orderkey", rules.bigint()), Field("start_date", "s", rules.date("yyyy-M-d")),
         Field("end_date", "e", rules.date("yyyy-M-d"))),
        required=("start_date",), defaults=(("end_date", "start_date"),), distinct=False, mode="overwrite",
    )
    return clean.align(clean.accepted(text.withColumn("o_orderkey", F.col("o_orderkey").cast("string")), spec), spec)


# -- P1–P4: alignment ----------------------------------------------------------------------
@register(
    "align_null_fill",
    X.ledger_select(
        """
SELECT CAST(NULL AS VARCHAR) AS chapter, CAST(NULL AS VARCHAR) AS chapter_name,
  CAST(NULL AS INTEGER) AS section_number, CAST(NULL AS VARCHAR) AS section_name,
  CAST(NULL AS VARCHAR) AS subsection_name, CAST(NULL AS INTEGER) AS ledger1_account,
  CAST(NULL AS VARCHAR) AS ledger1_account_name, CAST(p_partkey AS INTEGER) AS ledger_account,
  p_name AS ledger_account_name, CAST(NULL AS VARCHAR) AS characteristic,
  DATE '2018-01-01' AS start_date, CAST(NULL AS DATE) AS end_date
FROM part"""
    ),
)
def align_null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partial frame aligned to the 28 ledger columns with typed NULLs."""
    part = _t(spark, sf_dir, "part")
    partial = part.select(
        F.col("p_name").alias("ledger_account_name"),
        F.lit("2018-01-01").cast("date").alias("start_date"),
        F.col("p_partkey").cast("int").alias("ledger_account"),
    )
    return clean.align(partial, TB.MD_LEDGER_ACCOUNT_S)


# -- F1–F7: required filter ----------------------------------------------------------------
_BAL = X.table_expectations()["ft_balance_f"]


@register("required_filter", f"SELECT * FROM ({_BAL[0]}) r WHERE {_BAL[1]}")
def required_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed balances with a NULL date or account rejected; duplicates still in."""
    spec = TB.FT_BALANCE_F
    raw = read_feed(spark, spec, feeds.materialize_feed(spark, sf_dir, spec.name))
    return clean.accepted(raw, spec)


# -- A1–A3, L7: counters -------------------------------------------------------------------
@register("row_counters", X.counters("ft_balance_f"))
def row_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input, accepted, output and rejected rows of one load, counted in-pass."""
    spec = TB.FT_BALANCE_F
    source = feeds.materialize_feed(spark, sf_dir, spec.name)
    result = R.load_table(spark, spec, source, new_dir(spark, "targets") + "/" + spec.name)
    return R.counters_frame(spark, {spec.name: result})


# -- A4: distinct --------------------------------------------------------------------------
_POST = X.table_expectations()["ft_posting_f"]


@register("full_row_distinct", f"SELECT DISTINCT * FROM ({_POST[0]}) r WHERE {_POST[1]}")
def full_row_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: full-row distinct of the accepted postings (which keep their copies otherwise)."""
    spec = TB.FT_POSTING_F
    raw = read_feed(spark, spec, feeds.materialize_feed(spark, sf_dir, spec.name))
    return clean.accepted(raw, spec).dropDuplicates()


# -- L7, F1–F6: why rows are rejected; S1: malformed lines ---------------------------------
_REASONS = {  # feed → (rows with a weight of 2 where the feed repeats them, (column, missing, invalid))
    "ft_balance_f": (
        "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 53 = 0 THEN 2 ELSE 1 END AS w FROM orders",
        [("on_date", "false", "k % 11 = 0 OR k % 13 <> 0 AND k % 17 = 0"),
         ("account_rk", "k % 7 <> 0 AND k % 23 <> 0 AND k % 29 = 0", "k % 7 <> 0 AND k % 23 = 0")],
    ),
    "ft_posting_f": (
        "SELECT h AS k, CASE WHEN h % 53 = 0 THEN 2 ELSE 1 END AS w FROM (SELECT l_orderkey * 8 + l_linenumber AS h FROM lineitem) l",
        [("oper_date", "false", "k % 11 = 0 OR k % 13 <> 0 AND k % 17 = 0"),
         ("credit_account_rk", "k % 19 <> 0 AND k % 23 = 0", "false"), ("debet_account_rk", "false", "k % 31 = 0")],
    ),
}


@register("reject_reasons", " UNION ALL ".join(
    f"""SELECT '{feed}' AS feed, '{column}' AS column_name, '{reason}' AS reason,
    CAST(coalesce(sum(w) FILTER (WHERE {why}), 0) AS BIGINT) AS n_rows FROM ({rows}) r"""
    for feed, (rows, columns) in _REASONS.items()
    for column, *whys in columns
    for reason, why in zip(("missing", "invalid"), whys)
))
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reasons of rejected rows, counted by the staging write of two feeds."""
    found = []
    for name in _REASONS:
        spec, stage = TB.SPECS[name], new_dir(spark, f"stage/{name}")
        counters = R.stage_accepted(spark, spec, feeds.materialize_feed(spark, sf_dir, name), stage)[1]
        remove_path(spark, stage)
        found += [(name, c, reason, n) for c, by in counters.rejects().items() for reason, n in by.items()]
    return spark.createDataFrame(found, "feed string, column_name string, reason string, n_rows long")


@register(
    "rejected_rows",
    """
SELECT k AS account, reasons, CAST(sum(w) AS BIGINT) AS n_rows FROM (
  SELECT k, w, concat_ws(', ',
    CASE WHEN k % 11 = 0 OR k % 13 <> 0 AND k % 17 = 0 THEN 'on_date: invalid' END,
    CASE WHEN k % 7 <> 0 AND k % 23 = 0 THEN 'account_rk: invalid'
         WHEN k % 7 <> 0 AND k % 29 = 0 THEN 'account_rk: missing' END) AS reasons
  FROM (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 53 = 0 THEN 2 ELSE 1 END AS w FROM orders) o) r
WHERE reasons <> '' AND k % 29 <> 0 GROUP BY 1, 2""",
)
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The balances rows that the filter rejects, as they are in the feed, with every
    reason (those whose text names their account)."""
    spec = TB.FT_BALANCE_F
    raw = read_feed(spark, spec, feeds.materialize_feed(spark, sf_dir, spec.name))
    digits = F.regexp_extract("ACCOUNT_RK", r"(\d+)", 1).cast("long")
    found = clean.rejected_rows(raw, spec).filter("ACCOUNT_RK is not null").withColumn("account", digits)
    found = found.filter(F.col("account") % 29 != 0)
    return found.groupBy("account", F.array_join("reasons", ", ").alias("reasons")).agg(F.count("*").alias("n_rows"))


_LINES = TableSpec(
    "lines",
    (Field("d", "D", rules.date("yyyy-M-d")), Field("k", "K", rules.bigint(), nullable=False),
     Field("status", "STATUS", rules.text(9)), Field("priority", "PRIORITY", rules.text(20))),
    required=("k",), mode="overwrite",
)


@register(
    "malformed_lines",
    """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS priority,
  o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 AS is_malformed,
  count(*) FILTER (WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0) OVER () AS n_malformed
FROM orders""",
)
def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a field too few or too many are marked by the scan and counted by the
    staging write; their other fields are read as ever."""
    path = f"{new_dir(spark, 'feeds')}/lines"
    line = """concat_ws(';', date_format(o_orderdate, 'yyyy-M-d'), o_orderkey, o_orderstatus,
      CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN concat(o_orderpriority, ';more') ELSE o_orderpriority END)"""
    lines = _t(spark, sf_dir, "orders").select(F.expr(line).alias("D;K;STATUS;PRIORITY"))
    # Written as one column with a separator that no line has, so the lines are as planted.
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)
    stage = new_dir(spark, "stage/lines")
    n = R.stage_accepted(spark, _LINES, path, stage)[1].malformed()
    remove_path(spark, stage)
    raw = read_feed(spark, _LINES, path, malformed=clean.MALFORMED)
    return clean.typed(raw, _LINES, (clean.MALFORMED,)).select(
        "k", "priority", F.col(clean.MALFORMED).isNotNull().alias("is_malformed"), F.lit(n).cast("long").alias("n_malformed")
    )


# -- D1–D6: cleaned tables -----------------------------------------------------------------
_CLEAN = {
    "clean_balance": "ft_balance_f",
    "clean_posting": "ft_posting_f",
    "clean_account": "md_account_d",
    "clean_currency": "md_currency_d",
    "clean_exchange_rate": "md_exchange_rate_d",
    "clean_ledger": "md_ledger_account_s",
}


def _clean_query(table: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _cleaned_feed(spark, sf_dir, table)

    q.__doc__ = f"D1–D6: the {table} feed extracted and cleaned."
    return q


for _name, _table in _CLEAN.items():
    register(_name, X.cleaned(_table))(_clean_query(_table))


# -- N1–N3: constraint checks --------------------------------------------------------------
_ACC = X.table_expectations()["md_account_d"]


@register(
    "not_null_violations",
    f"""SELECT * FROM ({_ACC[0]}) r WHERE data_actual_date IS NULL OR data_actual_end_date IS NULL
    OR account_rk IS NULL OR account_number IS NULL OR char_type IS NULL OR currency_rk IS NULL
    OR currency_code IS NULL""",
)
def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed accounts (before filter and defaults) breaking a NOT NULL column."""
    spec = TB.MD_ACCOUNT_D
    raw = read_feed(spark, spec, feeds.materialize_feed(spark, sf_dir, spec.name))
    return checks.not_null_violations(clean.typed(raw, spec), spec)


@register(
    "pk_violations",
    """SELECT CAST(o_orderdate AS DATE) AS on_date, o_custkey AS account_rk, count(*) AS n_rows
FROM orders GROUP BY 1, 2 HAVING count(*) > 1""",
)
def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances keyed by (day, customer) — keys held by more than one row."""
    orders = _t(spark, sf_dir, "orders")
    df = orders.select(
        F.col("o_orderdate").cast("date").alias("on_date"),
        F.col("o_custkey").alias("account_rk"),
        (F.col("o_custkey") % 50).cast("int").alias("currency_rk"),
        F.col("o_totalprice").alias("balance_out"),
    )
    return checks.pk_violations(df, TB.FT_BALANCE_F)


@register(
    "length_violations",
    """
SELECT ledger_account, column_name, actual_length, max_length FROM (
  SELECT CAST(p_partkey AS INTEGER) AS ledger_account, 'chapter_name' AS column_name,
         CAST(length(p_type || ' ' || p_type) AS INTEGER) AS actual_length, 16 AS max_length FROM part
  UNION ALL
  SELECT CAST(p_partkey AS INTEGER), 'subsection_name', CAST(length(p_name || ' / ' || p_brand) AS INTEGER), 21 FROM part
  UNION ALL
  SELECT CAST(p_partkey AS INTEGER), 'ledger_account_name',
         CAST(length(trim(repeat(p_name || ' ', CAST(1 + p_partkey % 15 AS INTEGER)))) AS INTEGER), 153 FROM part
) v WHERE actual_length > max_length""",
)
def length_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger texts (trimmed, not clamped) longer than their column allows."""
    part = _t(spark, sf_dir, "part")
    df = part.select(
        F.col("p_partkey").cast("int").alias("ledger_account"),
        F.concat_ws(" ", "p_type", "p_type").alias("chapter_name"),
        F.concat_ws(" / ", "p_name", "p_brand").alias("subsection_name"),
        F.trim(F.expr("repeat(concat(p_name, ' '), 1 + cast(p_partkey % 15 AS int))")).alias("ledger_account_name"),
    )
    return checks.length_violations(df, TB.MD_LEDGER_ACCOUNT_S, key=["ledger_account"])


# -- J1, K1–K5, K8: keyed upsert -----------------------------------------------------------
_UPDATED_PRICE = "CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END"
_UPSERT_ORACLE = (
    f"SELECT DISTINCT * FROM ({X.with_dups(X.balances_typed(price=_UPDATED_PRICE))}) r WHERE {_BAL[1]}"
)


def _upsert_batches(spark: SparkSession, sf_dir: str, times: int, spec: TableSpec = TB.FT_BALANCE_F) -> DataFrame:
    """Even order keys loaded first; then odd keys (inserts) with keys ≡ 0 mod 4 re-sent at
    a changed amount (updates), ``times`` times. Keys ≡ 2 mod 4 stay as first loaded."""
    target = f"{new_dir(spark, 'targets')}/{spec.name}"
    first = feeds.materialize_feed(spark, sf_dir, spec.name, where="o_orderkey % 2 = 0")
    R.load_table(spark, spec, first, target)
    second = feeds.materialize_feed(
        spark, sf_dir, spec.name, where="o_orderkey % 2 = 1 OR o_orderkey % 4 = 0", price=_UPDATED_PRICE
    )
    for _ in range(times):
        R.load_table(spark, spec, second, target)
    for feed in (first, second):  # loaded: only the target is read from here on
        remove_path(spark, feed)
    return read_table(spark, spec, target)


@register("upsert_merge", _UPSERT_ORACLE)
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second batch updates matched keys and inserts new ones."""
    return _upsert_batches(spark, sf_dir, 1)


@register("upsert_twice", _UPSERT_ORACLE)
def upsert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 idempotence: the same batch merged twice equals merged once."""
    return _upsert_batches(spark, sf_dir, 2)


@register("upsert_wide", _UPSERT_ORACLE)
def upsert_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 for backfills: the batches of ``upsert_merge``, which touch every month, merged into a
    target stored in key buckets, whose rows no merge moves."""
    return _upsert_batches(spark, sf_dir, 1, dataclasses.replace(TB.FT_BALANCE_F, store_buckets=8))


def _stream_drops(spark: SparkSession, sf_dir: str, one_by_one: bool) -> DataFrame:
    """The two batches of ``upsert_merge`` as two file drops, streamed as each arrives or both
    waiting for one start."""
    from sluice.streaming import stream_feed

    spec = TB.FT_BALANCE_F
    root = new_dir(spark, "stream")
    target, inbox, ckpt = f"{root}/ds/{spec.name}", f"{root}/in", f"{root}/ckpt"
    drops = [
        dict(where="o_orderkey % 2 = 0"),
        dict(where="o_orderkey % 2 = 1 OR o_orderkey % 4 = 0", price=_UPDATED_PRICE),
    ]
    for i, shape in enumerate(drops):
        feeds.materialize_feed(spark, sf_dir, spec.name, dest=f"{inbox}/drop{i}", **shape)
        if one_by_one or i == len(drops) - 1:
            stream_feed(spark, spec, f"{inbox}/*", target, ckpt, journal_path=f"{root}/journal").awaitTermination()
    remove_path(spark, inbox)
    return read_table(spark, spec, target)


@register("stream_merge", _UPSERT_ORACLE)
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming ingestion: two drops, each streamed when it arrives."""
    return _stream_drops(spark, sf_dir, one_by_one=True)


@register("stream_waiting_drops", _UPSERT_ORACLE)
def stream_waiting_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming ingestion: both drops wait for one trigger and share keys; the later one's
    values stay."""
    return _stream_drops(spark, sf_dir, one_by_one=False)


@register("stream_drop_order", f"SELECT * FROM ({_UPSERT_ORACLE}) u CROSS JOIN (SELECT unnest(['all', 'one']) AS taken) t")
def stream_drop_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 via streaming: ``drop9`` came before ``drop10``, which shares keys with it; the later
    one's values stay whether a trigger takes all files or one."""
    from sluice.streaming import stream_feed

    spec, root = TB.FT_BALANCE_F, new_dir(spark, "stream")
    feeds.materialize_feed(spark, sf_dir, spec.name, dest=f"{root}/in/drop9", where="o_orderkey % 2 = 0")
    feeds.materialize_feed(
        spark, sf_dir, spec.name, dest=f"{root}/in/drop10", where="o_orderkey % 2 = 1 OR o_orderkey % 4 = 0", price=_UPDATED_PRICE
    )
    found = []
    for taken, most in (("all", None), ("one", 1)):
        target = f"{root}/{taken}/{spec.name}"
        stream_feed(spark, spec, f"{root}/in/*", target, f"{root}/ckpt-{taken}", max_files=most).awaitTermination()
        found.append(read_table(spark, spec, target).withColumn("taken", F.lit(taken)))
    remove_path(spark, f"{root}/in")
    return found[0].unionByName(found[1])


@register("overwrite_readback", f"SELECT *, count(*) OVER () AS rows_loaded FROM ({X.cleaned('ft_posting_f')}) r")
def overwrite_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6/S3/K8: a larger feed with more months first, then postings fully replace it; their
    rows and the returned read-back count (absent target → empty)."""
    spec = TB.FT_POSTING_F
    target = f"{new_dir(spark, 'targets')}/{spec.name}"
    assert read_table(spark, spec, target).isEmpty()
    frame = feeds.feed_frame(spark, sf_dir, spec.name)
    # Every row twice, as it is and in a later year, from one scan and one projection.
    twice = frame.withColumn("_later", F.explode(F.array(F.lit(False), F.lit(True))))
    later = F.regexp_replace("OPER_DATE", r"\d{4}$", "2031")
    larger = f"{new_dir(spark, 'feeds')}/{spec.name}"
    write_delimited(twice.withColumn("OPER_DATE", F.when(F.col("_later"), later).otherwise(F.col("OPER_DATE"))).drop("_later"), larger)
    source = feeds.materialize_feed(spark, sf_dir, spec.name)
    R.load_table(spark, spec, larger, target)
    done = R.load_table(spark, spec, source, target)
    for feed in (larger, source):
        remove_path(spark, feed)
    return read_table(spark, spec, target).withColumn("rows_loaded", F.lit(done["load"]["rows_loaded"]).cast("long"))


# -- N1–N3, K1: batches the load refuses ---------------------------------------------------
_CODES = TableSpec(
    "codes",
    (Field("d", "D", rules.date("yyyy-M-d"), nullable=False), Field("k", "K", rules.bigint(), nullable=False),
     Field("code", "CODE", rules.Rule(lambda c: c, "string", 3)), Field("note", "NOTE", rules.text(99), nullable=False)),
    required=("d", "k"), primary_key=("d", "k"), partition_date="d",
)


@register(
    "refused_batch",
    """
SELECT 'balances' AS feed, 'conflicting keys' AS reason, count(*) AS n FROM (
  SELECT 1 FROM (SELECT DISTINCT date_trunc('month', o_orderdate) AS d, o_custkey, o_totalprice FROM orders) o
  GROUP BY d, o_custkey HAVING count(*) > 1) c
UNION ALL SELECT 'codes', 'NULL in a NOT NULL column', count(*) FILTER (o_orderkey % 3 = 0) FROM orders
UNION ALL SELECT 'codes', 'text longer than its column', count(*) FILTER (length(o_orderpriority) > 3) FROM orders""",
)
def refused_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches the load refuses before it writes, with the counts its own check gives."""
    orders = _t(spark, sf_dir, "orders")
    balances = orders.select(
        F.trunc("o_orderdate", "month").alias("on_date"), F.col("o_custkey").alias("account_rk"),
        F.lit(1).alias("currency_rk"), F.col("o_totalprice").alias("balance_out"),
    )
    codes = orders.select(
        F.col("o_orderdate").cast("date").alias("d"), F.col("o_orderkey").alias("k"),
        F.col("o_orderpriority").alias("code"), F.when(F.col("o_orderkey") % 3 != 0, "x").alias("note"),
    )
    found = []
    for name, spec, batch in (("balances", TB.FT_BALANCE_F, balances), ("codes", _CODES, codes)):
        target = f"{new_dir(spark, 'targets')}/{spec.name}"
        try:
            upsert(spark, spec, batch, target, batch_is_distinct=False)
        except KeyConflictError as exc:
            found.append((name, "conflicting keys", exc.keys))
        except ConstraintError as exc:
            found += [(name, "NULL in a NOT NULL column", exc.not_null), (name, "text longer than its column", exc.too_long)]
        assert read_target(spark, spec, target) is None
    return spark.createDataFrame(found, "feed string, reason string, n long")


# -- L1–L6, F8, C22: journal ---------------------------------------------------------------
# Journal events from the event stream, every row of it: a user's day is a run; signups and
# views start an attempt, purchases and clicks finish it with success, errors with failure.
_EVENT_OF = """CASE event_type WHEN 'signup' THEN 'Started' WHEN 'view' THEN 'Started'
    WHEN 'purchase' THEN 'Success' WHEN 'click' THEN 'Success' ELSE 'Failed' END"""

_JOURNAL_EVENTS_SPARK = f"""
SELECT concat(user_id, '/', cast(cast(ts AS date) AS string)) AS run_id, ts AS at,
  {_EVENT_OF} AS event,
  CASE WHEN event_type = 'error' THEN concat('error in ', props) END AS error_message,
  props AS extra
FROM {{src}}"""

_JOURNAL_FOLD_ORACLE = f"""
WITH e AS (
  SELECT CAST(user_id AS VARCHAR) || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, ts AS evt_at,
    {_EVENT_OF} AS event,
    CASE WHEN event_type = 'error' THEN 'error in ' || props END AS error_message, props AS extra
  FROM events),
s AS (SELECT run_id, max(evt_at) AS started_at FROM e WHERE event = 'Started' GROUP BY run_id),
f AS (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY evt_at DESC, event DESC,
    error_message DESC NULLS LAST, extra DESC NULLS LAST) AS n
  FROM e WHERE event <> 'Started')
SELECT s.run_id, started_at,
  CASE WHEN evt_at >= started_at THEN evt_at END AS finished_at,
  CASE WHEN evt_at >= started_at THEN event ELSE 'Started' END AS status,
  CASE WHEN evt_at >= started_at THEN error_message END AS error_message,
  CASE WHEN evt_at >= started_at THEN extra END AS extra
FROM s LEFT JOIN f ON s.run_id = f.run_id AND n = 1"""


def _journal_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.sql(_JOURNAL_EVENTS_SPARK, src=_t(spark, sf_dir, "events"))
    return journal.fold(events)


@register("journal_fold", _JOURNAL_FOLD_ORACLE)
def journal_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1–L3: the append-only journal folded to one state row per run (last finish wins)."""
    return _journal_state(spark, sf_dir)


@register("journal_compacted", f"SELECT *, true AS few_files FROM ({_JOURNAL_FOLD_ORACLE}) s")
def journal_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2/L3 at length: events appended as many files, compacted as they come; the state folded
    from what is left, and whether that is a few files."""
    events = spark.sql(_JOURNAL_EVENTS_SPARK, src=_t(spark, sf_dir, "events"))
    path = new_dir(spark, "journal")
    for third in range(3):
        part = events.filter(F.pmod(F.xxhash64("run_id", "at"), F.lit(3)) == third)
        part.repartition(40).write.mode("append").parquet(path)
        journal.compact(spark, path, fan_in=8)
    left = journal.read_events(spark, path)
    return journal.fold(left).withColumn("few_files", F.lit(len(left.inputFiles()) <= 8))


@register("journal_open_runs", f"SELECT * FROM ({_JOURNAL_FOLD_ORACLE}) s WHERE status = 'Started' AND finished_at IS NULL")
def journal_open_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4/F8: runs started and not (validly) finished."""
    return journal.open_runs(_journal_state(spark, sf_dir))


@register(
    "journal_detail",
    """
SELECT CAST(user_id AS VARCHAR) || '/' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id,
  CAST(to_json({'started': count(*) FILTER (WHERE event_type = 'signup'),
                'succeeded': count(*) FILTER (WHERE event_type = 'purchase'),
                'failed': count(*) FILTER (WHERE event_type = 'error')}) AS VARCHAR) AS extra
FROM events GROUP BY 1""",
)
def journal_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-run detail encoded as JSON text."""
    ev = _t(spark, sf_dir, "events")
    run_id = F.concat_ws("/", F.col("user_id").cast("string"), F.col("ts").cast("date").cast("string"))
    n = lambda kind: F.count(F.when(F.col("event_type") == kind, 1))
    return ev.groupBy(run_id.alias("run_id")).agg(
        journal.detail_column(started=n("signup"), succeeded=n("purchase"), failed=n("error")).alias("extra")
    )


# -- D7, D8: whole run ---------------------------------------------------------------------
@register(
    "run_all_tables",
    " UNION ALL ".join(f"SELECT * FROM ({X.counters(s.name)}) c{i}" for i, s in enumerate(TB.RUN_ORDER)),
)
def run_all_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six feeds loaded in order, journaled; per-table counters."""
    return R.counters_frame(spark, _run_all(spark, sf_dir)[0]["tables"])


def _run_all(spark: SparkSession, sf_dir: str) -> tuple[dict, str]:
    root = new_dir(spark, "runs-all")
    sources = {s.feed_name: feeds.materialize_feed(spark, sf_dir, s.feed_name, dest=f"{root}/feeds/{s.feed_name}")
               for s in TB.RUN_ORDER}
    targets = {s.name: f"{root}/ds/{s.name}" for s in TB.RUN_ORDER}
    result = R.run_all(spark, sources, targets, f"{root}/journal")
    for folder in ("feeds", "ds"):  # the counters and the journal are what is read
        remove_path(spark, f"{root}/{folder}")
    return result, f"{root}/journal"


@register(
    "run_journal",
    " UNION ALL ".join(
        f"SELECT 'Success' AS status, c{i}.* FROM ({X.counters(s.name)}) c{i}" for i, s in enumerate(TB.RUN_ORDER)
    ),
)
def run_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The journal a run has written, read back: its state and the counters of
    every table from its JSON detail."""
    state = journal.fold(journal.read_events(spark, _run_all(spark, sf_dir)[1]))
    kind = "tables map<string, struct<transform: struct<rows_input: long, rows_after_filter: long, rows_output: long, rows_rejected: long>>>"
    detail = state.select("status", F.explode(F.from_json("extra", kind)["tables"]).alias("table", "detail"))
    return detail.select("status", "table", "detail.transform.*")


@register(
    "failed_run_journal",
    f"""
SELECT 'Failed' AS status, 'KeyConflictError' AS error_type, 'md_account_d' AS failed_step, true AS has_traceback,
  'ft_balance_f' AS committed,
  (SELECT count(*) FROM (SELECT DISTINCT data_actual_date, account_rk FROM ({X.cleaned('md_account_d')}) c) k) AS conflicts,
  (SELECT count(*) FROM ({X.cleaned('ft_balance_f')}) b) AS balances_loaded,
  (SELECT 2 * rows_after_filter FROM ({X.counters('md_account_d')}) a) AS rows_staged, 0 AS rows_in_target""",
)
def failed_run_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose second table holds every key twice: its journaled failure, what was
    committed before, and the staged rows that it leaves for a rerun."""
    root = new_dir(spark, "runs-failed")
    specs = [TB.FT_BALANCE_F, TB.MD_ACCOUNT_D]
    sources = {s.feed_name: f"{root}/feeds/{s.feed_name}" for s in specs}
    feeds.materialize_feed(spark, sf_dir, "ft_balance_f", dest=sources["ft_balance_f"])
    accounts = feeds.feed_frame(spark, sf_dir, "md_account_d")
    other = accounts.withColumn("ACCOUNT_NUMBER", F.concat(F.lit("9"), "ACCOUNT_NUMBER"))
    write_delimited(accounts.unionByName(other), sources["md_account_d"])
    targets = {s.name: f"{root}/ds/{s.name}" for s in specs}
    try:
        R.run_all(spark, sources, targets, f"{root}/journal", specs=specs)
    except KeyConflictError:
        pass
    state = journal.fold(journal.read_events(spark, f"{root}/journal"))
    kind = "error_type string, failed_step string, traceback string, stage string, committed array<string>"
    found = state.select("status", "error_message", F.from_json("extra", kind).alias("d"))
    staged = spark.read.parquet(f"{found.first()['d']['stage']}/accepted").count()
    loaded = [read_table(spark, s, targets[s.name]).count() for s in specs]
    return found.select(
        "status",
        "d.error_type",
        "d.failed_step",
        F.col("d.traceback").contains("KeyConflictError").alias("has_traceback"),
        F.array_join("d.committed", ",").alias("committed"),
        F.regexp_extract("error_message", r": (\d+) key", 1).cast("long").alias("conflicts"),
        F.lit(loaded[0]).cast("long").alias("balances_loaded"),
        F.lit(staged).cast("long").alias("rows_staged"),
        F.lit(loaded[1]).cast("int").alias("rows_in_target"),
    )


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
