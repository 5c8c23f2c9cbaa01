"""Feeds shaped like the six source files, derived from the driver's tables.

Each feed is a Spark SQL projection of one table into upper-case text columns, with
dirt planted as a pure function of the row's key (impossible dates, wrong separators,
trailing text, blank padding, empty values, decimals in integers, letters in numbers,
over-long text, exact duplicate rows). Because the dirt depends only on the key, the
expected typed result can be stated straight from the table (see ``plans.expected``).
The feed is written as ``;``-separated CSV with a header (the source files' format),
so the whole read path (header binding, empty → NULL, blank padding) is exercised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.delimited import write_delimited
from sluice.workspace import new_dir

# ---------------------------------------------------------------------------------------
# Balances (ft_balance_f) from orders. Key k = o_orderkey.
_BALANCES = """
SELECT
  CASE WHEN k % 11 = 0 THEN concat('30.2.', year(o_orderdate))
       WHEN k % 13 = 0 THEN concat(date_format(o_orderdate, 'd.M.yyyy'), 'abc')
       WHEN k % 17 = 0 THEN date_format(o_orderdate, 'd/M/yyyy')
       WHEN k % 19 = 0 THEN concat(' ', date_format(o_orderdate, 'd.M.yyyy'), ' 10:00')
       ELSE date_format(o_orderdate, 'd.M.yyyy') END AS ON_DATE,
  CASE WHEN k % 7 = 0 THEN concat(k, '.7')
       WHEN k % 23 = 0 THEN concat('A', k)
       WHEN k % 29 = 0 THEN ''
       WHEN k % 31 = 0 THEN concat(' ', k, ' ')
       ELSE cast(k AS string) END AS ACCOUNT_RK,
  CASE WHEN k % 37 = 0 THEN 'x'
       WHEN k % 41 = 0 THEN concat(o_custkey % 50, '.9')
       ELSE cast(o_custkey % 50 AS string) END AS CURRENCY_RK,
  CASE WHEN k % 43 = 0 THEN '1,5'
       WHEN k % 47 = 0 THEN cast(cast(floor(price) AS bigint) AS string)
       ELSE cast(price AS string) END AS BALANCE_OUT,
  k % 53 = 0 AS _dup
FROM (SELECT *, o_orderkey AS k, {price} AS price FROM {src} WHERE {where})
"""

# Postings (ft_posting_f) from lineitem. Key h = l_orderkey * 8 + l_linenumber.
_POSTINGS = """
SELECT
  CASE WHEN h % 11 = 0 THEN concat('31-4-', year(l_shipdate))
       WHEN h % 13 = 0 THEN concat(date_format(l_shipdate, 'd-M-yyyy'), ' 10:00:00')
       WHEN h % 17 = 0 THEN date_format(l_shipdate, 'yyyy-M-d')
       ELSE date_format(l_shipdate, 'd-M-yyyy') END AS OPER_DATE,
  CASE WHEN h % 19 = 0 THEN concat(l_partkey, '.5')
       WHEN h % 23 = 0 THEN ''
       WHEN h % 29 = 0 THEN concat('+', l_partkey)
       ELSE cast(l_partkey AS string) END AS CREDIT_ACCOUNT_RK,
  CASE WHEN h % 31 = 0 THEN 'abc'
       WHEN h % 37 = 0 THEN concat(' ', l_suppkey, ' ')
       ELSE cast(l_suppkey AS string) END AS DEBET_ACCOUNT_RK,
  CASE WHEN h % 41 = 0 THEN '1e3'
       WHEN h % 43 = 0 THEN 'n/a'
       ELSE cast(l_extendedprice AS string) END AS CREDIT_AMOUNT,
  CASE WHEN h % 47 = 0 THEN concat(' ', l_extendedprice * l_discount, ' ')
       ELSE cast(l_extendedprice * l_discount AS string) END AS DEBET_AMOUNT,
  h % 53 = 0 AS _dup
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS h FROM {src})
"""

# Accounts (md_account_d) from customer. Key k = c_custkey.
_ACCOUNTS = """
SELECT
  CASE WHEN k % 11 = 0 THEN '2018-1-1abc'
       WHEN k % 13 = 0 THEN '2018-13-01'
       WHEN k % 17 = 0 THEN '2018-01-01 00:00:00'
       ELSE '2018-01-01' END AS DATA_ACTUAL_DATE,
  CASE WHEN k % 7 = 0 THEN ''
       WHEN k % 19 = 0 THEN '2018-02-29'
       ELSE '2018-01-31' END AS DATA_ACTUAL_END_DATE,
  CASE WHEN k % 23 = 0 THEN concat(' ', k)
       WHEN k % 29 = 0 THEN concat(k, 'x')
       ELSE cast(k AS string) END AS ACCOUNT_RK,
  CASE WHEN k % 31 = 0 THEN concat(acct, '99999')
       WHEN k % 37 = 0 THEN '   '
       ELSE acct END AS ACCOUNT_NUMBER,
  CASE WHEN k % 41 = 0 THEN ''
       WHEN k % 43 = 0 THEN concat(' ', ch, 'x')
       ELSE ch END AS CHAR_TYPE,
  CASE WHEN k % 47 = 0 THEN concat(c_nationkey, '.5')
       ELSE cast(c_nationkey AS string) END AS CURRENCY_RK,
  CASE WHEN k % 53 = 0 THEN concat(cc, '0') ELSE cc END AS CURRENCY_CODE,
  k % 59 = 0 AS _dup
FROM (SELECT *, c_custkey AS k,
             concat('40817810', lpad(cast(c_custkey AS string), 12, '0')) AS acct,
             CASE WHEN c_custkey % 3 = 0 THEN 'П' ELSE 'А' END AS ch,
             lpad(cast(c_nationkey * 37 AS string), 3, '0') AS cc
      FROM {src})
"""

# Currencies (md_currency_d) from supplier. Key k = s_suppkey. No duplicates: the
# currency load keeps them, and an exact duplicate would fail the keyed load.
_CURRENCIES = """
SELECT
  CASE WHEN k % 5 = 1 THEN concat('RK-', k)
       WHEN k % 7 = 0 THEN concat(' ', k, ' ')
       WHEN k % 11 = 0 THEN 'none'
       WHEN k % 13 = 0 THEN '99999999999'
       ELSE cast(k AS string) END AS CURRENCY_RK,
  CASE WHEN k % 19 = 0 THEN ''
       WHEN k % 17 = 0 THEN concat(d, ' ')
       ELSE d END AS DATA_ACTUAL_DATE,
  CASE WHEN k % 23 = 0 THEN 'never' ELSE '2050-12-31' END AS DATA_ACTUAL_END_DATE,
  CASE WHEN k % 29 = 0 THEN ''
       WHEN k % 31 = 0 THEN '  '
       WHEN k % 37 = 0 THEN concat(cc, '12')
       ELSE cc END AS CURRENCY_CODE,
  CASE WHEN k % 41 = 0 THEN 'ЕВР'
       WHEN k % 43 = 0 THEN ''
       WHEN k % 4 = 1 THEN concat(' ', lower(iso), ' ')
       WHEN k % 6 = 2 THEN concat('1', iso, '2')
       WHEN k % 8 = 3 THEN substring(iso, 1, 2)
       ELSE iso END AS CODE_ISO_CHAR,
  false AS _dup
FROM (SELECT *, s_suppkey AS k,
             CASE s_suppkey % 3 WHEN 0 THEN '2011-9-6' WHEN 1 THEN '2017-05-11'
                  ELSE '2017-12-12' END AS d,
             lpad(cast(s_nationkey * 37 % 1000 AS string), 3, '0') AS cc,
             concat(char(65 + s_suppkey % 26), char(65 + (s_suppkey div 26) % 26),
                    char(65 + s_nationkey % 26)) AS iso
      FROM {src})
"""

# Exchange rates (md_exchange_rate_d) from events. Key k = event_id.
_EXCHANGE_RATES = """
SELECT
  CASE WHEN k % 11 = 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss')
       WHEN k % 13 = 0 THEN date_format(ts, 'yyyy/MM/dd')
       ELSE date_format(ts, 'yyyy-M-d') END AS DATA_ACTUAL_DATE,
  CASE WHEN k % 17 = 0 THEN ''
       ELSE date_format(date_add(cast(ts AS date), 30), 'yyyy-M-d') END AS DATA_ACTUAL_END_DATE,
  CASE WHEN k % 19 = 0 THEN concat(k, '.0')
       WHEN k % 23 = 0 THEN ''
       ELSE cast(k AS string) END AS CURRENCY_RK,
  CASE WHEN k % 31 = 0 THEN '1,5'
       WHEN k % 37 = 0 THEN concat(value, 'd')
       ELSE cast(value AS string) END AS REDUCED_COURCE,
  CASE WHEN k % 41 = 0 THEN concat(' ', num, '9') ELSE num END AS CODE_ISO_NUM,
  k % 43 = 0 AS _dup
FROM (SELECT *, event_id AS k, lpad(cast(user_id % 1000 AS string), 3, '0') AS num
      FROM {src})
"""

# Ledger accounts (md_ledger_account_s) from part. Key k = p_partkey.
_LEDGER = """
SELECT
  CASE WHEN k % 11 = 0 THEN concat(' ', ch, ' ') ELSE ch END AS CHAPTER,
  concat(p_type, ' ', p_type) AS CHAPTER_NAME,
  CASE WHEN k % 13 = 0 THEN concat(p_size % 9, '.0')
       WHEN k % 17 = 0 THEN 'III'
       ELSE cast(p_size % 9 AS string) END AS SECTION_NUMBER,
  concat(p_brand, ' section') AS SECTION_NAME,
  concat(p_name, ' / ', p_brand) AS SUBSECTION_NAME,
  cast(300 + p_size % 5 AS string) AS LEDGER1_ACCOUNT,
  concat('Ledger ', p_type, ' ', p_name) AS LEDGER1_ACCOUNT_NAME,
  CASE WHEN k % 19 = 0 THEN concat('L', k)
       WHEN k % 23 = 0 THEN concat(' ', k, '.00')
       ELSE cast(k AS string) END AS LEDGER_ACCOUNT,
  CASE WHEN k % 5 = 0 THEN concat('  ', nm, ' ') ELSE nm END AS LEDGER_ACCOUNT_NAME,
  CASE WHEN k % 3 = 0 THEN 'П' ELSE 'А' END AS CHARACTERISTIC,
  CASE WHEN k % 29 = 0 THEN '2017-02-30' ELSE sd END AS START_DATE,
  CASE WHEN k % 31 = 0 THEN '2050-12-31abc' ELSE '2050-12-31' END AS END_DATE,
  k % 37 = 0 AS _dup
FROM (SELECT *, p_partkey AS k,
             CASE WHEN p_partkey % 2 = 0 THEN 'А' ELSE 'Б' END AS ch,
             repeat(concat(p_name, ' '), 1 + cast(p_partkey % 15 AS int)) AS nm,
             CASE p_partkey % 4 WHEN 0 THEN '2013-01-01' WHEN 1 THEN '2015-6-15'
                  WHEN 2 THEN '2017-01-01' ELSE '2018-01-01' END AS sd
      FROM {src})
"""

# feed name -> (driver table, SQL template)
FEEDS = {
    "ft_balance_f": ("orders", _BALANCES),
    "ft_posting_f": ("lineitem", _POSTINGS),
    "md_account_d": ("customer", _ACCOUNTS),
    "md_currency_d": ("supplier", _CURRENCIES),
    "md_exchange_rate_d": ("events", _EXCHANGE_RATES),
    "md_ledger_account_s": ("part", _LEDGER),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def feed_frame(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    *,
    where: str = "true",
    price: str = "o_totalprice",
) -> DataFrame:
    """The text feed ``name`` as a DataFrame of strings (duplicates included).

    ``where`` / ``price`` shape the balances feed into load batches (a key subset and
    changed amounts); the other feeds take the whole table.
    """
    source, template = FEEDS[name]
    sql = template.replace("{where}", where).replace("{price}", price)
    rows = spark.sql(sql, src=table(spark, sf_dir, source))
    # Exact duplicate rows: a flagged row is emitted twice, in the same single scan.
    copies = F.when(F.col("_dup"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("_copy", F.explode(copies)).drop("_dup", "_copy")


def materialize_feed(spark: SparkSession, sf_dir: str, name: str, dest: str | None = None, **shape) -> str:
    """Write the feed as ``;`` CSV with a header to a fresh shared folder; return its path."""
    path = dest or f"{new_dir(spark, 'feeds')}/{name}"
    write_delimited(feed_frame(spark, sf_dir, name, **shape), path)
    return path
