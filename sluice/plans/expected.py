"""DuckDB statements of the expected typed rows of each derived feed.

Each ``*_TYPED`` query states, straight from the driver's tables, what the cleaning
rules must produce for every feed row *before* the required-columns filter, with a
``_dup`` flag for rows the feed repeats. The oracles in ``plans.queries`` build on
them; they never parse text, so they check the Spark parsers rather than mirror them.
"""

from __future__ import annotations


def with_dups(base: str) -> str:
    """Rows of ``base`` plus a second copy of its ``_dup`` rows, without the flag."""
    return (
        f"SELECT * EXCLUDE (_dup) FROM ({base}) b "
        f"UNION ALL SELECT * EXCLUDE (_dup) FROM ({base}) b WHERE _dup"
    )


def balances_typed(price: str = "o_totalprice", where: str = "true") -> str:
    return f"""
SELECT
  CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN CAST(o_orderdate AS DATE)
       WHEN k % 17 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS on_date,
  CASE WHEN k % 7 = 0 THEN k WHEN k % 23 = 0 THEN NULL WHEN k % 29 = 0 THEN NULL
       ELSE k END AS account_rk,
  CASE WHEN k % 37 = 0 THEN NULL ELSE CAST(o_custkey % 50 AS INTEGER) END AS currency_rk,
  CASE WHEN k % 43 = 0 THEN NULL WHEN k % 47 = 0 THEN floor(price) ELSE price END AS balance_out,
  k % 53 = 0 AS _dup
FROM (SELECT *, o_orderkey AS k, {price} AS price FROM orders WHERE {where}) t"""


POSTINGS_TYPED = """
SELECT
  CASE WHEN h % 11 = 0 THEN NULL WHEN h % 13 = 0 THEN CAST(l_shipdate AS DATE)
       WHEN h % 17 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS oper_date,
  CASE WHEN h % 19 = 0 THEN l_partkey WHEN h % 23 = 0 THEN NULL ELSE l_partkey END AS credit_account_rk,
  CASE WHEN h % 31 = 0 THEN NULL ELSE l_suppkey END AS debet_account_rk,
  CASE WHEN h % 41 = 0 THEN CAST(1000 AS DOUBLE) WHEN h % 43 = 0 THEN NULL
       ELSE l_extendedprice END AS credit_amount,
  l_extendedprice * l_discount AS debet_amount,
  h % 53 = 0 AS _dup
FROM (SELECT *, l_orderkey * 8 + l_linenumber AS h FROM lineitem) t"""

ACCOUNTS_TYPED = """
SELECT
  CASE WHEN k % 11 = 0 THEN DATE '2018-01-01' WHEN k % 13 = 0 THEN NULL
       ELSE DATE '2018-01-01' END AS data_actual_date,
  CASE WHEN k % 7 = 0 THEN NULL WHEN k % 19 = 0 THEN NULL
       ELSE DATE '2018-01-31' END AS data_actual_end_date,
  CASE WHEN k % 23 = 0 THEN k WHEN k % 29 = 0 THEN NULL ELSE k END AS account_rk,
  CASE WHEN k % 31 = 0 THEN acct WHEN k % 37 = 0 THEN '' ELSE acct END AS account_number,
  CASE WHEN k % 41 = 0 THEN NULL ELSE ch END AS char_type,
  c_nationkey AS currency_rk,
  cc AS currency_code,
  k % 59 = 0 AS _dup
FROM (SELECT *, c_custkey AS k,
             '40817810' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS acct,
             CASE WHEN c_custkey % 3 = 0 THEN 'П' ELSE 'А' END AS ch,
             lpad(CAST(c_nationkey * 37 AS VARCHAR), 3, '0') AS cc
      FROM customer) t"""

CURRENCIES_TYPED = """
SELECT
  CAST(CASE WHEN k % 5 = 1 THEN k WHEN k % 7 = 0 THEN k WHEN k % 11 = 0 THEN NULL
            WHEN k % 13 = 0 THEN NULL ELSE k END AS INTEGER) AS currency_rk,
  CASE WHEN k % 19 = 0 THEN NULL ELSE d END AS data_actual_date,
  CASE WHEN k % 23 = 0 THEN NULL ELSE DATE '2050-12-31' END AS data_actual_end_date,
  CASE WHEN k % 29 = 0 THEN NULL WHEN k % 31 = 0 THEN NULL ELSE cc END AS currency_code,
  CASE WHEN k % 41 = 0 THEN NULL WHEN k % 43 = 0 THEN NULL WHEN k % 4 = 1 THEN iso
       WHEN k % 6 = 2 THEN iso WHEN k % 8 = 3 THEN NULL ELSE iso END AS code_iso_char,
  false AS _dup
FROM (SELECT *, s_suppkey AS k,
             CASE s_suppkey % 3 WHEN 0 THEN DATE '2011-09-06' WHEN 1 THEN DATE '2017-05-11'
                  ELSE DATE '2017-12-12' END AS d,
             lpad(CAST(s_nationkey * 37 % 1000 AS VARCHAR), 3, '0') AS cc,
             chr(CAST(65 + s_suppkey % 26 AS INTEGER)) || chr(CAST(65 + (s_suppkey // 26) % 26 AS INTEGER))
               || chr(CAST(65 + s_nationkey % 26 AS INTEGER)) AS iso
      FROM supplier) t"""

EXCHANGE_RATES_TYPED = """
SELECT
  CASE WHEN k % 11 = 0 THEN CAST(ts AS DATE) WHEN k % 13 = 0 THEN NULL
       ELSE CAST(ts AS DATE) END AS data_actual_date,
  CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(ts AS DATE) + 30 END AS data_actual_end_date,
  CAST(CASE WHEN k % 19 = 0 THEN k WHEN k % 23 = 0 THEN NULL ELSE k END AS INTEGER) AS currency_rk,
  CASE WHEN k % 31 = 0 THEN NULL ELSE value END AS reduced_cource,
  num AS code_iso_num,
  k % 43 = 0 AS _dup
FROM (SELECT *, event_id AS k, lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') AS num
      FROM events) t"""

LEDGER_TYPED = """
SELECT
  ch AS chapter,
  substring(p_type || ' ' || p_type, 1, 16) AS chapter_name,
  CAST(CASE WHEN k % 13 = 0 THEN p_size % 9 WHEN k % 17 = 0 THEN NULL
            ELSE p_size % 9 END AS INTEGER) AS section_number,
  substring(p_brand || ' section', 1, 22) AS section_name,
  substring(p_name || ' / ' || p_brand, 1, 21) AS subsection_name,
  CAST(300 + p_size % 5 AS INTEGER) AS ledger1_account,
  substring('Ledger ' || p_type || ' ' || p_name, 1, 47) AS ledger1_account_name,
  CAST(CASE WHEN k % 19 = 0 THEN NULL ELSE k END AS INTEGER) AS ledger_account,
  substring(trim(repeat(p_name || ' ', CAST(1 + k % 15 AS INTEGER))), 1, 153) AS ledger_account_name,
  CASE WHEN k % 3 = 0 THEN 'П' ELSE 'А' END AS characteristic,
  CASE WHEN k % 29 = 0 THEN NULL ELSE sd END AS start_date,
  DATE '2050-12-31' AS end_date,
  k % 37 = 0 AS _dup
FROM (SELECT *, p_partkey AS k,
             CASE WHEN p_partkey % 2 = 0 THEN 'А' ELSE 'Б' END AS ch,
             CASE p_partkey % 4 WHEN 0 THEN DATE '2013-01-01' WHEN 1 THEN DATE '2015-06-15'
                  WHEN 2 THEN DATE '2017-01-01' ELSE DATE '2018-01-01' END AS sd
      FROM part) t"""

# Ledger columns the feed does not carry, in table order, with their types.
LEDGER_NULLS = {
    "is_resident": "INTEGER", "is_reserve": "INTEGER", "is_reserved": "INTEGER", "is_loan": "INTEGER",
    "is_reserved_assets": "INTEGER", "is_overdue": "INTEGER", "is_interest": "INTEGER",
    "pair_account": "VARCHAR",
}
LEDGER_NULLS_AFTER_DATES = {
    "is_rub_only": "INTEGER", "min_term": "VARCHAR", "min_term_measure": "VARCHAR", "max_term": "VARCHAR",
    "max_term_measure": "VARCHAR", "ledger_acc_full_name_translit": "VARCHAR", "is_revaluation": "VARCHAR",
    "is_correct": "VARCHAR",
}


def ledger_select(src: str) -> str:
    """All 28 ledger columns from a relation holding the 12 fed ones."""
    nulls1 = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in LEDGER_NULLS.items())
    nulls2 = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in LEDGER_NULLS_AFTER_DATES.items())
    return (
        "SELECT chapter, chapter_name, section_number, section_name, subsection_name, ledger1_account, "
        "ledger1_account_name, ledger_account, ledger_account_name, characteristic, "
        f"{nulls1}, start_date, end_date, {nulls2} FROM ({src}) s"
    )


# table -> (typed rows with duplicates, required predicate, distinct?, output select)
def table_expectations() -> dict:
    acc_cols = (
        "data_actual_date, coalesce(data_actual_end_date, data_actual_date) AS data_actual_end_date, "
        "account_rk, account_number, char_type, currency_rk, currency_code"
    )
    return {
        "ft_balance_f": (with_dups(balances_typed()), "on_date IS NOT NULL AND account_rk IS NOT NULL", True, "*"),
        "ft_posting_f": (
            with_dups(POSTINGS_TYPED),
            "oper_date IS NOT NULL AND credit_account_rk IS NOT NULL AND debet_account_rk IS NOT NULL",
            False,
            "*",
        ),
        "md_account_d": (
            with_dups(ACCOUNTS_TYPED),
            "data_actual_date IS NOT NULL AND account_rk IS NOT NULL AND account_number IS NOT NULL "
            "AND char_type IS NOT NULL AND currency_rk IS NOT NULL AND currency_code IS NOT NULL",
            True,
            acc_cols,
        ),
        "md_currency_d": (with_dups(CURRENCIES_TYPED), "currency_rk IS NOT NULL AND data_actual_date IS NOT NULL", False, "*"),
        "md_exchange_rate_d": (
            with_dups(EXCHANGE_RATES_TYPED),
            "currency_rk IS NOT NULL AND data_actual_date IS NOT NULL",
            True,
            "*",
        ),
        "md_ledger_account_s": (with_dups(LEDGER_TYPED), "ledger_account IS NOT NULL AND start_date IS NOT NULL", True, "*"),
    }


def cleaned(table: str) -> str:
    """Expected cleaned table: filter, defaults, distinct, aligned columns."""
    rows, required, distinct, cols = table_expectations()[table]
    sql = f"SELECT {'DISTINCT ' if distinct else ''}{cols} FROM ({rows}) r WHERE {required}"
    if table == "md_ledger_account_s":
        sql = ledger_select(sql)
    return sql


def counters(table: str) -> str:
    """Expected (rows_input, rows_after_filter, rows_output, rows_rejected) of a table."""
    rows, required, distinct, cols = table_expectations()[table]
    return f"""
SELECT '{table}' AS "table",
  (SELECT count(*) FROM ({rows}) a) AS rows_input,
  (SELECT count(*) FROM ({rows}) a WHERE {required}) AS rows_after_filter,
  (SELECT count(*) FROM ({cleaned(table)}) c) AS rows_output,
  (SELECT count(*) FROM ({rows}) a WHERE NOT ({required})) AS rows_rejected"""
