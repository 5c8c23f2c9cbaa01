"""The six target tables (D1–D6) as declarative specs.

Names, key columns, NOT NULL columns, text lengths and date layouts are fixed values of
the feed contract; the rules are the non-raising parsers of ``sluice.functions``.
"""

from __future__ import annotations

from sluice.functions import rules as r
from sluice.spec import Field, TableSpec

# D1 — balances: keyed by (on_date, account_rk); full-row distinct.
FT_BALANCE_F = TableSpec(
    name="ft_balance_f",
    fields=(
        Field("on_date", "ON_DATE", r.date("d.M.yyyy"), nullable=False),
        Field("account_rk", "ACCOUNT_RK", r.bigint(), nullable=False),
        Field("currency_rk", "CURRENCY_RK", r.integer()),
        Field("balance_out", "BALANCE_OUT", r.double()),
    ),
    required=("on_date", "account_rk"),
    primary_key=("on_date", "account_rk"),
    distinct=True,
    mode="upsert",
    partition_date="on_date",
)

# D2 — postings: no key, duplicates kept, full replacement on every load.
FT_POSTING_F = TableSpec(
    name="ft_posting_f",
    fields=(
        Field("oper_date", "OPER_DATE", r.date("d-M-yyyy"), nullable=False),
        Field("credit_account_rk", "CREDIT_ACCOUNT_RK", r.bigint(), nullable=False),
        Field("debet_account_rk", "DEBET_ACCOUNT_RK", r.bigint(), nullable=False),
        Field("credit_amount", "CREDIT_AMOUNT", r.double()),
        Field("debet_amount", "DEBET_AMOUNT", r.double()),
    ),
    required=("oper_date", "credit_account_rk", "debet_account_rk"),
    distinct=False,
    mode="overwrite",
    partition_date="oper_date",
)

# D3 — accounts: six required columns; the end date defaults to the start date.
MD_ACCOUNT_D = TableSpec(
    name="md_account_d",
    fields=(
        Field("data_actual_date", "DATA_ACTUAL_DATE", r.date("yyyy-M-d"), nullable=False),
        Field("data_actual_end_date", "DATA_ACTUAL_END_DATE", r.date("yyyy-M-d"), nullable=False),
        Field("account_rk", "ACCOUNT_RK", r.bigint(), nullable=False),
        Field("account_number", "ACCOUNT_NUMBER", r.text(20), nullable=False),
        Field("char_type", "CHAR_TYPE", r.text(1), nullable=False),
        Field("currency_rk", "CURRENCY_RK", r.integer(), nullable=False),
        Field("currency_code", "CURRENCY_CODE", r.text(3), nullable=False),
    ),
    required=("data_actual_date", "account_rk", "account_number", "char_type", "currency_rk", "currency_code"),
    primary_key=("data_actual_date", "account_rk"),
    defaults=(("data_actual_end_date", "data_actual_date"),),
    distinct=True,
    mode="upsert",
    partition_date="data_actual_date",
    key_buckets=16,  # one actual date holds the whole table
)

# D4 — currencies: digit-only key, normalised three-letter code; no distinct.
MD_CURRENCY_D = TableSpec(
    name="md_currency_d",
    fields=(
        Field("currency_rk", "CURRENCY_RK", r.digits_int(), nullable=False),
        Field("data_actual_date", "DATA_ACTUAL_DATE", r.date("yyyy-M-d"), nullable=False),
        Field("data_actual_end_date", "DATA_ACTUAL_END_DATE", r.date("yyyy-M-d")),
        Field("currency_code", "CURRENCY_CODE", r.code(3)),
        Field("code_iso_char", "CODE_ISO_CHAR", r.code3()),
    ),
    required=("currency_rk", "data_actual_date"),
    primary_key=("currency_rk", "data_actual_date"),
    distinct=False,
    mode="upsert",
    partition_date="data_actual_date",
    key_buckets=4,
)

# D5 — exchange rates.
MD_EXCHANGE_RATE_D = TableSpec(
    name="md_exchange_rate_d",
    fields=(
        Field("data_actual_date", "DATA_ACTUAL_DATE", r.date("yyyy-M-d"), nullable=False),
        Field("data_actual_end_date", "DATA_ACTUAL_END_DATE", r.date("yyyy-M-d")),
        Field("currency_rk", "CURRENCY_RK", r.integer(), nullable=False),
        Field("reduced_cource", "REDUCED_COURCE", r.double()),
        Field("code_iso_num", "CODE_ISO_NUM", r.text(3)),
    ),
    required=("currency_rk", "data_actual_date"),
    primary_key=("data_actual_date", "currency_rk"),
    distinct=True,
    mode="upsert",
    partition_date="data_actual_date",
)

# D6 — ledger accounts: 12 columns from the feed, 16 more always NULL from it.
_LEDGER_INT_FLAGS = (
    "is_resident", "is_reserve", "is_reserved", "is_loan", "is_reserved_assets", "is_overdue", "is_interest",
)
MD_LEDGER_ACCOUNT_S = TableSpec(
    name="md_ledger_account_s",
    fields=(
        Field("chapter", "CHAPTER", r.text(1)),
        Field("chapter_name", "CHAPTER_NAME", r.text(16)),
        Field("section_number", "SECTION_NUMBER", r.integer()),
        Field("section_name", "SECTION_NAME", r.text(22)),
        Field("subsection_name", "SUBSECTION_NAME", r.text(21)),
        Field("ledger1_account", "LEDGER1_ACCOUNT", r.integer()),
        Field("ledger1_account_name", "LEDGER1_ACCOUNT_NAME", r.text(47)),
        Field("ledger_account", "LEDGER_ACCOUNT", r.integer(), nullable=False),
        Field("ledger_account_name", "LEDGER_ACCOUNT_NAME", r.text(153)),
        Field("characteristic", "CHARACTERISTIC", r.text(1)),
        *[Field(c, None, r.null_of("int")) for c in _LEDGER_INT_FLAGS],
        Field("pair_account", None, r.null_of("string", 5)),
        Field("start_date", "START_DATE", r.date("yyyy-M-d"), nullable=False),
        Field("end_date", "END_DATE", r.date("yyyy-M-d")),
        Field("is_rub_only", None, r.null_of("int")),
        Field("min_term", None, r.null_of("string", 1)),
        Field("min_term_measure", None, r.null_of("string", 1)),
        Field("max_term", None, r.null_of("string", 1)),
        Field("max_term_measure", None, r.null_of("string", 1)),
        Field("ledger_acc_full_name_translit", None, r.null_of("string", 1)),
        Field("is_revaluation", None, r.null_of("string", 1)),
        Field("is_correct", None, r.null_of("string", 1)),
    ),
    required=("ledger_account", "start_date"),
    primary_key=("ledger_account", "start_date"),
    distinct=True,
    mode="upsert",
    partition_date="start_date",
    key_buckets=4,
)

# Load order of a full run (dimensions first, then facts).
RUN_ORDER = (
    MD_CURRENCY_D,
    MD_EXCHANGE_RATE_D,
    MD_ACCOUNT_D,
    MD_LEDGER_ACCOUNT_S,
    FT_BALANCE_F,
    FT_POSTING_F,
)

SPECS = {s.name: s for s in RUN_ORDER}
