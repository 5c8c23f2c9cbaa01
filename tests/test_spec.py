import pytest

from sluice.functions import rules as r
from sluice.plans import tables as TB
from sluice.spec import Field, TableSpec


def test_all_key_upsert_refused_before_any_job():
    with pytest.raises(ValueError, match="nothing to update"):
        TableSpec("t", (Field("d", "D", r.date("yyyy-M-d")),), required=("d",), primary_key=("d",))


def test_unknown_and_partition_columns():
    f = (Field("d", "D", r.date("yyyy-M-d")), Field("v", "V", r.integer()))
    with pytest.raises(ValueError, match="unknown column"):
        TableSpec("t", f, required=("x",), primary_key=("d",))
    with pytest.raises(ValueError, match="partition date"):
        TableSpec("t", f, required=("d", "v"), primary_key=("v",), partition_date="d")


def test_table_specs_shape():
    assert len(TB.MD_LEDGER_ACCOUNT_S.columns) == 28
    assert TB.MD_LEDGER_ACCOUNT_S.lengths["ledger_account_name"] == 153
    assert TB.MD_ACCOUNT_D.not_null == TB.MD_ACCOUNT_D.columns
    assert [s.name for s in TB.RUN_ORDER] == [
        "md_currency_d", "md_exchange_rate_d", "md_account_d", "md_ledger_account_s", "ft_balance_f", "ft_posting_f",
    ]
    assert TB.FT_POSTING_F.mode == "overwrite" and not TB.FT_POSTING_F.distinct
    assert TB.MD_CURRENCY_D.raw_schema.names == ["CURRENCY_RK", "DATA_ACTUAL_DATE", "DATA_ACTUAL_END_DATE",
                                                  "CURRENCY_CODE", "CODE_ISO_CHAR"]


def test_key_columns_must_be_required():
    f = (Field("d", "D", r.date("yyyy-M-d")), Field("k", "K", r.integer()), Field("v", "V", r.integer()))
    with pytest.raises(ValueError, match="must be required"):
        TableSpec("t", f, required=("d",), primary_key=("d", "k"))


def test_defaults_and_partition_column_types():
    f = (Field("d", "D", r.date("yyyy-M-d")), Field("k", "K", r.integer()), Field("e", "E", r.integer()))
    with pytest.raises(ValueError, match="default of 'e'"):
        TableSpec("t", f, required=("d", "k"), primary_key=("d", "k"), defaults=(("e", "d"),))
    with pytest.raises(ValueError, match="must be a date column"):
        TableSpec("t", f, required=("d", "k"), primary_key=("d", "k"), partition_date="k")
