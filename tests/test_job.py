import json

from sluice.operators.load import read_table
from sluice.plans import job
from sluice.plans import tables as TB
from sluice.sources import feeds


def test_run_and_state(spark, workdir, capsys):
    sf = "/root/testdata/sf0.001"
    for name in ("md_currency_d", "ft_balance_f"):
        feeds.materialize_feed(spark, sf, name, dest=f"{workdir}/in/{name}")
    code = job.main(["run", "--csv-dir", f"{workdir}/in", "--target-root", f"{workdir}/ds",
                     "--tables", "ft_balance_f,md_currency_d", "--run-id", "job-1"], spark=spark)
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and out["status"] == "Success" and list(out["tables"]) == ["md_currency_d", "ft_balance_f"]
    assert read_table(spark, TB.FT_BALANCE_F, f"{workdir}/ds/ft_balance_f").count() == \
        out["tables"]["ft_balance_f"]["transform"]["rows_output"]
    assert job.main(["state", "--journal", f"{workdir}/ds/_journal"], spark=spark) == 0
    state = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (state["run_id"], state["status"]) == ("job-1", "Success")
