from sluice.sources import jdbc


def test_options_and_names():
    url = jdbc.jdbc_url("db", 5432, "dwh")
    assert url == "jdbc:postgresql://db:5432/dwh"
    opts = jdbc.jdbc_options(url, "u", "p", stringtype="unspecified")
    assert opts["driver"] == "org.postgresql.Driver" and opts["stringtype"] == "unspecified"
    assert jdbc.qualified_table("DS", "ft_balance_f") == '"DS"."ft_balance_f"'
    assert jdbc.quoted('a"B') == '"a""B"'
