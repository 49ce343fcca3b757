from cardflow.sources.tables import (CONNECT_TIMEOUT_S, STATEMENT_TIMEOUT_S, jdbc_options, read_table, read_tables,
                                     register_views, run_sql)
from conftest import rows

SF = "/root/testdata/sf0.001"


def test_jdbc_options_map(monkeypatch):
    monkeypatch.setenv("CARDFLOW_TEST_USER", "reader")
    monkeypatch.setenv("CARDFLOW_TEST_PASSWORD", "secret")
    opts = jdbc_options("jdbc:postgresql://db.example:5432/dw", "schema.table", "CARDFLOW_TEST_USER",
                        "CARDFLOW_TEST_PASSWORD")
    assert opts["user"] == "reader" and opts["password"] == "secret"
    assert opts["connectTimeout"] == str(CONNECT_TIMEOUT_S) == "5"
    assert opts["queryTimeout"] == str(STATEMENT_TIMEOUT_S) == "900"
    assert "queryTimeout" not in jdbc_options("u", "t", "X_UNSET_U", "X_UNSET_P", statement_timeout_s=None)


def test_read_and_sql(spark):
    t = read_tables(spark, ["region", "nation"], SF)
    assert t["region"].count() == 5
    register_views(t)
    got = run_sql(spark, "SELECT r_name FROM region WHERE r_regionkey = :k", {"k": 1})
    assert rows(got) == [("AMERICA",)]
    got2 = run_sql(spark, "SELECT count(*) AS n FROM {n} WHERE n_regionkey = :k", {"k": 0},
                   n=read_table(spark, "nation", SF))
    assert rows(got2)[0][0] > 0
