"""End-to-end job runs over derived driver data written as parquet tables."""

import dataclasses
import json
import os

import pytest

import __spark_entry__ as E
from cardflow.jobs import JOBS, load_rules, run_job
from cardflow.registry.driver_inputs import (BD_FLAGGED, BD_MTD, BD_SUMMARY, SUMMARY_RULES, report_input)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    names = {n for spec in JOBS.values() for n in spec.inputs} | {"flag_history"}
    out = {}
    for n in sorted(names):
        out[n] = os.path.join(root, n)
        report_input(spark, SF, n).write.parquet(out[n])
    return out


@pytest.mark.parametrize("job,bd,key", [
    ("plan_postings", BD_MTD, "q_rpt_plan_postings_mtd"),
    ("interest_adjustments", BD_MTD, "q_rpt_interest_adjustments_mtd"),
    ("adjustment_transactions", BD_MTD, "q_rpt_adjustment_transactions"),
])
def test_extract_jobs(spark, tables, tmp_path, job, bd, key):
    path, rows = run_job(spark, job, bd, tables, str(tmp_path), fmt="parquet")
    assert os.path.basename(path) == f"{JOBS[job].report_name}_{bd.stamp(JOBS[job].grain)}"
    assert rows == E.queries()[key](spark, SF).count()
    assert spark.read.parquet(path).count() == rows


def test_flagged_accounts_job_appends_once(spark, tables, tmp_path):
    history = str(tmp_path / "history")
    spark.read.parquet(tables["flag_history"]).write.parquet(history)
    before = spark.read.parquet(history).count()
    path, rows = run_job(spark, "new_flagged_accounts", BD_FLAGGED, tables, str(tmp_path / "out"), history=history)
    assert rows == E.queries()["q_rpt_new_flagged_accounts"](spark, SF).count()
    appended = spark.read.parquet(history).count() - before
    assert appended == E.queries()["q_delta_rows"](spark, SF).count()
    run_job(spark, "new_flagged_accounts", BD_FLAGGED, tables, str(tmp_path / "out"), history=history)
    assert spark.read.parquet(history).count() - before == appended  # a re-run appends nothing


def test_summary_job_with_rules_file(spark, tables, tmp_path):
    rules = dataclasses.asdict(SUMMARY_RULES)
    rules["care_window"] = [d.isoformat() for d in rules["care_window"]]
    rules["product_cutover"] = rules["product_cutover"].isoformat()
    rules["product_labels"] = [[list(codes), label] for codes, label in rules["product_labels"]]
    rules_path = tmp_path / "rules.json"
    rules_path.write_text(json.dumps(rules))
    assert load_rules(str(rules_path)) == SUMMARY_RULES
    target = str(tmp_path / "summary_table")
    path, rows = run_job(spark, "daily_application_summary", BD_SUMMARY, tables, str(tmp_path / "out"),
                         target=target, rules=load_rules(str(rules_path)))
    assert rows == spark.read.parquet(target).count() == E.queries()["q_rpt_daily_application_summary"](spark, SF).count()
    assert path.endswith(f"daily_app_summary_{BD_SUMMARY.stamp('day')}")


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        run_job(spark, "interest_adjustments", BD_MTD, {}, str(tmp_path))


def test_cli_main(spark, tables, tmp_path, capsys):
    from cardflow.jobs import main

    rc = main(["interest_adjustments", "--run-date", BD_MTD.run_date.isoformat(), "--table",
               f"txn_detail={tables['txn_detail']}", "--output-root", str(tmp_path), "--format", "csv",
               "--report-name", "INTEREST_ADJ"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert rc == 0 and out["rows"] == E.queries()["q_rpt_interest_adjustments_mtd"](spark, SF).count()
    assert out["path"].endswith(f"INTEREST_ADJ_{BD_MTD.stamp('month')}")


def test_summary_job_for_changed_applications(spark, tables, tmp_path):
    target, want = str(tmp_path / "summary"), E.queries()["q_rpt_daily_application_summary"](spark, SF).count()
    for _ in range(2):  # the second run finds nothing changed
        path, rows = run_job(spark, "daily_application_summary", BD_SUMMARY, tables, str(tmp_path / "out"), target=target,
                             rules=SUMMARY_RULES, changed_only=True)
        assert rows == want and path.endswith(f"daily_app_summary_{BD_SUMMARY.stamp('day')}")


def test_database_inputs(spark, tables, tmp_path, monkeypatch):
    """A planned database read: what is asked of the reader (no database is at hand)."""
    from cardflow import jobs
    from cardflow.jobs import JdbcTable, read_input
    from cardflow.sources import splits

    assert JdbcTable.parse("dw.t") == JdbcTable("dw.t")
    planned = JdbcTable.parse(f"dw.t,acct_id,{tables['txn_detail']},4")
    with pytest.raises(ValueError):
        JdbcTable.parse("dw.t,acct_id")
    with pytest.raises(ValueError):
        read_input(spark, planned)
    monkeypatch.setenv("DB_USER", "reader")
    jdbc = {"url": "jdbc:postgresql://db/x", "user_env": "DB_USER", "password_env": "DB_PASSWORD"}
    asked = {}

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            asked.update(url=url, table=table, predicates=predicates, properties=properties)

    class Session:
        read = Reader()

    like = spark.read.parquet(tables["txn_detail"])
    monkeypatch.setattr(jobs, "read_target", lambda s, location: like)
    read_input(Session(), planned, jdbc)
    assert asked["table"] == "dw.t" and asked["properties"]["user"] == "reader" and asked["properties"]["queryTimeout"] == "900"
    assert asked["predicates"] == splits.split_predicates("acct_id", splits.split_points(like, "acct_id", 4))
    assert len(asked["predicates"]) == 5 and asked["predicates"][-1] == "acct_id IS NULL"
