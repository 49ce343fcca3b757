"""Run a report job end to end: read its tables, compute, write, export under a dated name.

    python -m cardflow.jobs interest_adjustments --run-date 2024-03-16 \\
        --table txn_detail=warehouse.plan_transactions --output-root /reports

``--table name=location`` maps each input of the job to a catalog table or a parquet folder
(a location containing ``/`` or ``:``). ``--jdbc name=table`` reads an input from the database of
``--jdbc-url`` instead (credentials come from the environment variables named by ``--jdbc-user-env`` and
``--jdbc-password-env``); ``--jdbc name=table,key,like,parts`` reads it in ``parts`` queries split evenly by
``key``, with split points from the location ``like`` that holds the same keys. The run date defaults to today; every date the job uses
derives from it (``BusinessDate``). The summary job needs ``--rules`` (a JSON file with the
``SummaryRules`` fields) and ``--target``; the flagged-accounts job needs ``--history``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cardflow.functions.dates import BusinessDate
from cardflow.plans import (SummaryRules, adjustment_transactions, interest_adjustments_mtd, plan_postings_mtd,
                            run_daily_application_summary)
from cardflow.plans.application_summary import SUMMARY_INPUTS
from cardflow.plans.new_flagged_accounts import run_new_flagged_accounts
from cardflow.plans.summary_refresh import refresh_summary
from cardflow.session import apply_recommended_conf
from cardflow.sinks.tables import read_target, write_report
from cardflow.sources.splits import read_jdbc_planned
from cardflow.sources.tables import jdbc_options, read_jdbc


@dataclass(frozen=True)
class JobSpec:
    inputs: tuple[str, ...]
    report_name: str
    grain: str


JOBS: dict[str, JobSpec] = {
    "new_flagged_accounts": JobSpec(("account_snapshot", "account_master"), "new_flagged_accounts", "day"),
    "plan_postings": JobSpec(("plan_txn", "plan_code"), "plan_postings", "month"),
    "interest_adjustments": JobSpec(("txn_detail",), "interest_adjustments", "month"),
    "adjustment_transactions": JobSpec(("txn_master",), "adjustment_transactions", "day"),
    "daily_application_summary": JobSpec(SUMMARY_INPUTS, "daily_app_summary", "day"),
}


@dataclass(frozen=True)
class JdbcTable:
    """An input in a database; with a key, read by several queries (``sources.splits``)."""

    table: str
    key: str | None = None
    like: str | None = None
    parts: int = 1

    @classmethod
    def parse(cls, text: str) -> "JdbcTable":
        fields = text.split(",")
        if len(fields) == 1:
            return cls(fields[0])
        if len(fields) != 4:
            raise ValueError(f"expected table or table,key,like,parts: {text}")
        return cls(fields[0], fields[1], fields[2], int(fields[3]))


def read_input(spark: SparkSession, location: str | JdbcTable, jdbc: Mapping[str, str] | None = None) -> DataFrame:
    """An input by its location. ``jdbc``: url, user_env and password_env of the database."""
    if not isinstance(location, JdbcTable):
        return read_target(spark, location)
    if not jdbc or not jdbc.get("url"):
        raise ValueError(f"{location.table}: no database url")
    options = jdbc_options(jdbc["url"], location.table, jdbc["user_env"], jdbc["password_env"])
    if location.key is None:
        return read_jdbc(spark, options)
    return read_jdbc_planned(spark, options, location.key, read_target(spark, location.like), location.parts)


def load_rules(path: str) -> SummaryRules:
    """``SummaryRules`` from JSON: dates as ``YYYY-MM-DD``, product labels as [[codes], label]."""
    with open(path, encoding="utf-8") as fh:
        raw = json.load(fh)
    day = dt.date.fromisoformat
    return SummaryRules(
        excluded_strategy=raw["excluded_strategy"],
        care_window=(day(raw["care_window"][0]), day(raw["care_window"][1])),
        care_address=raw["care_address"],
        cis_address_prefix=raw["cis_address_prefix"],
        intercept_mail_fragment=raw["intercept_mail_fragment"],
        product_labels=tuple((tuple(codes), label) for codes, label in raw["product_labels"]),
        product_cutover=day(raw["product_cutover"]),
        label_before_cutover=raw["label_before_cutover"],
        label_after_cutover=raw["label_after_cutover"],
    )


def run_job(spark: SparkSession, job: str, bd: BusinessDate, tables: Mapping[str, str | JdbcTable], output_root: str,
            fmt: str = "csv", history: str | None = None, target: str | None = None,
            rules: SummaryRules | None = None, report_name: str | None = None, load_id: str | None = None,
            changed_only: bool = False, jdbc: Mapping[str, str] | None = None) -> tuple[str, int]:
    """Run one report job; returns (export path, exported rows). ``report_name`` replaces the
    job's default file-name prefix (the period stamp is always appended). ``load_id`` names the load of the
    flagged-accounts job (a retry gives the same one); ``changed_only`` keeps the summary in a versioned
    folder and recomputes the applications that changed since its last version."""
    spec = JOBS[job]
    name = report_name or spec.report_name
    missing = [n for n in spec.inputs if n not in tables]
    if missing:
        raise ValueError(f"{job}: no location for inputs {missing}")
    inputs: dict[str, DataFrame] = {n: read_input(spark, tables[n], jdbc) for n in spec.inputs}
    if job == "daily_application_summary":
        if rules is None or target is None:
            raise ValueError("daily_application_summary needs rules and a target table")
        if changed_only:
            return write_report(refresh_summary(inputs, bd, rules, target), output_root, name, bd, spec.grain, fmt)
        return run_daily_application_summary(inputs, bd, rules, target, output_root, fmt, name)
    if job == "new_flagged_accounts":
        if history is None:
            raise ValueError("new_flagged_accounts needs the history table")
        report = run_new_flagged_accounts(inputs["account_snapshot"], history, inputs["account_master"], bd, load_id=load_id)
    elif job == "plan_postings":
        report = plan_postings_mtd(inputs["plan_txn"], inputs["plan_code"], bd)
    elif job == "interest_adjustments":
        report = interest_adjustments_mtd(inputs["txn_detail"], bd)
    else:
        report = adjustment_transactions(inputs["txn_master"])
    return write_report(report, output_root, name, bd, spec.grain, fmt)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cardflow.jobs", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("--run-date", type=dt.date.fromisoformat, default=dt.date.today())
    ap.add_argument("--table", action="append", default=[], metavar="NAME=LOCATION")
    ap.add_argument("--output-root", required=True)
    ap.add_argument("--format", default="csv", choices=["csv", "parquet"])
    ap.add_argument("--history", help="history table of the flagged-accounts job")
    ap.add_argument("--target", help="summary table replaced by the summary job")
    ap.add_argument("--rules", help="JSON file with the summary job's site rules")
    ap.add_argument("--load-id", help="id of the flagged-accounts load; a retry gives the same one")
    ap.add_argument("--changed-only", action="store_true", help="summary: recompute changed applications only")
    ap.add_argument("--jdbc", action="append", default=[], metavar="NAME=TABLE[,KEY,LIKE,PARTS]")
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-user-env", default="JDBC_USER")
    ap.add_argument("--jdbc-password-env", default="JDBC_PASSWORD")
    ap.add_argument("--report-name", help="file-name prefix of the export (default: the job's)")
    args = ap.parse_args(argv)
    tables: dict[str, str | JdbcTable] = dict(t.split("=", 1) for t in args.table)
    tables |= {n: JdbcTable.parse(t) for n, t in (x.split("=", 1) for x in args.jdbc)}
    jdbc = {"url": args.jdbc_url, "user_env": args.jdbc_user_env, "password_env": args.jdbc_password_env}
    spark = apply_recommended_conf(SparkSession.builder.appName(f"cardflow-{args.job}").getOrCreate())
    path, rows = run_job(spark, args.job, BusinessDate(args.run_date), tables, args.output_root, args.format,
                         args.history, args.target, load_rules(args.rules) if args.rules else None,
                         args.report_name, args.load_id, args.changed_only, jdbc)
    print(json.dumps({"job": args.job, "run_date": args.run_date.isoformat(), "path": path, "rows": rows}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
