"""RPT-1 ``new_flagged_accounts``: daily delta of newly flagged accounts.

The original ran the history insert and the report in one statement. Here the two halves are
separate: ``flagged_delta`` (pure), ``flagged_report`` (pure) and ``run_new_flagged_accounts``,
which appends the delta through the load log and builds the report from the rows of that load, so a
retry after a failure reproduces the same report instead of an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.functions.columns import pad_id
from cardflow.functions.dates import BusinessDate, day, in_month
from cardflow.operators.joins import left_join_effective
from cardflow.operators.membership import may_match
from cardflow.sinks.load_log import load_once
from cardflow.sinks.tables import new_keys

# Fixed values of the original job: instalment-credit flags that make an account reportable.
FLAGS = ("IP", "IC", "VP", "VC", "VF")

HISTORY_COLUMNS = ["acct_id", "acct_seq_num", "acct_open_dt", "cpc", "cdf21", "data_bus_dt", "data_load_dt"]
OUTPUT = ["name", "name_emboss", "prov", "postal_code", "cpc", "cdf21", "acct_open_dt", "acct_id"]


def flagged_batch(snapshot: DataFrame, bd: BusinessDate, flags: Sequence[str] = FLAGS) -> DataFrame:
    """Snapshot rows of the business date's month with a reportable flag, primary account only,
    shaped like the history table except for the load-date stamp."""
    rows = snapshot.filter(in_month("eff_dt_yymm", bd) & F.col("inst_credit").isin(list(flags))
                           & (F.col("acct_seq_num") == 0))
    return rows.select("acct_id", "acct_seq_num", "acct_open_dt", "cpc",
                       F.col("inst_credit").alias("cdf21"), day("lastday_month").alias("data_bus_dt"))


def flagged_delta(snapshot: DataFrame, history: DataFrame, bd: BusinessDate,
                  flags: Sequence[str] = FLAGS) -> DataFrame:
    """Rows to append: flagged batch rows whose account id is not yet in the history (the check
    is on ``acct_id`` alone), stamped with the run date as load date."""
    delta = new_keys(flagged_batch(snapshot, bd, flags), history, ["acct_id"])
    return delta.withColumn("data_load_dt", F.lit(bd.run_date)).select(*HISTORY_COLUMNS)


def flagged_report(delta: DataFrame, master: DataFrame, bd: BusinessDate) -> DataFrame:
    """Delta rows with names and address from the account master valid on the business date.

    Several valid master rows fan out; no valid row gives NULL names. No sort. The master's scan is
    filtered by a bitmap of the delta's accounts, so a master of any size sends only rows that may match.
    """
    keys = ["acct_id", "acct_seq_num"]
    joined = left_join_effective(delta, may_match(master, delta, keys), keys, bd.as_of)
    return joined.select(
        "name",
        "name_emboss",
        F.col("state_prov_code").alias("prov"),
        F.col("zip_postal_code").alias("postal_code"),
        "cpc",
        "cdf21",
        day("acct_open_dt").alias("acct_open_dt"),
        pad_id("acct_id", 11).alias("acct_id"),
    )


def new_flagged_accounts(snapshot: DataFrame, history: DataFrame, master: DataFrame,
                         bd: BusinessDate, flags: Sequence[str] = FLAGS) -> DataFrame:
    """The report as the original computed it, without writing (history as of before the load)."""
    return flagged_report(flagged_delta(snapshot, history, bd, flags), master, bd)


def run_new_flagged_accounts(snapshot: DataFrame, history_target: str, master: DataFrame, bd: BusinessDate,
                             flags: Sequence[str] = FLAGS, load_id: str | None = None) -> DataFrame:
    """Append the delta to ``history_target`` exactly once per load and report the rows which that load
    inserted. A retry (the same ``load_id``; by default the run date and the batch's digest) reports the same."""
    loaded = load_once(flagged_batch(snapshot, bd, flags), history_target, ["acct_id"], HISTORY_COLUMNS, bd.run_date, load_id)
    return flagged_report(loaded, master, bd)
