"""Refreshing the summary for the applications that changed (CMP-10, RPT-5).

A full refresh recomputes every application every day though few change. Here every application id has a
digest of all that its summary rows depend on: the rows of the eleven inputs that belong to it and can count
(``counted``: elements of other names, say, are read by no source), each with whether it counts on the business
date (validity, test marks, entry before the run date, exclusion). Digests are two order-independent sums of 31-bit
hashes (two different sets of rows agree in both by chance once in 2 ** 62), so they come from one aggregate with a
partial step; an id with very many rows sends one row a task. Hashes don't compress, so their width and the rows that
can't count are what the shuffle's size depends on. They are stored with the summary in one version, committed
together. The next run compares digests, recomputes the ids whose digest is new, changed or gone from
inputs cut to those ids, and takes the other rows from the last version.

What holds for all ids at once (the site's rules, the form of the digests, an exclusion listing that
holds a NULL and so excludes everything, the columns of an input) is a fingerprint; if it differs, or there
is no last version, everything is recomputed. Either way the result equals the full refresh.

The transfer account's custom row reaches an application by its transfer rows, so its digest is joined to
them (one row an account against any number of applications).
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import asdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cardflow.functions.dates import BusinessDate, before_day
from cardflow.operators.membership import key_bitmap, with_membership
from cardflow.plans.application_summary import SUMMARY_INPUTS, SummaryRules, counted, daily_application_summary
from cardflow.session import checkpoint_dir
from cardflow.sinks.versions import Versions

#: The column of each input that holds the application id; account_custom is reached through app_transfer.
APPLICATION_KEY = {
    "legacy_app": "app_num", "legacy_element": "app_num", "legacy_override": "app_num", "excluded_app": "app_num",
    "app": "appl_id", "app_decision": "appl_id", "app_element": "appl_id", "app_user_data": "appl_id",
    "app_transfer": "appl_id", "app_account": "appl_id"}
#: Columns whose comparison with a date decides whether a row counts.
ENTRY_COLUMN = {"legacy_app": "dt_entered", "app": "entry_dt"}
FORM = 2


def _hashed(name: str, df: DataFrame, bd: BusinessDate, key: str, out: str) -> DataFrame:
    """(out, a, b): two hashes of each row of an input with all that dates decide about it. Rows of no id,
    rows that can't count and rows that don't on the business date are left out."""
    df = df.filter(counted(name))
    valid = F.lit(True)
    if "efftv_from_dt" in df.columns:
        valid = F.coalesce(F.lit(bd.as_of).between(F.col("efftv_from_dt"), F.col("efftv_to_dt")), F.lit(False))
    entered = F.lit(True)
    if name in ENTRY_COLUMN:  # the spine reads applications whatever their validity
        entered = F.coalesce(before_day(ENTRY_COLUMN[name], bd.run_date), F.lit(False))
    else:
        df = df.filter(valid)
    # a hash skips NULLs, so each column comes with whether it is one
    parts = [F.lit(name), valid, entered, *[x for c in sorted(df.columns) for x in (F.col(c), F.col(c).isNull())]]
    return df.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias(out), F.xxhash64(*parts).alias("a"),
                                                    F.xxhash64(F.lit(FORM), *parts).alias("b"))


_PRIME = (1 << 31) - 1


def _digest() -> list[Column]:
    """Order-independent: two sums of hashes."""
    return [F.sum(F.pmod("a", F.lit(_PRIME))).alias("s"), F.sum(F.pmod("b", F.lit(_PRIME))).alias("t")]


def application_digests(inputs: Mapping[str, DataFrame], bd: BusinessDate) -> DataFrame:
    """(appl_id, digest): a digest of everything that an application's summary rows depend on."""
    rows: DataFrame | None = None
    for name, key in APPLICATION_KEY.items():
        part = _hashed(name, inputs[name], bd, key, "appl_id")
        rows = part if rows is None else rows.union(part)
    accounts = _hashed("account_custom", inputs["account_custom"], bd, "acct_id", "__acct").groupBy("__acct").agg(*_digest())
    transfers = inputs["app_transfer"]
    reached = transfers.filter(F.lit(bd.as_of).between(F.col("efftv_from_dt"), F.col("efftv_to_dt"))
                               & counted("app_transfer")).select("appl_id", "acct_id")
    through = reached.join(accounts, reached["acct_id"] == accounts["__acct"]).select(
        F.col("appl_id").cast("long").alias("appl_id"), F.xxhash64("__acct", "s", "t").alias("a"),
        F.xxhash64("t", "s", "__acct").alias("b"))
    sums = rows.union(through.filter("appl_id is not null")).groupBy("appl_id").agg(*_digest())
    return sums.select("appl_id", F.xxhash64("s", "t").alias("digest"))


def fingerprint(inputs: Mapping[str, DataFrame], rules: SummaryRules) -> str:
    """What all applications depend on alike."""
    no_null = inputs["excluded_app"].filter("app_num is null").isEmpty()
    schemas = {name: inputs[name].schema.jsonValue() for name in SUMMARY_INPUTS}
    text = json.dumps([FORM, asdict(rules), schemas, no_null], sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()


def changed_ids(now: DataFrame, last: DataFrame) -> DataFrame:
    """(appl_id): ids whose digest is new, another one, or gone. One join of two aggregates on the id."""
    old = last.select("appl_id", F.col("digest").alias("old"))
    new = now.select("appl_id", F.col("digest").alias("new"))
    return new.join(old, "appl_id", "full").filter(~F.col("new").eqNullSafe(F.col("old"))).select("appl_id")


def inputs_of(inputs: Mapping[str, DataFrame], ids: DataFrame) -> dict[str, DataFrame]:
    """The inputs cut to the rows that belong to ``ids``: a bitmap in the scan, then a semi join. The
    exclusion listing stays whole (its NULLs count for every id), as do the custom rows (the transfer
    rows that reach them are cut)."""
    cut = dict(inputs)
    flag, bitmap = "__may_change", key_bitmap(ids, ["appl_id"]).checkpoint(eager=True)  # BLOCKS rows at most
    for name, key in APPLICATION_KEY.items():
        df = inputs[name]
        if name == "excluded_app":
            continue
        rows = df
        if df.schema[key].dataType == LongType():
            rows = with_membership(df, [key], bitmap, flag).filter(flag).drop(flag)
        cut[name] = rows.join(ids.select(F.col("appl_id").alias(key)), key, "left_semi").select(*df.columns)
    return cut


def refresh_summary(inputs: Mapping[str, DataFrame], bd: BusinessDate, rules: SummaryRules, target: str) -> DataFrame:
    """Bring the versioned summary ``target`` up to date and return it.

    The new version holds the rows of changed ids, computed from inputs cut to them, and the last version's
    rows of all other ids. Its pointer notes how many ids changed (-1: everything was recomputed).
    """
    spark = inputs["app"].sparkSession
    checkpoint_dir(spark)
    versions = Versions(spark, target)
    last, print_now = versions.current(), fingerprint(inputs, rules)
    digests = application_digests(inputs, bd).checkpoint(eager=True)
    if last is None or last["notes"].get("fingerprint") != print_now:
        rows, changed = daily_application_summary(inputs, bd, rules), -1
    else:
        ids = changed_ids(digests, versions.read("digests")).checkpoint(eager=True)
        changed = ids.count()
        old = versions.read()
        kept = old.join(ids, "appl_id", "left_anti").select(*old.columns)
        rows = kept if not changed else kept.unionByName(daily_application_summary(inputs_of(inputs, ids), bd, rules))
    versions.replace({"rows": rows, "digests": digests}, {"fingerprint": print_now, "changed": changed})
    return versions.read()
