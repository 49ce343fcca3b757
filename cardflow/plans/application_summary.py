"""RPT-5 ``daily_application_summary``: two application systems reconciled into one summary.

Stages: a spine of application ids, the legacy source (every row), the current source (one
row per id, valid on the business date) and the overlay that prefers the newer status.

Plan choices for large inputs:

* The spine keeps ids only. Its entry day is used solely by the "entered before today" filter,
  which runs inside each union branch, and the final ``DISTINCT`` makes the day irrelevant.
* Current source: every joined table is reduced to its top row per key *before* the joins.
  Ranking the fan-out of all joins by the status keys and then by the joined tables' columns
  (in join order) picks exactly the combination of per-table top rows, so the result is the
  same, but every join is 1:1 on ``appl_id`` and a hot id never multiplies across tables. The
  original's rank ties between fan-out rows were arbitrary; this fixes them reproducibly.
* Legacy source: its two joined tables are reduced to distinct (id, value) pairs before the
  join. The final ``DISTINCT`` makes multiplicities irrelevant, and the pairs bound the fan-out
  by the number of distinct values instead of the product of row counts.
* Account custom data is keyed on the transfer account, not the application: it is resolved
  against the transfer rows first, so the main joins all share ``appl_id``.
* The spine meets the current source first (both one row per id), then the legacy rows, which
  can be many per id. Ids holding very many legacy rows are found first (``hot_keys``: a bounded
  set) and salted in the joins that keep every legacy row, so one id never lands in one task;
  adaptive execution alone cannot split these joins, whose inputs reuse earlier partitioning.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.functions.columns import (blank_to_null, case_when, decode, first_char, flag, newest_wins,
                                        override, prefer)
from cardflow.functions.dates import BusinessDate, before_day, day
from cardflow.operators.joins import exclude_listed, left_join_many_parts
from cardflow.operators.ranking import latest_per_key, pg_asc, pg_desc
from cardflow.operators.skew import hot_keys, salted_join
from cardflow.operators.sets import distinct_rows, union_distinct
from cardflow.operators.temporal import effective_on

b = blank_to_null

# Fixed values of the original job.
STATUS_LABELS = {
    "NEWACCOUNT": "APPROVED",
    "DECLINE": "DECLINED",
    "NORESPONSE": "DECLINED",
    "REJECTOFFR": "REJECT OFFER",
    "VOID APP": "VOID APP",
    "WITHDRAW": "WITHDRAW APP",
}
STATUS_DEFAULT = "PENDING"
FINAL_STATUSES = ("NEWACCOUNT", "DECLINE", "NORESPONSE", "REJECTOFFR", "VOID APP", "WITHDRAW")
APPROVED_STATUS = "NEWACCOUNT"
DECLINE_STATUSES = ("DECLINE", "NORESPONSE", "REJECTOFFR", "VOID APP", "WITHDRAW")
CREDIT_DECLINE_QUEUES = ("DECSIN", "DECLBUR", "DECPABUR")
CALL_CENTRE_CHANNELS = ("TCALLCEN", "TMS")
CALL_CENTRE = "TCALLCEN"
DEALER_CHANNELS = ("RCORRETL", "RDEALER", "FCORRETL", "FDEALER")
PREAPPROVED_FIRST_CHARS = ("0", "1", "2", "4", "5", "7", "8", "9")
EMPLOYEE_FIRST_CHAR = "3"
AGE_BUCKETS = {
    "A": "30+ DAYS",
    "B": "21 - 30 DAYS",
    "C": "16 - 20 DAYS",
    "D": "11 - 15 DAYS",
    "E": "6 - 10 DAYS",
    "F": "DAY 5",
    "G": "DAY 4",
    "H": "DAY 3",
    "I": "DAY 2",
    "J": "DAY 1",
    "K": "DAY 0",
}
INCOME_ELEMENT = "CHKINCOME"
INCOME_PRODUCTS = {"INCOMEWEN": "WEN", "INCOMERCB": "RCB"}
ENTRY_METHODS = {"A": "ASTRUM", "D": "DE_WEB"}
INSTALMENT_CODES = ("EI", "IC", "IP", "VC", "VF", "VP")
ONLINE_CHANNEL = "INTERNET"
DEALER_CAMPAIGN = "IDVPMO"
RETAIL_DEALER_PRODUCTS = ("WEN", "RCB", "CCA")
FRANCHISE_DEALER_PRODUCT = "FCB"

# Inputs of the job, by name.
SUMMARY_INPUTS = ("legacy_app", "legacy_element", "legacy_override", "app", "app_decision", "app_element",
                  "app_user_data", "app_transfer", "app_account", "account_custom", "excluded_app")

OUTPUT = ["appl_id", "dt_entered", "dt_status", "app_status", "channel", "category", "stc", "queue",
          "age_bucket", "adm_cpc", "product_type", "app_entry_method", "inst_cr", "stc_bkdown"]
SOURCE_FIELDS = ["dt_entered", "dt_status", "app_status", "channel", "category", "stc", "queue",
                 "age_bucket", "adm_cpc", "cpgn_src_cd", "app_entry_method", "stc_bkdown"]


@dataclass(frozen=True)
class SummaryRules:
    """Site-specific literals of the summary, supplied by the caller.

    ``product_labels`` is an ordered list of (product codes, label); a NULL product code is
    labelled by the entry day against ``product_cutover``; anything else is ``ERROR``.
    """

    excluded_strategy: str
    care_window: tuple[dt.date, dt.date]
    care_address: str
    cis_address_prefix: str
    intercept_mail_fragment: str
    product_labels: Sequence[tuple[Sequence[str], str]]
    product_cutover: dt.date
    label_before_cutover: str
    label_after_cutover: str


def _status(stc: Column) -> Column:
    return decode(stc, STATUS_LABELS, STATUS_DEFAULT)


def _category(code: Column) -> Column:
    return case_when([
        (code.isNull(), "BLANK APPLICATIONS"),
        (first_char(code) == EMPLOYEE_FIRST_CHAR, "EMPLOYEE PROGRAM"),
        (first_char(code).isin(list(PREAPPROVED_FIRST_CHARS)), "PREAPPROVED"),
    ], "ERROR")


def _status_breakdown(stc: Column, queue: Column) -> Column:
    """NULL status matches no rule (``NOT IN`` gives NULL) and ends as DECLINED_OTHER."""
    return case_when([
        (~stc.isin(list(FINAL_STATUSES)), "PENDING"),
        (stc == APPROVED_STATUS, "APPROVED"),
        (stc.isin(list(DECLINE_STATUSES)) & queue.isin(list(CREDIT_DECLINE_QUEUES)), "DECLINED_CREDIT"),
    ], "DECLINED_OTHER")


def _entry_method(code: Column) -> Column:
    return case_when([
        (code == "A", ENTRY_METHODS["A"]),
        (code == "D", ENTRY_METHODS["D"]),
        (code.isNull() | (code == "I"), "INST_APP"),
    ], "ERROR")


def _product(override_cpc: Column, income_value: Column, fallback_cpc: Column) -> Column:
    return F.coalesce(override_cpc, decode(income_value, INCOME_PRODUCTS), fallback_cpc)


def counted(name: str) -> Column:
    """Which rows of an input can count at all, whatever the date: the sources below read no others, and a
    refresh of changed ids (``summary_refresh``) makes its digests of them alone."""
    conditions = {
        "legacy_element": lambda: b("element_name") == INCOME_ELEMENT,
        "legacy_override": lambda: F.col("ts2_account_id") > 0,
        "app_element": lambda: b("ele_elmt_nm") == INCOME_ELEMENT,
        "app_transfer": lambda: F.col("acct_id") > 0,
        "account_custom": lambda: (F.col("acct_seq_num") == 0) & F.col("custom_21_data").isin(list(INSTALMENT_CODES)),
    }
    return conditions[name]() if name in conditions else F.lit(True)


def legacy_rows(app: DataFrame) -> DataFrame:
    """Legacy application rows that are not test rows (rows with both test marks set drop)."""
    return app.filter(b("test_app_sw").isNull() | b("test_acct_flag").isNull())


def legacy_source(app: DataFrame, element: DataFrame, override_rows: DataFrame, rules: SummaryRules,
                  hot: DataFrame | None = None, salts: int | None = None) -> DataFrame:
    """Legacy rows (test rows with both marks set drop), not deduplicated: one output row per
    distinct combination of the joined income element and product override. With ``hot``
    (application ids holding very many legacy rows, column ``app_num``) both joins are salted."""
    # decoded before the DISTINCT: at most one row per (application, income product)
    income = (element.filter(counted("legacy_element"))
              .select(F.col("app_num"), decode(b("alpha_value"), INCOME_PRODUCTS).alias("income_cpc")).distinct())
    override_cpc = (override_rows.filter(counted("legacy_override"))
                    .select(F.col("app_num"), b("client_prod_code").alias("override_cpc")).distinct())
    a = legacy_rows(app).select(
        "app_num",
        day("dt_entered").alias("dt_entered"),
        day("dt_status").alias("dt_status"),
        b("status_field").alias("stc"),
        b("acct_cust_data_81").alias("ch"),
        b("data_entry_officer").alias("officer"),
        b("user_20_byte_9").alias("address"),
        b("user_75_byte_1").alias("mail"),
        b("acct_cust_data_60").alias("cat_code"),
        b("af_queue_id").alias("queue"),
        F.col("age_bucket").alias("age_code"),
        b("client_product_cd").alias("app_cpc"),
        b("acct_cust_data_62").alias("cpgn_src_cd"),
        b("user_1_byte_12").alias("entry_code"),
    )
    if hot is None:
        j = a.join(income, "app_num", "left").join(override_cpc, "app_num", "left")
    else:
        j = salted_join(salted_join(a, income, ["app_num"], "left", hot, salts), override_cpc, ["app_num"], "left",
                        hot, salts)
    ch, officer = F.col("ch"), F.col("officer")
    care_lo, care_hi = rules.care_window
    in_care_window = F.col("dt_entered").between(F.lit(care_lo), F.lit(care_hi))
    channel = case_when([
        (ch.isNull() & officer.isNotNull(), "OTHER"),
        ((ch == CALL_CENTRE) & in_care_window & (F.col("address") == rules.care_address), "CARE"),
        ((ch == CALL_CENTRE) & in_care_window & F.col("address").startswith(rules.cis_address_prefix), "CIS"),
        (ch.isin(list(DEALER_CHANNELS)) & F.col("mail").contains(rules.intercept_mail_fragment), "INTERCEP"),
        (ch.isin(list(CALL_CENTRE_CHANNELS)), CALL_CENTRE),
        (ch.isNull() & officer.isNull(), "ERROR"),
    ], ch)
    return j.select(
        F.col("app_num").alias("appl_id"),
        "dt_entered",
        "dt_status",
        _status(F.col("stc")).alias("app_status"),
        channel.alias("channel"),
        _category(F.col("cat_code")).alias("category"),
        "stc",
        "queue",
        decode("age_code", AGE_BUCKETS).alias("age_bucket"),
        F.coalesce(F.col("override_cpc"), F.col("income_cpc"), F.col("app_cpc")).alias("adm_cpc"),
        "cpgn_src_cd",
        _entry_method(F.col("entry_code")).alias("app_entry_method"),
        _status_breakdown(F.col("stc"), F.col("queue")).alias("stc_bkdown"),
    )


def current_source(app: DataFrame, decision: DataFrame, element: DataFrame, user_data: DataFrame,
                   transfer: DataFrame, account: DataFrame, account_custom: DataFrame,
                   bd: BusinessDate, hot_min_rows: int | str | None = "auto", salts: int | None = None) -> DataFrame:
    """One row per application id: the row valid on the business date with the newest status
    (NULL status date first, then newest validity start), with each joined table's row valid
    on that date. Ties are broken by the remaining columns, ascending, NULLs last. A transfer
    account shared by more than ``hot_min_rows`` applications ("auto": a task's share) is salted in its lookup."""
    d = bd.as_of

    def valid_top(df: DataFrame, key: str, columns: Sequence, order: Sequence[Column],
                  where: Column | None = None) -> DataFrame:
        """Rows valid on ``d`` (and matching ``where``), reduced to the top row per ``key``."""
        rows = effective_on(df, d)
        rows = rows if where is None else rows.filter(where)
        return latest_per_key(rows.select(*columns), [key], order)

    a = valid_top(app, "appl_id",
                  ["appl_id", "entry_dt", "curr_stat_dt", "efftv_from_dt", "appl_stat_cd", "acqsn_channel_cd",
                   "appl_queue_id", "appl_age_bucket"],
                  [pg_desc("curr_stat_dt"), pg_desc("efftv_from_dt"), pg_asc("entry_dt"), pg_asc("appl_stat_cd"),
                   pg_asc("acqsn_channel_cd"), pg_asc("appl_queue_id"), pg_asc("appl_age_bucket")])
    dec = valid_top(decision, "appl_id", ["appl_id", "data_entry_off_num"], [pg_asc("data_entry_off_num")])
    inc = valid_top(element, "appl_id", ["appl_id", "ele_alph_val"], [pg_asc("ele_alph_val")],
                    where=counted("app_element"))
    usr = valid_top(user_data, "appl_id", ["appl_id", "user_1_byte_12"], [pg_asc("user_1_byte_12")])
    xfer = valid_top(transfer, "appl_id",
                     ["appl_id", F.col("acct_id").alias("xfer_acct_id"), F.col("clnt_prod_cd").alias("xfer_cpc")],
                     [pg_asc("xfer_cpc"), pg_asc("xfer_acct_id")], where=counted("app_transfer"))
    cdf = valid_top(account_custom, "xfer_acct_id",
                    [F.col("acct_id").alias("xfer_acct_id"), F.col("custom_21_data").alias("inst_cr")],
                    [pg_asc("inst_cr")], where=counted("account_custom"))
    acct = valid_top(account, "appl_id",
                     ["appl_id", "custom_data_60", "custom_data_62", F.col("clnt_prod_cd").alias("acct_cpc")],
                     [pg_asc("custom_data_60"), pg_asc("custom_data_62"), pg_asc("acct_cpc")])
    # many applications may share one transfer account: salted if one account is hot. Counted
    # on the valid transfer rows (a superset of the top rows, no ranking needed); a superset
    # can only add keys, still fewer than hot_keys' bound.
    hot_acct = None
    if hot_min_rows is not None:
        valid_transfers = effective_on(transfer, d).filter(counted("app_transfer"))
        hot_acct = hot_keys(valid_transfers.select(F.col("acct_id").alias("xfer_acct_id")), ["xfer_acct_id"],
                            min_rows=None if hot_min_rows == "auto" else hot_min_rows)
    if hot_acct is None:
        xfer_cdf = xfer.join(cdf, "xfer_acct_id", "left")
    else:
        xfer_cdf = salted_join(xfer, cdf, ["xfer_acct_id"], "left", hot_acct, salts)
    xfer_cdf = xfer_cdf.select("appl_id", "xfer_cpc", "inst_cr")

    j = (a.join(dec, "appl_id", "left").join(inc, "appl_id", "left").join(usr, "appl_id", "left")
         .join(xfer_cdf, "appl_id", "left").join(acct, "appl_id", "left"))
    ch, officer = b("acqsn_channel_cd"), b("data_entry_off_num")
    stc = b("appl_stat_cd")
    channel = case_when([
        (ch.isNull() & officer.isNotNull(), "OTHER"),
        (ch.isin(list(CALL_CENTRE_CHANNELS)), CALL_CENTRE),
        (ch.isNull() & officer.isNull(), None),
    ], ch)
    return j.select(
        "appl_id",
        day("entry_dt").alias("dt_entered"),
        day("curr_stat_dt").alias("dt_status"),
        _status(stc).alias("app_status"),
        channel.alias("channel"),
        _category(b("custom_data_60")).alias("category"),
        stc.alias("stc"),
        F.col("appl_queue_id").alias("queue"),
        decode("appl_age_bucket", AGE_BUCKETS).alias("age_bucket"),
        _product(b("xfer_cpc"), b("ele_alph_val"), b("acct_cpc")).alias("adm_cpc"),
        b("custom_data_62").alias("cpgn_src_cd"),
        _entry_method(F.col("user_1_byte_12")).alias("app_entry_method"),
        "inst_cr",
        _status_breakdown(stc, b("appl_queue_id")).alias("stc_bkdown"),
    )


def application_spine(legacy_app: DataFrame, app: DataFrame, bd: BusinessDate, rules: SummaryRules) -> DataFrame:
    """Distinct application ids entered before the run date in either system; current rows with
    a blank or excluded strategy do not contribute (the legacy side takes every row)."""
    legacy_ids = legacy_app.filter(before_day("dt_entered", bd.run_date)).select(F.col("app_num").alias("appl_id"))
    current_ids = (app.filter((b("appl_strgy_cd") != rules.excluded_strategy)
                              & before_day("entry_dt", bd.run_date)).select("appl_id"))
    return union_distinct(legacy_ids, current_ids)


def _prefixed(df: DataFrame, prefix: str, fields: Sequence[str]) -> DataFrame:
    return df.select("appl_id", *[F.col(f).alias(prefix + f) for f in fields])


def daily_application_summary(inputs: Mapping[str, DataFrame], bd: BusinessDate, rules: SummaryRules,
                              hot_min_rows: int | str | None = "auto", salts: int | None = None) -> DataFrame:
    """The summary table rows (the 14 columns of the original's final stage).

    ``inputs`` keys: legacy_app, legacy_element, legacy_override, app, app_decision, app_element,
    app_user_data, app_transfer, app_account, account_custom, excluded_app.

    Application ids with more than ``hot_min_rows`` legacy rows ("auto": more than a task's share of them, see
    ``hot_keys``) are spread over ``salts`` tasks in the joins that keep every legacy row;
    ``hot_min_rows=None`` turns the detection off.
    """
    spine = application_spine(inputs["legacy_app"], inputs["app"], bd, rules)
    spine = exclude_listed(spine, "appl_id", inputs["excluded_app"], "app_num")
    hot = None
    if hot_min_rows is not None:
        # counted over every legacy row (one column; a superset of the non-test rows)
        hot = hot_keys(inputs["legacy_app"].select("app_num"), ["app_num"], min_rows=None if hot_min_rows == "auto" else hot_min_rows)
    ta = _prefixed(legacy_source(inputs["legacy_app"], inputs["legacy_element"], inputs["legacy_override"], rules,
                                 hot, salts),
                   "ta_", SOURCE_FIELDS)
    cur = _prefixed(current_source(inputs["app"], inputs["app_decision"], inputs["app_element"],
                                   inputs["app_user_data"], inputs["app_transfer"], inputs["app_account"],
                                   inputs["account_custom"], bd, hot_min_rows, salts),
                    "cur_", SOURCE_FIELDS + ["inst_cr"])
    # The legacy source has rows for exactly the non-test legacy ids (its joins are left joins).
    # Ids with legacy rows and ids without them are disjoint, and the second kind has one row
    # per id, so only the first needs the DISTINCT (its partial step runs before the shuffle).
    legacy_ids = legacy_rows(inputs["legacy_app"]).select(F.col("app_num").alias("appl_id"))
    hot_ids = None if hot is None else hot.select(F.col("app_num").alias("appl_id"))
    if hot is None:  # one pass: spine and current source are computed once
        return distinct_rows(_overlay(spine.join(cur, "appl_id", "left").join(ta, "appl_id", "left"), rules))
    matched, unmatched = left_join_many_parts(spine.join(cur, "appl_id", "left"), ta, ["appl_id"], legacy_ids,
                                              hot_ids, salts)
    return distinct_rows(_overlay(matched, rules)).unionByName(_overlay(unmatched, rules))


def _overlay(j: DataFrame, rules: SummaryRules) -> DataFrame:
    """The 14 output columns from a row of the current source (``cur_*``, primary) and the
    legacy source (``ta_*``)."""

    def newer(field: str) -> Column:
        return newest_wins("cur_dt_status", "ta_dt_status", "cur_" + field, "ta_" + field)

    def pref(field: str) -> Column:
        return prefer("cur_" + field, "ta_" + field)

    cpc, entered = pref("adm_cpc"), pref("dt_entered")
    is_dealer_campaign = (pref("channel") == ONLINE_CHANNEL) & (pref("cpgn_src_cd") == DEALER_CAMPAIGN)
    channel = override(pref("channel"), [
        (is_dealer_campaign & cpc.isin(list(RETAIL_DEALER_PRODUCTS)), "RDEALER"),
        (is_dealer_campaign & (cpc == FRANCHISE_DEALER_PRODUCT), "FDEALER"),
    ])
    product_type = case_when(
        [(cpc.isin(list(codes)), label) for codes, label in rules.product_labels]
        + [
            (cpc.isNull() & (entered < F.lit(rules.product_cutover)), rules.label_before_cutover),
            (cpc.isNull() & (entered >= F.lit(rules.product_cutover)), rules.label_after_cutover),
        ],
        "ERROR",
    )
    return j.select(
        "appl_id",
        entered.alias("dt_entered"),
        newer("dt_status").alias("dt_status"),
        newer("app_status").alias("app_status"),
        channel.alias("channel"),
        pref("category").alias("category"),
        newer("stc").alias("stc"),
        pref("queue").alias("queue"),
        pref("age_bucket").alias("age_bucket"),
        cpc.alias("adm_cpc"),
        product_type.alias("product_type"),
        pref("app_entry_method").alias("app_entry_method"),
        flag("cur_inst_cr", "IC", "NON_IC").alias("inst_cr"),
        newer("stc_bkdown").alias("stc_bkdown"),
    )


def run_daily_application_summary(inputs: Mapping[str, DataFrame], bd: BusinessDate, rules: SummaryRules,
                                  target: str, report_root: str, fmt: str = "csv",
                                  report_name: str = "daily_app_summary") -> tuple[str, int]:
    """Full-refresh job (CMP-10): replace ``target`` with today's summary, then export the
    written table under a dated name. Returns (report path, row count)."""
    from cardflow.sinks.tables import read_target, replace_table, write_report

    summary = daily_application_summary(inputs, bd, rules)
    replace_table(summary, target)
    written = read_target(summary.sparkSession, target)
    return write_report(written, report_root, report_name, bd, grain="day", fmt=fmt)
