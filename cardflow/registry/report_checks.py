"""Checked report jobs (RPT-1..RPT-5) and sinks (SNK-1..SNK-5, CMP-5, CMP-10) on driver data.

The oracles restate each job's SQL in DuckDB over the same derived inputs; they are written
from the original statements, not from our DataFrame code.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cardflow.plans.adjustment_transactions import ACCOUNTING_FUNCTIONS, adjustment_transactions
from cardflow.plans.application_summary import (SUMMARY_INPUTS, daily_application_summary,
                                                run_daily_application_summary)
from cardflow.plans.interest_adjustments import interest_adjustments_mtd
from cardflow.operators.membership import key_bitmap, unseen_rows
from cardflow.plans.new_flagged_accounts import HISTORY_COLUMNS, flagged_batch, flagged_delta, new_flagged_accounts
from cardflow.plans.plan_postings import plan_postings_mtd
from cardflow.registry import operator_checks  # noqa: F401  (registers the oracle of q_overlay)
from cardflow.registry.base import ORACLES, check
from cardflow.registry.driver_inputs import (BD_FLAGGED, BD_MTD, BD_SUMMARY, SUMMARY_RULES,
                                             input_cte, report_input, report_inputs)
from cardflow.functions.dates import BusinessDate, before_day
from cardflow.operators.joins import exclude_listed, overlay
from cardflow.operators.ranking import latest_per_key, pg_desc
from cardflow.operators.skew import hot_keys
from cardflow.operators.sorting import exported_positions
from cardflow.plans.summary_refresh import refresh_summary
from cardflow.session import scratch_path
from cardflow.sinks.load_log import LoadLog, load_once
from cardflow.sinks.tables import (append_returning, append_rows, export_with_manifest, load_new_keys, new_keys,
                                   read_target, replace_table, stamp_rows, verify_export, write_report)
from cardflow.sinks.versions import replace_version
from cardflow.sources.clustered import read_between, write_bucketed, write_clustered
from cardflow.sources.splits import split_points, split_predicates

# ---------------------------------------------------------------- RPT-3
RPT3_SQL = f"""
{input_cte(["txn_detail"])},
window_bounds AS (
  SELECT CAST(date_trunc('month', DATE '{BD_MTD.as_of}') AS TIMESTAMP) AS lo,
         CAST(DATE '{BD_MTD.as_of}' AS TIMESTAMP) AS hi)
SELECT lpad(CAST(t.acct_id AS VARCHAR), 11, '0') AS acct_id, t.acct_seq_num, t.txn_posted_dt, t.txn_dt,
       t.txn_trans_cd, t.merch_nm, t.txn_amt
FROM txn_detail t, window_bounds w
WHERE t.txn_posted_dt >= w.lo AND t.txn_posted_dt <= w.hi
  AND t.acct_seq_num = 0 AND t.txn_trans_cd = '0162'
  AND t.merch_nm IN ('EPP INTEREST ADJUST', 'AJUST INTÉRÊTS PPE')
"""


@check("q_rpt_interest_adjustments_mtd", RPT3_SQL)
def q_rpt_interest_adjustments_mtd(spark, sf_dir):
    return interest_adjustments_mtd(report_input(spark, sf_dir, "txn_detail"), BD_MTD)


# ---------------------------------------------------------------- RPT-2
@check("q_rpt_plan_postings_mtd", f"""
{input_cte(["plan_txn", "plan_code"])}
SELECT c.bt_desc AS epp_desc, lpad(CAST(t.acct_id AS VARCHAR), 11, '0') AS acct_id, t.acct_seq_num,
       t.txn_post_dt AS epp_posted_dt, t.txn_dt AS epp_txn_dt, t.txn_exp_dt AS epp_expiry_dt,
       t.txn_amt AS epp_txn_amt, t.pmt_rte AS monthly_epp_pymt_amt
FROM plan_txn t
JOIN (SELECT * FROM plan_code WHERE tcat_cd IN (2010, 2011)) c
  ON t.txn_lvl_proc_option_set_id = CAST(c.tlp_option_set AS VARCHAR)
 AND t.reasgned_txn_cat_cd = CAST(c.tcat_cd AS VARCHAR)
WHERE t.txn_post_dt >= DATE '{BD_MTD.month_start}' AND t.txn_post_dt < DATE '{BD_MTD.run_date}'
""")
def q_rpt_plan_postings_mtd(spark, sf_dir):
    i = report_inputs(spark, sf_dir, ["plan_txn", "plan_code"])
    return plan_postings_mtd(i["plan_txn"], i["plan_code"], BD_MTD)


# ---------------------------------------------------------------- RPT-4
_FUNC_LABELS = ", ".join(f"('{k}', '{v}')" for k, v in ACCOUNTING_FUNCTIONS.items())


@check("q_rpt_adjustment_transactions", f"""
{input_cte(["txn_master"])},
func_labels(code, label) AS (VALUES {_FUNC_LABELS})
SELECT lpad(CAST(m.acct_id AS VARCHAR), 11, '0') AS acct_id, m.acct_seq_num, m.txn_posted_dt, m.txn_dt,
       lpad(CAST(m.outpt_txn_intrnl_cd AS VARCHAR), 4, '0') AS trans_cd,
       coalesce(f.label, 'ERROR') AS acctg_func, m.merch_nm, m.txn_amt
FROM txn_master m
LEFT JOIN func_labels f ON f.code = m.acctg_func_cd
WHERE m.txn_src_cd = 'BO' AND m.acctg_func_cd IS NOT NULL AND m.acctg_func_cd <> 'PAY'
""")
def q_rpt_adjustment_transactions(spark, sf_dir):
    return adjustment_transactions(report_input(spark, sf_dir, "txn_master"))


# ---------------------------------------------------------------- RPT-1
_RPT1_INPUTS = ["account_snapshot", "flag_history", "account_master"]
_FLAGGED_CTE = f"""
flagged AS (
  SELECT s.acct_id, s.acct_seq_num, s.acct_open_dt, s.cpc, s.inst_credit AS cdf21,
         CAST(s.lastday_month AS DATE) AS data_bus_dt, DATE '{BD_FLAGGED.run_date}' AS data_load_dt
  FROM account_snapshot s
  LEFT JOIN (SELECT DISTINCT acct_id FROM flag_history) seen ON seen.acct_id = s.acct_id
  WHERE seen.acct_id IS NULL
    AND s.eff_dt_yymm = strftime(DATE '{BD_FLAGGED.as_of}', '%Y_%m')
    AND s.acct_seq_num = 0
    AND s.inst_credit IN ('IP', 'IC', 'VP', 'VC', 'VF'))"""

RPT1_SQL = f"""
{input_cte(_RPT1_INPUTS)},
{_FLAGGED_CTE},
master_then AS (
  SELECT * FROM account_master WHERE DATE '{BD_FLAGGED.as_of}' BETWEEN efftv_from_dt AND efftv_to_dt)
SELECT m.name, m.name_emboss, m.state_prov_code AS prov, m.zip_postal_code AS postal_code, f.cpc, f.cdf21,
       CAST(f.acct_open_dt AS DATE) AS acct_open_dt, lpad(CAST(f.acct_id AS VARCHAR), 11, '0') AS acct_id
FROM flagged f
LEFT JOIN master_then m ON m.acct_id = f.acct_id AND m.acct_seq_num = f.acct_seq_num
"""

DELTA_SQL = f"""
{input_cte(["account_snapshot", "flag_history"])},
{_FLAGGED_CTE}
SELECT * FROM flagged
"""


@check("q_rpt_new_flagged_accounts", RPT1_SQL)
def q_rpt_new_flagged_accounts(spark, sf_dir):
    i = report_inputs(spark, sf_dir, _RPT1_INPUTS)
    return new_flagged_accounts(i["account_snapshot"], i["flag_history"], i["account_master"], BD_FLAGGED)


@check("q_delta_rows", DELTA_SQL)
def q_delta_rows(spark, sf_dir):
    i = report_inputs(spark, sf_dir, ["account_snapshot", "flag_history"])
    return flagged_delta(i["account_snapshot"], i["flag_history"], BD_FLAGGED)


def _seeded_history(spark, sf_dir) -> str:
    """A fresh history table in the shared scratch folder, seeded from the derived history."""
    target = scratch_path(spark, "history", uuid.uuid4().hex)
    append_rows(report_input(spark, sf_dir, "flag_history"), target, HISTORY_COLUMNS)
    return target


@check("q_append_returning", DELTA_SQL)
def q_append_returning(spark, sf_dir):
    target = _seeded_history(spark, sf_dir)
    batch = flagged_batch(report_input(spark, sf_dir, "account_snapshot"), BD_FLAGGED)
    return load_new_keys(batch, target, ["acct_id"], HISTORY_COLUMNS, BD_FLAGGED.run_date)


@check("q_load_second_batch", DELTA_SQL)
def q_load_second_batch(spark, sf_dir):
    """Two batches of one load date: the second holds the first's keys and the unseen ones."""
    target = _seeded_history(spark, sf_dir)
    batch = flagged_batch(report_input(spark, sf_dir, "account_snapshot"), BD_FLAGGED)
    load_new_keys(batch.filter("acct_id < 1000"), target, ["acct_id"], HISTORY_COLUMNS, BD_FLAGGED.run_date)
    return load_new_keys(batch, target, ["acct_id"], HISTORY_COLUMNS, BD_FLAGGED.run_date)


@check("q_load_log", f"""
{input_cte(["account_snapshot", "flag_history"])},
{_FLAGGED_CTE},
marked AS (
  SELECT 'seed' AS load_id, * FROM flag_history
  UNION ALL
  SELECT CASE WHEN cpc = 'CPC1' THEN 'first' ELSE 'second' END, f.* FROM flagged f
  WHERE cpc = 'CPC1' OR acct_id NOT IN (SELECT acct_id FROM flagged WHERE cpc = 'CPC1'))
SELECT load_id, acct_id, acct_seq_num, acct_open_dt, cpc, cdf21, data_bus_dt, data_load_dt,
       CASE WHEN load_id = 'seed' THEN NULL ELSE count(*) OVER (PARTITION BY load_id) END AS logged_rows
FROM marked
""")
def q_load_log(spark, sf_dir):
    """Loads that crash half way, are replayed and are doubled: the history holds each load's rows once.

    The first batch (one product) crashes with its rows staged and not all of its files published; the next
    run recovers it. The second batch holds the first's rows too, comes twice, and once more under
    another id. Every row of the final history is shown with its load and the log's row count.
    """
    target = _seeded_history(spark, sf_dir)
    batch = flagged_batch(report_input(spark, sf_dir, "account_snapshot"), BD_FLAGGED)
    day, log = BD_FLAGGED.run_date, LoadLog(spark, target)
    first = new_keys(batch.filter("cpc = 'CPC1'"), read_target(spark, target), ["acct_id"])
    log.stage(stamp_rows(first, day).select(*HISTORY_COLUMNS).repartition(3), "first", day)
    log.publish("first", most=1)  # the crash
    for load_id in ("first", "second", "second", "third"):
        load_once(batch, target, ["acct_id"], HISTORY_COLUMNS, day, load_id)
    rows = spark.createDataFrame([(k, v.rows) for k, v in log.loads().items()], "load_id string, logged_rows long")
    load = F.regexp_extract(F.col("_metadata.file_name"), "^load-([a-z]+)-", 1)
    history = read_target(spark, target).select(F.when(load == "", "seed").otherwise(load).alias("load_id"), *HISTORY_COLUMNS)
    return history.join(F.broadcast(rows), "load_id", "left")


@check("q_load_returned", DELTA_SQL)
def q_load_returned(spark, sf_dir):
    """The rows that a load hands on, from its second, doubled run."""
    target = _seeded_history(spark, sf_dir)
    batch = flagged_batch(report_input(spark, sf_dir, "account_snapshot"), BD_FLAGGED)
    load_once(batch, target, ["acct_id"], HISTORY_COLUMNS, BD_FLAGGED.run_date)
    return load_once(batch, target, ["acct_id"], HISTORY_COLUMNS, BD_FLAGGED.run_date)


@check("q_unseen_keys", DELTA_SQL)
def q_unseen_keys(spark, sf_dir):
    """JON-7 behind a stored bitmap of the history's keys: only rows it can't tell are joined."""
    history = report_input(spark, sf_dir, "flag_history")
    batch = flagged_batch(report_input(spark, sf_dir, "account_snapshot"), BD_FLAGGED)
    fresh = unseen_rows(batch, history, ["acct_id"], key_bitmap(history, ["acct_id"]))
    return stamp_rows(fresh, BD_FLAGGED.run_date).select(*HISTORY_COLUMNS)


@check("q_append_rows_returned", DELTA_SQL)
def q_append_rows_returned(spark, sf_dir):
    """SNK-2: the appended rows themselves, handed on after the append."""
    target = _seeded_history(spark, sf_dir)
    delta = flagged_delta(report_input(spark, sf_dir, "account_snapshot"), read_target(spark, target), BD_FLAGGED)
    return append_returning(delta, target, HISTORY_COLUMNS)


@check("q_replace_self_read", RPT3_SQL)
def q_replace_self_read(spark, sf_dir):
    """A replace whose plan reads the target, spelled in another way."""
    folder = scratch_path(spark, "replaced", uuid.uuid4().hex)
    replace_table(q_rpt_interest_adjustments_mtd(spark, sf_dir), f"{folder}/t")
    replace_table(read_target(spark, f"{folder}/t"), f"{folder}/./t")
    return read_target(spark, f"{folder}/t")


@check("q_replace_table", RPT3_SQL)
def q_replace_table(spark, sf_dir):
    target = scratch_path(spark, "replaced", uuid.uuid4().hex)
    report = q_rpt_interest_adjustments_mtd(spark, sf_dir)
    replace_table(report, target)
    replace_table(report, target)
    return read_target(spark, target)


@check("q_report_export", RPT3_SQL)
def q_report_export(spark, sf_dir):
    root = scratch_path(spark, "reports", uuid.uuid4().hex)
    path, rows = write_report(q_rpt_interest_adjustments_mtd(spark, sf_dir), root, "interest_adjustments",
                              BD_MTD, grain="month", fmt="parquet")
    return spark.read.parquet(path)


@check("q_report_export_csv", """
SELECT '  ' || c_name || ' ' AS padded, c_custkey, CASE WHEN c_nationkey < 12 THEN '   ' ELSE 'x' END AS blank
FROM customer
""")
def q_report_export_csv(spark, sf_dir):
    """The default export keeps blanks at either end of a text."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("padded"), "c_custkey",
        F.when(F.col("c_nationkey") < 12, "   ").otherwise("x").alias("blank"))
    path, _ = write_report(customer, scratch_path(spark, "reports", uuid.uuid4().hex), "padded", BD_MTD)
    return spark.read.option("header", True).schema(customer.schema).csv(path)


# ---------------------------------------------------------------- RPT-5
def _summary_sql() -> str:
    """The summary in DuckDB, written independently of the DataFrame code: blank-to-NULL values
    are computed once per source, labels come from lookup tables, the current source is ranked
    over the full fan-out of its joins, and the final rows are deduplicated at the end."""
    r, bd = SUMMARY_RULES, BD_SUMMARY
    as_of = f"DATE '{bd.as_of}'"
    care_lo, care_hi = r.care_window
    product_rows = ", ".join(f"('{c}', '{label}')" for codes, label in r.product_labels for c in codes)

    def valid(t: str) -> str:
        return f"{as_of} BETWEEN {t}.efftv_from_dt AND {t}.efftv_to_dt"

    def overlay(field: str) -> str:
        return (f"CASE WHEN cur_first THEN coalesce(c_{field}, l_{field}) "
                f"ELSE coalesce(l_{field}, c_{field}) END")

    return f"""
{input_cte(SUMMARY_INPUTS)},
status_labels(code, label) AS (VALUES ('NEWACCOUNT', 'APPROVED'), ('DECLINE', 'DECLINED'),
    ('NORESPONSE', 'DECLINED'), ('REJECTOFFR', 'REJECT OFFER'), ('VOID APP', 'VOID APP'),
    ('WITHDRAW', 'WITHDRAW APP')),
age_labels(code, label) AS (VALUES ('A', '30+ DAYS'), ('B', '21 - 30 DAYS'), ('C', '16 - 20 DAYS'),
    ('D', '11 - 15 DAYS'), ('E', '6 - 10 DAYS'), ('F', 'DAY 5'), ('G', 'DAY 4'), ('H', 'DAY 3'), ('I', 'DAY 2'),
    ('J', 'DAY 1'), ('K', 'DAY 0')),
income_codes(code, product) AS (VALUES ('INCOMEWEN', 'WEN'), ('INCOMERCB', 'RCB')),
product_labels(code, label) AS (VALUES {product_rows}),
app_days AS (
    SELECT app_num AS id, CAST(dt_entered AS DATE) AS entered_day FROM legacy_app
    UNION
    SELECT appl_id, CAST(entry_dt AS DATE) FROM app WHERE nullif(trim(appl_strgy_cd), '') <> '{r.excluded_strategy}'
),
legacy_norm AS (
    SELECT app_num AS id, CAST(dt_entered AS DATE) AS entered_day, CAST(dt_status AS DATE) AS status_day,
           nullif(trim(status_field), '') AS stc, nullif(trim(acct_cust_data_81), '') AS ch,
           nullif(trim(data_entry_officer), '') AS officer, nullif(trim(user_20_byte_9), '') AS addr,
           nullif(trim(user_75_byte_1), '') AS mail, nullif(trim(acct_cust_data_60), '') AS cat,
           nullif(trim(af_queue_id), '') AS queue, age_bucket AS age_code,
           nullif(trim(client_product_cd), '') AS own_cpc, nullif(trim(acct_cust_data_62), '') AS campaign,
           nullif(trim(user_1_byte_12), '') AS entry
    FROM legacy_app
    WHERE nullif(trim(test_app_sw), '') IS NULL OR nullif(trim(test_acct_flag), '') IS NULL
),
legacy_joined AS (
    SELECT n.*, o.ovr_cpc, i.income_value
    FROM legacy_norm n
    LEFT JOIN (SELECT app_num AS id, nullif(trim(alpha_value), '') AS income_value FROM legacy_element
               WHERE nullif(trim(element_name), '') = 'CHKINCOME') i ON i.id = n.id
    LEFT JOIN (SELECT app_num AS id, nullif(trim(client_prod_code), '') AS ovr_cpc FROM legacy_override
               WHERE ts2_account_id > 0) o ON o.id = n.id
),
legacy AS (
    SELECT j.id, j.entered_day, j.status_day, coalesce(sl.label, 'PENDING') AS app_status,
           CASE WHEN j.ch IS NULL AND j.officer IS NOT NULL THEN 'OTHER'
                WHEN j.ch = 'TCALLCEN' AND j.entered_day BETWEEN DATE '{care_lo}' AND DATE '{care_hi}'
                     AND j.addr = '{r.care_address}' THEN 'CARE'
                WHEN j.ch = 'TCALLCEN' AND j.entered_day BETWEEN DATE '{care_lo}' AND DATE '{care_hi}'
                     AND starts_with(j.addr, '{r.cis_address_prefix}') THEN 'CIS'
                WHEN j.ch IN ('RCORRETL', 'RDEALER', 'FCORRETL', 'FDEALER')
                     AND contains(j.mail, '{r.intercept_mail_fragment}') THEN 'INTERCEP'
                WHEN j.ch IN ('TCALLCEN', 'TMS') THEN 'TCALLCEN'
                WHEN j.ch IS NULL AND j.officer IS NULL THEN 'ERROR'
                ELSE j.ch END AS channel,
           CASE WHEN j.cat IS NULL THEN 'BLANK APPLICATIONS'
                WHEN left(j.cat, 1) = '3' THEN 'EMPLOYEE PROGRAM'
                WHEN left(j.cat, 1) IN ('0', '1', '2', '4', '5', '7', '8', '9') THEN 'PREAPPROVED'
                ELSE 'ERROR' END AS category,
           j.stc, j.queue, al.label AS age_bucket,
           coalesce(j.ovr_cpc, ic.product, j.own_cpc) AS adm_cpc, j.campaign AS cpgn_src_cd,
           CASE WHEN j.entry IS NULL OR j.entry = 'I' THEN 'INST_APP' WHEN j.entry = 'A' THEN 'ASTRUM'
                WHEN j.entry = 'D' THEN 'DE_WEB' ELSE 'ERROR' END AS app_entry_method,
           CASE WHEN j.stc IS NULL THEN 'DECLINED_OTHER'
                WHEN j.stc = 'NEWACCOUNT' THEN 'APPROVED'
                WHEN sl.code IS NULL THEN 'PENDING'
                WHEN j.queue IN ('DECSIN', 'DECLBUR', 'DECPABUR') THEN 'DECLINED_CREDIT'
                ELSE 'DECLINED_OTHER' END AS stc_bkdown
    FROM legacy_joined j
    LEFT JOIN status_labels sl ON sl.code = j.stc
    LEFT JOIN age_labels al ON al.code = j.age_code
    LEFT JOIN income_codes ic ON ic.code = j.income_value
),
current_fanout AS (
    SELECT a.appl_id AS id, a.entry_dt, a.curr_stat_dt, a.appl_stat_cd, a.acqsn_channel_cd, a.appl_queue_id,
           a.appl_age_bucket, b.data_entry_off_num, de.ele_alph_val, e.user_1_byte_12, f.clnt_prod_cd AS xfer_cpc,
           x.custom_21_data, g.custom_data_60, g.custom_data_62, g.clnt_prod_cd AS acct_cpc,
           row_number() OVER (PARTITION BY a.appl_id
               ORDER BY a.curr_stat_dt DESC NULLS FIRST, a.efftv_from_dt DESC NULLS FIRST,
                        a.entry_dt, a.appl_stat_cd, a.acqsn_channel_cd, a.appl_queue_id, a.appl_age_bucket,
                        b.data_entry_off_num, de.ele_alph_val, e.user_1_byte_12, f.clnt_prod_cd, f.acct_id,
                        x.custom_21_data, g.custom_data_60, g.custom_data_62, g.clnt_prod_cd) AS pick
    FROM (SELECT * FROM app a WHERE {valid("a")}) a
    LEFT JOIN (SELECT * FROM app_decision b WHERE {valid("b")}) b ON b.appl_id = a.appl_id
    LEFT JOIN (SELECT * FROM app_element de WHERE {valid("de")}
               AND nullif(trim(ele_elmt_nm), '') = 'CHKINCOME') de ON de.appl_id = a.appl_id
    LEFT JOIN (SELECT * FROM app_user_data e WHERE {valid("e")}) e ON e.appl_id = a.appl_id
    LEFT JOIN (SELECT * FROM app_transfer f WHERE {valid("f")} AND acct_id > 0) f ON f.appl_id = a.appl_id
    LEFT JOIN (SELECT * FROM app_account g WHERE {valid("g")}) g ON g.appl_id = a.appl_id
    LEFT JOIN (SELECT * FROM account_custom x WHERE {valid("x")} AND acct_seq_num = 0
               AND custom_21_data IN ('EI', 'IC', 'IP', 'VC', 'VF', 'VP')) x ON x.acct_id = f.acct_id
),
current_norm AS (
    SELECT id, CAST(entry_dt AS DATE) AS entered_day, CAST(curr_stat_dt AS DATE) AS status_day,
           nullif(trim(appl_stat_cd), '') AS stc, nullif(trim(acqsn_channel_cd), '') AS ch,
           nullif(trim(data_entry_off_num), '') AS officer, appl_queue_id AS queue,
           nullif(trim(appl_queue_id), '') AS queue_norm, appl_age_bucket AS age_code,
           nullif(trim(custom_data_60), '') AS cat, nullif(trim(custom_data_62), '') AS campaign,
           coalesce(nullif(trim(xfer_cpc), ''), ic.product, nullif(trim(acct_cpc), '')) AS adm_cpc,
           user_1_byte_12 AS entry, custom_21_data
    FROM current_fanout
    LEFT JOIN income_codes ic ON ic.code = nullif(trim(ele_alph_val), '')
    WHERE pick = 1
),
"current" AS (
    SELECT n.id, n.entered_day, n.status_day, coalesce(sl.label, 'PENDING') AS app_status,
           CASE WHEN n.ch IS NULL AND n.officer IS NOT NULL THEN 'OTHER'
                WHEN n.ch IN ('TCALLCEN', 'TMS') THEN 'TCALLCEN'
                ELSE n.ch END AS channel,
           CASE WHEN n.cat IS NULL THEN 'BLANK APPLICATIONS'
                WHEN left(n.cat, 1) = '3' THEN 'EMPLOYEE PROGRAM'
                WHEN left(n.cat, 1) IN ('0', '1', '2', '4', '5', '7', '8', '9') THEN 'PREAPPROVED'
                ELSE 'ERROR' END AS category,
           n.stc, n.queue, al.label AS age_bucket, n.adm_cpc, n.campaign AS cpgn_src_cd,
           CASE WHEN n.entry IS NULL OR n.entry = 'I' THEN 'INST_APP' WHEN n.entry = 'A' THEN 'ASTRUM'
                WHEN n.entry = 'D' THEN 'DE_WEB' ELSE 'ERROR' END AS app_entry_method,
           n.custom_21_data AS inst_code,
           CASE WHEN n.stc IS NULL THEN 'DECLINED_OTHER'
                WHEN n.stc = 'NEWACCOUNT' THEN 'APPROVED'
                WHEN sl.code IS NULL THEN 'PENDING'
                WHEN n.queue_norm IN ('DECSIN', 'DECLBUR', 'DECPABUR') THEN 'DECLINED_CREDIT'
                ELSE 'DECLINED_OTHER' END AS stc_bkdown
    FROM current_norm n
    LEFT JOIN status_labels sl ON sl.code = n.stc
    LEFT JOIN age_labels al ON al.code = n.age_code
),
paired AS (
    SELECT s.id,
           l.entered_day AS l_entered_day, c.entered_day AS c_entered_day,
           l.status_day AS l_status_day, c.status_day AS c_status_day,
           l.app_status AS l_app_status, c.app_status AS c_app_status,
           l.channel AS l_channel, c.channel AS c_channel,
           l.category AS l_category, c.category AS c_category,
           l.stc AS l_stc, c.stc AS c_stc,
           l.queue AS l_queue, c.queue AS c_queue,
           l.age_bucket AS l_age_bucket, c.age_bucket AS c_age_bucket,
           l.adm_cpc AS l_adm_cpc, c.adm_cpc AS c_adm_cpc,
           l.cpgn_src_cd AS l_cpgn_src_cd, c.cpgn_src_cd AS c_cpgn_src_cd,
           l.app_entry_method AS l_app_entry_method, c.app_entry_method AS c_app_entry_method,
           l.stc_bkdown AS l_stc_bkdown, c.stc_bkdown AS c_stc_bkdown,
           c.inst_code,
           coalesce(c.status_day, DATE '1900-01-01') >= coalesce(l.status_day, DATE '1900-01-01') AS cur_first
    FROM (SELECT DISTINCT id FROM app_days
          WHERE entered_day < DATE '{bd.run_date}' AND id NOT IN (SELECT app_num FROM excluded_app)) s
    LEFT JOIN legacy l ON l.id = s.id
    LEFT JOIN "current" c ON c.id = s.id
),
merged AS (
    SELECT id AS appl_id,
           coalesce(c_entered_day, l_entered_day) AS dt_entered,
           coalesce(c_channel, l_channel) AS raw_channel,
           coalesce(c_cpgn_src_cd, l_cpgn_src_cd) AS campaign,
           coalesce(c_adm_cpc, l_adm_cpc) AS adm_cpc,
           {overlay("status_day")} AS dt_status,
           {overlay("app_status")} AS app_status,
           {overlay("stc")} AS stc,
           {overlay("stc_bkdown")} AS stc_bkdown,
           coalesce(c_category, l_category) AS category,
           coalesce(c_queue, l_queue) AS queue,
           coalesce(c_age_bucket, l_age_bucket) AS age_bucket,
           coalesce(c_app_entry_method, l_app_entry_method) AS app_entry_method,
           inst_code
    FROM paired
)
SELECT DISTINCT m.appl_id, m.dt_entered, m.dt_status, m.app_status,
       CASE WHEN m.raw_channel = 'INTERNET' AND m.campaign = 'IDVPMO' AND m.adm_cpc IN ('WEN', 'RCB', 'CCA')
                 THEN 'RDEALER'
            WHEN m.raw_channel = 'INTERNET' AND m.campaign = 'IDVPMO' AND m.adm_cpc = 'FCB' THEN 'FDEALER'
            ELSE m.raw_channel END AS channel,
       m.category, m.stc, m.queue, m.age_bucket, m.adm_cpc,
       CASE WHEN m.adm_cpc IS NOT NULL THEN coalesce(pl.label, 'ERROR')
            WHEN m.dt_entered < DATE '{r.product_cutover}' THEN '{r.label_before_cutover}'
            WHEN m.dt_entered >= DATE '{r.product_cutover}' THEN '{r.label_after_cutover}'
            ELSE 'ERROR' END AS product_type,
       m.app_entry_method,
       CASE WHEN m.inst_code IS NULL THEN 'NON_IC' ELSE 'IC' END AS inst_cr,
       m.stc_bkdown
FROM merged m
LEFT JOIN product_labels pl ON pl.code = m.adm_cpc
"""


SUMMARY_SQL = _summary_sql()


def summary_inputs(spark, sf_dir):
    return report_inputs(spark, sf_dir, SUMMARY_INPUTS)


@check("q_rpt_daily_application_summary", SUMMARY_SQL)
def q_rpt_daily_application_summary(spark, sf_dir):
    return daily_application_summary(summary_inputs(spark, sf_dir), BD_SUMMARY, SUMMARY_RULES)


@check("q_refresh_summary", SUMMARY_SQL)
def q_refresh_summary(spark, sf_dir):
    """CMP-10: replace the summary table, export it with a dated name, read the export back."""
    base = scratch_path(spark, "summary", uuid.uuid4().hex)
    path, _ = run_daily_application_summary(summary_inputs(spark, sf_dir), BD_SUMMARY, SUMMARY_RULES,
                                            f"{base}/table", f"{base}/reports", fmt="parquet")
    return spark.read.parquet(path)


@check("q_refresh_changed", SUMMARY_SQL)
def q_refresh_changed(spark, sf_dir):
    """CMP-10 by changed ids: the summary of the day before, on inputs that have changed since (rows gone,
    come and altered in seven of the eleven), brought up to date. Equals the full refresh."""
    target = scratch_path(spark, "refreshed", uuid.uuid4().hex)
    today = summary_inputs(spark, sf_dir)
    refresh_summary(day_before(today), BusinessDate(BD_SUMMARY.as_of), SUMMARY_RULES, target)
    return refresh_summary(today, BD_SUMMARY, SUMMARY_RULES, target)


def day_before(inputs):
    """The inputs as they might have been a day earlier."""
    before = dict(inputs)
    before["legacy_app"] = inputs["legacy_app"].withColumn(
        "status_field", F.when(F.col("dt_status") >= "1998-07-01", "INREVIEW").otherwise(F.col("status_field")))
    before["legacy_override"] = inputs["legacy_override"].filter("not client_prod_code <=> 'TEC'")
    before["app"] = inputs["app"].filter("entry_dt < timestamp'1998-07-20 00:00:00'")
    before["app_user_data"] = inputs["app_user_data"].withColumn(
        "user_1_byte_12", F.when(F.col("user_1_byte_12") == "I", "A").otherwise(F.col("user_1_byte_12")))
    before["app_account"] = inputs["app_account"].filter("not custom_data_60 <=> 'X9'")
    before["account_custom"] = inputs["account_custom"].withColumn(
        "custom_21_data", F.when(F.col("custom_21_data") == "IC", F.lit(None)).otherwise(F.col("custom_21_data")))
    before["excluded_app"] = inputs["excluded_app"].filter(F.lit(False))
    return before


@check("q_replace_versions", RPT3_SQL)
def q_replace_versions(spark, sf_dir):
    """Replaces of a versioned folder, the last one from a plan that reads it."""
    target = scratch_path(spark, "versions", uuid.uuid4().hex)
    report = q_rpt_interest_adjustments_mtd(spark, sf_dir)
    replace_version(report.filter(F.lit(False)), target)
    replace_version(report, target)
    replace_version(read_target(spark, target), target)
    return read_target(spark, target)


_SORTED_SQL = f"""
{input_cte(["plan_txn", "plan_code", "txn_detail", "txn_master"])},
postings AS (
  SELECT strftime(t.txn_post_dt, '%Y-%m-%d %H:%M:%S') AS k1, lpad(CAST(t.acct_id AS VARCHAR), 11, '0') AS k2, '' AS k3,
         ROW_NUMBER() OVER (ORDER BY t.txn_post_dt NULLS LAST, t.txn_lvl_proc_option_set_id NULLS LAST, t.acct_id NULLS LAST) AS position
  FROM plan_txn t
  JOIN plan_code c ON t.txn_lvl_proc_option_set_id = CAST(c.tlp_option_set AS VARCHAR)
   AND t.reasgned_txn_cat_cd = CAST(c.tcat_cd AS VARCHAR) AND c.tcat_cd IN (2010, 2011)
  WHERE t.txn_post_dt >= DATE '{BD_MTD.month_start}' AND t.txn_post_dt < DATE '{BD_MTD.run_date}'),
interest AS (
  SELECT strftime(txn_posted_dt, '%Y-%m-%d %H:%M:%S') AS k1, acct_id AS k2, '' AS k3,
         ROW_NUMBER() OVER (ORDER BY txn_posted_dt NULLS LAST, acct_id NULLS LAST) AS position
  FROM (SELECT txn_posted_dt, lpad(CAST(acct_id AS VARCHAR), 11, '0') AS acct_id FROM txn_detail
        WHERE txn_posted_dt >= DATE '{BD_MTD.month_start}' AND txn_posted_dt <= DATE '{BD_MTD.as_of}'
          AND acct_seq_num = 0 AND txn_trans_cd = '0162' AND merch_nm IN ('EPP INTEREST ADJUST', 'AJUST INTÉRÊTS PPE')) x),
adjustments AS (
  SELECT acct_id AS k1, CAST(acct_seq_num AS VARCHAR) AS k2, CAST(txn_posted_dt AS VARCHAR) AS k3,
         ROW_NUMBER() OVER (ORDER BY acct_id, acct_seq_num, txn_posted_dt, tm_posted_seq_num) AS position
  FROM (SELECT *, lpad(CAST(acct_id AS VARCHAR), 11, '0') AS padded FROM txn_master
        WHERE txn_src_cd = 'BO' AND acctg_func_cd IS NOT NULL AND acctg_func_cd <> 'PAY') m(
          raw_id, acct_seq_num, txn_posted_dt, txn_dt, outpt_txn_intrnl_cd, acctg_func_cd, merch_nm, db_cr_cd, txn_amt,
          txn_src_cd, tm_posted_seq_num, acct_id))
SELECT 'plan_postings' AS report, * FROM postings
UNION ALL SELECT 'interest_adjustments', * FROM interest
UNION ALL SELECT 'adjustment_transactions', * FROM adjustments
"""


@check("q_sorted_positions", _SORTED_SQL)
def q_sorted_positions(spark, sf_dir):
    """SRT-1..3: three exports, each row with its place in the order of the written files. Sort keys only, so
    that rows tied on them are alike."""
    root, stamp = scratch_path(spark, "reports", uuid.uuid4().hex), "yyyy-MM-dd HH:mm:ss"
    reports = {
        "plan_postings": (q_rpt_plan_postings_mtd(spark, sf_dir), "month", [
            F.date_format("epp_posted_dt", stamp), F.col("acct_id"), F.lit("")]),
        "interest_adjustments": (q_rpt_interest_adjustments_mtd(spark, sf_dir), "month", [
            F.date_format("txn_posted_dt", stamp), F.col("acct_id"), F.lit("")]),
        "adjustment_transactions": (q_rpt_adjustment_transactions(spark, sf_dir), "day", [
            F.col("acct_id"), F.col("acct_seq_num").cast("string"), F.col("txn_posted_dt").cast("string")])}
    out = None
    for name, (report, grain, keys) in reports.items():
        path, _ = write_report(report, root, name, BD_MTD, grain, "parquet")
        places = exported_positions(spark, path).select(
            F.lit(name).alias("report"), *[k.alias(f"k{n}") for n, k in enumerate(keys, 1)], "position")
        out = places if out is None else out.unionByName(places)
    return out


@check("q_export_manifest", f"""
WITH exported AS ({RPT3_SQL})
SELECT 'interest_adjustments_{BD_MTD.as_of:%Y%m}' AS name, count(*) AS row_count, CAST(sum(txn_amt) AS DECIMAL(28,2)) AS txn_amt,
       count(DISTINCT acct_id) AS accounts, true AS verified
FROM exported
UNION ALL
SELECT 'interest_adjustments_{BD_MTD.run_date:%Y%m%d}', count(*), CAST(sum(txn_amt) AS DECIMAL(28,2)), count(DISTINCT acct_id), true
FROM exported
""")
def q_export_manifest(spark, sf_dir):
    """SNK-4, SNK-5, FN-12: monthly Parquet and daily CSV exports, their dated names and counts from the manifest, and
    whether the rows read back are those of the manifest."""
    root, report = scratch_path(spark, "reports", uuid.uuid4().hex), q_rpt_interest_adjustments_mtd(spark, sf_dir)
    out = None
    for grain, fmt in (("month", "parquet"), ("day", "csv")):
        path, manifest = export_with_manifest(report, root, "interest_adjustments", BD_MTD, grain, fmt)
        verified = verify_export(spark, path, report.schema, fmt) == manifest
        reader = spark.read.schema(report.schema)
        back = reader.option("header", True).csv(path) if fmt == "csv" else reader.parquet(path)
        row = back.agg(F.sum("txn_amt").alias("txn_amt"), F.countDistinct("acct_id").alias("accounts")).select(
            F.lit(manifest.name).alias("name"), F.lit(manifest.rows).cast("long").alias("row_count"), "txn_amt", "accounts",
            F.lit(verified).alias("verified"))
        out = row if out is None else out.unionByName(row)
    return out


@check("q_heavy_keys", """
WITH held AS (SELECT l_returnflag AS code, count(*) AS n FROM lineitem GROUP BY 1)
SELECT code FROM held WHERE n > greatest(10, ceil((SELECT sum(n) FROM held) / 3.0))
""")
def q_heavy_keys(spark, sf_dir):
    """Keys with more than a third of the rows, by bucket counts first."""
    codes = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_returnflag").alias("code"))
    found = hot_keys(codes, ["code"], max_keys=3, min_rows=10)
    return codes.filter(F.lit(False)) if found is None else found


@check("q_not_in_empty", "SELECT c_custkey, c_nationkey FROM customer")
def q_not_in_empty(spark, sf_dir):
    """JON-8 with an empty listing: every row stays."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    listing = spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_totalprice < 0").select("o_custkey")
    return exclude_listed(customer, "c_custkey", listing, "o_custkey")


@check("q_today", """
SELECT strftime(current_date, '%Y%m%d') AS day_stamp, strftime(current_date - 1, '%Y_%m') AS month_key,
       count(*) FILTER (WHERE o_orderdate < current_date) AS before_today, count(*) AS orders
FROM orders
""")
def q_today(spark, sf_dir):
    """FN-9: dates derived from the day the job runs."""
    bd = BusinessDate.today()
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.agg(F.count_if(before_day("o_orderdate", bd.run_date)).alias("before_today"), F.count(F.lit(1)).alias("orders")).select(
        F.lit(bd.stamp("day")).alias("day_stamp"), F.lit(bd.month_key).alias("month_key"), "before_today", "orders")


@check("q_planned_reads", """
SELECT count(*) AS row_count, CAST(sum(l_partkey) AS BIGINT) AS partkeys, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS price,
       true AS even FROM lineitem
""")
def q_planned_reads(spark, sf_dir):
    """SRC-4: sixteen planned reads of a table give each row once, none with more than twice its share."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    predicates = split_predicates("l_orderkey", split_points(lineitem, "l_orderkey", 16))
    out = None
    for k, predicate in enumerate(predicates):
        part = lineitem.filter(predicate).select(F.lit(k).alias("part"), "l_partkey",
                                                 F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
        out = part if out is None else out.union(part)
    parts = out.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("keys"), F.sum("price").alias("price"))
    return parts.agg(F.sum("n").alias("row_count"), F.sum("keys").alias("partkeys"), F.sum("price").alias("price"),
                     (F.max("n") * 16 <= 2 * F.sum("n")).alias("even"))


@check("q_clustered_month", RPT3_SQL)
def q_clustered_month(spark, sf_dir):
    """SRC-1, FLT-5: the month-to-date report from a table clustered by posting time."""
    path = scratch_path(spark, "clustered", uuid.uuid4().hex)
    write_clustered(report_input(spark, sf_dir, "txn_detail"), path, "txn_posted_dt", 32)
    month = read_between(spark, path, "txn_posted_dt", BD_MTD.month_start, BD_MTD.as_of)
    return interest_adjustments_mtd(month, BD_MTD)


@check("q_overlay_bucketed", ORACLES["q_overlay"])
def q_overlay_bucketed(spark, sf_dir):
    """JON-10, JON-9 on tables bucketed and sorted by the order key: no exchange below the joins."""
    base, key, buckets = scratch_path(spark, "bucketed", uuid.uuid4().hex), ["o_orderkey"], 16
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumnRenamed("l_orderkey", "o_orderkey")
    spine = write_bucketed(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey"), f"{base}/spine", key, buckets)
    lines = write_bucketed(items.select("o_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_returnflag"),
                           f"{base}/lines", key, buckets)
    primary = latest_per_key(lines.filter("l_returnflag = 'R'"), key, [
        pg_desc("l_shipdate"), pg_desc("l_linenumber"), pg_desc("l_partkey"), pg_desc("l_suppkey")]).select(
        "o_orderkey", F.col("l_partkey").alias("p_part"))
    secondary = lines.select("o_orderkey", F.col("l_partkey").alias("s_part"))
    return overlay(spine, primary, secondary, key).select(
        "o_orderkey", "p_part", "s_part", F.coalesce("p_part", "s_part").alias("part_pick"))
