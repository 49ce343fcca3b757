"""Report inputs derived from the driver tables.

Each report reads tables shaped like its production inputs. For the checks they are derived
from the TPC-H-like driver tables by SQL written in the subset that Spark SQL and DuckDB read
alike; Spark runs it over the parquet DataFrames (``{table}`` placeholders bound to DataFrames),
DuckDB over its views. Every derivation reads whole tables, so the work grows with the data. NULLs, blanks, space padding, validity intervals and fan-out come from CASE
rules on values.
"""

from __future__ import annotations

import datetime as dt
import re
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from cardflow.functions.dates import BusinessDate
from cardflow.plans.adjustment_transactions import ACCOUNTING_FUNCTIONS
from cardflow.plans.application_summary import SummaryRules
from cardflow.sources.tables import read_table

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Business dates used by the checks.
BD_FLAGGED = BusinessDate(dt.date(1998, 7, 1))      # month key 1998_06, as-of 1998-06-30
BD_MTD = BusinessDate(dt.date(1998, 6, 16))         # month to date 1998-06-01 .. 1998-06-15
BD_SUMMARY = BusinessDate(dt.date(2000, 7, 1))      # as-of 2000-06-30

# Invented site rules for the summary check (not the production values).
SUMMARY_RULES = SummaryRules(
    excluded_strategy="EXCL",
    care_window=(dt.date(1997, 3, 4), dt.date(1997, 3, 19)),
    care_address="10.1.2.3",
    cis_address_prefix="10.9.8.",
    intercept_mail_fragment="@partner.",
    product_labels=((("CON",), "CONNECT"), (("FCB",), "FRANCHISE"), (("WEN",), "ELITE"),
                    (("TEC",), "EXPENSE"), (("RCB", "CCA"), "PLATINUM")),
    product_cutover=dt.date(1998, 8, 1),
    label_before_cutover="STARTER",
    label_after_cutover="PLATINUM",
)

# 31 known codes, an unknown one, a NULL and PAY, then a few repeats: one per index 0..41.
_FUNC_CODES = list(ACCOUNTING_FUNCTIONS) + ["ZZZ", None, "PAY", "DBT", "CRT", "PAY", "CBD", "ZZZ", "MSC", "PRN", "CAR"]


def _func_code_values() -> str:
    rows = ", ".join(f"({i}, {'CAST(NULL AS STRING)' if c is None else repr(c)})" for i, c in enumerate(_FUNC_CODES))
    return f"(VALUES {rows}) AS func_codes(func_idx, func_cd)"


INPUT_SQL: dict[str, str] = {
    # RPT-3
    "txn_detail": """
SELECT l_orderkey AS acct_id,
       CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS acct_seq_num,
       CASE l_linenumber WHEN 1 THEN l_shipdate WHEN 2 THEN l_shipdate + INTERVAL 10 HOUR
            WHEN 3 THEN l_shipdate + INTERVAL 23 HOUR ELSE l_shipdate END AS txn_posted_dt,
       CAST(l_shipdate AS DATE) - 2 AS txn_dt,
       CASE l_returnflag WHEN 'R' THEN '0162' WHEN 'A' THEN '162' ELSE '0100' END AS txn_trans_cd,
       CASE WHEN l_quantity < 20 THEN 'EPP INTEREST ADJUST' WHEN l_quantity < 40 THEN 'AJUST INTÉRÊTS PPE'
            ELSE 'EPP OTHER' END AS merch_nm,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS txn_amt
FROM {lineitem}""",
    # RPT-2
    "plan_txn": """
SELECT l_orderkey AS acct_id,
       l_linenumber - 1 AS acct_seq_num,
       CASE WHEN l_linenumber <= 2 THEN l_shipdate ELSE l_shipdate + INTERVAL 23 HOUR END AS txn_post_dt,
       CAST(l_shipdate AS DATE) - 1 AS txn_dt,
       CAST(l_shipdate AS DATE) + 365 AS txn_exp_dt,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS txn_amt,
       CAST(l_quantity AS DECIMAL(18,2)) AS pmt_rte,
       CAST(l_suppkey AS STRING) AS txn_lvl_proc_option_set_id,
       CASE l_returnflag WHEN 'A' THEN '2010' WHEN 'N' THEN '2011' ELSE '2012' END AS reasgned_txn_cat_cd
FROM {lineitem}""",
    "plan_code": """
SELECT 'PLAN ' || s_name AS bt_desc,
       CAST(s_suppkey AS INT) AS tlp_option_set,
       CASE WHEN s_acctbal < 0 THEN 2012 WHEN s_nationkey < 12 THEN 2010 ELSE 2011 END AS tcat_cd
FROM {supplier}""",
    # RPT-4
    "txn_master": f"""
SELECT l_orderkey AS acct_id,
       l_linenumber AS acct_seq_num,
       CAST(l_shipdate AS DATE) AS txn_posted_dt,
       CAST(l_shipdate AS DATE) - 2 AS txn_dt,
       CAST(l_partkey AS INT) AS outpt_txn_intrnl_cd,
       func_cd AS acctg_func_cd,
       'MERCHANT ' || CAST(l_suppkey AS STRING) AS merch_nm,
       CASE WHEN l_discount < 0.05 THEN 'C' ELSE 'D' END AS db_cr_cd,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS txn_amt,
       CASE WHEN l_tax < 0.02 THEN 'OT' ELSE 'BO' END AS txn_src_cd,
       l_partkey AS tm_posted_seq_num
FROM {{lineitem}}
JOIN {_func_code_values()}
  ON func_idx = (l_linenumber - 1) * 6 + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 2 ELSE 4 END
                + CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END""",
    # RPT-1
    "account_snapshot": """
SELECT o_custkey AS acct_id,
       CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS acct_seq_num,
       o_orderdate AS acct_open_dt,
       'CPC' || SUBSTR(o_orderpriority, 1, 1) AS cpc,
       CASE o_orderstatus WHEN 'F' THEN 'IP'
            WHEN 'O' THEN CASE WHEN o_totalprice < 250000 THEN 'VC' ELSE 'VF' END
            ELSE CASE WHEN o_totalprice < 100000 THEN 'EI' ELSE 'IC' END END AS inst_credit,
       last_day(CAST(o_orderdate AS DATE)) AS lastday_month,
       CAST(year(o_orderdate) AS STRING) || '_' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') AS eff_dt_yymm
FROM {orders}""",
    "flag_history": """
SELECT o_custkey AS acct_id,
       CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS acct_seq_num,
       o_orderdate AS acct_open_dt,
       'CPC' || SUBSTR(o_orderpriority, 1, 1) AS cpc,
       'IP' AS cdf21,
       last_day(CAST(o_orderdate AS DATE)) AS data_bus_dt,
       CAST(o_orderdate AS DATE) + 35 AS data_load_dt
FROM {orders}
WHERE o_orderdate < DATE '1996-01-01' AND o_orderstatus = 'F'""",
    "account_master": """
SELECT c_custkey AS acct_id, 0 AS acct_seq_num, c_name AS name, UPPER(c_name) AS name_emboss,
       'P' || CAST(c_nationkey AS STRING) AS state_prov_code, 'Z' || CAST(c_custkey AS STRING) AS zip_postal_code,
       CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN DATE '1998-07-01' ELSE DATE '1990-01-01' END AS efftv_from_dt,
       CASE c_mktsegment WHEN 'MACHINERY' THEN DATE '1998-06-30' WHEN 'FURNITURE' THEN DATE '1998-06-29'
            ELSE DATE '9999-12-31' END AS efftv_to_dt
FROM {customer}
UNION ALL
SELECT c_custkey, 0, c_name || ' NEW', UPPER(c_name || ' NEW'),
       'Q' || CAST(c_nationkey AS STRING), 'Y' || CAST(c_custkey AS STRING),
       DATE '1998-06-30', DATE '9999-12-31'
FROM {customer}
WHERE c_mktsegment IN ('MACHINERY', 'FURNITURE')
UNION ALL
SELECT c_custkey, 1, c_name || ' JOINT', UPPER(c_name || ' JOINT'),
       'P' || CAST(c_nationkey AS STRING), 'X' || CAST(c_custkey AS STRING),
       DATE '1990-01-01', DATE '9999-12-31'
FROM {customer}""",
    # RPT-5: legacy system = orders in status F or P, current system = status O or P.
    "legacy_app": """
SELECT o_orderkey AS app_num,
       CASE WHEN o_totalprice < 5000 THEN NULL ELSE o_orderdate + INTERVAL 9 HOUR END AS dt_entered,
       CASE WHEN o_orderpriority = '1-URGENT' THEN NULL
            ELSE o_orderdate + INTERVAL 30 DAY + INTERVAL 5 HOUR END AS dt_status,
       CASE WHEN o_totalprice < 40000 THEN 'NEWACCOUNT' WHEN o_totalprice < 80000 THEN ' DECLINE '
            WHEN o_totalprice < 120000 THEN 'NORESPONSE' WHEN o_totalprice < 160000 THEN 'REJECTOFFR'
            WHEN o_totalprice < 200000 THEN 'VOID APP' WHEN o_totalprice < 240000 THEN 'WITHDRAW'
            WHEN o_totalprice < 280000 THEN '   ' WHEN o_totalprice < 320000 THEN NULL
            WHEN o_totalprice < 360000 THEN 'INREVIEW' ELSE 'NEWACCOUNT' END AS status_field,
       CASE month(o_orderdate) WHEN 1 THEN NULL WHEN 2 THEN '  ' WHEN 3 THEN 'TCALLCEN' WHEN 4 THEN 'TMS'
            WHEN 5 THEN 'RDEALER' WHEN 6 THEN ' FCORRETL' WHEN 7 THEN 'INTERNET' WHEN 8 THEN ' INTERNET '
            WHEN 9 THEN 'BRANCH' ELSE 'TCALLCEN' END AS acct_cust_data_81,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'OFF' || CAST(o_custkey AS STRING)
            WHEN o_orderpriority = '3-MEDIUM' THEN ' ' ELSE NULL END AS data_entry_officer,
       CASE WHEN day(o_orderdate) <= 10 THEN '10.1.2.3'
            WHEN day(o_orderdate) <= 20 THEN '10.9.8.' || CAST(day(o_orderdate) AS STRING)
            ELSE NULL END AS user_20_byte_9,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'x@partner.example' ELSE 'y@mail.example' END AS user_75_byte_1,
       CASE WHEN day(o_orderdate) <= 3 THEN NULL WHEN day(o_orderdate) <= 6 THEN '  '
            WHEN day(o_orderdate) <= 12 THEN '3EMP' WHEN day(o_orderdate) <= 18 THEN '6X'
            WHEN day(o_orderdate) <= 22 THEN 'Q1' ELSE ' 12' END AS acct_cust_data_60,
       CASE WHEN o_totalprice < 60000 THEN 'DECSIN' WHEN o_totalprice < 140000 THEN ' DECPABUR '
            WHEN o_totalprice < 200000 THEN 'GENQ' ELSE NULL END AS af_queue_id,
       CASE SUBSTR(o_orderpriority, 1, 1) WHEN '1' THEN 'A' WHEN '2' THEN 'C' WHEN '3' THEN 'F'
            WHEN '4' THEN 'K' ELSE ' A' END AS age_bucket,
       CASE year(o_orderdate) WHEN 1995 THEN 'WEN' WHEN 1996 THEN 'RCB' WHEN 1997 THEN 'FCB'
            WHEN 1998 THEN ' ' WHEN 1999 THEN 'CON' ELSE NULL END AS client_product_cd,
       CASE WHEN o_orderpriority IN ('2-HIGH', '4-NOT SPECIFIED') THEN 'IDVPMO' ELSE 'WEBX' END AS acct_cust_data_62,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN ' D' WHEN '3-MEDIUM' THEN NULL
            WHEN '4-NOT SPECIFIED' THEN ' ' ELSE 'Z' END AS user_1_byte_12,
       CASE WHEN o_totalprice > 450000 THEN 'Y' ELSE NULL END AS test_app_sw,
       CASE WHEN o_totalprice > 470000 THEN 'Y' WHEN o_totalprice > 440000 THEN ' ' ELSE NULL END AS test_acct_flag
FROM {orders}
WHERE o_orderstatus IN ('F', 'P')""",
    "legacy_element": """
SELECT l_orderkey AS app_num,
       CASE l_linenumber WHEN 1 THEN 'CHKINCOME' WHEN 2 THEN ' CHKINCOME ' WHEN 3 THEN 'OTHERELEM'
            ELSE NULL END AS element_name,
       CASE l_returnflag WHEN 'A' THEN 'INCOMEWEN' WHEN 'R' THEN ' INCOMERCB ' ELSE 'INCOMEXXX' END AS alpha_value
FROM {lineitem}""",
    "legacy_override": """
SELECT l_orderkey AS app_num,
       CASE WHEN l_linestatus = 'F' THEN l_partkey + 1 ELSE 0 END AS ts2_account_id,
       CASE WHEN l_quantity < 10 THEN 'CCA' WHEN l_quantity < 20 THEN ' ' WHEN l_quantity < 30 THEN 'TEC'
            ELSE NULL END AS client_prod_code
FROM {lineitem}""",
    "app": """
SELECT o_orderkey AS appl_id,
       o_orderdate + INTERVAL 8 HOUR AS entry_dt,
       CASE o_orderpriority WHEN '2-HIGH' THEN NULL WHEN '3-MEDIUM' THEN o_orderdate + INTERVAL 30 DAY
            WHEN '4-NOT SPECIFIED' THEN o_orderdate + INTERVAL 10 DAY
            ELSE o_orderdate + INTERVAL 60 DAY END AS curr_stat_dt,
       CAST(o_orderdate AS DATE) AS efftv_from_dt,
       CASE WHEN o_orderpriority = '5-LOW' THEN DATE '2000-06-29' ELSE DATE '2000-06-30' END AS efftv_to_dt,
       CASE WHEN o_totalprice < 20000 THEN 'EXCL' WHEN o_totalprice < 30000 THEN '  '
            ELSE 'STD' END AS appl_strgy_cd,
       CASE WHEN o_totalprice < 60000 THEN 'NEWACCOUNT' WHEN o_totalprice < 110000 THEN 'DECLINE'
            WHEN o_totalprice < 150000 THEN ' WITHDRAW' WHEN o_totalprice < 190000 THEN 'NORESPONSE'
            WHEN o_totalprice < 230000 THEN NULL WHEN o_totalprice < 270000 THEN '  '
            WHEN o_totalprice < 300000 THEN 'VOID APP' ELSE 'OPEN' END AS appl_stat_cd,
       CASE month(o_orderdate) WHEN 1 THEN NULL WHEN 2 THEN ' ' WHEN 3 THEN 'TMS' WHEN 4 THEN 'TCALLCEN'
            WHEN 5 THEN 'INTERNET' WHEN 6 THEN 'INTERNET' WHEN 7 THEN ' INTERNET' ELSE 'BRANCH' END AS acqsn_channel_cd,
       CASE WHEN o_totalprice < 80000 THEN 'DECSIN' WHEN o_totalprice < 120000 THEN ' DECLBUR'
            WHEN o_totalprice < 200000 THEN 'OTHERQ' ELSE NULL END AS appl_queue_id,
       CASE SUBSTR(o_orderpriority, 1, 1) WHEN '1' THEN 'B' WHEN '2' THEN 'E' WHEN '3' THEN 'J'
            WHEN '4' THEN ' K' ELSE NULL END AS appl_age_bucket
FROM {orders}
WHERE o_orderstatus IN ('O', 'P')
UNION ALL
SELECT o_orderkey,
       o_orderdate + INTERVAL 8 HOUR,
       CASE o_orderpriority WHEN '2-HIGH' THEN o_orderdate + INTERVAL 90 DAY
            ELSE o_orderdate + INTERVAL 45 DAY END,
       DATE '2000-06-30',
       DATE '9999-12-31',
       'STD',
       CASE WHEN o_totalprice < 250000 THEN 'NEWACCOUNT' ELSE 'DECLINE' END,
       'INTERNET',
       CASE WHEN o_totalprice < 250000 THEN 'DECPABUR' ELSE 'OTHERQ' END,
       'A'
FROM {orders}
WHERE o_orderstatus IN ('O', 'P') AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderdate < DATE '2000-06-30'
UNION ALL
SELECT o_orderkey,
       o_orderdate + INTERVAL 8 HOUR,
       o_orderdate + INTERVAL 60 DAY,
       CAST(o_orderdate AS DATE),
       DATE '9999-12-31',
       'STD',
       'WITHDRAW',
       'TMS',
       'DECLBUR',
       'C'
FROM {orders}
WHERE o_orderstatus IN ('O', 'P') AND o_orderpriority = '5-LOW'""",
    "app_decision": """
SELECT o_orderkey AS appl_id,
       CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN 'D' || CAST(o_custkey AS STRING)
            WHEN o_orderpriority = '2-HIGH' THEN '  ' ELSE NULL END AS data_entry_off_num,
       DATE '1990-01-01' AS efftv_from_dt, DATE '9999-12-31' AS efftv_to_dt
FROM {orders}
WHERE o_orderstatus IN ('O', 'P')
UNION ALL
SELECT o_orderkey, ' ', DATE '1990-01-01', DATE '9999-12-31'
FROM {orders}
WHERE o_orderstatus IN ('O', 'P') AND o_orderpriority = '1-URGENT' AND o_totalprice < 100000""",
    "app_element": """
SELECT l_orderkey AS appl_id,
       CASE l_linenumber WHEN 1 THEN 'CHKINCOME' WHEN 2 THEN 'CHKINCOME  ' ELSE 'OTHER' END AS ele_elmt_nm,
       CASE l_returnflag WHEN 'A' THEN 'INCOMERCB' WHEN 'N' THEN ' INCOMEWEN' ELSE NULL END AS ele_alph_val,
       DATE '1990-01-01' AS efftv_from_dt,
       CASE WHEN l_linestatus = 'F' THEN DATE '9999-12-31' ELSE DATE '2000-06-30' END AS efftv_to_dt
FROM {lineitem}""",
    "app_user_data": """
SELECT o_orderkey AS appl_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'D' WHEN '2-HIGH' THEN ' A' WHEN '3-MEDIUM' THEN 'I'
            WHEN '4-NOT SPECIFIED' THEN NULL ELSE ' ' END AS user_1_byte_12,
       DATE '1990-01-01' AS efftv_from_dt,
       CASE WHEN o_totalprice > 480000 THEN DATE '2000-06-29' ELSE DATE '9999-12-31' END AS efftv_to_dt
FROM {orders}
WHERE o_orderstatus IN ('O', 'P')""",
    "app_transfer": """
SELECT l_orderkey AS appl_id,
       CASE WHEN l_returnflag = 'N' THEN 0 ELSE l_partkey + 1 END AS acct_id,
       CASE WHEN l_quantity < 15 THEN 'FCB' WHEN l_quantity < 30 THEN 'WEN' WHEN l_quantity < 40 THEN ' '
            ELSE NULL END AS clnt_prod_cd,
       DATE '1990-01-01' AS efftv_from_dt, DATE '9999-12-31' AS efftv_to_dt
FROM {lineitem}""",
    "app_account": """
SELECT o_orderkey AS appl_id,
       CASE WHEN day(o_orderdate) <= 4 THEN NULL WHEN day(o_orderdate) <= 8 THEN ' '
            WHEN day(o_orderdate) <= 14 THEN '31' WHEN day(o_orderdate) <= 20 THEN '7A'
            WHEN day(o_orderdate) <= 25 THEN 'X9' ELSE '6' END AS custom_data_60,
       CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM') THEN 'IDVPMO' ELSE ' WEB ' END AS custom_data_62,
       CASE year(o_orderdate) WHEN 1996 THEN 'RCB' WHEN 1997 THEN 'CCA' WHEN 1998 THEN 'SMB'
            WHEN 1999 THEN ' ' ELSE NULL END AS clnt_prod_cd,
       DATE '1990-01-01' AS efftv_from_dt, DATE '9999-12-31' AS efftv_to_dt
FROM {orders}
WHERE o_orderstatus IN ('O', 'P')""",
    "account_custom": """
SELECT p_partkey + 1 AS acct_id,
       CASE WHEN p_size > 45 THEN 1 ELSE 0 END AS acct_seq_num,
       CASE p_type WHEN 'ECONOMY' THEN 'EI' WHEN 'MEDIUM' THEN 'IC' WHEN 'LARGE' THEN 'XX'
            WHEN 'STANDARD' THEN 'VP' WHEN 'SMALL' THEN NULL ELSE 'VF' END AS custom_21_data,
       DATE '1990-01-01' AS efftv_from_dt,
       CASE WHEN p_retailprice > 1900 THEN DATE '2000-01-01' ELSE DATE '9999-12-31' END AS efftv_to_dt
FROM {part}""",
    "excluded_app": """
SELECT o_orderkey AS app_num
FROM {orders}
WHERE o_totalprice > 490000""",
}



def _tables_used(sql: str) -> list[str]:
    return sorted(set(re.findall(r"(?<!\{)\{(\w+)\}(?!\})", sql)))


_FRAMES: WeakKeyDictionary[SparkSession, dict[tuple[str, str], DataFrame]] = WeakKeyDictionary()


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a lazy DataFrame, one per session and folder: reading the parquet
    footer to learn the schema is a Spark job, so it is done once, not per query."""
    frames = _FRAMES.setdefault(spark, {})
    if (sf_dir, name) not in frames:
        frames[sf_dir, name] = read_table(spark, name, sf_dir)
    return frames[sf_dir, name]


def driver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: driver_table(spark, sf_dir, t) for t in DRIVER_TABLES}


def report_input(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived report input as a lazy Spark DataFrame over the driver parquet files."""
    sql = INPUT_SQL[name]
    return spark.sql(sql, **{t: driver_table(spark, sf_dir, t) for t in _tables_used(sql)})


def report_inputs(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    return {n: report_input(spark, sf_dir, n) for n in names}


def input_cte(names) -> str:
    """``WITH`` clause defining the named inputs for the DuckDB oracle (no trailing comma)."""
    parts = []
    for n in names:
        sql = INPUT_SQL[n]
        sql = sql.format(**{t: t for t in _tables_used(sql)})
        parts.append(f"{n} AS ({sql}\n)")
    return "WITH " + ",\n".join(parts)
