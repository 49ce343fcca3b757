"""One checked query per operator of the survey's inventory, over whole driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cardflow.functions import columns as C
from cardflow.functions import dates as D
from cardflow.operators import joins as J
from cardflow.operators.ranking import latest_per_key, pg_desc, with_row_number
from cardflow.operators.sets import distinct_rows, union_distinct
from cardflow.operators.sorting import sort_report
from cardflow.operators.temporal import effective_on
from cardflow.registry.base import check
from cardflow.registry.driver_inputs import BD_FLAGGED, BD_MTD, driver_table
from cardflow.sources.tables import run_sql


def _t(spark, sf_dir, name):
    return driver_table(spark, sf_dir, name)


@check("q_scan_project", """
SELECT * FROM (SELECT c_custkey AS cust_id, c_name AS cust_name, c_mktsegment AS segment, c_acctbal AS balance
               FROM customer) s
""")
def q_scan_project(spark, sf_dir):
    renamed = _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("cust_name"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    return run_sql(spark, "SELECT * FROM {s}", s=renamed)


@check("q_sql_params", """
SELECT c_custkey AS cust_id, c_mktsegment AS segment FROM customer
WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000
""")
def q_sql_params(spark, sf_dir):
    return run_sql(spark, "SELECT c_custkey AS cust_id, c_mktsegment AS segment FROM {c} "
                          "WHERE c_mktsegment = :seg AND c_acctbal > :bal",
                   {"seg": "BUILDING", "bal": 5000}, c=_t(spark, sf_dir, "customer"))


@check("q_cast_pad", """
SELECT LPAD(CAST(o_orderkey AS VARCHAR), 11, '0') AS id11,
       LPAD(CAST(o_orderkey AS VARCHAR), 4, '0') AS id4,
       CAST(o_orderkey AS VARCHAR) AS id_text,
       CAST(o_orderdate AS DATE) AS order_day,
       LENGTH(CAST(o_orderkey AS VARCHAR)) > 4 AS id4_cut
FROM orders
""")
def q_cast_pad(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select(C.pad_id("o_orderkey", 11).alias("id11"), C.pad_id("o_orderkey", 4).alias("id4"),
                    F.col("o_orderkey").cast("string").alias("id_text"), D.day("o_orderdate").alias("order_day"),
                    C.overlong("o_orderkey", 4).alias("id4_cut"))


_RAW_STATUS_SQL = "CASE o_orderstatus WHEN 'P' THEN '   ' ELSE '  ' || o_orderstatus || ' ' END"


def _raw_status():
    return (F.when(F.col("o_orderstatus") == "P", F.lit("   "))
            .otherwise(F.concat(F.lit("  "), F.col("o_orderstatus"), F.lit(" "))))


@check("q_blank_to_null", f"""
SELECT o_orderkey, NULLIF(TRIM({_RAW_STATUS_SQL}), '') AS status,
       NULLIF(TRIM({_RAW_STATUS_SQL}), '') IS NULL AS is_missing
FROM orders
""")
def q_blank_to_null(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("raw", _raw_status())
    s = C.blank_to_null("raw")
    return o.select("o_orderkey", s.alias("status"), s.isNull().alias("is_missing"))


PRIORITY_LABELS = {"1-URGENT": "URGENT", "2-HIGH": "HIGH", "3-MEDIUM": "MEDIUM", "4-NOT SPECIFIED": "NONE"}
_PRIORITY_CASE = ("CASE WHEN o_orderpriority = '1-URGENT' THEN 'URGENT' WHEN o_orderpriority = '2-HIGH' THEN 'HIGH' "
                  "WHEN o_orderpriority = '3-MEDIUM' THEN 'MEDIUM' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'NONE' "
                  "ELSE 'OTHER' END")


@check("q_decode_default", f"SELECT o_orderkey, {_PRIORITY_CASE} AS priority_label FROM orders")
def q_decode_default(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select("o_orderkey", C.decode("o_orderpriority", PRIORITY_LABELS, "OTHER").alias("priority_label"))


@check("q_decode_join", f"SELECT o_orderkey, {_PRIORITY_CASE} AS priority_label FROM orders")
def q_decode_join(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return J.decode_join(o, "o_orderpriority", PRIORITY_LABELS, "priority_label", "OTHER").select(
        "o_orderkey", "priority_label")


@check("q_case_rules", """
SELECT p_partkey,
       CASE WHEN SUBSTR(p_type, 1, 1) = 'E' AND p_size < 10 THEN 'SMALL ECONOMY'
            WHEN SUBSTR(p_type, 1, 1) IN ('S', 'M') THEN 'S OR M'
            WHEN p_retailprice >= 1500 THEN 'PRICEY'
            WHEN p_size IS NULL THEN 'UNSIZED'
            ELSE 'OTHER' END AS part_class
FROM part
""")
def q_case_rules(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    fc = C.first_char("p_type")
    rule = C.case_when([
        ((fc == "E") & (F.col("p_size") < 10), "SMALL ECONOMY"),
        (fc.isin("S", "M"), "S OR M"),
        (F.col("p_retailprice") >= 1500, "PRICEY"),
        (F.col("p_size").isNull(), "UNSIZED"),
    ], "OTHER")
    return p.select("p_partkey", rule.alias("part_class"))


_NULLABLE_DAY_SQL = "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END"


def _nullable_day():
    return F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(D.day("o_orderdate"))


@check("q_date_cutover", f"""
SELECT o_orderkey,
       CASE WHEN {_NULLABLE_DAY_SQL} < DATE '1998-08-01' THEN 'BEFORE'
            WHEN {_NULLABLE_DAY_SQL} >= DATE '1998-08-01' THEN 'AFTER'
            ELSE 'UNKNOWN' END AS side
FROM orders
""")
def q_date_cutover(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("d", _nullable_day())
    cut = dt.date(1998, 8, 1)
    side = C.case_when([(D.before("d", cut), "BEFORE"), (D.on_or_after("d", cut), "AFTER")], "UNKNOWN")
    return o.select("o_orderkey", side.alias("side"))


@check("q_case_same", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice END AS total
FROM orders
""")
def q_case_same(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    same = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    return o.select("o_orderkey", same.alias("total"))


@check("q_flag", """
SELECT c.c_custkey, o.o_orderkey, CASE WHEN o.o_orderkey IS NOT NULL THEN 'HAS' ELSE 'HAS_NOT' END AS big_order
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey AND o.o_totalprice > 450000
""")
def q_flag(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey")
    o = _t(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 450000).select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    j = J.left_join(c, o, "c_custkey", many=True)
    return j.select("c_custkey", "o_orderkey", C.flag("o_orderkey", "HAS", "HAS_NOT").alias("big_order"))


@check("q_filter_eq_in", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_returnflag = 'R' AND l_linenumber IN (1, 3, 5)
""")
def q_filter_eq_in(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.filter((F.col("l_returnflag") == "R") & F.col("l_linenumber").isin(1, 3, 5)).select(
        "l_orderkey", "l_linenumber", "l_quantity")


_NULL_STATUS_SQL = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END"


@check("q_filter_null_logic", f"""
SELECT o_orderkey, status FROM (SELECT o_orderkey, {_NULL_STATUS_SQL} AS status FROM orders) s
WHERE status <> 'F' AND status NOT IN ('X', 'Y')
""")
def q_filter_null_logic(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderstatus")).alias("status"))
    return o.filter((F.col("status") != "F") & C.not_in_values("status", ["X", "Y"]))


@check("q_null_logic_values", f"""
SELECT o_orderkey, status <> 'F' AS ne_f, status NOT IN ('F', 'X') AS not_in_fx
FROM (SELECT o_orderkey, {_NULL_STATUS_SQL} AS status FROM orders) s
""")
def q_null_logic_values(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderstatus")).alias("status"))
    return o.select("o_orderkey", (F.col("status") != "F").alias("ne_f"),
                    C.not_in_values("status", ["F", "X"]).alias("not_in_fx"))


@check("q_between", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate BETWEEN DATE '1998-06-01' AND DATE '1998-06-30'
""")
def q_between(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.filter(D.between("o_orderdate", dt.date(1998, 6, 1), dt.date(1998, 6, 30))).select(
        "o_orderkey", "o_orderdate")


@check("q_or_groups", """
SELECT c.c_custkey, c.c_mktsegment, n.n_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey AND n.n_regionkey > 0
WHERE (c.c_mktsegment = 'BUILDING' OR c.c_mktsegment = 'MACHINERY') OR c.c_acctbal < 0
""")
def q_or_groups(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    n = _t(spark, sf_dir, "nation").filter(F.col("n_regionkey") > 0)
    seg = F.col("c_mktsegment")
    kept = c.filter(((seg == "BUILDING") | (seg == "MACHINERY")) | (F.col("c_acctbal") < 0))
    j = J.left_join(kept, n, kept["c_nationkey"] == n["n_nationkey"])
    return j.select("c_custkey", "c_mktsegment", "n_name")


@check("q_like", """
SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'blue%' OR p_name LIKE '%widget%'
""")
def q_like(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.filter(F.col("p_name").like("blue%") | F.col("p_name").like("%widget%")).select("p_partkey", "p_name")


@check("q_month_key", f"""
WITH run_month AS (SELECT strftime(DATE '{BD_FLAGGED.as_of}', '%Y_%m') AS month_key)
SELECT o.o_orderkey, strftime(o.o_orderdate, '%Y_%m') AS month_key
FROM orders o CROSS JOIN run_month m
WHERE strftime(o.o_orderdate, '%Y_%m') = m.month_key
""")
def q_month_key(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("month_key", D.month_key("o_orderdate"))
    return o.filter(D.in_month("month_key", BD_FLAGGED)).select("o_orderkey", "month_key")


@check("q_month_to_date", f"""
SELECT l_orderkey, l_linenumber, l_shipdate,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month
FROM lineitem
WHERE l_shipdate >= date_trunc('month', DATE '{BD_MTD.run_date}' - INTERVAL 1 DAY)
  AND l_shipdate < DATE '{BD_MTD.run_date}'
""")
def q_month_to_date(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    return li.filter(D.month_to_date("l_shipdate", BD_MTD)).select(
        "l_orderkey", "l_linenumber", "l_shipdate", D.month_start(D.day("l_shipdate")).alias("ship_month"))


_BD_EVENTS = D.BusinessDate(dt.date(2024, 1, 21))


@check("q_month_to_date_closed", f"""
SELECT event_id, ts FROM events
WHERE ts BETWEEN DATE '{_BD_EVENTS.month_start}' AND DATE '{_BD_EVENTS.as_of}'
""")
def q_month_to_date_closed(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.filter(D.month_to_date("ts", _BD_EVENTS, closed=True)).select("event_id", "ts")


@check("q_before_day", """
SELECT event_id, CAST(date_trunc('day', ts) AS DATE) AS event_day FROM events
WHERE date_trunc('day', ts) < DATE '2024-01-10'
""")
def q_before_day(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.filter(D.before_day("ts", dt.date(2024, 1, 10))).select("event_id", D.day("ts").alias("event_day"))


@check("q_inner_text_keys", """
SELECT o.o_orderkey, c.c_name, c.c_nationkey
FROM orders o, customer c
WHERE CAST(o.o_custkey AS VARCHAR) = CAST(c.c_custkey AS VARCHAR) AND c.c_nationkey IN (1, 2, 3)
""")
def q_inner_text_keys(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("cust_text"))
    c = _t(spark, sf_dir, "customer").filter(F.col("c_nationkey").isin(1, 2, 3))
    j = J.inner_join(o, c, o["cust_text"] == c["c_custkey"].cast("string"))
    return j.select("o_orderkey", "c_name", "c_nationkey")


_SEQ_SQL = "CASE o_orderpriority WHEN '1-URGENT' THEN 1 ELSE 2 END"


@check("q_left_two_keys", f"""
SELECT o.o_orderkey, o.seq, l.l_partkey, l.l_quantity
FROM (SELECT o_orderkey, {_SEQ_SQL} AS seq FROM orders) o
LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') l
  ON o.o_orderkey = l.l_orderkey AND o.seq = l.l_linenumber
""")
def q_left_two_keys(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(2).alias("seq"))
    li = _t(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("seq"), "l_partkey", "l_quantity")
    return J.left_join(o, li, ["o_orderkey", "seq"], many=True)


@check("q_left_filtered", """
SELECT c.c_custkey, o.o_orderkey
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey AND o.o_totalprice > 450000
""")
def q_left_filtered(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey")
    o = _t(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 450000).select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return J.left_join(c, o, "c_custkey", many=True)


_VALIDITY_SQL = ("SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS efftv_from_dt, "
                 "CAST(o_orderdate AS DATE) + 400 AS efftv_to_dt FROM orders")
_AS_OF = dt.date(1998, 6, 30)


def _validity_rows(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", D.day("o_orderdate").alias("efftv_from_dt"),
        F.date_add(D.day("o_orderdate"), 400).alias("efftv_to_dt"))


@check("q_effective_on", f"""
SELECT * FROM ({_VALIDITY_SQL}) v
WHERE efftv_from_dt <= DATE '{_AS_OF}' AND efftv_to_dt >= DATE '{_AS_OF}'
""")
def q_effective_on(spark, sf_dir):
    return effective_on(_validity_rows(spark, sf_dir), _AS_OF)


@check("q_left_effective", f"""
SELECT c.c_custkey, v.o_orderkey, v.efftv_from_dt
FROM customer c LEFT JOIN ({_VALIDITY_SQL}) v
  ON c.c_custkey = v.o_custkey AND v.efftv_from_dt <= DATE '{_AS_OF}' AND v.efftv_to_dt >= DATE '{_AS_OF}'
""")
def q_left_effective(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey")
    v = _validity_rows(spark, sf_dir).withColumnRenamed("o_custkey", "c_custkey")
    return J.left_join_effective(c, v, "c_custkey", _AS_OF, many=True).select("c_custkey", "o_orderkey", "efftv_from_dt")


@check("q_left_chain", """
SELECT c.c_custkey, o.o_orderkey, l.l_partkey
FROM customer c
LEFT JOIN orders o ON c.c_custkey = o.o_custkey AND o.o_totalprice > 400000
LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_linenumber = 1 AND l.l_returnflag IN ('A', 'R')
""")
def q_left_chain(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey")
    o = _t(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 400000).select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    li = _t(spark, sf_dir, "lineitem").filter(
        (F.col("l_linenumber") == 1) & F.col("l_returnflag").isin("A", "R")).select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    chain = J.left_join(J.left_join(c, o, "c_custkey", many=True), li, "o_orderkey", many=True)
    return chain.select("c_custkey", "o_orderkey", "l_partkey")


@check("q_anti", """
SELECT c.c_custkey, c.c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000)
""")
def q_anti(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    big = _t(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 400000).select(
        F.col("o_custkey").alias("c_custkey"))
    return J.anti_join(c, big, "c_custkey")


@check("q_not_in_nullaware", """
SELECT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
""")
def q_not_in_nullaware(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey")
    listing = _t(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 300000).select("o_custkey")
    return J.exclude_listed(c, "c_custkey", listing, "o_custkey")


_NULL_LISTING_SQL = ("SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_custkey END AS k "
                     "FROM orders WHERE o_totalprice > 300000")


@check("q_not_in_with_null", f"""
SELECT COUNT(*) AS n_left FROM customer WHERE c_custkey NOT IN ({_NULL_LISTING_SQL})
""")
def q_not_in_with_null(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey")
    listing = _t(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 300000).select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None)).otherwise(F.col("o_custkey")).alias("k"))
    return J.exclude_listed(c, "c_custkey", listing, "k").agg(F.count(F.lit(1)).alias("n_left"))


@check("q_row_number", f"""
SELECT o_orderkey, o_custkey, o_totalprice, {_NULLABLE_DAY_SQL} AS d,
       CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY {_NULLABLE_DAY_SQL} DESC NULLS FIRST,
                               o_orderkey DESC NULLS FIRST) AS BIGINT) AS rn
FROM orders
""")
def q_row_number(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", _nullable_day().alias("d"))
    return with_row_number(o, ["o_custkey"], [pg_desc("d"), pg_desc("o_orderkey")], "rn")


@check("q_latest_per_key", """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT o_custkey, o_orderkey, o_orderdate,
         ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS rn
  FROM orders) r
WHERE rn = 1
""")
def q_latest_per_key(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest_per_key(o, ["o_custkey"], [pg_desc("o_orderdate"), pg_desc("o_orderkey")])


@check("q_left_latest", """
SELECT c.c_custkey, r.o_orderkey, r.o_totalprice
FROM customer c LEFT JOIN (
  SELECT o_custkey, o_orderkey, o_totalprice,
         ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderstatus = 'F') r
  ON c.c_custkey = r.o_custkey AND r.rn = 1
""")
def q_left_latest(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select("c_custkey")
    o = _t(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice", "o_orderdate")
    j = J.left_join_latest(c, o, ["c_custkey"], [pg_desc("o_orderdate"), pg_desc("o_orderkey")])
    return j.select("c_custkey", "o_orderkey", "o_totalprice")


_NULL_PRIORITY_SQL = "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END"


@check("q_distinct", f"""
SELECT DISTINCT o_orderstatus, {_NULL_PRIORITY_SQL} AS priority, CAST(year(o_orderdate) AS INTEGER) AS order_year
FROM orders
""")
def q_distinct(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return distinct_rows(o.select(
        "o_orderstatus",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)).otherwise(F.col("o_orderpriority")).alias("priority"),
        F.year("o_orderdate").alias("order_year")))


@check("q_union_distinct", """
SELECT c_custkey AS cust_key, c_mktsegment AS label FROM customer
UNION
SELECT o_custkey, o_orderstatus FROM orders
""")
def q_union_distinct(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cust_key"), F.col("c_mktsegment").alias("label"))
    o = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    return union_distinct(c, o)


@check("q_sort_hidden", """
SELECT LPAD(CAST(o_orderkey AS VARCHAR), 11, '0') AS order_id, o_custkey
FROM orders ORDER BY o_orderdate, o_totalprice, order_id
""")
def q_sort_hidden(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return sort_report(o.withColumn("order_id", C.pad_id("o_orderkey", 11)),
                       ["o_orderdate", "o_totalprice", "order_id"], ["order_id", "o_custkey"])


_A_SQL = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL ELSE 'A' || o_orderstatus END"
_B_SQL = "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'B' || SUBSTR(o_orderpriority, 1, 1) END"


@check("q_coalesce", f"""
SELECT o_orderkey, COALESCE({_A_SQL}, {_B_SQL}, 'NONE') AS pick3, COALESCE({_A_SQL}, {_B_SQL}) AS pick2
FROM orders
""")
def q_coalesce(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    a = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit(None)).otherwise(
        F.concat(F.lit("A"), F.col("o_orderstatus")))
    b = F.when(F.col("o_orderstatus") == "F", F.lit(None)).otherwise(
        F.concat(F.lit("B"), C.first_char("o_orderpriority")))
    return o.select("o_orderkey", C.prefer(a, b, F.lit("NONE")).alias("pick3"), C.prefer(a, b).alias("pick2"))


_P_VAL_SQL = "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END"
_S_DATE_SQL = "CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_shipdate AS DATE) - 120 END"


@check("q_newest_wins", f"""
WITH p AS (SELECT o_orderkey, {_NULLABLE_DAY_SQL} AS p_date, {_P_VAL_SQL} AS p_val FROM orders),
s AS (
  SELECT l_orderkey, {_S_DATE_SQL} AS s_date, l_returnflag AS s_val,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS FIRST, l_linenumber DESC NULLS FIRST,
                            l_partkey DESC NULLS FIRST, l_suppkey DESC NULLS FIRST, l_returnflag DESC NULLS FIRST) AS rn
  FROM lineitem)
SELECT p.o_orderkey,
       CASE WHEN COALESCE(p.p_date, DATE '1900-01-01') >= COALESCE(s.s_date, DATE '1900-01-01')
            THEN COALESCE(p.p_date, s.s_date) ELSE COALESCE(s.s_date, p.p_date) END AS status_date,
       CASE WHEN COALESCE(p.p_date, DATE '1900-01-01') >= COALESCE(s.s_date, DATE '1900-01-01')
            THEN COALESCE(p.p_val, s.s_val) ELSE COALESCE(s.s_val, p.p_val) END AS status
FROM p LEFT JOIN s ON p.o_orderkey = s.l_orderkey AND s.rn = 1
""")
def q_newest_wins(spark, sf_dir):
    p = _t(spark, sf_dir, "orders").select(
        "o_orderkey", _nullable_day().alias("p_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_orderstatus")).alias("p_val"))
    li = _t(spark, sf_dir, "lineitem")
    s = latest_per_key(
        li.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey",
                  "l_returnflag"),
        ["o_orderkey"],
        [pg_desc("l_shipdate"), pg_desc("l_linenumber"), pg_desc("l_partkey"), pg_desc("l_suppkey"),
         pg_desc("l_returnflag")],
    ).select("o_orderkey",
             F.when(F.col("l_returnflag") == "N", F.lit(None)).otherwise(
                 F.date_sub(D.day("l_shipdate"), 120)).alias("s_date"),
             F.col("l_returnflag").alias("s_val"))
    j = J.left_join(p, s, "o_orderkey")
    return j.select("o_orderkey",
                    C.newest_wins("p_date", "s_date", "p_date", "s_date").alias("status_date"),
                    C.newest_wins("p_date", "s_date", "p_val", "s_val").alias("status"))


@check("q_override", """
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' AND c_nationkey IN (1, 2, 3) AND c_acctbal < 0 THEN 'BUILDING-NEG'
            WHEN c_mktsegment = 'BUILDING' AND c_nationkey = 4 THEN 'BUILDING-4'
            ELSE c_mktsegment END AS segment
FROM customer
""")
def q_override(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    rules = [
        ((seg == "BUILDING") & F.col("c_nationkey").isin(1, 2, 3) & (F.col("c_acctbal") < 0), "BUILDING-NEG"),
        ((seg == "BUILDING") & (F.col("c_nationkey") == 4), "BUILDING-4"),
    ]
    return c.select("c_custkey", C.override(seg, rules).alias("segment"))


@check("q_overlay", """
WITH pr AS (
  SELECT l_orderkey, l_partkey AS p_part,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC NULLS FIRST, l_linenumber DESC,
                            l_partkey DESC, l_suppkey DESC) AS rn
  FROM lineitem WHERE l_returnflag = 'R'),
se AS (SELECT l_orderkey, l_partkey AS s_part FROM lineitem)
SELECT o.o_orderkey, pr.p_part, se.s_part, COALESCE(pr.p_part, se.s_part) AS part_pick
FROM orders o
LEFT JOIN pr ON o.o_orderkey = pr.l_orderkey AND pr.rn = 1
LEFT JOIN se ON o.o_orderkey = se.l_orderkey
""")
def q_overlay(spark, sf_dir):
    spine = _t(spark, sf_dir, "orders").select("o_orderkey")
    li = _t(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    primary = latest_per_key(
        li.filter(F.col("l_returnflag") == "R"), ["o_orderkey"],
        [pg_desc("l_shipdate"), pg_desc("l_linenumber"), pg_desc("l_partkey"), pg_desc("l_suppkey")],
    ).select("o_orderkey", F.col("l_partkey").alias("p_part"))
    secondary = li.select("o_orderkey", F.col("l_partkey").alias("s_part"))
    j = J.overlay(spine, primary, secondary, ["o_orderkey"], many=True)
    return j.select("o_orderkey", "p_part", "s_part", C.prefer("p_part", "s_part").alias("part_pick"))
