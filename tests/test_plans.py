"""Physical-plan checks: pushdown, pruning, partial top-1, no cross products, bounded broadcasts."""

import contextlib
import datetime as dt
import io
import os

import pytest

import __spark_entry__ as E
from cardflow.functions.dates import BusinessDate
from cardflow.operators import joins as J
from cardflow.operators.ranking import latest_per_key, pg_desc
from cardflow.plans.new_flagged_accounts import flagged_batch

SF = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_month_to_date_filter_reaches_scan(spark):
    p = plan(E.queries()["q_month_to_date"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate,1998-06-01T00:00), " \
           "LessThan(l_shipdate,1998-06-16T00:00)]" in p


def test_projection_prunes_scan_columns(spark):
    p = plan(E.queries()["q_filter_eq_in"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string>" in p


def test_top1_limits_rows_before_shuffle(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    p = plan(latest_per_key(o, ["o_custkey"], [pg_desc("o_orderdate"), pg_desc("o_orderkey")]), "simple")
    lines = p.splitlines()
    exchange = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(o_custkey" in x)
    final = next(i for i, x in enumerate(lines) if "WindowGroupLimit" in x and "Final" in x)
    partial = next(i for i, x in enumerate(lines) if "WindowGroupLimit" in x and "Partial" in x)
    # the tree prints parents first: final limit above the exchange, partial limit below it
    assert final < exchange < partial


def test_exclusion_is_plain_anti_join(spark):
    c = spark.read.parquet(f"{SF}/customer.parquet")
    o = spark.read.parquet(f"{SF}/orders.parquet")
    p = plan(J.exclude_listed(c, "c_custkey", o.select("o_custkey"), "o_custkey"), "simple")
    assert "LeftAnti" in p and "BroadcastNestedLoopJoin" not in p and "isNullAwareAntiJoin=true" not in p


def test_decode_table_is_broadcast(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    p = plan(J.decode_join(o, "o_orderpriority", {"1-URGENT": "U"}, "label", "OTHER"), "simple")
    assert "BroadcastHashJoin" in p


def test_month_key_prunes_partitions(spark, scratch):
    path = os.path.join(scratch, "snapshot")
    rows = [(1, 0, dt.datetime(2024, 3, 1), "C", "IP", dt.datetime(2024, 3, 31), "2024_03"),
            (2, 0, dt.datetime(2024, 2, 1), "C", "IP", dt.datetime(2024, 2, 29), "2024_02")]
    schema = ("acct_id long, acct_seq_num int, acct_open_dt timestamp_ntz, cpc string, inst_credit string, "
              "lastday_month timestamp_ntz, eff_dt_yymm string")
    spark.createDataFrame(rows, schema).write.partitionBy("eff_dt_yymm").parquet(path)
    df = flagged_batch(spark.read.parquet(path), BusinessDate(dt.date(2024, 4, 1)))
    p = plan(df)
    assert "PartitionFilters: [isnotnull(eff_dt_yymm" in p and "(eff_dt_yymm#" in p and "= 2024_03)" in p
    assert [r.acct_id for r in df.collect()] == [1]


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_no_cross_products(spark, key):
    p = plan(E.queries()[key](spark, SF), "simple")
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_summary_joins_share_the_application_key(spark):
    p = plan(E.queries()["q_rpt_daily_application_summary"](spark, SF), "simple")
    # every shuffle of the summary is on an id (application or transfer account) or the dedup keys
    for line in p.splitlines():
        if "Exchange hashpartitioning(" in line:
            keys = line.split("Exchange hashpartitioning(")[1]
            assert keys.startswith(("appl_id", "app_num", "xfer_acct_id", "__listed_key", "o_orderkey", "l_orderkey")), line


def test_left_join_many_splits_a_hot_key(spark):
    from test_operators import partitions_holding

    from pyspark.sql import functions as F

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        n = 120_000
        # one key holds a third of the right side's rows
        right = spark.range(n).select(F.when(F.col("id") < n // 3, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                      (F.col("id") * 3).alias("v"))
        left = spark.range(n).select(F.col("id").alias("k"), F.lit("x").alias("l"))
        out = J.left_join_many(left, right, ["k"]).groupBy("l").agg(F.sum("v").alias("s"), F.count("*").alias("n"))
        got = out.collect()
        assert got[0]["n"] == n + n // 3 - 1
        # the hot key is found (more rows than a task's share) and spread
        assert partitions_holding(spark, J.left_join_many(left, right, ["k"]), "k = 7") > 1
        # the summary's shape: DISTINCT right after the split join (needs forceOptimizeSkewedJoin,
        # part of the recommended settings; AQE then shuffles above the partial aggregate)
        matched, _ = J.left_join_many_parts(left, right, ["k"], hot=None)
        deduped = matched.distinct()
        assert deduped.count() == n  # every right row matches and v is unique
        deduped.collect()
        assert "SortMergeJoin(skew=true)" in plan(deduped, "simple")
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
