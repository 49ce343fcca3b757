"""Stateful tests: incremental load, append-returning, replace and dated export."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cardflow.functions.dates import BusinessDate
from cardflow.plans.new_flagged_accounts import HISTORY_COLUMNS, run_new_flagged_accounts
from cardflow.sinks.tables import (append_returning, load_new_keys, read_target, replace_table, report_path,
                                   write_report)
from conftest import rows
from test_reports_golden import BD1, rpt1_inputs


def test_load_new_keys_twice_and_retry(spark, scratch):
    snap, hist, master = rpt1_inputs(spark)
    target = os.path.join(scratch, "history")
    hist.write.parquet(target)
    first = run_new_flagged_accounts(snap, target, master, BD1)
    first_rows = sorted(rows(first), key=str)
    assert len(first_rows) == 7
    # a retry on the same day appends nothing and reproduces the report
    again = run_new_flagged_accounts(snap, target, master, BD1)
    assert sorted(rows(again), key=str) == first_rows
    assert read_target(spark, target).count() == 1 + 6
    # the next day the same keys are already loaded: empty delta
    next_day = BusinessDate(dt.date(2024, 4, 2))
    assert run_new_flagged_accounts(snap, target, master, next_day).count() == 0
    # same-batch duplicates were both inserted
    assert read_target(spark, target).filter(F.col("acct_id") == 3).count() == 2


def test_append_returning_keeps_rows_after_append(spark, scratch):
    target = os.path.join(scratch, "hist2")
    spark.createDataFrame([(1,)], "k long").write.parquet(target)
    batch = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    delta = batch.join(read_target(spark, target), "k", "left_anti")
    kept = append_returning(delta, target, ["k"])
    # re-planning the delta now finds nothing; the returned rows were materialised before the append
    assert batch.join(read_target(spark, target), "k", "left_anti").count() == 0
    assert sorted(rows(kept)) == [(2,), (3,)]
    assert sorted(rows(read_target(spark, target))) == [(1,), (2,), (3,)]


def test_load_new_keys_creates_missing_target(spark, scratch):
    target = os.path.join(scratch, "fresh")
    batch = spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    out = load_new_keys(batch, target, ["k"], ["k", "v", "data_load_dt"], dt.date(2024, 1, 1))
    assert sorted(rows(out)) == [(1, "a", dt.date(2024, 1, 1)), (1, "b", dt.date(2024, 1, 1))]


def test_replace_table_twice_and_self_read(spark, scratch):
    target = os.path.join(scratch, "summary")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string")
    replace_table(df, target)
    replace_table(df, target)
    assert sorted(rows(read_target(spark, target))) == [(1, "x"), (2, "y")]
    # a plan that reads its own target is materialised before the overwrite
    grown = read_target(spark, target).withColumn("k", F.col("k") + 10)
    replace_table(grown, target)
    assert sorted(rows(read_target(spark, target))) == [(11, "x"), (12, "y")]


def test_replace_catalog_table(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS cardflow_test LOCATION '{scratch}/db'")
    name = "cardflow_test.daily_summary"
    replace_table(spark.createDataFrame([(1,)], "k long"), name)
    replace_table(spark.table(name).withColumn("k", F.col("k") + 1), name)
    assert rows(spark.table(name)) == [(2,)]
    spark.sql(f"DROP TABLE {name}")


def test_write_report_dated_name_and_count(spark, scratch):
    bd = BusinessDate(dt.date(2024, 3, 1))
    df = spark.createDataFrame([(i, f"r{i}") for i in range(25)], "k int, v string").orderBy("k")
    path, n = write_report(df, scratch, "adjustments", bd, grain="day")
    assert path.endswith("adjustments_20240301") and n == 25
    path_m, n_m = write_report(df, scratch, "postings", bd, grain="month", fmt="parquet")
    assert path_m == report_path(scratch, "postings", bd, "month") and path_m.endswith("postings_202402")
    back = spark.read.option("header", True).csv(path)
    assert back.count() == 25 and back.columns == ["k", "v"]
    # re-run overwrites
    write_report(df.limit(3), scratch, "adjustments", bd, grain="day")
    assert spark.read.option("header", True).csv(path).count() == 3


def test_history_columns_order():
    assert HISTORY_COLUMNS == ["acct_id", "acct_seq_num", "acct_open_dt", "cpc", "cdf21", "data_bus_dt",
                               "data_load_dt"]


def test_failed_replace_keeps_old_catalog_table(spark, scratch):
    import pytest

    spark.sql(f"CREATE DATABASE IF NOT EXISTS cardflow_fail LOCATION '{scratch}/dbf'")
    name = "cardflow_fail.summary"
    replace_table(spark.createDataFrame([(1,), (2,)], "k long"), name)
    # a job that fails while its rows are computed (ANSI division by zero at run time)
    bad = spark.range(5).select((F.lit(1) / (F.col("id") - F.col("id"))).cast("long").alias("k"))
    with pytest.raises(Exception):
        replace_table(bad, name)
    assert sorted(rows(spark.table(name))) == [(1,), (2,)]
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"DROP TABLE IF EXISTS {name}__staging")


def test_second_batch_of_a_load_date_adds_its_unseen_keys(spark, scratch):
    target, day = os.path.join(scratch, "second"), dt.date(2024, 1, 1)
    make = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k long")
    load_new_keys(make(2), target, ["k"], ["k", "data_load_dt"], day)
    assert sorted(rows(load_new_keys(make(2, 3), target, ["k"], ["k", "data_load_dt"], day), "k")) == [(2,), (3,)]


def test_failing_folder_replace_keeps_the_old_rows(spark, scratch):
    target = os.path.join(scratch, "kept")
    replace_table(spark.createDataFrame([(1,)], "k long"), target)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("k"))
    try:
        replace_table(broken, target)
        raise AssertionError("the replace should fail")
    except Exception as error:
        assert "no" in str(error)
    assert rows(read_target(spark, target)) == [(1,)]
    replace_table(read_target(spark, target).withColumn("k", F.col("k") + 1), os.path.join(scratch, ".", "kept"))
    assert rows(read_target(spark, target)) == [(2,)]


def test_csv_export_keeps_blanks(spark, scratch):
    df = spark.createDataFrame([("  DEC ", 1), ("   ", 2)], "v string, k int")
    path, _ = write_report(df, scratch, "blank", BusinessDate(dt.date(2024, 3, 1)))
    assert sorted(rows(spark.read.option("header", True).csv(path), "v")) == [("   ",), ("  DEC ",)]
