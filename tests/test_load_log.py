"""The load log: crashes at every step, doubled loads, several loads of a date, stored key bitmaps."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cardflow.operators.membership import key_bitmap, may_match, unseen_rows
from cardflow.sinks.load_log import LoadLog, StoredMembers, batch_id, load_once
from cardflow.sinks.tables import append_rows
from conftest import rows

DAY = dt.date(2024, 1, 1)
COLUMNS = ["k", "v", "data_load_dt"]


def batch(spark, *keys):
    return spark.createDataFrame([(k, f"v{k}") for k in keys], "k long, v string")


def held(spark, target):
    return sorted(r["k"] for r in spark.read.parquet(target).collect())


def load(spark, target, load_id, *keys):
    return sorted(r["k"] for r in load_once(batch(spark, *keys), target, ["k"], COLUMNS, DAY, load_id).collect())


def test_doubled_and_overlapping_loads(spark, scratch):
    target = os.path.join(scratch, "t")
    assert load(spark, target, "a", 1, 2, 2) == [1, 2, 2]  # duplicates of a batch stay
    assert load(spark, target, "a", 1, 2, 2) == [1, 2, 2]
    assert load(spark, target, "b", 2, 3) == [3]  # the second load of the date returns its own rows only
    assert load(spark, target, "a", 9) == [1, 2, 2]  # an id that is done only reports
    assert held(spark, target) == [1, 2, 2, 3]
    log = LoadLog(spark, target).loads()
    assert {k: (v.state, v.rows, v.load_date) for k, v in log.items()} == {
        "a": ("done", 3, "2024-01-01"), "b": ("done", 1, "2024-01-01")}


def test_crash_before_the_entry_is_computed_anew(spark, scratch):
    target = os.path.join(scratch, "t")
    load(spark, target, "a", 1)
    batch(spark, 7, 8).write.parquet(f"{target}/_loads/b")  # rows of a load that never got its entry
    assert held(spark, target) == [1]
    assert load(spark, target, "b", 1, 2) == [2]
    assert held(spark, target) == [1, 2]


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_crash_while_publishing_is_rolled_forward(spark, scratch, moved):
    target = os.path.join(scratch, "t")
    load(spark, target, "a", 1)
    log = LoadLog(spark, target)
    rows_b = batch(spark, 2, 3, 4).withColumn("data_load_dt", F.lit(DAY)).repartitionByRange(3, "k")
    log.stage(rows_b, "b", DAY)
    log.publish("b", most=moved)
    assert sorted(r["k"] for r in log.committed().collect()) == [1]  # half a load isn't part of the history
    assert load(spark, target, "c", 3, 4, 5) == [5]  # whoever loads next finishes it first
    assert load(spark, target, "b", 2, 3, 4, 6) == [2, 3, 4]
    assert held(spark, target) == [1, 2, 3, 4, 5]
    assert log.recover() == []


def test_load_into_rows_that_came_otherwise(spark, scratch):
    target = os.path.join(scratch, "t")
    append_rows(batch(spark, 1, 2).withColumn("data_load_dt", F.lit(DAY)), target, COLUMNS)
    assert load(spark, target, "a", 2, 3) == [3]
    append_rows(batch(spark, 4).withColumn("data_load_dt", F.lit(DAY)), target, COLUMNS)
    members = StoredMembers(LoadLog(spark, target), ["k"])
    assert members.read() is None  # the stored bitmap hasn't seen the appended row
    assert load(spark, target, "b", 4, 5) == [5]
    assert members.read() is not None and load(spark, target, "c", 3, 4, 5, 6) == [6]
    assert load(spark, target, "none") == []
    assert held(spark, target) == [1, 2, 3, 4, 5, 6]


def test_partitioned_catalog_table(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS cardflow_loads LOCATION '{scratch}/db'")
    name = "cardflow_loads.history"
    spark.sql(f"CREATE TABLE {name} (k BIGINT, v STRING, data_load_dt DATE) USING parquet PARTITIONED BY (data_load_dt)")
    for load_id, keys, new in (("a", (1, 2), [1, 2]), ("a", (1, 2), [1, 2]), ("b", (2, 3), [3])):
        assert load(spark, name, load_id, *keys) == new
    assert sorted(rows(spark.table(name))) == [(1, "v1", DAY), (2, "v2", DAY), (3, "v3", DAY)]
    spark.sql(f"DROP TABLE {name}")


def test_ids(spark, scratch):
    a, b = batch(spark, 1, 2, 3), batch(spark, 3, 1, 2)
    assert batch_id(a, DAY) == batch_id(b, DAY) != batch_id(batch(spark, 1, 2, 2), DAY)
    assert batch_id(a, DAY) != batch_id(a, dt.date(2024, 1, 2))
    with pytest.raises(ValueError):
        LoadLog(spark, os.path.join(scratch, "t")).stage(a, "../x")


def test_unseen_rows_equal_the_anti_join(spark):
    make = lambda ks: spark.createDataFrame([(k, str(k)) for k in ks], "k long, s string")
    new, old = make([None, 1, 1, 2, 50, 60]), make([None, 2, 2, 50, *range(100, 3000)])
    want = sorted(rows(new.join(old.select("k").distinct(), "k", "left_anti")), key=repr)
    for members in (None, key_bitmap(old, ["k"])):
        assert sorted(rows(unseen_rows(new, old, ["k"], members).select("k", "s")), key=repr) == want
    assert may_match(old, new, ["k"]).count() < 20  # most of the history stays where it is scanned
    other = old.withColumn("k", F.col("k").cast("int"))  # another type has other hashes: joined plainly
    assert sorted(rows(unseen_rows(new, other, ["k"], key_bitmap(other, ["k"])).select("k", "s")), key=repr) == want


def test_history_is_filtered_before_its_shuffle(spark, scratch):
    """What reaches the history's exchange are rows that may match, not the history."""
    old = spark.range(200_000).withColumnRenamed("id", "k")
    old.write.parquet(f"{scratch}/old")
    new = spark.createDataFrame([(5,), (300_000,)], "k long")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = unseen_rows(new, spark.read.parquet(f"{scratch}/old"), ["k"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        scan = plan.index("FileScan")
        between = plan[:scan][plan[:scan].rindex("Exchange"):]
        assert "getbit" in between and rows(joined) == [(300_000,)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
