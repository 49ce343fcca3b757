"""Heavy keys in two steps, lazy exclusion, export order and manifests, planned reads, clustered and bucketed tables."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from cardflow.functions.dates import BusinessDate
from cardflow.operators import joins as J
from cardflow.operators.ranking import latest_per_key
from cardflow.operators.skew import BUCKETS, hot_keys, salted_join
from cardflow.operators.sorting import exported_positions, sort_report
from cardflow.sinks.tables import export_with_manifest, verify_export, write_report
from cardflow.sources.clustered import files_between, read_between, write_bucketed, write_clustered
from cardflow.sources.splits import split_points, split_predicates
from conftest import rows

BD = BusinessDate(dt.date(2024, 3, 16))


def plain_hot_keys(df, keys, max_keys, min_rows):
    held = df.dropna(subset=keys).groupBy(*keys).count().collect()
    threshold = max(min_rows, -(-sum(r["count"] for r in held) // max_keys))
    return sorted(tuple(r[k] for k in keys) for r in held if r["count"] > threshold)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_heavy_keys_equal_counts_by_key(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice([None, 1, 1, 2, 3, rng.randrange(1000)]), rng.choice(["a", "b"])) for _ in range(3000)]
    df = spark.createDataFrame(data, "k long, s string")
    for keys, max_keys in ((["k"], 10), (["k", "s"], 10), (["k"], 3), (["s"], 2)):
        want = plain_hot_keys(df, keys, max_keys, 50)
        found = hot_keys(df, keys, max_keys, 50)
        assert (sorted(rows(found)) if found is not None else []) == want
    assert hot_keys(df.limit(0), ["k"]) is None


def test_heavy_buckets_without_a_heavy_key(spark):
    """Several keys of one bucket make it heavy; none of them is hot."""
    bucket = F.pmod(F.xxhash64("id"), F.lit(BUCKETS))
    same = spark.range(400_000).withColumn("b", bucket).filter("b = 7").select(F.col("id").alias("k"))
    df = same.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20)))).select("k")
    assert df.select("k").distinct().count() > 1
    assert hot_keys(df, ["k"], max_keys=1000, min_rows=25) is None


def test_heavy_keys_shuffle_buckets_not_keys(spark):
    """What one step exchanges is bounded by the buckets; the other sees rows of heavy buckets only."""
    df = spark.range(50_000).select(F.when(F.col("id") < 20_000, -1).otherwise(F.col("id")).alias("k"))
    plan = hot_keys(df, ["k"], max_keys=10, min_rows=100)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange"):]
    assert "Filter" in below and "xxhash64" in below


def test_salted_join_writes_hot_rows_only(spark):
    big = spark.range(5000).select(F.when(F.col("id") < 2000, 7).when(F.col("id") < 2100, F.lit(None)).otherwise(F.col("id")).alias("k"),
                                   F.col("id").alias("v"))
    small = spark.createDataFrame([(7, "a"), (7, "b"), (2500, "c"), (None, "d")], "k long, w string")
    hot = spark.createDataFrame([(7,)], "k long")
    for how in ("inner", "left"):
        got = salted_join(big, small, ["k"], how, hot=hot)
        assert sorted(rows(got), key=repr) == sorted(rows(big.join(small, "k", how)), key=repr)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Range (0, 5000" in plan  # rows that aren't hot come from their own plan, not from a written copy


def test_exclusion_is_planned_without_a_job(spark):
    probe = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    tracker, group = spark.sparkContext.statusTracker(), "exclusion"
    spark.sparkContext.setJobGroup(group, "building an exclusion")
    try:
        listing = spark.range(2, 5).select(F.col("id").alias("x"))
        frame = J.exclude_listed(probe, "k", listing, "x")
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows(frame) == [(1,)]


def test_exclusion_follows_the_listing(spark, scratch):
    """The same frame, run before and after the listing changes (files of one length, written anew)."""
    place = os.path.join(scratch, "listing.csv")

    def listed(text):
        with open(place, "w") as f:
            f.write(text)

    listed("2,x\n")
    probe = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k long")
    frame = J.exclude_listed(probe, "k", spark.read.schema("x long, pad string").csv(place), "x")
    for text, want in (("2,x\n", [(1,), (3,)]), ("3,x\n", [(1,), (2,)]), (",xx\n", []), ("\n\n\n\n", [(1,), (2,), (3,), (None,)])):
        listed(text)
        assert sorted(rows(frame.select("k")), key=str) == want


def test_positions_of_an_export(spark, scratch):
    df = spark.range(1000).select((F.pmod(F.xxhash64("id"), F.lit(300))).alias("k"), F.when(F.col("id") % 9 > 0, F.col("id")).alias("v"))
    path, n = write_report(sort_report(df.repartition(7), ["k", "v"]), scratch, "sorted", BD, fmt="parquet")
    got = sorted((r["position"], r["k"], r["v"]) for r in exported_positions(spark, path).collect())
    want = sorted(rows(df), key=lambda r: (r[0], r[1] is None, r[1] or 0))
    assert n == 1000 and [p for p, _, _ in got] == list(range(1, 1001))
    assert [(k, v) for _, k, v in got] == want
    empty, _ = write_report(df.limit(0), scratch, "empty", BD, fmt="parquet")
    assert exported_positions(spark, empty).count() == 0


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_manifest_finds_any_change(spark, scratch, fmt):
    df = spark.createDataFrame([(k, f" r{k} ", None if k % 3 else k / 8, dt.date(2024, 1, 1)) for k in range(50)],
                               "k long, v string, x double, d date")
    path, manifest = export_with_manifest(df, scratch, "report", BD, fmt=fmt)
    assert manifest.name == "report_20240316" and manifest.rows == 50
    assert verify_export(spark, path, df.schema, fmt) == manifest
    again, same = export_with_manifest(df.repartition(5), scratch, "report", BD, fmt=fmt)  # another order, the same digest
    assert (again, same) == (path, manifest)
    leaf = next(n for n in sorted(os.listdir(path)) if n.startswith("part-"))
    os.remove(os.path.join(path, leaf))
    with pytest.raises(ValueError, match="differs from its manifest"):
        verify_export(spark, path, df.schema, fmt)
    _, changed = export_with_manifest(df.withColumn("v", F.when(F.col("k") == 7, "x").otherwise(F.col("v"))), scratch, "report", BD, fmt=fmt)
    assert changed.rows == 50 and changed.row_digest != manifest.row_digest
    assert [c for c in changed.column_digests if changed.column_digests[c] != manifest.column_digests[c]] == ["v"]


@pytest.mark.parametrize("keys", [[None], [5], [None, 1, 1, 1, 1, 1, 2], [*range(1000), *[7] * 500, None, -10**9]])
def test_splits_cover_each_row_once(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    predicates = split_predicates("k", split_points(df, "k", 8))
    later = df.union(spark.createDataFrame([(10**12,), (-10**12,), (None,)], "k long"))  # rows the sketch hasn't seen
    for table in (df, later):
        assert sum(table.filter(p).count() for p in predicates) == table.count()
        assert table.filter(" + ".join(f"cast(coalesce({p}, false) as int)" for p in predicates) + " <> 1").count() == 0
    days = spark.range(100).select(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int")).alias("k"))
    counts = [days.filter(p).count() for p in split_predicates("k", split_points(days, "k", 4))]
    assert sum(counts) == 100 and max(counts) <= 30


def test_clustered_reads_open_few_files(spark, scratch):
    path, day = os.path.join(scratch, "c"), dt.date(2024, 1, 1)
    df = spark.range(4000).select("id", F.when(F.col("id") % 50 > 0, F.date_add(F.lit(day), (F.pmod(F.xxhash64("id"), F.lit(400))).cast("int"))).alias("d"))
    write_clustered(df, path, "d", 20)
    whole = [n for n in os.listdir(path) if n.startswith("part-")]
    low, high = dt.date(2024, 3, 1), dt.date(2024, 3, 15)
    assert 1 <= len(files_between(spark, path, low, high)) <= 3 < len(whole)
    for closed in (True, False):
        want = df.filter((F.col("d") >= low) & ((F.col("d") <= high) if closed else (F.col("d") < high)))
        assert sorted(rows(read_between(spark, path, "d", low, high, closed))) == sorted(rows(want))
    assert read_between(spark, path, "d", dt.date(2030, 1, 1), dt.date(2031, 1, 1)).count() == 0
    assert spark.read.parquet(path).count() == 4000


def test_bucketed_tables_join_without_exchange(spark, scratch):
    a = write_bucketed(spark.range(3000).select(F.col("id").alias("k")), f"{scratch}/a", ["k"], 6)
    b = write_bucketed(spark.range(9000).select((F.col("id") % 2000).alias("k"), "id"), f"{scratch}/b", ["k"], 6)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        top = latest_per_key(b, ["k"], [F.col("id").desc_nulls_last()]).withColumnRenamed("id", "top")
        out = J.overlay(a, top, b, ["k"])
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 9000 + 1000 and out.filter("top is null").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
