import datetime as dt

from pyspark.sql import functions as F

from cardflow.operators import joins as J
from cardflow.operators.ranking import latest_per_key, pg_asc, pg_desc, row_number
from cardflow.operators.sets import distinct_rows, union_distinct
from cardflow.operators.sorting import sort_report
from cardflow.operators.temporal import effective_on
from conftest import rows

D0, D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def test_effective_on_inclusive_and_null_bounds(spark):
    df = spark.createDataFrame(
        [(1, D0, D1), (2, D1, D1), (3, D2, D2), (4, None, D2), (5, D0, None)], "k int, f date, t date")
    assert sorted(rows(effective_on(df, D1, "f", "t"), "k")) == [(1,), (2,)]


def test_exclude_listed_null_aware(spark):
    probe = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    listing = spark.createDataFrame([(2,)], "x long")
    with_null = spark.createDataFrame([(2,), (None,)], "x long")
    empty = spark.createDataFrame([], "x long")
    assert rows(J.exclude_listed(probe, "k", listing, "x")) == [(1,)]
    assert rows(J.exclude_listed(probe, "k", with_null, "x")) == []
    assert sorted(rows(J.exclude_listed(probe, "k", empty, "x")), key=str) == [(1,), (2,), (None,)]


def test_exclude_listed_matches_sql_not_in(spark):
    probe = spark.createDataFrame([(i,) for i in range(20)] + [(None,)], "k long")
    listing = spark.createDataFrame([(i,) for i in range(0, 20, 3)], "x long")
    probe.createOrReplaceTempView("probe_v")
    listing.createOrReplaceTempView("listing_v")
    expected = sorted(rows(spark.sql("SELECT k FROM probe_v WHERE k NOT IN (SELECT x FROM listing_v)")))
    assert sorted(rows(J.exclude_listed(probe, "k", listing, "x"))) == expected


def test_anti_join_ignores_null_keys(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    b = spark.createDataFrame([(2,), (None,)], "k long")
    assert sorted(rows(J.anti_join(a, b, "k")), key=str) == [(1,), (None,)]


def test_latest_per_key_nulls_first_and_tiebreak(spark):
    df = spark.createDataFrame(
        [(1, D0, "a"), (1, None, "b"), (1, D2, "c"), (2, D1, "z"), (2, D1, "y"), (3, None, None)],
        "k int, d date, v string")
    out = sorted(rows(latest_per_key(df, ["k"], [pg_desc("d"), pg_asc("v")]), "k", "v"))
    assert out == [(1, "b"), (2, "y"), (3, None)]


def test_row_number_pg_order(spark):
    df = spark.createDataFrame([(1, D0), (1, None), (1, D1)], "k int, d date")
    out = rows(df.select("d", row_number(["k"], [pg_desc("d")]).alias("rn")).orderBy("rn"))
    assert out == [(None, 1), (D1, 2), (D0, 3)]


def test_left_join_effective_and_latest(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    b = spark.createDataFrame([(1, "old", D0, D0), (1, "cur", D0, D2), (2, "gone", D0, D0)],
                              "k int, v string, efftv_from_dt date, efftv_to_dt date")
    assert sorted(rows(J.left_join_effective(a, b, "k", D1), "k", "v")) == [(1, "cur"), (2, None), (3, None)]
    c = spark.createDataFrame([(1, D0, "x"), (1, D1, "y")], "k int, d date, v string")
    assert sorted(rows(J.left_join_latest(a, c, ["k"], [pg_desc("d")]), "k", "v"), key=str) == [
        (1, "y"), (2, None), (3, None)]


def test_decode_join_matches_decode(spark):
    df = spark.createDataFrame([("A",), ("Q",), (None,)], "c string")
    out = J.decode_join(df, "c", {"A": "alpha"}, "label", "ERROR")
    assert sorted(rows(out, "c", "label"), key=str) == [("A", "alpha"), ("Q", "ERROR"), (None, "ERROR")]


def test_union_distinct_positional(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (None, None)], "app_num long, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (None, None)], "appl_id long, w string")
    out = union_distinct(a, b)
    assert out.columns == ["app_num", "v"]
    assert sorted(rows(out), key=str) == [(1, "x"), (2, "y"), (None, None)]
    assert sorted(rows(distinct_rows(a)), key=str) == [(1, "x"), (None, None)]


def test_sort_report_nulls_last_and_hidden_key(spark):
    df = spark.createDataFrame([(None, 1, "a"), (2, 0, "b"), (1, 5, "c"), (1, 2, "d")], "k int, hidden int, v string")
    out = sort_report(df, ["k", "hidden"], ["k", "v"])
    assert out.columns == ["k", "v"]
    assert rows(out) == [(1, "d"), (1, "c"), (2, "b"), (None, "a")]


def test_inner_join_on_text_cast_key(spark):
    a = spark.createDataFrame([("10", "x"), ("11", "y")], "code string, v string")
    b = spark.createDataFrame([(10, "ten")], "n int, name string")
    out = J.inner_join(a, b, a["code"] == b["n"].cast("string"))
    assert rows(out, "v", "name") == [("x", "ten")]


def test_overlay_reuses_key(spark):
    spine = spark.createDataFrame([(1,), (2,)], "k int")
    p = spark.createDataFrame([(1, "p1")], "k int, pv string")
    s = spark.createDataFrame([(1, "s1"), (2, "s2")], "k int, sv string")
    out = J.overlay(spine, p, s, ["k"]).select("k", F.coalesce("pv", "sv").alias("v"))
    assert sorted(rows(out)) == [(1, "p1"), (2, "s2")]


def test_left_join_many_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n"), (4, "d")], "k long, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (1, "y"), (2, None), (3, "z")], "k long, r string")
    want = sorted(rows(left.join(right, "k", "left").select("k", "l", "r")), key=str)
    got = J.left_join_many(left, right, ["k"])
    assert got.columns == ["k", "l", "r"]
    assert sorted(rows(got.select("k", "l", "r")), key=str) == want


def test_with_row_number_matches_window_under_a_hot_key(spark):
    from cardflow.operators.ranking import with_row_number

    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") < n // 3, F.lit(None)).when(F.col("id") < 2 * n // 3, F.lit(7)).otherwise(F.col("id") % 50)
        .alias("k"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 97).alias("d"),
        F.col("id"))
    order = [pg_desc("d"), pg_asc("id")]
    want = sorted(rows(df.withColumn("rn", row_number(["k"], order)), "id", "rn"))
    got = with_row_number(df, ["k"], order, "rn", num_partitions=7)
    assert got.columns == ["k", "d", "id", "rn"]
    assert sorted(rows(got, "id", "rn")) == want


SHUFFLE_JOIN_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                     "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                     "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def partitions_holding(spark, df, cond):
    """Number of shuffle partitions holding rows matching ``cond`` when joins must shuffle."""
    old = {k: spark.conf.get(k, None) for k in SHUFFLE_JOIN_CONF}
    try:
        for k, v in SHUFFLE_JOIN_CONF.items():
            spark.conf.set(k, v)
        return df.filter(cond).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_salted_join_equals_join_and_spreads_a_hot_key(spark):
    from cardflow.operators.skew import hot_keys, salted_join

    n = 6000
    big = spark.range(n).select(
        F.when(F.col("id") < n // 3, F.lit(7)).when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.col("id"))
        .alias("k"), F.col("id").alias("v"))
    small = spark.createDataFrame([(7, "hot"), (7, "hot2"), (10, "ten"), (None, "null")], "k long, s string")
    hot = hot_keys(big, ["k"], max_keys=10, min_rows=100)
    assert rows(hot) == [(7,)]
    assert hot_keys(big.filter("k <> 7"), ["k"], max_keys=10, min_rows=100) is None
    for how in ("inner", "left"):
        want = sorted(rows(big.join(small, "k", how)), key=repr)
        got = salted_join(big, small, ["k"], how, hot=hot, salts=8)
        assert got.columns == ["k", "v", "s"]
        assert sorted(rows(got), key=repr) == want
    # the hot key's rows land in several shuffle partitions of the join (a plain join: one)
    assert partitions_holding(spark, salted_join(big, small, ["k"], "inner", hot=hot, salts=8), "k = 7") > 1
    assert partitions_holding(spark, big.join(small, "k", "inner"), "k = 7") == 1


def test_left_join_many_salts_a_hot_key_after_another_join(spark):
    from cardflow.operators.skew import hot_keys

    n = 6000
    spine = spark.range(n).select(F.col("id").alias("k"))
    first = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 2).alias("a"))
    right = spark.range(n).select(F.when(F.col("id") < n // 3, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                  F.col("id").alias("b"))
    left = spine.join(first, "k", "left")  # the left input comes out of a join, not a shuffle
    hot = hot_keys(right.select("k"), ["k"], max_keys=10, min_rows=100)
    got = J.left_join_many(left, right, ["k"], hot=hot)
    want = left.join(right, "k", "left")
    assert sorted(rows(got), key=repr) == sorted(rows(want.select(*got.columns)), key=repr)
    assert partitions_holding(spark, got, "k = 7") > 1
    assert partitions_holding(spark, J.left_join_many(left, right, ["k"], hot=None), "k = 7") == 1


def test_row_number_with_payload_and_a_hot_key(spark):
    from cardflow.operators.ranking import row_number, with_row_number

    df = spark.range(60_000).select((F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 97)).alias("k"), "id",
                                    F.concat(F.lit("payload"), F.col("id")).alias("p"))
    got = with_row_number(df, ["k"], [F.col("id").desc_nulls_first()], "rn", num_partitions=8).select("id", "rn")
    want = df.withColumn("want", row_number(["k"], [F.col("id").desc_nulls_first()])).select("id", "want")
    assert got.join(want, "id").filter("rn <> want").count() == 0


def test_salted_join_spreads_identical_rows_and_null_keys(spark):
    from cardflow.operators.skew import salted_join

    big = spark.range(4000).select(F.when(F.col("id") < 2000, 7).cast("long").alias("k"), F.lit("x").alias("v"))
    small = spark.createDataFrame([(7, "a")], "k long, w string")
    hot = spark.createDataFrame([(7,)], "k long")
    got = salted_join(big, small, ["k"], "left", hot=hot, salts=8)
    assert got.count() == 4000 and got.filter("w = 'a'").count() == 2000


def test_salts_stay_when_the_big_side_is_read_in_another_order(spark):
    """As after a lost executor: the rows come back in another order, and must keep their join task."""
    import numpy as np

    from cardflow.operators.skew import salted_join

    def reordered(frames):
        for f in frames:
            yield f.iloc[np.random.default_rng().permutation(len(f))]

    big = spark.range(0, 2000, 1, 2).selectExpr("cast(7 as long) k", "id v").mapInPandas(reordered, "k long, v long")
    small = spark.createDataFrame([(7, "a")], "k long, w string")
    hot = spark.createDataFrame([(7,)], "k long")
    old = {k: spark.conf.get(k, None) for k in SHUFFLE_JOIN_CONF}
    try:
        for k, v in SHUFFLE_JOIN_CONF.items():
            spark.conf.set(k, v)
        got = salted_join(big, small, ["k"], "inner", hot=hot, salts=8).select("v", F.spark_partition_id().alias("p"))
        first, again = dict(rows(got, "v", "p")), dict(rows(got, "v", "p"))  # two plans, each reads the rows anew
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(first) == 2000 and len(set(first.values())) > 1
    assert first == again
