"""Property tests: the skew-safe operators equal their plain Spark counterparts on random data."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cardflow.operators import joins as J
from cardflow.operators.ranking import pg_asc, pg_desc, row_number, with_row_number
from conftest import rows

keys = st.one_of(st.none(), st.integers(min_value=0, max_value=4))
vals = st.one_of(st.none(), st.integers(min_value=0, max_value=3))
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(left=st.lists(st.tuples(keys, vals), max_size=12), right=st.lists(st.tuples(keys, vals), max_size=12))
def test_left_join_many_is_left_join(spark, left, right):
    a = spark.createDataFrame(left, "k int, a int")
    b = spark.createDataFrame(right, "k int, b int")
    want = sorted(rows(a.join(b, "k", "left")), key=repr)
    assert sorted(rows(J.left_join_many(a, b, ["k"])), key=repr) == want


@SETTINGS
@given(probe=st.lists(keys, max_size=10), listing=st.lists(keys, max_size=6))
def test_exclude_listed_is_not_in(spark, probe, listing):
    p = spark.createDataFrame([(k,) for k in probe], "k int")
    ls = spark.createDataFrame([(k,) for k in listing], "x int")
    p.createOrReplaceTempView("prop_probe")
    ls.createOrReplaceTempView("prop_listing")
    want = sorted(rows(spark.sql("SELECT k FROM prop_probe WHERE k NOT IN (SELECT x FROM prop_listing)")), key=repr)
    assert sorted(rows(J.exclude_listed(p, "k", ls, "x")), key=repr) == want


@SETTINGS
@given(data=st.lists(st.tuples(keys, vals), min_size=1, max_size=25), parts=st.integers(min_value=1, max_value=5))
def test_with_row_number_is_window(spark, data, parts):
    df = spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(data)], "k int, v int, id int")
    order = [pg_desc("v"), pg_asc("id")]
    want = sorted(rows(df.withColumn("rn", row_number(["k"], order)), "id", "rn"))
    assert sorted(rows(with_row_number(df, ["k"], order, "rn", num_partitions=parts), "id", "rn")) == want
