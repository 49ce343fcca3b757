"""The summary job with one application id holding a third of the legacy rows."""

import contextlib
import io

from pyspark.sql import functions as F

from cardflow.operators.joins import exclude_listed
from cardflow.operators.sets import distinct_rows
from cardflow.plans import application_summary as S
from cardflow.registry.driver_inputs import BD_SUMMARY, SUMMARY_RULES
from cardflow.registry.report_checks import summary_inputs

SF = "/root/testdata/sf0.01"
HOT = 7

SKEW_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}


def _hot(df, col, share_below):
    return df.withColumn(col, F.when(F.col(col) < share_below, F.lit(HOT)).otherwise(F.col(col)))


def plain_summary(inputs):
    """The same rows written the direct way: plain left joins, DISTINCT at the end."""
    bd, r = BD_SUMMARY, SUMMARY_RULES
    spine = exclude_listed(S.application_spine(inputs["legacy_app"], inputs["app"], bd, r), "appl_id",
                           inputs["excluded_app"], "app_num")
    ta = S._prefixed(S.legacy_source(inputs["legacy_app"], inputs["legacy_element"], inputs["legacy_override"], r),
                     "ta_", S.SOURCE_FIELDS)
    cur = S._prefixed(S.current_source(inputs["app"], inputs["app_decision"], inputs["app_element"],
                                       inputs["app_user_data"], inputs["app_transfer"], inputs["app_account"],
                                       inputs["account_custom"], bd, hot_min_rows=None),
                      "cur_", S.SOURCE_FIELDS + ["inst_cr"])
    return distinct_rows(S._overlay(spine.join(cur, "appl_id", "left").join(ta, "appl_id", "left"), r))


def test_summary_with_a_hot_application_id(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        inputs = dict(summary_inputs(spark, SF))
        n_orders = 15000  # sf0.01: a third of the order keys become one application id
        inputs["legacy_app"] = _hot(inputs["legacy_app"], "app_num", n_orders // 3)
        inputs["legacy_element"] = _hot(inputs["legacy_element"], "app_num", n_orders // 3)
        # a third of the transfer rows point at one account, which has custom data
        inputs["app_transfer"] = inputs["app_transfer"].withColumn(
            "acct_id", F.when(F.col("appl_id") < n_orders // 3, F.lit(HOT)).otherwise(F.col("acct_id")))
        legacy = inputs["legacy_app"]
        share = legacy.filter(F.col("app_num") == HOT).count() / legacy.count()
        assert share > 0.3
        from cardflow.operators.skew import hot_keys

        legacy_ids = S.legacy_rows(legacy).select("app_num")
        assert [r[0] for r in hot_keys(legacy_ids, ["app_num"], min_rows=500).collect()] == [HOT]
        out = S.daily_application_summary(inputs, BD_SUMMARY, SUMMARY_RULES, hot_min_rows=500, salts=8)
        got = sorted((tuple(r) for r in out.collect()), key=repr)
        want = sorted((tuple(r) for r in plain_summary(inputs).collect()), key=repr)
        assert got == want
        assert len({r[0] for r in got if r[0] == HOT}) == 1
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            out.explain()
        # the legacy joins and the matched join are salted by a hash of the row
        # the legacy joins, the matched join and the transfer-account lookup are salted
        assert buf.getvalue().count("xxhash64") >= 4
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
