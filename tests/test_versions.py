"""Gapless replaces, and the summary refreshed for changed ids."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from cardflow.functions.dates import BusinessDate
from cardflow.plans.application_summary import daily_application_summary
from cardflow.plans.summary_refresh import application_digests, changed_ids, refresh_summary
from cardflow.registry.driver_inputs import BD_SUMMARY, SUMMARY_RULES
from cardflow.registry.report_checks import day_before, summary_inputs
from cardflow.sinks.tables import read_target
from cardflow.sinks.versions import Versions, replace_table_version, replace_version
from conftest import rows

SF = "/root/testdata/sf0.001"


def numbered(spark, n, size=40):
    return spark.range(size).select(F.lit(n).alias("version"), "id")


def test_reader_throughout_replaces_never_misses_the_table(spark, scratch):
    target = os.path.join(scratch, "t")
    replace_version(numbered(spark, 0), target)
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                got = {(r["version"], r["n"]) for r in read_target(spark, target).groupBy("version").agg(
                    F.count(F.lit(1)).alias("n")).collect()}
                seen.append(got)
            except Exception as error:  # a missing table or file is what the test looks for
                errors.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 6):
        replace_version(numbered(spark, n), target)
    stop.set()
    reader.join()
    assert not errors and len(seen) > 1
    assert all(len(s) == 1 and next(iter(s))[1] == 40 for s in seen)  # whole versions only
    order = [next(iter(s))[0] for s in seen]
    assert order == sorted(order)


def test_old_versions_stay_for_running_readers(spark, scratch):
    target = os.path.join(scratch, "t")
    replace_version(numbered(spark, 1), target)
    running = read_target(spark, target)
    replace_version(running.withColumn("version", F.col("version") + 1), target)  # reads its own target
    replace_version(numbered(spark, 3), target)
    assert running.count() == 40 and {r["version"] for r in running.collect()} == {1}
    assert {r["version"] for r in read_target(spark, target).collect()} == {3}
    replace_version(numbered(spark, 4), target)
    assert len(Versions(spark, target).pointers()) == 4  # replaced only just now
    replace_version(numbered(spark, 5), target, grace_s=0)
    folders = [n for n in os.listdir(target) if n.startswith("_version-")]
    assert len(folders) == 3 and len(Versions(spark, target).pointers()) == 3


def test_failing_replace_changes_nothing(spark, scratch):
    target = os.path.join(scratch, "t")
    replace_version(numbered(spark, 1), target)
    with pytest.raises(Exception):
        replace_version(spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("k")), target)
    assert {r["version"] for r in read_target(spark, target).collect()} == {1}
    replace_version(spark.range(0), target)  # no rows, other columns
    assert read_target(spark, target).columns == ["id"] and read_target(spark, target).count() == 0


def test_catalog_table_switches_its_location(spark, scratch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS cardflow_versions LOCATION '{scratch}/db'")
    name, place = "cardflow_versions.summary", os.path.join(scratch, "versions")
    replace_table_version(numbered(spark, 1), name, place)
    running = spark.table(name)
    replace_table_version(spark.table(name).withColumn("version", F.col("version") + 1), name, place)
    assert {r["version"] for r in spark.table(name).collect()} == {2}
    assert running.count() == 40
    replace_table_version(spark.range(2), name, place)  # other columns
    assert sorted(rows(spark.table(name))) == [(0,), (1,)]
    spark.sql(f"DROP TABLE {name}")


def test_refresh_recomputes_changed_ids_only(spark, scratch):
    target, inputs = os.path.join(scratch, "summary"), summary_inputs(spark, SF)
    full = sorted(map(repr, rows(daily_application_summary(inputs, BD_SUMMARY, SUMMARY_RULES))))
    notes = lambda: Versions(spark, target).current()["notes"]["changed"]
    refresh_summary(inputs, BD_SUMMARY, SUMMARY_RULES, target)
    assert notes() == -1
    assert sorted(map(repr, rows(refresh_summary(inputs, BD_SUMMARY, SUMMARY_RULES, target)))) == full
    assert notes() == 0
    one = dict(inputs)
    some = inputs["legacy_app"].agg(F.min("app_num")).first()[0]
    one["legacy_app"] = inputs["legacy_app"].withColumn(
        "status_field", F.when(F.col("app_num") == some, "DECLINE").otherwise(F.col("status_field")))
    one["excluded_app"] = inputs["excluded_app"].union(spark.createDataFrame([(some + 1,)], "app_num long"))
    want = sorted(map(repr, rows(daily_application_summary(one, BD_SUMMARY, SUMMARY_RULES))))
    assert sorted(map(repr, rows(refresh_summary(one, BD_SUMMARY, SUMMARY_RULES, target)))) == want
    assert notes() == 2
    null = {**one, "excluded_app": one["excluded_app"].union(spark.createDataFrame([(None,)], "app_num long"))}
    assert refresh_summary(null, BD_SUMMARY, SUMMARY_RULES, target).count() == 0 and notes() == -1


def test_digests_see_dates_and_repeated_rows(spark):
    inputs = summary_inputs(spark, SF)
    today, before = application_digests(inputs, BD_SUMMARY), application_digests(inputs, BusinessDate(BD_SUMMARY.as_of))
    moved = changed_ids(today, before)
    # intervals that begin or end between the two days are changes, though no row is
    edges = inputs["app"].filter("efftv_from_dt <= efftv_to_dt and (efftv_to_dt = date'2000-06-29' or "
                                 "efftv_from_dt = date'2000-06-30')").select("appl_id").distinct()
    assert edges.join(moved, "appl_id", "left_anti").count() == 0 < moved.count() < today.count()
    twice = {**inputs, "app_decision": inputs["app_decision"].union(inputs["app_decision"])}
    ids = inputs["app_decision"].select("appl_id").distinct().count()
    assert changed_ids(application_digests(twice, BD_SUMMARY), today).count() == ids
    assert changed_ids(application_digests(day_before(inputs), BD_SUMMARY), today).count() > ids / 10


def test_digests_leave_out_rows_that_no_source_reads(spark):
    inputs = summary_inputs(spark, SF)
    altered = dict(inputs)
    other = lambda name, column, rows_of: inputs[name].withColumn(
        column, F.when(rows_of, F.lit("ANOTHER")).otherwise(F.col(column)))
    altered["legacy_element"] = other("legacy_element", "alpha_value", F.col("element_name") == "OTHERELEM")
    altered["legacy_override"] = other("legacy_override", "client_prod_code", F.col("ts2_account_id") == 0)
    altered["app_element"] = other("app_element", "ele_alph_val", F.col("ele_elmt_nm") == "OTHER")
    altered["app_transfer"] = other("app_transfer", "clnt_prod_cd", F.col("acct_id") == 0)
    altered["account_custom"] = other("account_custom", "custom_21_data", F.col("acct_seq_num") == 1)
    today = application_digests(inputs, BD_SUMMARY)
    assert today.columns == ["appl_id", "digest"]
    assert changed_ids(application_digests(altered, BD_SUMMARY), today).isEmpty()
    read = {**inputs, "legacy_element": other("legacy_element", "alpha_value", F.trim("element_name") == "CHKINCOME")}
    want = inputs["legacy_element"].filter("trim(element_name) = 'CHKINCOME'").select("app_num").distinct().count()
    assert changed_ids(application_digests(read, BD_SUMMARY), today).count() == want
