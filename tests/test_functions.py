import datetime as dt

from pyspark.sql import functions as F

from cardflow.functions import columns as C
from cardflow.functions import dates as D
from conftest import rows


def test_business_date():
    bd = D.BusinessDate(dt.date(2024, 3, 1))
    assert bd.as_of == dt.date(2024, 2, 29)
    assert bd.month_start == dt.date(2024, 2, 1)
    assert bd.month_key == "2024_02"
    assert bd.stamp("day") == "20240301"
    # monthly report named after the month it covers, even when run on the 1st
    assert bd.stamp("month") == "202402"
    assert D.BusinessDate.for_as_of(dt.date(2024, 2, 29)) == bd


def test_blank_to_null_trims_spaces_only(spark):
    df = spark.createDataFrame([("  a ",), ("   ",), ("",), (None,), ("\t",)], "v string")
    assert rows(df.select(C.blank_to_null("v"))) == [("a",), (None,), (None,), (None,), ("\t",)]


def test_pad_id_cuts_long_values(spark):
    df = spark.createDataFrame([(7,), (123456789012,), (None,)], "v long")
    out = rows(df.select(C.pad_id("v", 11), C.pad_id("v", 4), C.overlong("v", 11)))
    assert out == [("00000000007", "0007", False), ("12345678901", "1234", True), (None, None, None)]


def test_decode_default_and_null(spark):
    df = spark.createDataFrame([("A",), ("B",), ("Z",), (None,)], "v string")
    out = rows(df.select(C.decode("v", {"A": "alpha", "B": "beta"}, "ERROR")))
    assert out == [("alpha",), ("beta",), ("ERROR",), ("ERROR",)]
    assert rows(df.select(C.decode("v", {"A": "alpha"}))) == [("alpha",), (None,), (None,), (None,)]


def test_case_when_first_match_and_null_condition(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "v int")
    rule = C.case_when([(F.col("v") > 3, "big"), (F.col("v") > 0, "small")], "none")
    assert rows(df.select(rule)) == [("small",), ("big",), ("none",)]


def test_newest_wins(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    data = [
        (d1, d1, "p", "s"),     # tie: primary
        (d1, d2, "p", "s"),     # secondary newer
        (d2, d1, None, "s"),    # primary newer but NULL value: falls back
        (None, None, "p", "s"),  # both NULL dates: tie, primary
        (None, d1, "p", None),  # secondary newer, NULL value: falls back to primary
    ]
    df = spark.createDataFrame(data, "pd date, sd date, pv string, sv string")
    out = rows(df.select(C.newest_wins("pd", "sd", "pv", "sv")))
    assert out == [("p",), ("s",), ("s",), ("p",), ("p",)]


def test_flag_prefer_override(spark):
    df = spark.createDataFrame([("x", None, "INTERNET"), (None, "y", "BRANCH")], "a string, b string, ch string")
    out = rows(df.select(C.flag("a", "IC", "NON_IC"), C.prefer("a", "b"),
                         C.override("ch", [(F.col("ch") == "INTERNET", "DEALER")])))
    assert out == [("IC", "x", "DEALER"), ("NON_IC", "y", "BRANCH")]


def test_not_in_values_three_valued(spark):
    df = spark.createDataFrame([("F",), ("O",), (None,)], "s string")
    assert rows(df.select(C.not_in_values("s", ["F"]))) == [(False,), (True,), (None,)]


def test_month_to_date_boundaries(spark):
    bd = D.BusinessDate(dt.date(2024, 3, 16))
    ts = [dt.datetime(2024, 2, 29, 23, 59), dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 15),
          dt.datetime(2024, 3, 15, 10), dt.datetime(2024, 3, 15, 23, 59, 59), dt.datetime(2024, 3, 16)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    half_open = [r[0] for r in df.filter(D.month_to_date("t", bd)).collect()]
    closed = [r[0] for r in df.filter(D.month_to_date("t", bd, closed=True)).collect()]
    assert half_open == ts[1:5]
    assert closed == ts[1:3]


def test_month_key_and_before_day(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 9, 23),), (dt.datetime(2024, 2, 10),)], "t timestamp_ntz")
    assert rows(df.select(D.month_key("t"), D.day("t"), D.month_start("t"))) == [
        ("2024_02", dt.date(2024, 2, 9), dt.date(2024, 2, 1)), ("2024_02", dt.date(2024, 2, 10), dt.date(2024, 2, 1))]
    assert rows(df.filter(D.before_day("t", dt.date(2024, 2, 10)))) == [(dt.datetime(2024, 2, 9, 23),)]
