"""Column functions: the reference's unit cases for normalisation plus the other scalar functions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from runway.functions import expr as X


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


@pytest.mark.parametrize("raw,code", [
    ("sheremetyevo", "SVO"), ("SVO", "SVO"), ("svo", "SVO"),
    ("pulkovo", "LED"), ("LED", "LED"), ("led", "LED"),
    ("domodedovo", "DME"), ("DME", "DME"),
    (" Koltsovo\t", "SVX"), ("zzz", "ZZZ"), ("ufa", "UFA"),
])
def test_normalize_airport(spark, raw, code):
    assert one_col(spark, [raw], X.normalize_airport) == [code]


def test_normalize_airport_null(spark):
    assert one_col(spark, [None], X.normalize_airport) == [None]


@pytest.mark.parametrize("raw,flight", [
    ("SU101", "SU101"), ("su101", "SU101"), ("SU 101", "SU101"), ("su 102", "SU102"),
    ("SU  101", "SU101"), (" SU 101 ", "SU101"), ("Su101", "SU101"), ("sU102", "SU102"),
])
def test_normalize_flight_number(spark, raw, flight):
    assert one_col(spark, [raw], X.normalize_flight_number) == [flight]


def test_normalize_flight_number_null(spark):
    assert one_col(spark, [None], X.normalize_flight_number) == [None]


def test_case_and_trim(spark):
    assert one_col(spark, [" CONFIRMED\n", None], X.lower_trim) == ["confirmed", None]
    assert one_col(spark, ["rub ", "Rub"], X.upper_trim) == ["RUB", "RUB"]


def test_remap_or_self(spark):
    assert one_col(spark, ["repair", "washing", None], X.remap_or_self) == ["repair", "washing", None]


def test_safe_parsers(spark):
    ts = one_col(spark, ["2024-01-15 10:00:00", "2024-01-15T09:00:00Z", "nope"], X.safe_timestamp)
    assert ts[0] == datetime(2024, 1, 15, 10, 0) and ts[1] == datetime(2024, 1, 15, 9, 0) and ts[2] is None
    assert one_col(spark, ["12.5", "n/a", None], X.safe_double) == [12.5, None, None]
    assert one_col(spark, ["2024-03-01", "bad"], X.safe_date) == [date(2024, 3, 1), None]


def test_calendar(spark):
    df = spark.createDataFrame([(date(2024, 1, 13),), (date(2024, 3, 4),)], "d date")
    rows = df.select(*[c.alias(n) for n, c in X.calendar_columns("d").items()]).orderBy("date_id").collect()
    sat, mon = rows
    assert sat.date_id == 20240113 and sat.day_of_week == 5 and sat.is_weekend and sat.day_name == "Saturday"
    assert mon.quarter == 1 and mon.month_name == "March" and not mon.is_weekend and mon.day_of_week == 0


def test_delays(spark):
    df = spark.createDataFrame([
        (datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 10, 15, 59)),
        (datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 9, 55)),
        (datetime(2024, 1, 1, 10, 0), None),
    ], "s timestamp_ntz, a timestamp_ntz")
    got = df.select(X.delay_minutes("s", "a").alias("d"), X.signed_delay_minutes("s", "a").alias("x")).collect()
    assert [r.d for r in got] == [15, 0, None]
    assert abs(got[0].x - 15.983333) < 1e-5 and got[1].x == -5.0 and got[2].x is None


def test_percent_text_and_default(spark):
    df = spark.createDataFrame([(1, 8), (5, 8), (None, 8)], "p long, w long")
    got = df.select(X.percent_text("p", "w").alias("t"), X.default_if_null("p", 0).alias("d")).collect()
    assert [r.t for r in got[:2]] == ["12.5%", "62.5%"]
    assert got[2].d == 0


def test_day_names_ru(spark):
    assert one_col(spark, [date(2024, 1, 15)], X.day_name_ru, "date") == ["Понедельник"]


def test_null_count(spark):
    df = spark.createDataFrame([(None, float("nan"), "a"), (1, 2.0, None)], "a int, b double, c string")
    got = df.select(X.null_count(["a", "b", "c"], {"b"}).alias("n")).collect()
    assert [r.n for r in got] == [2, 1]


def test_written_forms_of_times(spark):
    texts = ["2024-02-01T09:05:00Z", " 2024-02-01 09:05 ", "01.02.2024 9:05", "2/1/2024 09:05:00", "2024/2/1 9:05", "20240201 090500", "1 Feb 2024 9:05",
             "Feb 1, 2024 9:05"]
    got = one_col(spark, texts, lambda c: X.safe_timestamp(c).cast("timestamp_ntz"))
    assert {str(x) for x in got} == {"2024-02-01 09:05:00"}
    assert one_col(spark, ["", "32.01.2024", "13/13/2024", "soon", None, "20241", "09:05:00"], lambda c: X.safe_timestamp(c).cast("string")) == [None] * 7
    assert [str(x) for x in one_col(spark, ["1.2.2024", "2/1/2024", "20240201"], X.safe_date)] == ["2024-02-01"] * 3


def test_strip_any_white_space(spark):
    assert one_col(spark, ["\t a b \u00a0\n", "\u2003x\u3000", "", None], X.strip_ws) == ["a b", "x", "", None]
