import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from recordloom.functions import cleaning as C

TS = dt.datetime


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_price(spark):
    got = apply(spark, C.parse_price, ["$29.99", "1,299.99", " 12.5 ", "", None, "  ", "abc", "12d", "-3", "1_000", "$"])
    assert got == [29.99, 1299.99, 12.5, 0.0, 0.0, 0.0, None, None, -3.0, 1000.0, 0.0]


def test_price_special_numbers(spark):
    got = apply(spark, C.parse_price, ["nan", "Infinity"])
    assert math.isnan(got[0]) and got[1] == math.inf


def test_quantity(spark):
    got = apply(spark, C.parse_quantity, ["", None, "12.7", "-0.5", "-3", "x", "1e2", " 4 "])
    assert got == [0, 0, 12, 0, -3, None, 100, 4]


def test_integer_text(spark):
    assert apply(spark, C.to_bigint, ["1", "1.0", "1.5", "x", " 7 ", "-2", None]) == [1, 1, None, None, 7, -2, None]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-15T10:30:00Z", TS(2024, 1, 15, 10, 30)),
        ("2024-01-15T10:30:00+02:00", TS(2024, 1, 15, 8, 30)),
        ("2024-01-15", TS(2024, 1, 15)),
        ("20240115", TS(2024, 1, 15)),
        ("20240115T103000Z", TS(2024, 1, 15, 10, 30)),
        ("2024-01-15 10:30:00,5", TS(2024, 1, 15, 10, 30, 0, 500000)),
        ("2024-13-45", None),
        ("2024", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_iso_timestamp(spark, text, expected):
    assert apply(spark, C.iso_timestamp, [text]) == [expected]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Mon, 01 Jan 2024 12:00:00 GMT", TS(2024, 1, 1, 12)),
        ("Tue, 2 Jan 2024 12:00:00 +0200", TS(2024, 1, 2, 10)),
        ("03 Jan 2024 12:00:00", TS(2024, 1, 3, 12)),
        ("2024-01-15T10:30:00Z", TS(2024, 1, 15, 10, 30)),
        ("", None),
        ("n/a", None),
    ],
)
def test_mail_timestamp(spark, text, expected):
    assert apply(spark, C.mail_or_iso_timestamp, [text]) == [expected]


def test_strict_timestamp(spark):
    got = apply(spark, C.strict_timestamp, ["1705276800", "1705276800000", "2024-01-15", "", "yesterday"])
    assert got == [TS(2024, 1, 15), TS(2024, 1, 15), TS(2024, 1, 15), None, None]


def test_clean_string(spark):
    assert apply(spark, C.clean_string, ["  Test Title  ", "\tx\n", None, " "]) == ["Test Title", "x", "", ""]


def test_short_mail_dates(spark):
    rows = [("Tue, 05 Mar 24 07:08 GMT", 1709622480), ("5 Mar 2024 07:08", 1709622480), ("05 Mar 75 07:08:09 GMT", 163235289), ("05 Mar 2024 07:08:09 +0100", 1709618889)]
    df = spark.createDataFrame(rows, "s string, at long")
    assert [r[0] for r in df.select(F.unix_timestamp(C.mail_or_iso_timestamp(F.col("s")))).collect()] == [a for _, a in rows]
