"""Scalar functions (F1–F18) and the natural keys (G1, G2) on literal rows."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from appmart import functions as fn
from appmart.functions.keys import app_user_key, campaign_key, day_text_from_date, day_text_from_ts


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def md5(text: str) -> str:
    return hashlib.md5(text.encode("utf-8")).hexdigest()


def test_ifnull_empty(spark):
    assert one(spark, fn.ifnull_empty, None) == ""
    assert one(spark, fn.ifnull_empty, "a") == "a"


def test_lower(spark):
    assert one(spark, fn.lower, "Com.App") == "com.app"


@pytest.mark.parametrize("text,expected", [
    ("a  b", "a b"),
    ("a\t\n\r\fb", "a b"),
    ("a\x0bb", "a\x0bb"),          # vertical tab is not squeezed
    ("  a  ", " a "),
])
def test_squeeze_whitespace(spark, text, expected):
    assert one(spark, fn.squeeze_whitespace, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("  a b  ", "a b"),
    ("\t\na\r\n", "a"),
    (" a ", "a"),        # Unicode spaces are trimmed too
    ("", ""),
])
def test_trim_whitespace(spark, text, expected):
    assert one(spark, fn.trim_whitespace, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("  Com.App  1 ", "com.app 1"),
    ("COM.app\t\t2", "com.app 2"),
    (None, ""),
    ("", ""),
])
def test_normalize_text(spark, text, expected):
    assert one(spark, fn.normalize_text, text) == expected


def test_concat_strict_null_poisons(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "p string, q string")
    out = [r["c"] for r in df.select(fn.concat_strict("p", "q").alias("c")).collect()]
    assert out == [None, "ab"]


def test_coalesce_first_present(spark):
    df = spark.createDataFrame([(None, None, "z"), (None, "y", "z")], "a string, b string, c string")
    out = [r["c"] for r in df.select(fn.coalesce("a", "b", "c").alias("c")).collect()]
    assert out == ["z", "y"]


@pytest.mark.parametrize("text", ["", "abc", "com.app 12024-01-051.2", "ünïcode"])
def test_md5_hex_matches_utf8_md5(spark, text):
    assert one(spark, fn.md5_hex, text) == md5(text)


@pytest.mark.parametrize("text,expected", [
    ("2023-01-05", dt.date(2023, 1, 5)),
    ("2023-1-5", dt.date(2023, 1, 5)),
    (" 2023-12-31 ", dt.date(2023, 12, 31)),
    (None, None),
])
def test_parse_date(spark, text, expected):
    assert one(spark, fn.parse_date, text) == expected


@pytest.mark.parametrize("text", ["2023-02-30", "", "2023-01-05x", "05/01/2023"])
def test_parse_date_rejects_bad_text(spark, text):
    with pytest.raises(Exception):
        one(spark, fn.parse_date, text)


def test_format_day(spark):
    assert one(spark, fn.format_day, dt.date(2023, 1, 5), "date") == "2023-01-05"


@pytest.mark.parametrize("text,expected", [
    ("2024-01-05 03:04:05 UTC", dt.datetime(2024, 1, 5, 3, 4, 5)),
    ("2024-1-5 3:4:5 UTC", dt.datetime(2024, 1, 5, 3, 4, 5)),
    ("2024-01-05 20:00:00 America/New_York", dt.datetime(2024, 1, 6, 1, 0, 0)),
])
def test_parse_ts_seconds(spark, text, expected):
    got = one(spark, lambda c: fn.parse_ts_seconds(c).cast("timestamp_ntz"), text)
    assert got == expected


def test_parse_ts_fraction_rejects_a_tenth_digit(spark):
    with pytest.raises(Exception):
        one(spark, fn.parse_ts_fraction, "2024-01-05 03:04:05.1234567890 UTC")


def test_parse_ts_seconds_rejects_fraction(spark):
    with pytest.raises(Exception):
        one(spark, fn.parse_ts_seconds, "2024-01-05 03:04:05.123 UTC")


@pytest.mark.parametrize("text,expected", [
    ("2024-01-05 03:04:05 UTC", dt.datetime(2024, 1, 5, 3, 4, 5)),
    ("2024-01-05 03:04:05.123 UTC", dt.datetime(2024, 1, 5, 3, 4, 5, 123000)),
    ("2024-01-05 03:04:05.123456 UTC", dt.datetime(2024, 1, 5, 3, 4, 5, 123456)),
    ("2024-01-05 03:04:05.1234567 UTC", dt.datetime(2024, 1, 5, 3, 4, 5, 123456)),
    ("2024-01-05 03:04:05.123456789 UTC", dt.datetime(2024, 1, 5, 3, 4, 5, 123456)),
    ("2024-1-5 3:4:5.999999999 America/New_York", dt.datetime(2024, 1, 5, 8, 4, 5, 999999)),
])
def test_parse_ts_fraction(spark, text, expected):
    got = one(spark, lambda c: fn.parse_ts_fraction(c).cast("timestamp_ntz"), text)
    assert got == expected


@pytest.mark.parametrize("text,expected", [
    ("2024-02-01T06:30:00+00:00", dt.datetime(2024, 2, 1, 6, 30)),
    ("2024-02-01T06:30:00.250000+00:00", dt.datetime(2024, 2, 1, 6, 30, 0, 250000)),
    ("2024-02-01T08:30:00+02:00", dt.datetime(2024, 2, 1, 6, 30)),
])
def test_ts_literal(spark, text, expected):
    got = spark.range(1).select(fn.ts_literal(text).cast("timestamp_ntz").alias("t")).first()["t"]
    assert got == expected


def test_utc_day_and_day_start(spark):
    df = spark.createDataFrame([("2024-01-05 23:59:59 UTC",), ("2024-01-05 20:00:00 America/New_York",)],
                               "x string")
    ts = fn.parse_ts_seconds("x")
    rows = df.select(fn.utc_day(ts).alias("d"),
                     fn.day_start(fn.utc_day(ts)).cast("timestamp_ntz").alias("s")).collect()
    assert [r["d"] for r in rows] == [dt.date(2024, 1, 5), dt.date(2024, 1, 6)]
    assert [r["s"] for r in rows] == [dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)]


@pytest.mark.parametrize("value,expected", [
    (1.234, 1.23), (1.235, 1.24), (-1.235, -1.24), (2.5, 2.5), (0.125, 0.13), (-0.125, -0.13),
])
def test_round2_half_away_from_zero(spark, value, expected):
    assert one(spark, fn.round2, value, "double") == expected


def test_new_etl_ts_format():
    ts = fn.new_etl_ts(dt.datetime(2024, 2, 1, 6, 30, tzinfo=dt.timezone.utc))
    assert ts == "2024-02-01T06:30:00+00:00"
    ts = fn.new_etl_ts(dt.datetime(2024, 2, 1, 8, 30, 0, 5, tzinfo=dt.timezone(dt.timedelta(hours=2))))
    assert ts == "2024-02-01T06:30:00.000005+00:00"


# --- keys --------------------------------------------------------------------

def test_app_user_key_normalises_package_not_version(spark):
    df = spark.createDataFrame([("  Com.App  1 ", "2024-1-5", "1.2 "), ("com.app 1", "2024-01-05", "1.2 "),
                                ("com.app 1", "2024-01-05", "1.2")], "p string, d string, v string")
    keys = [r["k"] for r in df.select(app_user_key("p", day_text_from_date("d"), "v").alias("k")).collect()]
    assert keys[0] == keys[1] == md5("com.app 12024-01-051.2 ")
    assert keys[2] == md5("com.app 12024-01-051.2")


def test_app_user_key_null_parts_hash_as_empty(spark):
    df = spark.createDataFrame([(None, None, None), ("", "", "")], "p string, d string, v string")
    keys = [r["k"] for r in df.select(app_user_key("p", "d", "v").alias("k")).collect()]
    assert keys == [md5(""), md5("")]


def test_app_user_key_from_timestamp_uses_utc_day(spark):
    df = spark.createDataFrame([("P", "2024-01-05 20:00:00 America/New_York", "1")], "p string, t string, v string")
    key = df.select(app_user_key("p", day_text_from_ts("t"), "v").alias("k")).first()["k"]
    assert key == md5("p2024-01-061")


def test_campaign_key_collides_without_separator(spark):
    df = spark.createDataFrame([("2024-01-05", "ab", "c"), ("2024-01-05", "a", "bc"),
                                ("2024-01-05", " AB ", "C")], "d string, c string, n string")
    keys = [r["k"] for r in df.select(campaign_key("d", "c", "n").alias("k")).collect()]
    assert keys[0] == keys[1] == keys[2] == md5("2024-01-05abc")
    sep = [r["k"] for r in df.select(campaign_key("d", "c", "n", sep="|").alias("k")).collect()]
    assert sep[0] != sep[1] and sep[0] == sep[2]
