import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from varve.functions import cleaning as K
from varve.functions import market as M
from varve.functions import names as N


def test_wind_speed_keeps_digits_and_dots(values):
    texts = ["10 mph", "10 to 15 mph", "calm", "", None, "7.5", "1.2.3", "-4"]
    got = values([(t,) for t in texts], "w string", K.clean_wind_speed("w"))
    assert got == [10.0, 1015.0, None, None, 0.0, 7.5, None, 4.0]


@pytest.mark.parametrize("mode,expected", [("first", [10.0, None, 0.0]), ("mean", [12.5, None, 0.0])])
def test_wind_speed_modes(values, mode, expected):
    assert values([("10 to 15 mph",), ("calm",), (None,)], "w string", K.clean_wind_speed("w", mode)) == expected


def test_wind_speed_unknown_mode(spark):
    with pytest.raises(ValueError):
        K.clean_wind_speed("w", "last")


FALLBACK = dt.datetime(2030, 1, 1)
TIMES = {
    None: FALLBACK,
    "not-a-time": FALLBACK,
    "2024-05-06": FALLBACK,
    "2024-05-06T07:08:09": dt.datetime(2024, 5, 6, 7, 8, 9),
    "2024-05-06T07:08:09.123": dt.datetime(2024, 5, 6, 7, 8, 9, 123000),
    "2024-05-06T07:08:09.123456": dt.datetime(2024, 5, 6, 7, 8, 9, 123000),
    "2024-05-06T07:08:09+02:00": dt.datetime(2024, 5, 6, 5, 8, 9),
    "2024-05-06T07:08:09.123456Z": dt.datetime(2024, 5, 6, 7, 8, 9, 123000),
    "2024-13-06T07:08:09": None,
    "2024-05-06T07:08:09.12": None,
}


def test_timestamp(values):
    rows = [(t, FALLBACK) for t in TIMES]
    got = values(rows, "t string, p timestamp_ntz", K.clean_timestamp("t", "p").cast("timestamp_ntz"))
    assert dict(zip(TIMES, got)) == TIMES


def test_strict_timestamp(values):
    rows = [(t, FALLBACK) for t in (None, "not-a-time", "2024-05-06T07:08:09", "2024-05-06T07:08:09.123")]
    exact = K.clean_timestamp_strict("t", "p").cast("timestamp_ntz")
    cast = K.clean_timestamp_strict("t", "p", exact=False).cast("timestamp_ntz")
    second = dt.datetime(2024, 5, 6, 7, 8, 9)
    assert values(rows, "t string, p timestamp_ntz", exact, cast) == [
        (FALLBACK, FALLBACK),
        (None, None),
        (second, second),
        (None, second.replace(microsecond=123000)),
    ]


def test_city(values):
    assert values([(" Oslo ",), (None,), ("",)], "c string", K.clean_city("c")) == ["OSLO", "UNKNOWN", ""]


def test_range_flags_at_the_edges(values):
    flags = K.range_flags(metrics=("temperature", "pressure"))
    rows = [(-90.0, 800.0), (60.0, 1100.0), (-90.1, 799.9), (60.1, 1100.1), (None, None), (math.nan, math.nan)]
    assert values(rows, "temperature double, pressure double", *flags.values()) == [
        (True, True), (True, True), (False, False), (False, False), (False, False), (False, False)
    ]


def test_score_counts_true_flags(values):
    flags = [F.col("a"), F.col("b")]
    rows = [(True, True), (True, False), (False, False)]
    assert values(rows, "a boolean, b boolean", K.quality_score(flags), K.is_valid(flags)) == [(1.0, True), (0.5, False), (0.0, False)]


def test_category_first_match(values):
    rows = [(31.0, 99.0, 1.0), (-1.0, 99.0, 1.0), (10.0, 16.0, 1.0), (10.0, 15.0, 4.0), (10.0, 0.0, 5.0), (None, None, None), (30.0, None, None)]
    got = values(rows, "temperature double, wind_speed double, visibility double", K.weather_category())
    assert got == ["HOT", "COLD", "WINDY", "FOGGY", "NORMAL", "NORMAL", "NORMAL"]


def test_freshness_counts_whole_seconds(values):
    rows = [(dt.datetime(2024, 1, 1, 1, 0, 0, 999999), dt.datetime(2024, 1, 1, 0, 30, 0, 1))]
    assert values(rows, "p timestamp_ntz, t timestamp_ntz", K.freshness_hours("p", "t")) == [0.5]


def test_completeness(values):
    rows = [(None, 1.0, 1.0, "x"), (1.0, None, 1.0, "x"), (1.0, 1.0, 1.0, None), (1.0, 1.0, 1.0, "x")]
    schema = "temperature double, humidity double, pressure double, wind_speed string"
    assert values(rows, schema, K.completeness_score(), K.completeness_flag()) == [(0.0, False), (0.5, False), (0.5, False), (1.0, True)]


def test_usable(values):
    rows = [(0.0, 0.0, 0.0), (-3.0, -1.0, -1.0), (2.0, 2.0, 2.0), (None, None, None)]
    got = values(rows, "temperature double, humidity double, wind_speed double", K.usable("temperature"), K.usable("humidity"), K.usable("wind_speed"))
    assert got == [(None, None, 0.0), (-3.0, None, None), (2.0, 2.0, 2.0), (None, None, None)]


def test_numbers_from_text(values):
    texts = ["$1,234.50", "12", "abc", "", None, "-$3"]
    assert values([(t,) for t in texts], "t string", K.parse_money("t")) == [1234.5, 12.0, None, None, None, -3.0]
    assert values([("1.5",), ("None",)], "t string", K.to_number("t")) == [1.5, None]


def test_market_hours(spark, values):
    at = {
        dt.datetime(2024, 7, 1, 13, 30): True,  # Monday, 09:30 in New York (summer)
        dt.datetime(2024, 7, 1, 13, 29, 59): False,
        dt.datetime(2024, 7, 1, 20, 0): True,
        dt.datetime(2024, 7, 1, 20, 0, 0, 1): False,
        dt.datetime(2024, 1, 2, 14, 29): False,  # 09:29 in winter
        dt.datetime(2024, 1, 2, 14, 30): True,
        dt.datetime(2024, 7, 6, 15, 0): False,  # Saturday
    }
    assert values([(t,) for t in at], "t timestamp_ntz", M.market_hours("t")) == list(at.values())
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert values([(t,) for t in at], "t timestamp_ntz", M.market_hours("t")) == list(at.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_safe_names(values):
    names = ["a.parquet", "a b", "", None, "x" * 100, "x" * 101, "../x", "1a"]
    rows = [(n,) for n in names]
    assert values(rows, "n string", N.safe_name("n", "file_name")) == [True, False, False, False, True, False, False, True]
    assert values(rows, "n string", N.safe_name("n", "column_name"))[-1] is False
    assert N.check_name("abc", "dataset_name") == "abc"
    for bad in ("", "a/b", "a\n", "x" * 101):
        with pytest.raises(ValueError):
            N.check_name(bad, "dataset_name")


def test_data_files(values):
    assert values([("a/b.csv",), ("a.parquet.tmp",), (None,), ("x.JSON",)], "p string", N.data_file("p")) == [True, False, False, False]
