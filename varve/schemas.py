"""Schemas of the layers. Every layer ends in ``conform(df, schema)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
}


def _schema(text: str) -> T.StructType:
    """``name type, name type, …``; needs no session, unlike a DDL string."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW = _schema(
    "temperature double, wind_speed string, city string, timestamp string, humidity double, pressure double, visibility double"
)

BRONZE = T.StructType(
    RAW.fields
    + _schema(
        "processing_timestamp timestamp, hour int, minute int, kafka_offset bigint, kafka_partition int,"
        "kafka_timestamp timestamp, data_source string, year int, month int, day int"
    ).fields
)

SILVER = _schema(
    "temperature double, wind_speed double, city string, timestamp timestamp, humidity double, pressure double,"
    "visibility double, processing_timestamp timestamp, hour int, minute int, data_source string, year int, month int,"
    "day int, quality_score double, is_valid boolean, weather_category string, data_freshness_hours double,"
    "kafka_offset bigint, kafka_partition int, kafka_timestamp timestamp"
)

SILVER_STRICT = T.StructType(
    [f for f in SILVER.fields if f.name not in ("weather_category", "data_freshness_hours")]
)

BARS = _schema("symbol string, ts timestamp, open double, high double, low double, close double, volume double")

FEED = _schema("symbol string, ts timestamp, overall_sentiment_score string, overall_sentiment_label string")

INDICATORS = _schema("symbol string, ts timestamp, rsi string, macd string, macd_signal string, macd_hist string")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast, name and order the columns of ``df`` as ``schema`` says; other columns are dropped."""
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
