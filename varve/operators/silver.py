"""Bronze and silver steps over readings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .. import schemas
from ..functions import cleaning as K
from .dedup import keep_latest

FILLABLE = ("temperature", "humidity", "pressure", "visibility", "offset", "partition")


def non_empty_payload(column: str | Column = "json") -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.length(column) > 0, F.lit(False))


def decode_readings(messages: DataFrame) -> DataFrame:
    """Topic rows (``value, offset, partition, timestamp``) to raw readings with their place in the topic.

    Empty payloads are dropped. One that is no JSON object gives a row of nulls.
    """
    text = messages.select(
        F.col("value").cast("string").alias("json"),
        "offset",
        "partition",
        F.col("timestamp").alias("kafka_timestamp"),
    )
    parsed = text.where(non_empty_payload("json")).withColumn("data", F.from_json("json", schemas.RAW))
    return parsed.select("data.*", "offset", "partition", "kafka_timestamp")


def fill_numeric_nulls(df: DataFrame, columns: tuple[str, ...] = FILLABLE) -> DataFrame:
    return df.na.fill(0, subset=[c for c in columns if c in df.columns])


def to_bronze(df: DataFrame, source: str, processed_at: Column | None = None) -> DataFrame:
    """Stamp decoded readings with their processing time, its parts, and the source.

    ``processed_at`` replaces the clock, for replays and tests.
    """
    stamped = df.withColumn("processing_timestamp", F.current_timestamp() if processed_at is None else processed_at)
    at = F.col("processing_timestamp")
    return schemas.conform(
        stamped.withColumns({"hour": F.hour(at), "minute": F.minute(at), "data_source": F.lit(source), **K.date_parts(at)})
        .withColumnsRenamed({"offset": "kafka_offset", "partition": "kafka_partition"}),
        schemas.BRONZE,
    )


def bronze(messages: DataFrame, source: str = C.WEATHER_SOURCE, fill: bool = True, processed_at: Column | None = None) -> DataFrame:
    """Topic rows to bronze rows; narrow, and the same for a batch and a stream.

    ``fill`` writes 0 for missing numbers, as consumers of the bronze table expect; without it they stay null.
    """
    decoded = decode_readings(messages)
    return to_bronze(fill_numeric_nulls(decoded) if fill else decoded, source, processed_at)


def score(df: DataFrame) -> DataFrame:
    """Quality score, validity and category of cleaned readings."""
    flags = list(K.range_flags().values())
    return df.withColumns(
        {
            "quality_score": K.quality_score(flags),
            "is_valid": K.is_valid(flags),
            "weather_category": K.weather_category(),
            "data_freshness_hours": K.freshness_hours("processing_timestamp", "timestamp"),
        }
    )


def clean(df: DataFrame, timestamp: Column, city: Column | None = None, wind_mode: str = "all") -> DataFrame:
    return df.withColumns(
        {
            "wind_speed": K.clean_wind_speed("wind_speed", wind_mode),
            "timestamp": timestamp,
            "city": K.clean_city("city") if city is None else city,
            **K.date_parts("processing_timestamp"),
        }
    )


def silver(df: DataFrame, strict_time: bool = False, wind_mode: str = "all") -> DataFrame:
    """Bronze rows to silver: clean, keep the latest copy, then score what is left.

    Scores read only columns of the kept row, so they are computed after the shuffle and not carried through it.
    ``strict_time`` reads whole seconds only, as the date-scoped job does.
    """
    parse = K.clean_timestamp_strict if strict_time else K.clean_timestamp
    cleaned = clean(df, parse("timestamp", "processing_timestamp"), wind_mode=wind_mode)
    return schemas.conform(score(keep_latest(cleaned)), schemas.SILVER)


def validated() -> Column:
    """Complete readings inside the ranges; wind and visibility have no upper bound here."""
    limits = C.VALID_RANGES
    inside = [F.col(m).between(*limits[m]) for m in ("temperature", "humidity", "pressure")]
    keep = F.col("is_valid") & (F.col("wind_speed") >= 0) & (F.col("visibility") >= 0)
    for condition in inside:
        keep = keep & condition
    return F.coalesce(keep, F.lit(False))


def newest_first() -> list[Column]:
    """Rows by processing time, the newest first; those of one time by their place in the topic, then by their key.

    Rows of one micro-batch share their time. The order tells them apart, so that a sort spreads them over tasks.
    """
    return [F.col("processing_timestamp").desc(), F.col("kafka_partition").asc(), F.col("kafka_offset").asc(), F.xxhash64(*C.DEDUP_KEYS).asc()]


def silver_strict(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Bronze rows to the strict silver table: scored by completeness, valid rows only, and ``ordered`` newest first."""
    scored = df.withColumns({"quality_score": K.completeness_score(), "is_valid": K.completeness_flag()})
    cleaned = clean(
        scored,
        K.clean_timestamp_strict("timestamp", "processing_timestamp", exact=False),
        city=F.col("city"),
    )
    kept = schemas.conform(keep_latest(cleaned).where(validated()), schemas.SILVER_STRICT)
    return kept.orderBy(*newest_first()) if ordered else kept


def for_date(df: DataFrame, date: str | dt.date) -> DataFrame:
    """Rows of one processing date; prunes to one partition on a table laid out by year, month and day."""
    day = dt.date.fromisoformat(date) if isinstance(date, str) else date
    return df.where((F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day))


def quality_metrics(df: DataFrame) -> dict[str, Column]:
    """Aggregates over silver rows, for ``agg`` or ``observe``."""
    return {
        "total_records": F.count(F.lit(1)),
        "valid_records": F.count_if(F.col("is_valid")),
        "invalid_records": F.count_if(~F.col("is_valid")),
        "avg_quality_score": F.avg("quality_score"),
        "earliest_record": F.min("processing_timestamp"),
        "latest_record": F.max("processing_timestamp"),
    }


def quality_summary(df: DataFrame) -> DataFrame:
    metrics = df.agg(*[column.alias(name) for name, column in quality_metrics(df).items()])
    return metrics.withColumn("quality_rate", quality_rate())


def quality_rate(valid: str = "valid_records", total: str = "total_records") -> Column:
    return F.try_divide(F.col(valid), F.col(total)) * 100
