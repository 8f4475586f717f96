"""Flatten nested JSON payloads to rows, and build messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .series import POSITION, position_levels, with_position

# Field names and shapes of the payloads.
_VALUE = "struct<value: double>"
_MEASURE = "struct<value: double, unitCode: string>"
FORECAST = (
    "properties struct<periods: array<struct<startTime: string, endTime: string, temperature: double,"
    "temperatureUnit: string, windSpeed: string, windDirection: string, shortForecast: string,"
    f"detailedForecast: string, probabilityOfPrecipitation: {_VALUE}, relativeHumidity: {_VALUE},"
    f"dewpoint: {_MEASURE}, pressure: {_MEASURE}, visibility: {_MEASURE}>>>"
)
FORECAST_FIELDS = {
    "start_time": "startTime",
    "end_time": "endTime",
    "temperature": "temperature",
    "temperature_unit": "temperatureUnit",
    "wind_speed": "windSpeed",
    "wind_direction": "windDirection",
    "short_forecast": "shortForecast",
    "detailed_forecast": "detailedForecast",
    "precipitation_probability": "probabilityOfPrecipitation.value",
    "relative_humidity": "relativeHumidity.value",
    "dewpoint": "dewpoint.value",
    "dewpoint_unit": "dewpoint.unitCode",
    "pressure": "pressure.value",
    "pressure_unit": "pressure.unitCode",
    "visibility": "visibility.value",
    "visibility_unit": "visibility.unitCode",
}
BAR_FIELDS = {"open": "1. open", "high": "2. high", "low": "3. low", "close": "4. close", "volume": "5. volume"}
RSI_KEY, MACD_KEY = "Technical Analysis: RSI", "Technical Analysis: MACD"
MACD_FIELDS = {"macd": "MACD", "macd_signal": "MACD_Signal", "macd_hist": "MACD_Hist"}
ARTICLE = (
    "title: string, url: string, time_published: string, source: string, summary: string,"
    "overall_sentiment_score: string, overall_sentiment_label: string"
)


def _struct_of(names: Sequence[str]) -> str:
    return "struct<" + ", ".join(f"`{n}`: string" for n in names) + ">"


def flatten_forecast(df: DataFrame, payload: str = "payload", latitude: str = "latitude", longitude: str = "longitude", fetched_at: Column | None = None) -> DataFrame:
    """One row per forecast period. Parts missing from the payload are null; no periods give no rows."""
    periods = F.from_json(payload, FORECAST)["properties"]["periods"]
    at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if fetched_at is None else fetched_at
    rows = df.select("*", F.explode(periods).alias("__p"))
    return rows.select(
        at.alias("timestamp"),
        F.concat_ws("_", F.col(latitude).cast("string"), F.col(longitude).cast("string")).alias("grid_id"),
        F.col(latitude).alias("latitude"),
        F.col(longitude).alias("longitude"),
        *[F.col(f"__p.{path}").alias(name) for name, path in FORECAST_FIELDS.items()],
    )


def forecast_to_reading(df: DataFrame) -> DataFrame:
    """Forecast rows in the shape of raw readings: the grid stands for the city, Fahrenheit becomes Celsius."""
    celsius = F.when(F.col("temperature_unit") == "F", (F.col("temperature") - 32) * 5 / 9).otherwise(F.col("temperature"))
    return df.select(
        celsius.alias("temperature"),
        "wind_speed",
        F.col("grid_id").alias("city"),
        "timestamp",
        F.col("relative_humidity").alias("humidity"),
        "pressure",
        "visibility",
    )


def flatten_intraday(df: DataFrame, symbol: str = "symbol", payload: str = "payload", interval: str = "5min") -> DataFrame:
    """One row per bar of a time-keyed price map, prices still as text; an empty map gives no rows."""
    key = f"Time Series ({interval})"
    series = F.from_json(payload, f"`{key}` map<string, {_struct_of(list(BAR_FIELDS.values()))}>")[key]
    rows = df.select(F.col(symbol).alias("symbol"), F.explode(series).alias("__ts", "__bar"))
    return rows.select(
        "symbol",
        F.col("__ts").try_cast("timestamp").alias("ts"),
        *[F.col("__bar")[field].alias(name) for name, field in BAR_FIELDS.items()],
    )


def flatten_feed(df: DataFrame, symbol: str = "symbol", payload: str = "payload") -> DataFrame:
    """One row per article, with its publication time as ``ts``."""
    feed = F.from_json(payload, f"feed array<struct<{ARTICLE}>>")["feed"]
    rows = df.select(F.col(symbol).alias("symbol"), F.explode(feed).alias("__a")).select("symbol", "__a.*")
    return rows.withColumn("ts", F.try_to_timestamp("time_published", F.lit("yyyyMMdd'T'HHmmss")))


def _by_time(df: DataFrame, symbol: str, payload: str, key: str, fields: dict[str, str]) -> DataFrame:
    series = F.from_json(payload, f"`{key}` map<string, {_struct_of(list(fields.values()))}>")[key]
    rows = df.select(F.col(symbol).alias("symbol"), F.explode(series).alias("__ts", "__v"))
    return rows.select(
        "symbol", F.col("__ts").try_cast("timestamp").alias("ts"), *[F.col("__v")[f].alias(n) for n, f in fields.items()]
    )


def flatten_indicators(rsi: DataFrame, macd: DataFrame, symbol: str = "symbol", payload: str = "payload") -> DataFrame:
    """One row per time of the RSI map, with the MACD values of that time; values still as text."""
    left = _by_time(rsi, symbol, payload, RSI_KEY, {"rsi": "RSI"})
    right = _by_time(macd, symbol, payload, MACD_KEY, MACD_FIELDS)
    return left.join(right, ["symbol", "ts"], "left")


def decode_messages(records: DataFrame) -> DataFrame:
    """Topic records with key and value as text; values that are no JSON are skipped."""
    text = records.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )
    return text.where(F.try_parse_json("value").isNotNull())


def encode_messages(df: DataFrame, key: str | Column, columns: Sequence[str] | None = None) -> DataFrame:
    """``key, value`` rows for a topic, the value as JSON with null fields kept."""
    fields = columns or df.columns
    key = F.col(key) if isinstance(key, str) else key
    return df.select(
        key.cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in fields]), {"ignoreNullFields": "false"}).alias("value"),
    )


def envelope(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    order: Sequence[str] = (),
    batch_rows: int | None = None,
    sent_at: Column | None = None,
) -> DataFrame:
    """Messages ``{timestamp, symbol, data}`` keyed by symbol.

    One row per message, or with ``batch_rows`` up to that many rows of one symbol in ``data``, in order. Batches are
    cut by exact position, so a message and the group behind it never grow past ``batch_rows``.
    """
    at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if sent_at is None else sent_at
    record = F.struct(*[F.col(f"`{c}`") for c in columns])
    if batch_rows is None:
        return encode_messages(
            df.select(at.alias("timestamp"), F.col(key).alias("symbol"), record.alias("data")), "symbol"
        )
    df, levels = position_levels(df, [key], list(order))
    placed = with_position(df, [key], list(order), levels)
    batch = F.floor((F.col(POSITION) - 1) / batch_rows)
    grouped = placed.groupBy(F.col(key).alias("symbol"), batch.alias("__batch")).agg(
        F.array_sort(F.collect_list(F.struct(F.col(POSITION).alias("p"), record.alias("r")))).alias("__rows")
    )
    return encode_messages(grouped.select(at.alias("timestamp"), "symbol", F.col("__rows.r").alias("data")), "symbol")


