"""Operator inputs derived from the test tables."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.functions.cleaning import date_parts
from varve.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


STAGED: dict[tuple[str, str], str] = {}


def staged(name: str):
    """Read what ``stage`` has written for these tables, if it has; else work it out."""

    def wrap(function):
        @wraps(function)
        def read(spark: SparkSession, sf_dir: str, *more) -> DataFrame:
            path = STAGED.get((name, sf_dir))
            return spark.read.parquet(path) if path and not more else function(spark, sf_dir, *more)

        return read

    return wrap


def stage(spark: SparkSession, sf_dir: str, folder: str, frames: dict[str, DataFrame], files: int = 32) -> None:
    """Write derived inputs as tables of many files, so that what reads them is measured by itself."""
    for name, df in frames.items():
        path = f"{folder}/{name}"
        df.repartition(files).write.parquet(path)
        STAGED[name, sf_dir] = path


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of files."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@staged("single_readings")
def single_readings(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """One bronze row per event, with dirt in every field."""
    events = table(spark, sf_dir, "events") if events is None else events
    k = F.get_json_object("props", "$.k").cast("double")
    e, u, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    low = (u % 20).cast("string")
    stamp = "yyyy-MM-dd'T'HH:mm:ss"
    wind = (
        F.when(e % 7 == 0, None)
        .when(e % 7 == 1, "calm")
        .when(e % 7 == 2, F.concat(low, F.lit(" to "), (u % 20 + 5).cast("string"), F.lit(" mph")))
        .otherwise(F.concat((u % 60).cast("string"), F.lit(" mph")))
    )
    text = (
        F.when(e % 11 == 0, None)
        .when(e % 11 == 1, "not-a-time")
        .when(e % 11 < 5, F.date_format(ts, stamp + ".SSSSSS"))
        .when(e % 11 < 8, F.date_format(ts, stamp + ".SSS"))
        .otherwise(F.date_format(ts, stamp))
    )
    rows = events.select(
        F.when(e % 17 != 0, F.col("value") * 0.5 - 20).alias("temperature"),
        wind.alias("wind_speed"),
        F.when(e % 13 != 0, F.concat(F.lit(" city_"), (u % 12).cast("string"), F.lit(" "))).alias("city"),
        text.alias("timestamp"),
        F.when(e % 19 != 0, k * 1.1).alias("humidity"),
        (k * 3.5 + 780).alias("pressure"),
        F.when(e % 23 != 0, (u % 60).cast("double")).alias("visibility"),
        (ts + F.expr("INTERVAL 90 MINUTES")).alias("processing_timestamp"),
        e.alias("kafka_offset"),
        (u % 4).cast("int").alias("kafka_partition"),
        ts.alias("kafka_timestamp"),
        F.lit("noaa").alias("data_source"),
    )
    return _timed(rows)


def _timed(rows: DataFrame) -> DataFrame:
    at = F.col("processing_timestamp")
    return rows.withColumns({"hour": F.hour(at), "minute": F.minute(at), **date_parts(at)})


@staged("readings")
def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows where every event was delivered again an hour later."""
    first = single_readings(spark, sf_dir)
    again = first.withColumns(
        {
            "processing_timestamp": F.col("processing_timestamp") + F.expr("INTERVAL 1 HOUR"),
            "kafka_offset": F.col("kafka_offset") + 10_000_000,
        }
    )
    return first.unionByName(_timed(again))


@staged("messages")
def messages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """Topic rows: one JSON reading per event, some empty, some broken."""
    rows = single_readings(spark, sf_dir, events)
    fields = ("temperature", "wind_speed", "city", "timestamp", "humidity", "pressure", "visibility")
    text = (
        F.when(F.col("kafka_offset") % 29 == 0, "")
        .when(F.col("kafka_offset") % 29 == 1, "{broken")
        .when(F.col("kafka_offset") % 29 == 2, None)
        .otherwise(F.to_json(F.struct(*fields)))
    )
    return rows.select(
        F.lit("weather-forecast").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("city").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.col("kafka_timestamp").alias("timestamp"),
        "processing_timestamp",
    )


@staged("bars")
def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per symbol, the first and last price of a day being that of its lowest and highest line key."""
    lines = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    key = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    return lines.groupBy(
        F.concat(F.lit("S"), (F.col("l_suppkey") % 6).cast("string")).alias("symbol"),
        F.col("l_shipdate").cast("date").alias("trading_date"),
    ).agg(
        F.min_by(price, key).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, key).alias("close"),
        F.sum("l_quantity").alias("volume"),
    )


@staged("mixed_bars")
def mixed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of one symbol with its whole series, and of many whose series end with each year."""
    short = F.concat("symbol", F.lit("-"), F.year("trading_date").cast("string"))
    return bars(spark, sf_dir).withColumn("symbol", F.when(F.col("symbol") == "S0", F.col("symbol")).otherwise(short))


@staged("tied_readings")
def tied_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of which a third share one processing time."""
    at = F.lit("2024-01-10 12:00:00").cast(dict(table(spark, sf_dir, "events").dtypes)["ts"])
    time = F.when(F.col("kafka_offset") % 3 == 0, at).otherwise(F.col("processing_timestamp"))
    return readings(spark, sf_dir).withColumn("processing_timestamp", time)


def _by_customer_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(
        F.concat(F.lit("S"), (F.col("o_custkey") % 6).cast("string")).alias("symbol"),
        F.col("o_orderdate").cast("date").alias("trading_date"),
    ).agg(F.max("o_orderkey").alias("m"), F.min("o_orderkey").alias("n"))


@staged("feed")
def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("m")
    score = F.when(m % 29 == 0, "n/a").otherwise(F.concat(F.lit("0."), F.lpad((m % 1000).cast("string"), 3, "0")))
    label = F.when(m % 3 == 0, "Bullish").when(m % 3 == 1, "Neutral").otherwise("Bearish")
    return _by_customer_day(spark, sf_dir).select(
        "symbol", "trading_date", score.alias("overall_sentiment_score"), label.alias("overall_sentiment_label")
    )


@staged("indicators")
def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, n = F.col("m"), F.col("n")
    return _by_customer_day(spark, sf_dir).select(
        "symbol",
        "trading_date",
        F.when(m % 31 == 0, "None").otherwise((m % 101).cast("string")).alias("rsi"),
        (m % 21 - 10).cast("string").alias("macd"),
        (n % 19 - 9).cast("string").alias("macd_signal"),
        (m % 21 - n % 19 - 1).cast("string").alias("macd_hist"),
    )


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One two-period forecast payload per event."""
    u = F.col("user_id")

    def text(column) -> F.Column:
        return column.cast("string")

    payload = F.concat(
        F.lit('{"properties": {"periods": [{"startTime": "t0", "temperature": '),
        text(u % 90),
        F.lit(', "temperatureUnit": "F", "windSpeed": "'),
        text(u % 30),
        F.lit(' mph", "relativeHumidity": {"value": '),
        text(u % 100),
        F.lit('}}, {"startTime": "t1", "temperature": '),
        text(u % 40),
        F.lit(', "temperatureUnit": "C", "pressure": {"value": '),
        text(u % 300 + 800),
        F.lit(', "unitCode": "hPa"}}]}}'),
    )
    return table(spark, sf_dir, "events").select(
        payload.alias("payload"), (u % 90).cast("int").alias("latitude"), (-(F.col("event_id") % 180)).cast("int").alias("longitude")
    )


def intraday_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per symbol and month, each a map of at most 31 bars."""
    price = {"1. open": "open", "2. high": "high", "3. low": "low", "4. close": "close", "5. volume": "volume"}
    record = F.struct(*[F.col(c).cast("string").alias(name) for name, c in price.items()])
    entry = F.struct(F.col("trading_date").cast("string").alias("k"), record.alias("v"))
    series = F.map_from_entries(F.collect_list(entry)).alias("Time Series (5min)")
    return (
        bars(spark, sf_dir)
        .groupBy("symbol", F.date_trunc("month", "trading_date").alias("month"))
        .agg(F.to_json(F.struct(series)).alias("payload"))
        .select("symbol", "payload")
    )


def feed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    article = F.struct(
        F.date_format("trading_date", "yyyyMMdd'T'HHmmss").alias("time_published"),
        "overall_sentiment_score",
        "overall_sentiment_label",
    )
    return (
        feed(spark, sf_dir)
        .groupBy("symbol", F.date_trunc("month", "trading_date").alias("month"))
        .agg(F.to_json(F.struct(F.collect_list(article).alias("feed"))).alias("payload"))
        .select("symbol", "payload")
    )


def indicator_payloads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = indicators(spark, sf_dir)
    macd = F.struct(
        F.col("macd").alias("MACD"), F.col("macd_signal").alias("MACD_Signal"), F.col("macd_hist").alias("MACD_Hist")
    )

    day = F.col("trading_date").cast("string")
    # The MACD map has no readable time for the first of a month.
    macd_day = F.when(F.dayofmonth("trading_date") == 1, F.concat(F.lit("no "), day)).otherwise(day)

    def pack(key: str, value, at) -> DataFrame:
        entry = F.struct(at.alias("k"), value.alias("v"))
        return (
            rows.groupBy("symbol", F.date_trunc("month", "trading_date").alias("month"))
            .agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(entry)).alias(key))).alias("payload"))
            .select("symbol", "payload")
        )

    return (
        pack("Technical Analysis: RSI", F.struct(F.col("rsi").alias("RSI")), day),
        pack("Technical Analysis: MACD", macd, macd_day),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing: one partitioned data file per event, some plain files, and some that are no data or unsafe."""
    e, ts = F.col("event_id"), F.col("ts")
    day = F.concat(
        F.lit("/year="), F.year(ts).cast("string"), F.lit("/month="), F.month(ts).cast("string"), F.lit("/day="), F.dayofmonth(ts).cast("string")
    )
    number = e.cast("string")
    path = (
        F.when(e % 5 == 0, F.concat(F.lit("gold/weather"), day, F.lit("/part-"), number, F.lit(".parquet")))
        .when(e % 5 == 1, F.concat(F.lit("gold/market/"), F.col("event_type"), day, F.lit("/part-"), number, F.lit(".json")))
        .when(e % 5 == 2, F.concat(F.lit("raw/dump_"), number, F.lit(".v1.csv")))
        .when(e % 5 == 3, F.concat(F.lit("raw/notes_"), number, F.lit(".txt")))
        .otherwise(F.concat(F.lit("raw/bad name "), number, F.lit(".csv")))
    )
    return table(spark, sf_dir, "events").select(
        path.alias("path"), (e % 1000 + 1).alias("size"), ts.alias("modified")
    )
