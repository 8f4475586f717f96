"""Registered queries: each an operator over whole test tables, with its SQL twin."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varve import constants as C
from varve.functions import cleaning as K
from varve.functions import market as M
from varve.functions import names as N
from varve.operators import dedup, gold, market, nested, quality, quantiles, silver, states, tables
from varve.plans import changes, jobs
from varve.plans import registry as transformers
from varve.session import shared_folder
from varve.sinks import compaction
from varve.sinks import files as sinks
from varve.sources import files as sources
from varve.sources import listing
from varve.streaming import bronze as streams
from varve.streaming import silver as silver_streams

from . import inputs as I
from .oracle import DAY, rounded, sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

AS_OF_DAY = "2024-01-20"


def query(name: str, select: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = function
        if select is not None:
            ORACLES[name] = sql(select)
        return function

    return add


def gold_time() -> Column:
    """A fixed gold processing time, so that runs agree."""
    return F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")


def plain(df: DataFrame, *round_columns: str) -> DataFrame:
    """Timestamps without zone, and the named columns rounded, as both engines can compare them."""
    columns = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if field.name in round_columns:
            c = F.round(c + F.lit(1e-10), 6) + F.lit(0.0)
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(field.name))
    return df.select(columns)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


SILVER_COLUMNS = ", ".join(silver.schemas.SILVER.names)
STRICT_COLUMNS = ", ".join(silver.schemas.SILVER_STRICT.names)
BRONZE_COLUMNS = ", ".join(silver.schemas.BRONZE.names)


@I.staged("silver")
def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver.silver(I.readings(spark, sf))


def _lake(spark: SparkSession, sf: str) -> str:
    """The readings as a table laid out by date."""
    path = new_folder(spark, "readings")
    sinks.write_partitioned(I.readings(spark, sf), path)
    return path


def _readings_out(df: DataFrame) -> DataFrame:
    return plain(df.select(*silver.schemas.BRONZE.names))


# Sources ------------------------------------------------------------------------------------------------------------


@query("consume_topic", """
SELECT 'weather-forecast' AS topic, kafka_partition AS partition, kafka_offset AS offset, city AS key, wind_speed, temperature
FROM single_readings WHERE kafka_offset % 29 > 2""")
def consume_topic(spark, sf):
    out = nested.decode_messages(I.messages(spark, sf))
    data = F.from_json("value", silver.schemas.RAW)
    return out.select("topic", "partition", "offset", "key", data["wind_speed"].alias("wind_speed"), data["temperature"].alias("temperature"))


@query("read_table", f"SELECT {BRONZE_COLUMNS} FROM readings")
def read_table(spark, sf):
    return _readings_out(sources.read_table(spark, _lake(spark, sf)))


@query("read_for_date", f"SELECT {BRONZE_COLUMNS} FROM readings WHERE CAST(processing_timestamp AS DATE) = DATE '{DAY}'")
def read_for_date(spark, sf):
    return _readings_out(sources.read_for_date(sources.read_table(spark, _lake(spark, sf)), DAY))


@query("read_parquet_glob", f"SELECT {BRONZE_COLUMNS} FROM readings")
def read_parquet_glob(spark, sf):
    return _readings_out(sources.read_parquet_glob(spark, _lake(spark, sf)))


@query("read_until", f"SELECT {BRONZE_COLUMNS} FROM readings WHERE processing_timestamp < TIMESTAMP '2024-01-10 00:00:00'")
def read_until(spark, sf):
    return _readings_out(sources.read_until(spark, _lake(spark, sf), DAY.replace("-", "")))


@query("read_csv", "SELECT * FROM orders")
def read_csv(spark, sf):
    orders = I.table(spark, sf, "orders")
    path = new_folder(spark, "csv")
    orders.write.option("header", "true").csv(path)
    return sources.read_csv(spark, path, schema=orders.schema)


@query("read_json", "SELECT * FROM events")
def read_json(spark, sf):
    events = I.table(spark, sf, "events")
    path = new_folder(spark, "json")
    events.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return sources.read_json(spark, path, events.schema)


@query("read_parquet", "SELECT * FROM lineitem")
def read_parquet(spark, sf):
    return sources.read_parquet(spark, f"{sf}/lineitem.parquet")


@query("read_mixed_dataset", """
SELECT c_custkey AS id, c_acctbal AS balance, NULL AS segment, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, NULL, 'supplier' FROM supplier
UNION ALL SELECT c_custkey, NULL, c_mktsegment, 'segment' FROM customer""")
def read_mixed_dataset(spark, sf):
    root = new_folder(spark, "mixed")
    customer, supplier = I.table(spark, sf, "customer"), I.table(spark, sf, "supplier")
    customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance")).write.option("header", "true").csv(f"{root}/kind=customer")
    supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")).write.json(f"{root}/kind=supplier")
    customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")).write.parquet(f"{root}/kind=segment")
    out = sources.read_mixed_dataset(spark, root)
    return out.select(F.col("id").cast("bigint").alias("id"), "balance", "segment", "kind")


@query("read_local_tree", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def read_local_tree(spark, sf):
    root = new_folder(spark, "tree")
    customer = I.table(spark, sf, "customer")
    customer.write.parquet(f"{root}/a/b")
    customer.write.parquet(f"{root}/c")
    return sources.read_local_tree(spark, root)


@query("load", f"SELECT {BRONZE_COLUMNS} FROM readings")
def load(spark, sf):
    return _readings_out(sources.load(spark, _lake(spark, sf)))


@query("read_mixed_types", """
SELECT CAST(c_custkey AS VARCHAR) AS id, 'customer' AS kind FROM customer UNION ALL SELECT o_orderpriority, 'order' FROM orders""")
def read_mixed_types(spark, sf):
    root = new_folder(spark, "types")
    I.table(spark, sf, "customer").select(F.col("c_custkey").alias("id")).write.option("header", "true").csv(f"{root}/kind=customer")
    I.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("id")).write.json(f"{root}/kind=order")
    return sources.read_mixed_dataset(spark, root)


@query("read_csv_first_rows", """
SELECT o_orderkey, o_custkey, CAST(m AS INTEGER) AS m FROM (
  SELECT *, row_number() OVER (PARTITION BY m ORDER BY o_orderkey) AS n
  FROM (SELECT o_orderkey, o_custkey, 12 * year(o_orderdate) + month(o_orderdate) AS m FROM orders)) WHERE n <= 10""")
def read_csv_first_rows(spark, sf):
    month = 12 * F.year("o_orderdate") + F.month("o_orderdate")
    rows = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", month.alias("m"))
    path = new_folder(spark, "csv")
    rows.repartition("m").sortWithinPartitions("m", "o_orderkey").write.option("header", "true").partitionBy("m").csv(path)  # a file a month
    return sources.read_csv(spark, path, max_rows=10, schema=rows.schema)


@query("register_external", "SELECT o_orderkey, o_custkey FROM orders")
def register_external(spark, sf):
    path = new_folder(spark, "external")
    rows = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    rows.write.parquet(path)
    return sources.register_external(spark, "varve_checks", f"external_{uuid.uuid4().hex}", rows.schema, path)


@query("materialize", "SELECT c_custkey, c_name FROM customer")
def materialize(spark, sf):
    spark.sql("CREATE DATABASE IF NOT EXISTS varve_checks")
    rows = I.table(spark, sf, "customer").select("c_custkey", "c_name")
    name = f"varve_checks.customers_{uuid.uuid4().hex}"
    sinks.materialize(rows.limit(0), name)
    return sinks.materialize(rows, name)  # rebuilt in full


@query("land_raw_json", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def land_raw_json(spark, sf):
    rows = I.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return spark.read.schema(rows.schema).json(sinks.land_raw_json(rows, new_folder(spark, "raw"), "customers"))


@query("copy_parquet", f"SELECT {BRONZE_COLUMNS} FROM readings")
def copy_parquet(spark, sf):
    path = new_folder(spark, "copy")
    sinks.copy_parquet(spark, _lake(spark, sf), path, cols=("year", "month", "day"))
    return _readings_out(spark.read.parquet(path))


@query("transformer", f"SELECT {BRONZE_COLUMNS} FROM bronze")
def transformer(spark, sf):
    at = F.col("kafka_timestamp") + F.expr("INTERVAL 90 MINUTES")
    return _readings_out(transformers.transformer("NOAA")(I.messages(spark, sf), processed_at=at))


@query("sample_table", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey, o_custkey, o_totalprice LIMIT 10000")
def sample_table(spark, sf):
    I.table(spark, sf, "orders").createOrReplaceTempView("orders_to_sample")
    out = sources.sample_table(spark, "orders_to_sample", order_by=("o_orderkey", "o_custkey", "o_totalprice"))
    return out.select("o_orderkey", "o_custkey", "o_totalprice")


@query("list_datasets", """
SELECT concat(dataset_name, '_partitioned') AS name, dataset_name AS key, CAST(sum(size) AS BIGINT) AS size, max(modified) AS last_modified,
       dataset_name, true AS is_partitioned, CAST(count(*) AS INTEGER) AS partition_count,
       (SELECT string_agg(concat(partition_key, '=', v), ' ' ORDER BY partition_key) FROM (
          SELECT partition_key, string_agg(partition_value, ',' ORDER BY partition_value) AS v FROM part_values p
          WHERE p.dataset_name = data_files.dataset_name GROUP BY partition_key)) AS partition_info
FROM data_files WHERE is_partitioned GROUP BY dataset_name
UNION ALL
SELECT concat(dataset_name, '.v1.csv'), path, size, modified, dataset_name, false, NULL, NULL FROM data_files WHERE NOT is_partitioned""")
def list_datasets(spark, sf):
    out = listing.list_datasets(I.listing(spark, sf))
    entry = F.transform(F.map_entries("partition_info"), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ",")))
    return plain(out.withColumn("partition_info", F.array_join(entry, " ")).drop("root_path"))


_PAGE = 10


@query("value_pages", f"""
SELECT dataset_name, partition_key, page, string_agg(partition_value, ',' ORDER BY partition_value) AS partition_values,
       count(*) AS value_count, CAST(sum(files) AS BIGINT) AS files, CAST(sum(size) AS BIGINT) AS size
FROM (SELECT *, (row_number() OVER (PARTITION BY dataset_name, partition_key ORDER BY partition_value) - 1) // {_PAGE} + 1 AS page FROM part_values)
GROUP BY dataset_name, partition_key, page""")
def value_pages(spark, sf):
    path = new_folder(spark, "values")
    listing.store_values(I.listing(spark, sf), path)
    return listing.value_pages(spark, path, _PAGE).withColumn("partition_values", F.array_join("partition_values", ","))


@query("list_dataset_counts", """
SELECT dataset_name, CAST(count(*) AS INTEGER) AS partition_count, CAST(sum(size) AS BIGINT) AS size,
       (SELECT string_agg(concat(partition_key, '=', n), ' ' ORDER BY partition_key) FROM (
          SELECT partition_key, count(*) AS n FROM part_values p WHERE p.dataset_name = data_files.dataset_name GROUP BY partition_key)) AS partition_info
FROM data_files WHERE is_partitioned GROUP BY dataset_name""")
def list_dataset_counts(spark, sf):
    out = listing.list_datasets(I.listing(spark, sf), with_values=False).where("is_partitioned")
    entry = F.transform(F.map_entries("partition_info"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return out.select("dataset_name", "partition_count", "size", F.array_join(entry, " ").alias("partition_info"))


@query("list_partitions", """
SELECT dataset_name, partition_key, string_agg(partition_value, ',' ORDER BY partition_value) AS partition_values,
       count(*) AS value_count, (SELECT count(*) FROM part_values WHERE dataset_name = 'weather') AS total_partitions
FROM part_values WHERE dataset_name = 'weather' GROUP BY dataset_name, partition_key""")
def list_partitions(spark, sf):
    out = listing.list_partitions(I.listing(spark, sf), "weather")
    return out.withColumn("partition_values", F.array_join("partition_values", ","))


@query("partition_values", "SELECT * FROM part_values")
def partition_values(spark, sf):
    return listing.partition_values(I.listing(spark, sf))


@query("data_extensions", "SELECT path FROM listing WHERE NOT path LIKE '%.txt'")
def data_extensions(spark, sf):
    return I.listing(spark, sf).where(N.data_file("path")).select("path")


@query("safe_name", """
SELECT name, length(name) BETWEEN 1 AND 100 AND regexp_matches(name, '^[a-zA-Z0-9_.-]+$') AS file_name,
       length(name) BETWEEN 1 AND 100 AND regexp_matches(name, '^[a-zA-Z0-9_-]+$') AS dataset_name,
       length(name) BETWEEN 1 AND 100 AND regexp_matches(name, '^[a-zA-Z_][a-zA-Z0-9_]*$') AS column_name
FROM (SELECT url AS name FROM pages UNION ALL SELECT replace(p_name, ' ', '_') FROM part UNION ALL SELECT c_name FROM customer)""")
def safe_name(spark, sf):
    urls = I.table(spark, sf, "pages").select(F.col("url").alias("name"))
    parts = I.table(spark, sf, "part").select(F.replace("p_name", F.lit(" "), F.lit("_")).alias("name"))
    people = I.table(spark, sf, "customer").select(F.col("c_name").alias("name"))
    return tables.union_all([urls, parts, people]).select("name", *[N.safe_name("name", k).alias(k) for k in C.SAFE_NAMES])


# Sinks --------------------------------------------------------------------------------------------------------------


@query("write_partitioned", f"SELECT {BRONZE_COLUMNS} FROM readings")
def write_partitioned(spark, sf):
    path = _lake(spark, sf)
    return _readings_out(spark.read.parquet(path))


@query("export_parquet", "SELECT * FROM gold")
def export_parquet(spark, sf):
    path = new_folder(spark, "gold")
    rows = gold.weather_metrics(_silver(spark, sf), gold_time(), ordered=False)
    sinks.export_parquet(rows, path)
    return plain(spark.read.parquet(path).select(*rows.columns), *GOLD_ROUND)


@query("compact", f"SELECT {BRONZE_COLUMNS} FROM readings")
def compact(spark, sf):
    source = _lake(spark, sf)
    return _readings_out(spark.read.parquet(sinks.compact(spark, source, new_folder(spark, "compacted"))))


@query("pack", f"SELECT {BRONZE_COLUMNS} FROM readings")
def pack(spark, sf):
    path = new_folder(spark, "small")
    I.readings(spark, sf).repartition(6).write.partitionBy(*C.DATE_PARTS).parquet(path)
    if not compaction.pack(spark, path):
        raise RuntimeError("nothing was packed")
    return _readings_out(spark.read.parquet(path))


@query("encode_messages", """
SELECT coalesce(city, 'none') AS key,
       concat('{"kafka_offset":', kafka_offset, ',"wind_speed":', coalesce('"' || wind_speed || '"', 'null'), '}') AS value
FROM single_readings""")
def encode_messages(spark, sf):
    rows = I.single_readings(spark, sf)
    return nested.encode_messages(rows, F.coalesce("city", F.lit("none")), ["kafka_offset", "wind_speed"])


@query("publish_if_valid", "SELECT * FROM gold")
def publish_if_valid(spark, sf):
    source, target = new_folder(spark, "gold"), new_folder(spark, "published")
    rows = gold.weather_metrics(_silver(spark, sf), gold_time(), ordered=False)
    sinks.export_parquet(rows, source)
    report = jobs.validate(spark, source)
    if not sinks.publish_if_valid(spark.read.parquet(source), report, target, source=source):
        raise RuntimeError("the checks failed")
    return plain(spark.read.parquet(target).select(*rows.columns), *GOLD_ROUND)


# Bronze and silver --------------------------------------------------------------------------------------------------


@query("decode_readings", """
SELECT CASE WHEN ok THEN temperature END AS temperature, CASE WHEN ok THEN wind_speed END AS wind_speed,
       CASE WHEN ok THEN city END AS city, CASE WHEN ok THEN timestamp END AS timestamp,
       CASE WHEN ok THEN humidity END AS humidity, CASE WHEN ok THEN pressure END AS pressure,
       CASE WHEN ok THEN visibility END AS visibility,
       kafka_offset AS offset, kafka_partition AS partition, kafka_timestamp
FROM (SELECT *, kafka_offset % 29 <> 1 AS ok FROM single_readings WHERE kafka_offset % 29 NOT IN (0, 2))""")
def decode_readings(spark, sf):
    return plain(silver.decode_readings(I.messages(spark, sf)))


@query("non_empty_payload", 'SELECT kafka_offset AS "offset" FROM single_readings WHERE kafka_offset % 29 NOT IN (0, 2)')
def non_empty_payload(spark, sf):
    return I.messages(spark, sf).where(silver.non_empty_payload(F.col("value").cast("string"))).select("offset")


@query("fill_numeric_nulls", """
SELECT kafka_offset, coalesce(temperature, 0) AS temperature, coalesce(humidity, 0) AS humidity, coalesce(pressure, 0) AS pressure,
       coalesce(visibility, 0) AS visibility, wind_speed FROM readings""")
def fill_numeric_nulls(spark, sf):
    out = silver.fill_numeric_nulls(I.readings(spark, sf))
    return out.select("kafka_offset", "temperature", "humidity", "pressure", "visibility", "wind_speed")


@query("bronze", f"SELECT {BRONZE_COLUMNS} FROM bronze")
def bronze(spark, sf):
    return plain(_bronze(I.messages(spark, sf)))


def _bronze(messages: DataFrame) -> DataFrame:
    """Bronze with a processing time taken from the topic time, so that runs agree."""
    return silver.bronze(messages, processed_at=F.col("kafka_timestamp") + F.expr("INTERVAL 90 MINUTES"))


@query("bronze_stream", f"SELECT {BRONZE_COLUMNS} FROM bronze")
def bronze_stream(spark, sf):
    path = new_folder(spark, "bronze")
    q = streams.bronze_stream(
        I.messages(spark, sf, I.event_stream(spark, sf)),
        path,
        new_folder(spark, "checkpoint"),
        trigger=None,
        processed_at=F.col("kafka_timestamp") + F.expr("INTERVAL 90 MINUTES"),
    )
    q.awaitTermination()
    return _readings_out(spark.read.parquet(path))


@query("stream_restart", f"SELECT {BRONZE_COLUMNS} FROM bronze")
def stream_restart(spark, sf):
    path, checkpoint = new_folder(spark, "bronze"), new_folder(spark, "checkpoint")
    for _ in range(2):  # the second run finds nothing new
        messages = I.messages(spark, sf, I.event_stream(spark, sf))
        streams.bronze_stream(messages, path, checkpoint, trigger=None, processed_at=F.col("kafka_timestamp") + F.expr("INTERVAL 90 MINUTES")).awaitTermination()
    return _readings_out(spark.read.parquet(path))


FILE_ROWS = 100_000


def _part_files(spark, sf) -> int:
    """The files of a quarter of the messages: more for more rows, so that no task has all of it."""
    return 1 + I.table(spark, sf, "events").count() // (4 * FILE_ROWS)


def _message_files(spark, sf, path: str, halves) -> None:
    """Some messages as files of a folder that a stream reads. The texts are made after the rows are dealt out."""
    events, files = I.table(spark, sf, "events"), _part_files(spark, sf)
    for half in halves:
        part = events.where(F.col("event_id") % 4 == half).repartition(files)
        I.messages(spark, sf, part).write.mode("append").parquet(path)


def _message_stream(spark, sf, path: str) -> DataFrame:
    """A quarter of the messages at a time."""
    return spark.readStream.schema(I.messages(spark, sf).schema).option("maxFilesPerTrigger", _part_files(spark, sf)).parquet(path)


@query("rate_capped_stream", f"SELECT {BRONZE_COLUMNS} FROM bronze")
def rate_capped_stream(spark, sf):
    inbox, path = new_folder(spark, "inbox"), new_folder(spark, "bronze")
    _message_files(spark, sf, inbox, range(4))
    q = streams.bronze_stream(_message_stream(spark, sf, inbox), path, new_folder(spark, "checkpoint"), trigger=None, processed_at=F.col("kafka_timestamp") + F.expr("INTERVAL 90 MINUTES"))
    q.awaitTermination()
    if sum(p["numInputRows"] > 0 for p in q.recentProgress) < 4:
        raise RuntimeError("the cap did not hold")
    return _readings_out(spark.read.parquet(path))


@query("bounded_run", f"SELECT {BRONZE_COLUMNS} FROM bronze")
def bounded_run(spark, sf):
    path, checkpoint = new_folder(spark, "bronze"), new_folder(spark, "checkpoint")
    messages = I.messages(spark, sf, I.event_stream(spark, sf))
    q = streams.bronze_stream(messages, path, checkpoint, trigger=None, processed_at=F.col("kafka_timestamp") + F.expr("INTERVAL 90 MINUTES"))
    if not streams.run_bounded(q, 3300):
        raise RuntimeError("the run was cut off")
    return _readings_out(spark.read.parquet(path))


@query("silver_stream", f"SELECT {SILVER_COLUMNS} FROM silver_bronze")
def silver_stream(spark, sf):
    inbox, lake, checkpoint = (new_folder(spark, n) for n in ("inbox", "lake", "checkpoint"))
    for halves in ((0, 1), (2, 3)):  # stopped, and started again where it stopped
        _message_files(spark, sf, inbox, halves)
        read_at = F.col("kafka_timestamp") + F.expr("INTERVAL 90 MINUTES")
        silver_streams.silver_stream(_message_stream(spark, sf, inbox), lake, checkpoint, trigger=None, processed_at=read_at).awaitTermination()
    return plain(spark.read.parquet(f"{lake}/silver").select(*silver.schemas.SILVER.names))


@query("clean_wind_speed", "SELECT kafka_offset, wind_text, wind_speed FROM cleaned")
def clean_wind_speed(spark, sf):
    return I.readings(spark, sf).select("kafka_offset", F.col("wind_speed").alias("wind_text"), K.clean_wind_speed("wind_speed").alias("wind_speed"))


@query("clean_timestamp", "SELECT kafka_offset, timestamp FROM cleaned")
def clean_timestamp(spark, sf):
    return plain(I.readings(spark, sf).select("kafka_offset", K.clean_timestamp("timestamp", "processing_timestamp").alias("timestamp")))


@query("clean_timestamp_strict", """
SELECT e.kafka_offset, e.timestamp AS exact, c.timestamp AS parsed
FROM cleaned_exact e JOIN cleaned_cast c ON e.kafka_offset = c.kafka_offset""")
def clean_timestamp_strict(spark, sf):
    return plain(
        I.readings(spark, sf).select(
            "kafka_offset",
            K.clean_timestamp_strict("timestamp", "processing_timestamp").alias("exact"),
            K.clean_timestamp_strict("timestamp", "processing_timestamp", exact=False).alias("parsed"),
        )
    )


@query("clean_city", "SELECT kafka_offset, city FROM cleaned")
def clean_city(spark, sf):
    return I.readings(spark, sf).select("kafka_offset", K.clean_city("city").alias("city"))


def _wind_cleaned(spark, sf):
    return I.readings(spark, sf).withColumn("wind_speed", K.clean_wind_speed("wind_speed"))


@query("range_flags", """
SELECT kafka_offset, coalesce(temperature BETWEEN -90 AND 60, false) AS temperature_valid,
       coalesce(humidity BETWEEN 0 AND 100, false) AS humidity_valid, coalesce(pressure BETWEEN 800 AND 1100, false) AS pressure_valid,
       coalesce(wind_speed BETWEEN 0 AND 100, false) AS wind_speed_valid, coalesce(visibility BETWEEN 0 AND 50, false) AS visibility_valid
FROM cleaned""")
def range_flags(spark, sf):
    flags = K.range_flags()
    return _wind_cleaned(spark, sf).withColumns(flags).select("kafka_offset", *flags)


@query("quality_score", """
SELECT kafka_offset, (CASE WHEN temperature BETWEEN -90 AND 60 THEN 1 ELSE 0 END + CASE WHEN humidity BETWEEN 0 AND 100 THEN 1 ELSE 0 END
  + CASE WHEN pressure BETWEEN 800 AND 1100 THEN 1 ELSE 0 END + CASE WHEN wind_speed BETWEEN 0 AND 100 THEN 1 ELSE 0 END
  + CASE WHEN visibility BETWEEN 0 AND 50 THEN 1 ELSE 0 END) / 5::DOUBLE AS quality_score FROM cleaned""")
def quality_score(spark, sf):
    return _wind_cleaned(spark, sf).select("kafka_offset", K.quality_score(K.range_flags().values()).alias("quality_score"))


@query("is_valid", """
SELECT kafka_offset, coalesce(temperature BETWEEN -90 AND 60 AND humidity BETWEEN 0 AND 100 AND pressure BETWEEN 800 AND 1100
  AND wind_speed BETWEEN 0 AND 100 AND visibility BETWEEN 0 AND 50, false) AS is_valid FROM cleaned""")
def is_valid(spark, sf):
    return _wind_cleaned(spark, sf).select("kafka_offset", K.is_valid(K.range_flags().values()).alias("is_valid"))


@query("weather_category", """
SELECT kafka_offset, CASE WHEN temperature > 30 THEN 'HOT' WHEN temperature < 0 THEN 'COLD' WHEN wind_speed > 15 THEN 'WINDY'
  WHEN visibility < 5 THEN 'FOGGY' ELSE 'NORMAL' END AS weather_category FROM cleaned""")
def weather_category(spark, sf):
    return _wind_cleaned(spark, sf).select("kafka_offset", K.weather_category().alias("weather_category"))


@query("freshness_hours", """
SELECT kafka_offset, (floor(epoch(processing_timestamp)) - floor(epoch(kafka_timestamp))) / 3600 AS data_freshness_hours FROM readings""")
def freshness_hours(spark, sf):
    return I.readings(spark, sf).select("kafka_offset", K.freshness_hours("processing_timestamp", "kafka_timestamp").alias("data_freshness_hours"))


@query("date_parts", """
SELECT kafka_offset, CAST(date_part('year', kafka_timestamp) AS INTEGER) AS year, CAST(date_part('month', kafka_timestamp) AS INTEGER) AS month,
       CAST(date_part('day', kafka_timestamp) AS INTEGER) AS day FROM readings""")
def date_parts(spark, sf):
    return I.readings(spark, sf).withColumns(K.date_parts("kafka_timestamp")).select("kafka_offset", "year", "month", "day")


@query("conform", "SELECT CAST(event_id AS INTEGER) AS kafka_partition, CAST(value AS VARCHAR) AS wind_speed FROM (SELECT event_id, CAST(user_id AS BIGINT) AS value FROM events)")
def conform(spark, sf):
    events = I.table(spark, sf, "events").select("ts", F.col("event_id").alias("kafka_partition"), F.col("user_id").alias("wind_speed"))
    target = T.StructType([silver.schemas.BRONZE["kafka_partition"], silver.schemas.BRONZE["wind_speed"]])
    return silver.schemas.conform(events, target)


@query("completeness_score", "SELECT kafka_offset, quality_score FROM completeness")
def completeness_score(spark, sf):
    return I.readings(spark, sf).select("kafka_offset", K.completeness_score().alias("quality_score"))


@query("completeness_flag", "SELECT kafka_offset, is_valid FROM completeness")
def completeness_flag(spark, sf):
    return I.readings(spark, sf).select("kafka_offset", K.completeness_flag().alias("is_valid"))


@query("usable", """
SELECT kafka_offset, CASE WHEN temperature <> 0 THEN temperature END AS temperature, CASE WHEN humidity > 0 THEN humidity END AS humidity,
       CASE WHEN pressure > 0 THEN pressure END AS pressure, CASE WHEN visibility >= 0 THEN visibility END AS visibility FROM bronze""")
def usable(spark, sf):
    rows = _bronze(I.messages(spark, sf))
    return rows.select("kafka_offset", *[K.usable(m).alias(m) for m in ("temperature", "humidity", "pressure", "visibility")])


@query("validated", "SELECT kafka_offset FROM silver_strict")
def validated(spark, sf):
    return silver.silver_strict(I.readings(spark, sf), ordered=False).select("kafka_offset")


@query("keep_latest", "SELECT kafka_offset FROM latest")
def keep_latest(spark, sf):
    rows = silver.clean(I.readings(spark, sf), K.clean_timestamp("timestamp", "processing_timestamp"))
    return dedup.keep_latest(rows).select("kafka_offset")


@query("keep_latest_by_aggregate", "SELECT kafka_offset FROM latest")
def keep_latest_by_aggregate(spark, sf):
    rows = silver.clean(I.readings(spark, sf), K.clean_timestamp("timestamp", "processing_timestamp"))
    return dedup.keep_latest_by_aggregate(rows).select("kafka_offset")


@query("silver", f"SELECT {SILVER_COLUMNS} FROM silver")
def silver_table(spark, sf):
    return plain(_silver(spark, sf))


@query("silver_for_date", """
SELECT count(*) > 0 AS success, count(*) AS record_count, count(*) FILTER (WHERE is_valid) AS valid_records,
       count(*) FILTER (WHERE NOT is_valid) AS invalid_records, round(avg(quality_score) + 1e-10, 6) AS avg_quality_score
FROM silver_day""")
def silver_for_date(spark, sf):
    # Copies that came after midnight belong to the next day's run.
    result = jobs.silver_for_date(spark, _lake(spark, sf), new_folder(spark, "silver"), DAY)
    return plain(result.frame(spark).drop("processing_time_ms"), "avg_quality_score")


@query("silver_for_date_rows", f"SELECT {SILVER_COLUMNS} FROM silver_day")
def silver_for_date_rows(spark, sf):
    path = new_folder(spark, "silver")
    jobs.silver_for_date(spark, _lake(spark, sf), path, DAY)
    return plain(spark.read.parquet(path).select(*silver.schemas.SILVER.names))


@query("silver_job", f"SELECT {SILVER_COLUMNS} FROM silver")
def silver_job(spark, sf):
    path, source = new_folder(spark, "silver"), _lake(spark, sf)
    jobs.silver_job(spark, source, path)
    jobs.silver_job(spark, source, path)
    return plain(spark.read.parquet(path).select(*silver.schemas.SILVER.names))


@query("silver_exact_time", f"SELECT {SILVER_COLUMNS} FROM silver_exact")
def silver_exact_time(spark, sf):
    return plain(silver.silver(I.readings(spark, sf), strict_time=True))


@query("silver_strict", f"SELECT {STRICT_COLUMNS} FROM silver_strict ORDER BY processing_timestamp DESC")
def silver_strict(spark, sf):
    return plain(silver.silver_strict(I.readings(spark, sf), ordered=True))


@query("silver_in_order", """
SELECT kafka_offset, kafka_partition, processing_timestamp,
       row_number() OVER (ORDER BY processing_timestamp DESC NULLS LAST, kafka_partition NULLS FIRST, kafka_offset NULLS FIRST) AS position FROM strict_tied""")
def silver_in_order(spark, sf):
    path = new_folder(spark, "ordered")
    sinks.write_in_order(silver.silver_strict(I.tied_readings(spark, sf)), path, silver.newest_first())
    return plain(sources.read_in_order(spark, path).select("kafka_offset", "kafka_partition", "processing_timestamp", "position"))


@query("quality_metrics", """
SELECT count(*) AS total_records, count(*) FILTER (WHERE is_valid) AS valid_records, count(*) FILTER (WHERE NOT is_valid) AS invalid_records,
       round(avg(quality_score) + 1e-10, 6) AS avg_quality_score, min(processing_timestamp) AS earliest_record,
       max(processing_timestamp) AS latest_record, round(count(*) FILTER (WHERE is_valid) * 100 / count(*)::DOUBLE + 1e-10, 6) AS quality_rate
FROM silver""")
def quality_metrics(spark, sf):
    return plain(silver.quality_summary(_silver(spark, sf)), "avg_quality_score", "quality_rate")


# Gold ---------------------------------------------------------------------------------------------------------------

GOLD_ROUND = ("avg_temperature", "temperature_stddev", "avg_humidity", "avg_pressure", "avg_wind_speed", "avg_visibility", "avg_quality_score")


@query("daily_metrics", "SELECT * FROM daily")
def daily_metrics(spark, sf):
    return plain(gold.daily_metrics(_silver(spark, sf)), *GOLD_ROUND)


@query("daily_metrics_merged", "SELECT * FROM daily")
def daily_metrics_merged(spark, sf):
    rows = _silver(spark, sf)
    batches = [states.daily_states(rows.where(F.coalesce(F.pmod(F.hash("kafka_offset"), F.lit(3)), F.lit(0)) == i)) for i in range(3)]
    merged = states.merge_states(states.merge_states(*batches[:2]), batches[2])
    return plain(states.metrics_of(merged), *GOLD_ROUND)


@query("hourly_metrics", """
SELECT data_source, year, month, day, hour, city,
       round(avg(temperature) FILTER (WHERE temperature <> 0) + 1e-10, 6) AS hourly_avg_temperature,
       round(avg(humidity) FILTER (WHERE humidity > 0) + 1e-10, 6) AS hourly_avg_humidity,
       round(avg(pressure) FILTER (WHERE pressure > 0) + 1e-10, 6) AS hourly_avg_pressure,
       round(avg(wind_speed) FILTER (WHERE wind_speed >= 0) + 1e-10, 6) AS hourly_avg_wind_speed,
       round(avg(visibility) FILTER (WHERE visibility >= 0) + 1e-10, 6) AS hourly_avg_visibility,
       round(avg(quality_score) + 1e-10, 6) AS hourly_avg_quality_score, count(*) AS hourly_record_count
FROM silver GROUP BY data_source, year, month, day, hour, city""")
def hourly_metrics(spark, sf):
    out = gold.hourly_metrics(_silver(spark, sf))
    return plain(out, *[c for c in out.columns if c.startswith("hourly_avg")])


@query("weather_alerts", "SELECT * FROM alerts")
def weather_alerts(spark, sf):
    return gold.weather_alerts(_silver(spark, sf))


@query("alert_type", "SELECT city, year, month, day, weather_alert_type FROM alerts")
def alert_type(spark, sf):
    return gold.daily_metrics(_silver(spark, sf)).select("city", "year", "month", "day", gold.alert_type().alias("weather_alert_type"))


@query("alert_severity", "SELECT city, year, month, day, alert_severity FROM alerts")
def alert_severity(spark, sf):
    return gold.daily_metrics(_silver(spark, sf)).select("city", "year", "month", "day", gold.alert_severity().alias("alert_severity"))


@query("attach_alerts", """
SELECT s.data_source, s.year, s.month, s.day, s.city, s.record_count, a.weather_alert_type, a.alert_severity
FROM (SELECT data_source, year, month, day, city, count(*) AS record_count FROM latest_cast GROUP BY ALL) s
LEFT JOIN alerts a ON s.data_source = a.data_source AND s.year = a.year AND s.month = a.month AND s.day = a.day
  AND trim(upper(s.city)) = a.city AND s.city = trim(upper(s.city))""")
def attach_alerts(spark, sf):
    # Raw cities on the left: some null, none spelled as in the alerts, so most rows stay without an alert.
    strict = silver.clean(I.readings(spark, sf), K.clean_timestamp_strict("timestamp", "processing_timestamp", exact=False), F.col("city"))
    daily = dedup.keep_latest(strict).groupBy(*C.DAILY_KEYS).agg(F.count(F.lit(1)).alias("record_count"))
    return gold.attach_alerts(daily, gold.weather_alerts(_silver(spark, sf)))


@query("weather_metrics", "SELECT * FROM gold ORDER BY data_source, year, month, day, city")
def weather_metrics(spark, sf):
    return plain(gold.weather_metrics(_silver(spark, sf), gold_time()), *GOLD_ROUND)


@query("weather_metrics_joined", "SELECT * FROM gold ORDER BY data_source, year, month, day, city")
def weather_metrics_joined(spark, sf):
    return plain(gold.weather_metrics(_silver(spark, sf), gold_time(), joined=True), *GOLD_ROUND)


# Market -------------------------------------------------------------------------------------------------------------

TS = "trading_date"
# Sums come out in another order per engine; differences and ratios of the same two numbers do not.
BAR_ROUND = ("sma_20", "sma_50", "volume_ma", "volatility", "volume_ratio")
SIDE_ROUND = ("sentiment_ma",)


@query("bar_features", f"SELECT {rounded(*BAR_ROUND)} FROM bar_features")
def bar_features(spark, sf):
    return plain(market.bar_features(I.bars(spark, sf), TS), *BAR_ROUND)


@query("bar_features_chunked", f"SELECT {rounded(*BAR_ROUND)} FROM bar_features")
def bar_features_chunked(spark, sf):
    return plain(market.bar_features(I.bars(spark, sf), TS, rows_per_task=500, long=True), *BAR_ROUND)


@query("volatility_regime", "SELECT symbol, trading_date, volatility_regime FROM regimes")
def volatility_regime(spark, sf):
    out = market.volatility_regime(market.bar_features(I.bars(spark, sf), TS))
    return out.select("symbol", TS, "volatility_regime")


@query("volatility_regime_counted", "SELECT symbol, trading_date, volatility_regime FROM regimes")
def volatility_regime_counted(spark, sf):
    out = market.volatility_regime(market.bar_features(I.bars(spark, sf), TS), long=True)
    return out.select("symbol", TS, "volatility_regime")


@query("exact_quantiles", """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1::DOUBLE) + 1e-10, 6) AS q0, round(quantile_cont(l_extendedprice, 0.5::DOUBLE) + 1e-10, 6) AS q1,
       round(quantile_cont(l_extendedprice, 0.99::DOUBLE) + 1e-10, 6) AS q2 FROM lineitem GROUP BY l_returnflag""")
def exact_quantiles(spark, sf):
    out = quantiles.exact_quantiles(I.table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.1, 0.5, 0.99])
    return plain(out, "q0", "q1", "q2")


@query("sentiment_features", f"SELECT {rounded(*SIDE_ROUND)} FROM sentiment")
def sentiment_features(spark, sf):
    return plain(market.sentiment_features(I.feed(spark, sf), TS), *SIDE_ROUND)


@query("indicator_features", "SELECT * FROM signals")
def indicator_features(spark, sf):
    return market.indicator_features(I.indicators(spark, sf), TS)


@query("combine_features", "SELECT * FROM bars LEFT JOIN feed USING (symbol, trading_date) LEFT JOIN indicators USING (symbol, trading_date)")
def combine_features(spark, sf):
    return market.combine_features(I.bars(spark, sf), I.feed(spark, sf), I.indicators(spark, sf), TS)


@query("market_features", f"SELECT {rounded(*BAR_ROUND, *SIDE_ROUND)} FROM market")
def market_features(spark, sf):
    out = market.market_features(I.bars(spark, sf), I.feed(spark, sf), I.indicators(spark, sf), TS)
    return plain(out, *BAR_ROUND, *SIDE_ROUND)


@query("market_features_chunked", f"SELECT {rounded(*BAR_ROUND, *SIDE_ROUND)} FROM market")
def market_features_chunked(spark, sf):
    out = market.market_features(I.bars(spark, sf), I.feed(spark, sf), I.indicators(spark, sf), TS, rows_per_task=300, long=True)
    return plain(out, *BAR_ROUND, *SIDE_ROUND)


@query("market_features_mixed", f"SELECT {rounded(*BAR_ROUND, *SIDE_ROUND)} FROM mixed_market")
def market_features_mixed(spark, sf):
    # Symbols of more than a year are cut, and told by their counts.
    out = market.market_features(I.mixed_bars(spark, sf), I.feed(spark, sf), I.indicators(spark, sf), TS, rows_per_task=366)
    return plain(out, *BAR_ROUND, *SIDE_ROUND)


@query("parse_money", "SELECT c_custkey, c_acctbal AS amount FROM customer")
def parse_money(spark, sf):
    text = F.concat(F.lit("$"), F.expr("format_number(c_acctbal, '#,##0.00')"))
    return I.table(spark, sf, "customer").select("c_custkey", K.parse_money(text).alias("amount"))


@query("to_number", "SELECT symbol, trading_date, TRY_CAST(overall_sentiment_score AS DOUBLE) AS score FROM feed")
def to_number(spark, sf):
    return I.feed(spark, sf).select("symbol", TS, K.to_number("overall_sentiment_score").alias("score"))


@query("high_low_range", "SELECT symbol, trading_date, high - low AS high_low_range FROM bars")
def high_low_range(spark, sf):
    return I.bars(spark, sf).select("symbol", TS, M.high_low_range().alias("high_low_range"))


@query("volume_ratio", "SELECT symbol, trading_date, round(volume_ratio + 1e-10, 6) AS volume_ratio FROM bar_features")
def volume_ratio(spark, sf):
    return plain(market.bar_features(I.bars(spark, sf), TS).select("symbol", TS, "volume_ratio"), "volume_ratio")


@query("rsi_signals", "SELECT symbol, trading_date, rsi_overbought, rsi_oversold FROM signals")
def rsi_signals(spark, sf):
    rows = I.indicators(spark, sf).withColumn("rsi", K.to_number("rsi"))
    return rows.withColumns(M.rsi_signals()).select("symbol", TS, "rsi_overbought", "rsi_oversold")


@query("trend", "SELECT symbol, trading_date, trend FROM bar_features")
def trend(spark, sf):
    return market.bar_features(I.bars(spark, sf), TS).select("symbol", TS, "trend")


@query("moving_average", """
SELECT symbol, trading_date, round(avg(close) OVER (PARTITION BY symbol ORDER BY trading_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) + 1e-10, 6) AS close_ma_7 FROM bars""")
def moving_average(spark, sf):
    return plain(market.with_moving_average(I.bars(spark, sf), "close", 7).select("symbol", TS, "close_ma_7"), "close_ma_7")


@query("price_change", "SELECT symbol, trading_date, price_change FROM bar_features")
def price_change(spark, sf):
    return market.bar_features(I.bars(spark, sf), TS).select("symbol", TS, "price_change")


@query("pct_change", "SELECT symbol, trading_date, daily_return, price_momentum FROM bar_features")
def pct_change(spark, sf):
    return market.bar_features(I.bars(spark, sf), TS).select("symbol", TS, "daily_return", "price_momentum")


@query("rolling_std", "SELECT symbol, trading_date, round(volatility + 1e-10, 6) + 0.0::DOUBLE AS volatility FROM bar_features")
def rolling_std(spark, sf):
    return plain(market.bar_features(I.bars(spark, sf), TS).select("symbol", TS, "volatility"), "volatility")


@query("rolling_mean", f"SELECT symbol, trading_date, round(sma_20 + 1e-10, 6) AS sma_20, round(sma_50 + 1e-10, 6) AS sma_50, round(volume_ma + 1e-10, 6) AS volume_ma FROM bar_features")
def rolling_mean(spark, sf):
    return plain(market.bar_features(I.bars(spark, sf), TS).select("symbol", TS, "sma_20", "sma_50", "volume_ma"), "sma_20", "sma_50", "volume_ma")


@query("macd_crossover", "SELECT symbol, trading_date, macd_crossover FROM signals")
def macd_crossover(spark, sf):
    return market.indicator_features(I.indicators(spark, sf), TS).select("symbol", TS, "macd_crossover")


@query("date_gaps", """
SELECT * FROM (SELECT *, CAST(next_date - trading_date AS INTEGER) AS days_difference FROM (
  SELECT symbol, trading_date, lead(trading_date) OVER (PARTITION BY symbol ORDER BY trading_date) AS next_date
  FROM (SELECT DISTINCT concat('P', l_partkey % 500) AS symbol, CAST(l_shipdate AS DATE) AS trading_date FROM lineitem)))
WHERE days_difference > 3 AND isodow(trading_date) < 6""")
def date_gaps(spark, sf):
    lines = I.table(spark, sf, "lineitem")
    return market.date_gaps(lines.select(F.concat(F.lit("P"), (F.col("l_partkey") % 500).cast("string")).alias("symbol"), F.col("l_shipdate").alias(TS)))


@query("stale_symbols", """
SELECT concat('C', o_custkey) AS symbol, max(CAST(o_orderdate AS DATE)) AS last_trading_date FROM orders GROUP BY o_custkey
HAVING max(CAST(o_orderdate AS DATE)) < DATE '2001-06-01'""")
def stale_symbols(spark, sf):
    orders = I.table(spark, sf, "orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("symbol"), F.col("o_orderdate").alias(TS))
    return market.stale_symbols(orders, F.lit("2001-06-02 15:00:00").cast("timestamp"))


@query("violation_counts", """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE daily_return < -0.5 OR daily_return > 0.5) AS extreme_returns,
       count(*) FILTER (WHERE volatility > 1) AS high_volatility, count(*) FILTER (WHERE close <= 0) AS invalid_prices FROM bar_features""")
def violation_counts(spark, sf):
    return market.violation_counts(market.bar_features(I.bars(spark, sf), TS))


@query("price_anomalies", """
SELECT symbol, trading_date, round(daily_return * 100 + 1e-10, 6) AS price_change_pct FROM bar_features
WHERE abs(daily_return * 100) > 5 AND trading_date >= DATE '2000-01-01'""")
def price_anomalies(spark, sf):
    rows = market.bar_features(I.bars(spark, sf), TS).withColumn("price_change_pct", F.col("daily_return") * 100)
    out = market.price_anomalies(rows, "2000-01-01", date=TS)
    return plain(out.select("symbol", TS, "price_change_pct"), "price_change_pct")


@query("avg_quality_by_symbol", f"""
SELECT event_type AS symbol, round(avg(value) + 1e-10, 6) AS avg_quality_score, count(*) AS record_count FROM events
WHERE CAST(ts AS DATE) >= DATE '{AS_OF_DAY}' GROUP BY event_type""")
def avg_quality_by_symbol(spark, sf):
    events = I.table(spark, sf, "events").select(F.col("event_type").alias("symbol"), F.col("ts").cast("date").alias("date"), F.col("value").alias("data_quality_score"))
    return plain(market.avg_quality_by_symbol(events, AS_OF_DAY), "avg_quality_score")


@query("market_hours", """
SELECT event_id, ts FROM (SELECT *, ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS local FROM events)
WHERE isodow(local) < 6 AND CAST(local AS TIME) BETWEEN TIME '09:30:00' AND TIME '16:00:00'""")
def market_hours(spark, sf):
    return I.table(spark, sf, "events").where(M.market_hours("ts")).select("event_id", "ts")


# Nested payloads ----------------------------------------------------------------------------------------------------


@query("flatten_forecast", """
SELECT 'now' AS timestamp, concat(latitude, '_', longitude) AS grid_id, latitude, longitude,
       CASE period WHEN 1 THEN 't0' ELSE 't1' END AS start_time, NULL AS end_time,
       CAST(CASE period WHEN 1 THEN user_id % 90 ELSE user_id % 40 END AS DOUBLE) AS temperature,
       CASE period WHEN 1 THEN 'F' ELSE 'C' END AS temperature_unit,
       CASE period WHEN 1 THEN concat(user_id % 30, ' mph') END AS wind_speed, NULL AS wind_direction, NULL AS short_forecast,
       NULL AS detailed_forecast, CAST(NULL AS DOUBLE) AS precipitation_probability,
       CAST(CASE period WHEN 1 THEN user_id % 100 END AS DOUBLE) AS relative_humidity,
       CAST(NULL AS DOUBLE) AS dewpoint, NULL AS dewpoint_unit,
       CAST(CASE period WHEN 2 THEN user_id % 300 + 800 END AS DOUBLE) AS pressure, CASE period WHEN 2 THEN 'hPa' END AS pressure_unit,
       CAST(NULL AS DOUBLE) AS visibility, NULL AS visibility_unit
FROM forecast_periods""")
def flatten_forecast(spark, sf):
    return nested.flatten_forecast(I.forecasts(spark, sf), fetched_at=F.lit("now"))


@query("forecast_to_reading", """
SELECT round(CASE period WHEN 1 THEN (user_id % 90 - 32) * 5 / 9::DOUBLE ELSE user_id % 40 END + 1e-10, 6) + 0.0::DOUBLE AS temperature,
       CASE period WHEN 1 THEN concat(user_id % 30, ' mph') END AS wind_speed, concat(latitude, '_', longitude) AS city, 'now' AS timestamp,
       CAST(CASE period WHEN 1 THEN user_id % 100 END AS DOUBLE) AS humidity,
       CAST(CASE period WHEN 2 THEN user_id % 300 + 800 END AS DOUBLE) AS pressure, CAST(NULL AS DOUBLE) AS visibility
FROM forecast_periods""")
def forecast_to_reading(spark, sf):
    return plain(nested.forecast_to_reading(nested.flatten_forecast(I.forecasts(spark, sf), fetched_at=F.lit("now"))), "temperature")


@query("flatten_intraday", "SELECT symbol, CAST(trading_date AS TIMESTAMP) AS ts, open, high, low, close, volume FROM bars")
def flatten_intraday(spark, sf):
    return plain(market.numeric_bars(nested.flatten_intraday(I.intraday_payloads(spark, sf))))


@query("flatten_feed", "SELECT symbol, CAST(trading_date AS TIMESTAMP) AS ts, overall_sentiment_score, overall_sentiment_label FROM feed")
def flatten_feed(spark, sf):
    out = nested.flatten_feed(I.feed_payloads(spark, sf))
    return plain(out.select("symbol", "ts", "overall_sentiment_score", "overall_sentiment_label"))


@query("flatten_indicators", """
SELECT symbol, CAST(trading_date AS TIMESTAMP) AS ts, rsi, CASE WHEN day(trading_date) > 1 THEN macd END AS macd,
       CASE WHEN day(trading_date) > 1 THEN macd_signal END AS macd_signal, CASE WHEN day(trading_date) > 1 THEN macd_hist END AS macd_hist
FROM indicators""")
def flatten_indicators(spark, sf):
    return plain(nested.flatten_indicators(*I.indicator_payloads(spark, sf)))


@query("envelope", """
SELECT symbol AS key, concat('{"timestamp":"now","symbol":"', symbol, '","data":{"rsi":"', rsi, '","macd":"', macd, '"}}') AS value FROM indicators""")
def envelope(spark, sf):
    return nested.envelope(I.indicators(spark, sf), "symbol", ["rsi", "macd"], sent_at=F.lit("now"))


@query("envelope_batched", """
SELECT symbol AS key, concat('{"timestamp":"now","symbol":"', symbol, '","data":[',
         string_agg(concat('{"rsi":"', rsi, '","macd":"', macd, '"}'), ',' ORDER BY trading_date), ']}') AS value
FROM (SELECT *, (row_number() OVER (PARTITION BY symbol ORDER BY trading_date) - 1) // 50 AS batch FROM indicators) GROUP BY symbol, batch""")
def envelope_batched(spark, sf):
    return nested.envelope(I.indicators(spark, sf), "symbol", ["rsi", "macd"], order=[TS], batch_rows=50, sent_at=F.lit("now"))


# Sort, page, sets ---------------------------------------------------------------------------------------------------


@query("page", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey, o_custkey LIMIT 500 OFFSET 250")
def page(spark, sf):
    orders = I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return tables.page(orders, [F.col("o_totalprice").desc(), "o_orderkey", "o_custkey"], top=500, skip=250)


@query("union_all", """
SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, NULL AS nation FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, NULL, s_nationkey FROM supplier""")
def union_all(spark, sf):
    customers = I.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = I.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"))
    return tables.union_all([customers, suppliers])


# Quality ------------------------------------------------------------------------------------------------------------


def _result(suite: str, rows: list[tuple[str, str | None, str, str]], source: str) -> str:
    """Result rows from (expectation, column, success, detail) expressions over aggregates of ``source``."""
    parts = []
    for n, (expectation, column, success, detail) in enumerate(rows, 1):
        name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"SELECT '{suite}' AS suite, {n} AS n, '{expectation}' AS expectation, {name} AS \"column\", "
            f"{success} AS success, {detail} AS detail, count(*) AS records FROM {source}"
        )
    return "\nUNION ALL ".join(parts)


def _rows() -> tuple:
    return ("expect_table_row_count_to_be_between", None, "count(*) >= 1", "concat(count(*), ' rows')")


def _not_null(c: str) -> tuple:
    return ("expect_column_values_to_not_be_null", c, f"count(*) = count({c})", f"concat(count(*) - count({c}), ' nulls')")


def _in_set(c: str, values: str, null_fails: bool = False) -> tuple:
    bad = f"count(*) FILTER (WHERE {c} NOT IN ({values}){f' OR {c} IS NULL' if null_fails else ''})"
    return ("expect_column_values_to_be_in_set", c, f"{bad} = 0", f"concat({bad}, ' unexpected')")


def _between(c: str, low: str, high: str) -> tuple:
    bad = f"count(*) FILTER (WHERE {c} < {low} OR {c} > {high})"
    return ("expect_column_values_to_be_between", c, f"{bad} = 0", f"concat({bad}, ' outside {low} to {high}')")


_MOSTLY_BAD = "count(*) FILTER (WHERE avg_temperature < -100 OR avg_temperature > 100)"
_GOLD_CHECKS = [
    _rows(),
    *[_not_null(c) for c in ("data_source", "year", "month", "day", "city")],
    _in_set("data_source", "'noaa', 'alphavantage', 'eosdis', 'openweather'", True),
    _between("year", "2020", "2030"),
    _between("month", "1", "12"),
    _between("day", "1", "31"),
    (
        "expect_column_values_to_be_between",
        "avg_temperature",
        f"(count(avg_temperature) - {_MOSTLY_BAD}) / count(avg_temperature)::DOUBLE >= 0.8",
        f"concat({_MOSTLY_BAD}, '/', count(avg_temperature), ' outliers')",
    ),
    ("expect_column_values_to_be_between", "record_count", "count(*) FILTER (WHERE record_count < 1) = 0", "concat(count(*) FILTER (WHERE record_count < 1), ' outside 1 to any')"),
]
_SILVER_CHECKS = [
    ("expect_table_columns_to_match_ordered_list", None, "true", "'columns match'"),
    _rows(),
    *[_not_null(c) for c in silver.schemas.SILVER.names],
    _in_set("data_source", "'noaa'"),
    _between("year", "2020", "2030"),
    _between("month", "1", "12"),
    _between("day", "1", "31"),
    _between("quality_score", "0", "1"),
    _in_set("is_valid", "true, false"),
    _in_set("weather_category", "'HOT', 'COLD', 'WINDY', 'FOGGY', 'NORMAL'"),
    _between("data_freshness_hours", "0", "168"),
]
_MARKET_CHECKS = [
    _not_null("close"),
    _between("daily_return", "-0.5", "0.5"),
    _between("volatility", "0", "1"),
    ("expect_column_values_to_be_greater_than", "close", "count(*) FILTER (WHERE close <= 0) = 0", "concat(count(*) FILTER (WHERE close <= 0), ' not above 0')"),
]


@query("gold_suite", _result("gold", _GOLD_CHECKS, "gold"))
def gold_suite(spark, sf):
    return quality.run_suite(gold.weather_metrics(_silver(spark, sf), gold_time(), ordered=False), quality.GOLD_SUITE)


@query("suite_merged", _result("gold", _GOLD_CHECKS, "gold"))
def suite_merged(spark, sf):
    rows = gold.weather_metrics(_silver(spark, sf), gold_time(), ordered=False)
    return quality.merged_suite(quality.suite_counters(rows, quality.GOLD_SUITE), quality.GOLD_SUITE, rows)


@query("silver_suite", _result("silver", _SILVER_CHECKS, "silver"))
def silver_suite(spark, sf):
    return quality.run_suite(_silver(spark, sf), quality.SILVER_SUITE)


@query("market_suite", _result("market", _MARKET_CHECKS, "bar_features"))
def market_suite(spark, sf):
    return quality.run_suite(market.bar_features(I.bars(spark, sf), TS), quality.MARKET_SUITE)


@query("bronze_suite", _result("bronze", [*[_not_null(c) for c in ("temperature", "city", "processing_timestamp", "data_source")], _in_set("data_source", "'noaa'")], "readings"))
def bronze_suite(spark, sf):
    return quality.run_suite(I.readings(spark, sf), quality.BRONZE_SUITE)


@query("indicator_suite", _result("indicators", [_between("TRY_CAST(rsi AS DOUBLE)", "0", "100"), ("expect_column_values_to_be_between", "daily_return", "false", "'column daily_return not found'")], "indicators").replace("'TRY_CAST(rsi AS DOUBLE)'", "'rsi'"))
def indicator_suite(spark, sf):
    return quality.run_suite(I.indicators(spark, sf), quality.INDICATOR_SUITE)


@query("row_count_check", _result("rows", [_rows()], "lineitem"))
def row_count_check(spark, sf):
    return quality.run_suite(I.table(spark, sf, "lineitem"), quality.Suite("rows", (quality.row_count(),)))


@query("not_null_check", _result("nulls", [_not_null("city"), _not_null("kafka_offset")], "readings"))
def not_null_check(spark, sf):
    return quality.run_suite(I.readings(spark, sf), quality.Suite("nulls", (quality.not_null("city"), quality.not_null("kafka_offset"))))


@query("value_set_check", _result("sets", [_in_set("city", "' city_1 ', ' city_2 '"), _in_set("city", "' city_1 ', ' city_2 '", True)], "readings"))
def value_set_check(spark, sf):
    cities = (" city_1 ", " city_2 ")
    return quality.run_suite(I.readings(spark, sf), quality.Suite("sets", (quality.in_set("city", cities), quality.in_set("city", cities, null_ok=False))))


@query("between_check", """
SELECT 'ranges' AS suite, 1 AS n, 'expect_column_values_to_be_between' AS expectation, 'temperature' AS "column",
       count(*) FILTER (WHERE temperature < -10 OR temperature > 10) = 0 AS success,
       concat(count(*) FILTER (WHERE temperature < -10 OR temperature > 10), ' outside -10 to 10') AS detail, count(*) AS records FROM readings
UNION ALL SELECT 'ranges', 2, 'expect_column_values_to_be_between', 'temperature',
       count(*) FILTER (WHERE temperature BETWEEN -10 AND 10) / count(temperature)::DOUBLE >= 0.8,
       concat(count(*) FILTER (WHERE temperature < -10 OR temperature > 10), '/', count(temperature), ' outliers'), count(*) FROM readings""")
def between_check(spark, sf):
    checks = (quality.between("temperature", -10, 10), quality.between("temperature", -10, 10, mostly=0.8))
    return quality.run_suite(I.readings(spark, sf), quality.Suite("ranges", checks))


@query("greater_than_check", _result("above", [("expect_column_values_to_be_greater_than", "c_acctbal", "count(*) FILTER (WHERE c_acctbal <= 0) = 0", "concat(count(*) FILTER (WHERE c_acctbal <= 0), ' not above 0')")], "customer"))
def greater_than_check(spark, sf):
    return quality.run_suite(I.table(spark, sf, "customer"), quality.Suite("above", (quality.greater_than("c_acctbal", 0),)))


@query("freshness_check", """
SELECT 'freshness' AS suite, 1 AS n, 'no stale symbols' AS expectation, CAST(NULL AS VARCHAR) AS "column", count(*) = 0 AS success,
       concat(count(*), ' rows found') AS detail, count(*) AS records
FROM (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING max(CAST(o_orderdate AS DATE)) < DATE '2001-06-01')""")
def freshness_check(spark, sf):
    return quality.no_rows(stale_symbols(spark, sf), "freshness", "no stale symbols")


@query("continuity_check", """
SELECT 'continuity' AS suite, 1 AS n, 'no date gaps' AS expectation, CAST(NULL AS VARCHAR) AS "column", count(*) = 0 AS success,
       concat(count(*), ' rows found') AS detail, count(*) AS records
FROM (SELECT trading_date, lead(trading_date) OVER (PARTITION BY symbol ORDER BY trading_date) - trading_date AS days FROM bars)
WHERE days > 3 AND isodow(trading_date) < 6""")
def continuity_check(spark, sf):
    return quality.no_rows(market.date_gaps(I.bars(spark, sf)), "continuity", "no date gaps")


def _summary(results: str, pass_percent: int) -> str:
    return f"""
SELECT max(records) > 0 AND count(*) FILTER (WHERE success) * 100 / count(*)::DOUBLE >= {pass_percent} AS success, max(records) AS total_records,
       count(*) AS validations_checked, count(*) FILTER (WHERE success) AS successful_validations,
       count(*) FILTER (WHERE NOT success) AS failed_validations,
       round(count(*) FILTER (WHERE success) * 100 / count(*)::DOUBLE + 1e-10, 6) AS success_rate, CAST(NULL AS VARCHAR) AS error FROM ({results})"""


@query("gold_summary", _summary(_result("gold", _GOLD_CHECKS, "gold"), 80))
def gold_summary(spark, sf):
    return plain(quality.summarize(gold_suite(spark, sf)), "success_rate")


@query("silver_summary", _summary(_result("silver", _SILVER_CHECKS, "silver"), 100))
def silver_summary(spark, sf):
    return plain(quality.summarize(silver_suite(spark, sf), C.SILVER_PASS_PERCENT), "success_rate")


@query("unexpected_rows", """
SELECT CAST(1 AS INTEGER) AS n, wind_speed AS value FROM (SELECT DISTINCT wind_speed FROM readings WHERE wind_speed NOT IN ('calm') ORDER BY wind_speed LIMIT 5)
UNION ALL SELECT 2, city FROM (SELECT DISTINCT city FROM readings WHERE city IS NULL OR city <> ' city_3 ' ORDER BY city NULLS FIRST LIMIT 5)""")
def unexpected_rows(spark, sf):
    checks = (quality.in_set("wind_speed", ["calm"]), quality.in_set("city", [" city_3 "], null_ok=False))
    return quality.unexpected_rows(I.readings(spark, sf), quality.Suite("sets", checks))


@query("unexpected_values", "SELECT DISTINCT city AS value FROM cleaned WHERE city NOT IN ('CITY_1', 'UNKNOWN') ORDER BY city LIMIT 5")
def unexpected_values(spark, sf):
    rows = I.readings(spark, sf).select(K.clean_city("city").alias("city"))
    return quality.unexpected_values(rows, "city", ["CITY_1", "UNKNOWN"])


@query("null_counts", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM readings" for c in silver.schemas.BRONZE.names
) + ") WHERE nulls > 0")
def null_counts(spark, sf):
    return quality.null_counts(I.readings(spark, sf))


@query("duplicate_count", """
SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicates""")
def duplicate_count(spark, sf):
    return quality.duplicate_count(I.table(spark, sf, "lineitem"))


@query("value_counts", "SELECT city AS value, count(*) AS count FROM readings WHERE city IS NOT NULL GROUP BY city ORDER BY count DESC, value")
def value_counts(spark, sf):
    return quality.value_counts(I.readings(spark, sf), "city")


@query("top_values", "SELECT user_id AS value, count(*) AS count FROM events GROUP BY user_id ORDER BY count DESC, value LIMIT 5")
def top_values(spark, sf):
    return quality.top_values(I.table(spark, sf, "events"), "user_id")


@query("value_range", "SELECT min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value FROM lineitem")
def value_range(spark, sf):
    return quality.value_range(I.table(spark, sf, "lineitem"), "l_extendedprice")


@query("row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf):
    return quality.records(I.table(spark, sf, "lineitem"))


@query("profile", """
SELECT 'records' AS section, 'rows' AS item, CAST(count(*) AS VARCHAR) AS value FROM gold
UNION ALL SELECT 'columns', 'count', CAST(count(*) AS VARCHAR) FROM (DESCRIBE SELECT * FROM gold)
UNION ALL SELECT 'column', CAST(row_number() OVER () AS VARCHAR), column_name FROM (DESCRIBE SELECT * FROM gold)
UNION ALL SELECT 'data_source', data_source, CAST(count(*) AS VARCHAR) FROM gold GROUP BY data_source
UNION ALL SELECT 'weather_alert_type', weather_alert_type, CAST(count(*) AS VARCHAR) FROM gold GROUP BY weather_alert_type
UNION ALL SELECT 'year', 'min', CAST(min(year) AS VARCHAR) FROM gold UNION ALL SELECT 'year', 'max', CAST(max(year) AS VARCHAR) FROM gold
UNION ALL SELECT 'top_city', city, CAST(n AS VARCHAR) FROM (SELECT city, count(*) AS n FROM gold GROUP BY city ORDER BY n DESC, city LIMIT 5)""")
def profile(spark, sf):
    return quality.profile(gold.weather_metrics(_silver(spark, sf), gold_time(), ordered=False))


# Layers end to end --------------------------------------------------------------------------------------------------


@query("no_data_report", """
SELECT false AS success, CAST(count(*) AS BIGINT) AS total_records, CAST(0 AS BIGINT) AS validations_checked, CAST(0 AS BIGINT) AS successful_validations,
       CAST(0 AS BIGINT) AS failed_validations, 0.0::DOUBLE AS success_rate, 'No data' AS error FROM readings WHERE temperature > 1000""")
def no_data_report(spark, sf):
    path = new_folder(spark, "readings")
    sinks.write_partitioned(I.readings(spark, sf).where("temperature > 1000"), path)
    return jobs.validate(spark, path)


@query("run_all_twice", "SELECT * FROM gold_from_bronze")
def run_all_twice(spark, sf):
    lake, published = new_folder(spark, "lake"), new_folder(spark, "published")
    read_at, messages = F.col("kafka_timestamp") + F.expr("INTERVAL 90 MINUTES"), I.messages(spark, sf)
    for half in (0, 1, 1):  # the last one repeats
        jobs.run_all(spark, messages.where(F.col("offset") % 2 == half), lake, published, processed_at=read_at, gold_at=gold_time())
    return plain(spark.read.parquet(published), *GOLD_ROUND)


@query("run_all_incremental", "SELECT * FROM gold_from_bronze")
def run_all_incremental(spark, sf):
    lake, published = new_folder(spark, "lake"), new_folder(spark, "published")
    read_at, messages = F.col("kafka_timestamp") + F.expr("INTERVAL 90 MINUTES"), I.messages(spark, sf)
    for third in (0, 1, 2, 2):  # the last one repeats
        changes.run_changes(spark, messages.where(F.col("offset") % 3 == third), lake, published, processed_at=read_at, gold_at=gold_time())
    return plain(spark.read.parquet(published), *GOLD_ROUND)


@query("run_all", "SELECT * FROM gold_from_bronze")
def run_all(spark, sf):
    lake, published = new_folder(spark, "lake"), new_folder(spark, "published")
    read_at = F.col("kafka_timestamp") + F.expr("INTERVAL 90 MINUTES")
    jobs.run_all(spark, I.messages(spark, sf), lake, published, processed_at=read_at, gold_at=gold_time())
    return plain(spark.read.parquet(published), *GOLD_ROUND)
