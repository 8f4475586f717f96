"""Layer jobs from table to table."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators import gold as G
from ..operators import quality as Q
from ..operators import silver as S
from ..sinks.files import check_apart, publish_if_valid, write_partitioned
from ..sinks.swap import replace as swap
from ..sources.files import is_missing, read_table


@dataclass(frozen=True)
class ProcessingResult:
    success: bool
    record_count: int
    valid_records: int
    invalid_records: int
    avg_quality_score: float
    processing_time_ms: int

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [tuple(asdict(self).values())],
            "success boolean, record_count bigint, valid_records bigint, invalid_records bigint,"
            "avg_quality_score double, processing_time_ms bigint",
        )


def _write_observed(silver: DataFrame, path: str, fmt: str, replace: str) -> ProcessingResult:
    """Write silver rows and take their metrics in the same pass."""
    started = time.monotonic()
    seen = Observation()
    metrics = [column.alias(name) for name, column in S.quality_metrics(silver).items()]
    if fmt == "parquet":  # other table formats replace as a transaction of their own
        swap(silver, path, partitions=replace == "partitions", observed=(seen, metrics))
    else:
        write_partitioned(silver, path, fmt=fmt, replace=replace, observed=(seen, metrics))
    found = seen.get
    total = found["total_records"]
    return ProcessingResult(
        success=total > 0,
        record_count=total,
        valid_records=found["valid_records"],
        invalid_records=found["invalid_records"],
        avg_quality_score=found["avg_quality_score"] or 0.0,
        processing_time_ms=int((time.monotonic() - started) * 1000),
    )


NO_DATA = ProcessingResult(False, 0, 0, 0, 0.0, 0)


def _read_or_none(spark: SparkSession, path: str, fmt: str) -> DataFrame | None:
    try:
        return read_table(spark, path, fmt)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return None


class LayerFailed(RuntimeError):
    """A layer gave no usable table; later layers did not run."""


MESSAGE_KEYS = ("data_source", "kafka_partition", "kafka_offset", "kafka_timestamp")


def not_among(rows: DataFrame, old: DataFrame, keys: Sequence[str] = MESSAGE_KEYS) -> DataFrame:
    """Rows of messages that ``old`` has not got. Rows without an offset cannot be told apart and are always new."""
    return rows.join(old.select(*keys).distinct(), list(keys), "left_anti").select(*rows.columns)


def append_bronze(rows: DataFrame, path: str, keys: Sequence[str] = MESSAGE_KEYS) -> None:
    """Add rows to the bronze table, except those of messages that it has already, so that a repeated run adds nothing.

    Of the table only files that reach into the range of the new offsets are read.
    """
    spark = rows.sparkSession
    old = _read_or_none(spark, path, "parquet")
    if old is not None:
        low, high = rows.agg(F.min("kafka_offset"), F.max("kafka_offset")).first()
        rows = not_among(rows, old.where(F.col("kafka_offset").between(low, high)) if low is not None else old.where("false"), keys)
    write_partitioned(rows, path, replace="nothing")


def silver_job(spark: SparkSession, bronze_path: str, silver_path: str, fmt: str = "parquet") -> ProcessingResult:
    """The whole bronze table to the silver table. A missing or empty table is a failure, and writes nothing."""
    check_apart(bronze_path, silver_path)
    rows = _read_or_none(spark, bronze_path, fmt)
    if rows is None or rows.isEmpty():  # a row of bronze gives one of silver, so there is something to replace it with
        return NO_DATA
    return _write_observed(S.silver(rows), silver_path, fmt, "table")


def silver_for_date(spark: SparkSession, bronze_path: str, silver_path: str, date: str | dt.date, fmt: str = "parquet") -> ProcessingResult:
    """One processing date to its silver partition; other dates stay. No rows is a failure, and writes nothing."""
    check_apart(bronze_path, silver_path)
    rows = _read_or_none(spark, bronze_path, fmt)
    if rows is None:
        return NO_DATA
    return _write_observed(S.silver(S.for_date(rows, date), strict_time=True), silver_path, fmt, "partitions")


def silver_result(rows: DataFrame) -> DataFrame:
    """The counts of a silver run as a one-row frame, without a write."""
    m = S.quality_metrics(rows)
    total = m["total_records"]
    return rows.agg(
        (total > 0).alias("success"),
        total.alias("record_count"),
        m["valid_records"].alias("valid_records"),
        m["invalid_records"].alias("invalid_records"),
        F.coalesce(m["avg_quality_score"], F.lit(0.0)).alias("avg_quality_score"),
    )


def gold_job(spark: SparkSession, silver_path: str, gold_path: str, fmt: str = "parquet", processed_at: Column | None = None) -> None:
    """The silver table to the gold table, by date. Dates that silver has no longer leave gold; without silver rows
    nothing is written."""
    check_apart(silver_path, gold_path)
    silver = read_table(spark, silver_path, fmt)
    if silver.isEmpty():
        raise LayerFailed("gold: silver has no data")
    swap(G.weather_metrics(silver, processed_at, ordered=False), gold_path, compression="snappy")


def validate(spark: SparkSession, path: str, suite: Q.Suite = Q.GOLD_SUITE, pass_percent: float = C.GOLD_PASS_PERCENT) -> DataFrame:
    """One-row report on a table; a table that is not there fails for want of data."""
    rows = _read_or_none(spark, path, "parquet")
    return Q.no_data(spark) if rows is None else Q.summarize(Q.run_suite(rows, suite), pass_percent)


def run_all(
    spark: SparkSession,
    messages: DataFrame,
    lake: str,
    published: str,
    source: str = C.WEATHER_SOURCE,
    processed_at: Column | None = None,
    gold_at: Column | None = None,
) -> DataFrame:
    """Bronze, silver, gold, checks and publication, each from the table the one before wrote; stops at a failure.

    New messages are added to bronze, and the later layers follow the whole of it, so that runs add up.
    """
    bronze_path, silver_path, gold_path = (f"{lake.rstrip('/')}/{layer}" for layer in ("bronze", "silver", "gold"))
    check_apart(lake, published)
    append_bronze(S.bronze(messages, source, processed_at=processed_at), bronze_path)
    if not silver_job(spark, bronze_path, silver_path).success:
        raise LayerFailed("silver: no data")
    gold_job(spark, silver_path, gold_path, processed_at=gold_at)
    report = validate(spark, gold_path)
    if not publish_if_valid(spark.read.parquet(gold_path), report, published, source=gold_path):
        raise LayerFailed("gold: the checks failed, nothing was published")
    return report
