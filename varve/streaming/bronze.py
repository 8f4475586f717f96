"""Bronze ingestion as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import constants as C
from ..operators.silver import bronze
from ..sources.kafka import read_kafka_stream


def write_bronze_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = C.TRIGGER_INTERVAL,
    name: str | None = None,
    fmt: str = "parquet",
    cols: tuple[str, ...] = C.DATE_PARTS,
) -> StreamingQuery:
    """Append to the bronze table. ``trigger=None`` takes what is there now and stops.

    The checkpoint makes a restarted query go on where it stopped, without repeats.
    """
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    writer = writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
    if name:
        writer = writer.queryName(name)
    return writer.partitionBy(*cols).start()


def bronze_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    source: str = C.WEATHER_SOURCE,
    trigger: str | None = C.TRIGGER_INTERVAL,
    fmt: str = "parquet",
    fill: bool = True,
    processed_at: Column | None = None,
) -> StreamingQuery:
    """Topic rows, streaming, to the bronze table. All steps are narrow."""
    rows = bronze(messages, source, fill, processed_at)
    return write_bronze_stream(rows, path, checkpoint, trigger, f"bronze_{source}_streaming_query", fmt)


def ingest_topic(spark: SparkSession, topic: str, path: str, checkpoint: str, servers: str = "localhost:9092", fmt: str = "delta", source: str = C.WEATHER_SOURCE, **options) -> StreamingQuery:
    """``options`` go to the reader, see :func:`varve.sources.kafka.stream_options`."""
    return bronze_stream(read_kafka_stream(spark, topic, servers, **options), path, checkpoint, source, fmt=fmt)


def run_bounded(query: StreamingQuery, seconds: float = C.BOUNDED_RUN_SECONDS) -> bool:
    """Let a query run for a time at most, then stop it. True if it ended by itself."""
    try:
        return bool(query.awaitTermination(seconds))
    finally:
        if query.isActive:
            query.stop()
