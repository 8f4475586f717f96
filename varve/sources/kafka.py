"""Topic readers. They need the Kafka connector on the class path; options and decoding do not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .. import constants as C
from ..operators.nested import decode_messages


def stream_options(
    topic: str,
    servers: str = "localhost:9092",
    starting: str = "earliest",
    max_offsets: int | None = None,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    """Reader options; ``max_offsets`` caps what one micro-batch takes, and nothing does by default."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_kafka_stream(spark: SparkSession, topic: str = C.WEATHER_TOPIC, servers: str = "localhost:9092", **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**stream_options(topic, servers, **options)).load()


def read_topics(spark: SparkSession, topics: Sequence[str], servers: str = "localhost:9092") -> DataFrame:
    """All that the topics hold now."""
    options = stream_options(",".join(topics), servers, max_offsets=None)
    return spark.read.format("kafka").options(**options, endingOffsets="latest").load()


def consume_topic(spark: SparkSession, topics: Sequence[str], servers: str = "localhost:9092") -> DataFrame:
    return decode_messages(read_topics(spark, topics, servers))
