"""Topic writers, for batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from .. import constants as C
from ..operators.nested import encode_messages


def producer_options(topic: str, servers: str = "localhost:9092") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **C.PRODUCER_OPTIONS}


def write_kafka(df: DataFrame, topic: str, key: str | Column, servers: str = "localhost:9092", checkpoint: str | None = None) -> StreamingQuery | None:
    """Send rows as JSON messages. A streaming frame needs a checkpoint and gives its running query."""
    messages = encode_messages(df, key)
    options = producer_options(topic, servers)
    if df.isStreaming:
        if not checkpoint:
            raise ValueError("a stream needs a checkpoint folder")
        return messages.writeStream.format("kafka").options(**options, checkpointLocation=checkpoint).start()
    messages.write.format("kafka").options(**options).save()
    return None
