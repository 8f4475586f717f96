"""Silver as a stream: every micro-batch goes through bronze into silver, and is applied once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import constants as C
from ..operators.silver import bronze
from ..plans.changes import Lake, change_silver, set_down, take_over
from ..sinks.swap import Folders, recover


def last_batch(spark: SparkSession, lake: Lake) -> int:
    """The number of the last micro-batch that silver has in full, -1 before the first."""
    folders = Folders(spark, lake.root)
    return int(folders.read(f"{lake.changes}/last")) if folders.exists(f"{lake.changes}/last") else -1


def apply_batch(messages: DataFrame, number: int, lake: Lake, source: str = C.WEATHER_SOURCE, processed_at: Column | None = None) -> bool:
    """Bring bronze and silver up to date with one micro-batch; whether it had not been applied before.

    The batch is set down under its number first. When it comes again, after a failure, what was set down is applied in
    place of it, so that its processing times stay, and messages that bronze already has are no second time added.
    """
    spark = messages.sparkSession
    if number <= last_batch(spark, lake):
        return False
    for path in (lake.silver, lake.offsets, lake.zones):
        recover(spark, path)
    take_over(spark, lake)
    folders, change = Folders(spark, lake.root), f"{lake.changes}/batch-{number}"
    fresh = set_down(bronze(messages, source, processed_at=processed_at), lake, change)
    change_silver(spark, change, lake, fresh)
    folders.write(f"{lake.changes}/last-{number}", str(number))
    folders.delete(f"{lake.changes}/last")
    folders.move(f"{lake.changes}/last-{number}", f"{lake.changes}/last")
    folders.delete(change)
    return True


def silver_stream(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    source: str = C.WEATHER_SOURCE,
    trigger: str | None = C.TRIGGER_INTERVAL,
    processed_at: Column | None = None,
) -> StreamingQuery:
    """Topic rows, streaming, to bronze and silver below ``root``. ``trigger=None`` takes what is there now and stops.

    A batch reads and replaces only the dates of silver that it changes. The stream must be the only writer of the lake;
    batch runs of :func:`varve.plans.changes.run_changes` may follow it once it has stopped.
    """
    lake = Lake(root)
    writer = messages.writeStream.foreachBatch(lambda batch, number: apply_batch(batch, number, lake, source, processed_at) and None)
    writer = writer.option("checkpointLocation", checkpoint).queryName(f"silver_{source}_streaming_query")
    return (writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)).start()
