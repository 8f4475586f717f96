"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C

LATEST_FIRST = ("processing_timestamp", "kafka_timestamp", "kafka_partition", "kafka_offset")


def keep_latest(df: DataFrame, keys: Sequence[str] = C.DEDUP_KEYS, order: Sequence[str] = LATEST_FIRST) -> DataFrame:
    """The latest row of each key; null keys form groups of their own.

    The rank filter is applied per task before the shuffle (window group limit), so a key with many copies sends
    one row per task.
    """
    latest = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    return df.withColumn("__n", F.row_number().over(latest)).where(F.col("__n") == 1).drop("__n")


def keep_latest_by_aggregate(df: DataFrame, keys: Sequence[str] = C.DEDUP_KEYS, order: Sequence[str] = LATEST_FIRST) -> DataFrame:
    """Twin of :func:`keep_latest` as an aggregate over whole rows."""
    rest = [c for c in df.columns if c not in keys]
    when: Column = F.struct(*order)
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), when).alias("__best"))
    return best.select(*keys, "__best.*").select(*df.columns)
