"""Daily metrics as states that merge: counts, sums, squared deviations and extremes per source, day and city.

The states of several batches add up to that of all their readings, so a batch costs what it holds, not what came before.
Readings cannot be taken out of a state; keys that lose one are counted again from their readings.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.cleaning import usable

_METRICS = [metric for metric, _ in C.DAILY_AGGREGATES]
_SPREAD = [metric for metric, names in C.DAILY_AGGREGATES if "stddev" in names]
_COUNTS = [f"n_{m}" for m in [*_METRICS, "quality"]] + ["records"]
_SUMS = [f"sum_{m}" for m in [*_METRICS, "quality"]]


def daily_states(silver: DataFrame) -> DataFrame:
    """One state per source, day and city. All parts have partial aggregates, so a hot city shrinks before the shuffle."""
    columns = []
    for m in _METRICS:
        value = usable(m)
        columns += [F.count(value).alias(f"n_{m}"), F.sum(value).alias(f"sum_{m}"), F.max(value).alias(f"max_{m}"), F.min(value).alias(f"min_{m}")]
    columns += [(F.var_pop(usable(m)) * F.count(usable(m))).alias(f"square_{m}") for m in _SPREAD]
    columns += [F.count("quality_score").alias("n_quality"), F.sum("quality_score").alias("sum_quality"), F.count(F.lit(1)).alias("records")]
    columns += [F.max("processing_timestamp").alias("latest"), F.min("processing_timestamp").alias("earliest")]
    return silver.groupBy(*C.DAILY_KEYS).agg(*columns)


def merge_states(*states: DataFrame) -> DataFrame:
    """The states of all readings together, from those of disjoint parts of them.

    Squared deviations are taken about the mean of the whole: each part adds its own and what its mean is off, times its
    count, so nothing large is subtracted. A key has one row per part, which its window holds.
    """
    rows = reduce(DataFrame.unionByName, states)
    whole = Window.partitionBy(*C.DAILY_KEYS)
    about = {}
    for m in _SPREAD:
        mean = F.try_divide(F.sum(f"sum_{m}").over(whole), F.sum(f"n_{m}").over(whole))
        off = F.try_divide(F.col(f"sum_{m}"), F.col(f"n_{m}")) - mean
        about[f"square_{m}"] = F.col(f"square_{m}") + F.col(f"n_{m}") * off * off
    parts = [F.sum(c).alias(c) for c in [*_COUNTS, *_SUMS, *about]]
    parts += [f(c).alias(c) for m in _METRICS for f, c in ((F.max, f"max_{m}"), (F.min, f"min_{m}"))]
    parts += [F.max("latest").alias("latest"), F.min("earliest").alias("earliest")]
    return rows.withColumns(about).groupBy(*C.DAILY_KEYS).agg(*parts).select(*states[0].columns)


def recount(states: DataFrame, silver: DataFrame, touched: DataFrame) -> DataFrame:
    """``states`` with the keys of ``touched`` counted again from ``silver``, of which the caller may give their dates only."""
    key: Column = F.struct(*C.DAILY_KEYS)
    keys = touched.select(key.alias("__key")).distinct()

    def matched(df: DataFrame, how: str) -> DataFrame:
        return df.withColumn("__key", key).join(keys, "__key", how).drop("__key")

    return matched(states, "left_anti").unionByName(daily_states(matched(silver, "left_semi")))


def metrics_of(states: DataFrame) -> DataFrame:
    """The daily metrics, as :func:`varve.operators.gold.daily_metrics` has them."""
    columns = []
    for metric, names in C.DAILY_AGGREGATES:
        for name in names:
            if name == "avg":
                columns.append(F.try_divide(F.col(f"sum_{metric}"), F.col(f"n_{metric}")).alias(f"avg_{metric}"))
            elif name == "stddev":
                spread = F.when(F.col(f"n_{metric}") > 1, F.sqrt(F.col(f"square_{metric}") / (F.col(f"n_{metric}") - 1)))
                columns.append(spread.alias(f"{metric}_stddev"))
            else:
                columns.append(F.col(f"{name}_{metric}"))
    return states.select(
        *C.DAILY_KEYS,
        *columns,
        F.try_divide(F.col("sum_quality"), F.col("n_quality")).alias("avg_quality_score"),
        F.col("records").alias("record_count"),
        F.col("latest").alias("latest_processing_timestamp"),
        F.col("earliest").alias("earliest_processing_timestamp"),
    )
