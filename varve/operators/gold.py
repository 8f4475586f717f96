"""Daily and hourly metrics, alerts, and the gold table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.cleaning import usable
from ..functions.rules import any_of, first_match, holds

_AGGREGATES = {"avg": F.avg, "max": F.max, "min": F.min, "stddev": F.stddev_samp}


def _daily_columns() -> list[Column]:
    columns = []
    for metric, names in C.DAILY_AGGREGATES:
        for name in names:
            label = f"{metric}_stddev" if name == "stddev" else f"{name}_{metric}"
            columns.append(_AGGREGATES[name](usable(metric)).alias(label))
    return columns + [
        F.avg("quality_score").alias("avg_quality_score"),
        F.count(F.lit(1)).alias("record_count"),
        F.max("processing_timestamp").alias("latest_processing_timestamp"),
        F.min("processing_timestamp").alias("earliest_processing_timestamp"),
    ]


def daily_metrics(silver: DataFrame) -> DataFrame:
    """One row per source, day and city. Every aggregate has a partial form, so a hot city shrinks before the shuffle."""
    return silver.groupBy(*C.DAILY_KEYS).agg(*_daily_columns())


def hourly_metrics(silver: DataFrame) -> DataFrame:
    return silver.groupBy(*C.HOURLY_KEYS).agg(
        *[F.avg(usable(metric)).alias(f"hourly_avg_{metric}") for metric, _ in C.DAILY_AGGREGATES],
        F.avg("quality_score").alias("hourly_avg_quality_score"),
        F.count(F.lit(1)).alias("hourly_record_count"),
    )


def alert_type() -> Column:
    """Alert type from daily aggregates."""
    return first_match(((holds(c, how, level), label) for label, c, how, level in C.ALERT_TYPE_RULES), C.DEFAULT_ALERT_TYPE)


def alert_severity() -> Column:
    return first_match(
        ((any_of(holds(*rule) for rule in rules), label) for label, rules in C.ALERT_SEVERITY_RULES),
        C.DEFAULT_SEVERITY,
    )


def weather_alerts(silver: DataFrame) -> DataFrame:
    return daily_metrics(silver).select(
        *C.DAILY_KEYS, alert_type().alias("weather_alert_type"), alert_severity().alias("alert_severity")
    )


def attach_alerts(daily: DataFrame, alerts: DataFrame) -> DataFrame:
    """Left join on the five keys; a row with a null key gets no alert."""
    return daily.join(alerts, list(C.DAILY_KEYS), "left")


def weather_metrics(silver: DataFrame, processed_at: Column | None = None, ordered: bool = False, joined: bool = False) -> DataFrame:
    """The gold table. Metrics and alerts come from one aggregate.

    ``joined`` computes them apart and joins them, with the same rows: there a row with a null key finds no partner,
    here its alert is set to null.
    """
    if joined:
        out = attach_alerts(daily_metrics(silver), weather_alerts(silver))
    else:
        keyed = F.lit(True)
        for k in C.DAILY_KEYS:
            keyed = keyed & F.col(k).isNotNull()
        out = daily_metrics(silver).withColumns(
            {
                "weather_alert_type": F.when(keyed, alert_type()),
                "alert_severity": F.when(keyed, alert_severity()),
            }
        )
    out = out.withColumn("gold_processing_timestamp", F.current_timestamp() if processed_at is None else processed_at)
    return out.orderBy(*C.DAILY_KEYS) if ordered else out
