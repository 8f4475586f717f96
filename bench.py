"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_QUERIES`` (optional) a comma-separated choice.
Inputs that are derived from the tables (readings, messages, silver, bars, news, indicators) are first written as
tables of many files, so that the time is the operator's. Each query is run once to warm up and then timed three times,
of which the best counts; results are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import time

from checks import inputs as I
from checks.registry import QUERIES, _silver, new_folder
from varve.session import get_session

HEADLINE = (
    "bronze",
    "keep_latest",
    "keep_latest_by_aggregate",
    "silver",
    "silver_strict",
    "quality_metrics",
    "daily_metrics",
    "hourly_metrics",
    "weather_alerts",
    "weather_metrics",
    "weather_metrics_joined",
    "silver_suite",
    "gold_suite",
    "profile",
    "duplicate_count",
    "bar_features",
    "bar_features_chunked",
    "volatility_regime",
    "volatility_regime_counted",
    "market_features",
    "market_features_chunked",
    "exact_quantiles",
    "date_gaps",
    "moving_average",
    "flatten_forecast",
    "consume_topic",
    "list_datasets",
    "read_for_date",
    "silver_for_date",
)


def run(query, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    derived = {f.__name__: f(spark, sf_dir) for f in (I.single_readings, I.readings, I.messages, I.bars, I.feed, I.indicators)}
    I.stage(spark, sf_dir, new_folder(spark, "bench"), derived)
    I.stage(spark, sf_dir, new_folder(spark, "bench"), {"silver": _silver(spark, sf_dir)})
    cold, warm = {}, {}
    for name in chosen:
        cold[name] = round(run(QUERIES[name], spark, sf_dir), 3)
        warm[name] = round(min(run(QUERIES[name], spark, sf_dir) for _ in range(3)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries on staged inputs, best of three, total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
