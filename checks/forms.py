"""Time plain forms of a job against the forms used here.

``python -m checks.forms [sf_dir [first words of a pair …]]``
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varve.functions import cleaning as K
from varve.functions import market as M
from varve.operators import dedup, gold, market, quality, silver
from varve.operators.series import rolling
from varve.plans import jobs
from varve.session import get_session
from varve.sinks.files import write_partitioned

from . import inputs as I
from .registry import new_folder


def throw_away(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def three_actions(spark, bronze: str, target: str) -> None:
    rows = spark.read.parquet(bronze)
    rows.count()
    out = silver.silver(rows)
    silver.quality_summary(out).collect()
    write_partitioned(out, target)


def priced(spark, sf_dir: str) -> DataFrame:
    """Every line as a point of one of six series, in an order that tells any two lines apart."""
    lines = I.table(spark, sf_dir, "lineitem")
    key = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")
    return lines.select((F.col("l_suppkey") % 6).alias("k"), key.alias("at"), F.col("l_extendedprice").alias("price"))


def short_bars(spark, sf_dir: str) -> DataFrame:
    """Every line as a bar of one of very many short series."""
    lines = I.table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    at = F.timestamp_add("SECOND", (F.col("l_orderkey") % 86_400).cast("int"), F.col("l_shipdate").cast("timestamp"))
    prices = [price.alias(c) for c in ("open", "high", "low", "close")]
    return lines.select((F.col("l_partkey") % 5_000).cast("string").alias("symbol"), at.alias("at"), *prices, F.col("l_quantity").alias("volume"))


def rolled(points: DataFrame, blocks: bool) -> DataFrame:
    w = Window.partitionBy("k").orderBy("at")
    if blocks:
        return rolling(points, w, {"m20": ("price", 20), "m50": ("price", 50)}, {"s20": ("price", 20)})
    return points.withColumns(
        {
            "m20": M.rolling_mean("price", 20, w),
            "m50": M.rolling_mean("price", 50, w),
            "s20": M.rolling_std("price", 20, w),
        }
    )


def check_by_check(df: DataFrame) -> None:
    for check in quality.SILVER_SUITE.checks:
        quality.run_suite(df, quality.Suite("silver", (check,))).collect()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("forms", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    bronze, table = (new_folder(spark, n) for n in ("bronze", "silver"))
    write_partitioned(I.readings(spark, sf_dir), bronze)
    readings = spark.read.parquet(bronze)
    write_partitioned(silver.silver(readings), table)
    rows = spark.read.parquet(table).select(*silver.schemas.SILVER.names)
    points = priced(spark, sf_dir)
    many = new_folder(spark, "many")
    short_bars(spark, sf_dir).repartition(32).write.parquet(many)
    bars = spark.read.parquet(many)
    cleaned = silver.clean(readings, K.clean_timestamp("timestamp", "processing_timestamp"))

    pairs = {
        "gold: two aggregates joined / one aggregate": (
            lambda: throw_away(gold.weather_metrics(rows, joined=True)),
            lambda: throw_away(gold.weather_metrics(rows)),
        ),
        "silver suite: check by check / one pass": (
            lambda: check_by_check(rows),
            lambda: quality.run_suite(rows, quality.SILVER_SUITE).collect(),
        ),
        "silver job: count, metrics, write / observed write": (
            lambda: three_actions(spark, bronze, new_folder(spark, "silver")),
            lambda: jobs.silver_job(spark, bronze, new_folder(spark, "silver")),
        ),
        "rolling windows: sliding frames / blocks": (
            lambda: throw_away(rolled(points, False)),
            lambda: throw_away(rolled(points, True)),
        ),
        "market features of many short symbols: stated to be short / told by a count": (
            lambda: throw_away(market.market_features(bars, ts="at", long=False)),
            lambda: throw_away(market.market_features(bars, ts="at", rows_per_task=1_000)),
        ),
        "market features of many short symbols: all cut / told by a count": (
            lambda: throw_away(market.market_features(bars, ts="at", rows_per_task=1_000, long=True)),
            lambda: throw_away(market.market_features(bars, ts="at", rows_per_task=1_000)),
        ),
        "dedup: whole-row aggregate / ranked window": (
            lambda: throw_away(dedup.keep_latest_by_aggregate(cleaned)),
            lambda: throw_away(dedup.keep_latest(cleaned)),
        ),
    }
    wanted = sys.argv[2:]
    for name, forms in pairs.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        best = []
        for form in forms:
            times = []
            for _ in range(3):
                started = time.perf_counter()
                form()
                times.append(time.perf_counter() - started)
            best.append(min(times))
        print(f"| {name} | {best[0]:.2f} | {best[1]:.2f} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
