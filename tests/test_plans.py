"""Physical plans: what is shuffled, how often, and what reaches the scan."""

import pytest
from pyspark.sql import functions as F

from checks import inputs as I
from checks.registry import new_folder
from varve import constants as C
from varve.functions import cleaning as K
from varve.operators import dedup, gold, market, quality, series, silver
from varve.session import cut, get_session, session_with, shared_folder
from varve.sinks.files import write_partitioned


def plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture(scope="module")
def tables(spark):
    """Bronze, silver and bars as plain Parquet tables."""
    sf = "/root/testdata/sf0.001"
    paths = {name: new_folder(spark, name) for name in ("bronze", "silver", "bars")}
    write_partitioned(I.readings(spark, sf), paths["bronze"])
    write_partitioned(silver.silver(I.readings(spark, sf)), paths["silver"])
    I.bars(spark, sf).write.parquet(paths["bars"])
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def test_bronze_is_narrow(spark, sf):
    assert "Exchange" not in plan(silver.bronze(I.messages(spark, sf)))


def test_dedup_limits_ranks_before_its_one_shuffle(tables):
    text = plan(dedup.keep_latest(silver.clean(tables["bronze"], K.clean_timestamp("timestamp", "processing_timestamp"))))
    assert text.count("Exchange") == 1
    before, after = text.split("Exchange")
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_scores_are_not_carried_through_the_dedup(tables):
    above, below = plan(silver.silver(tables["bronze"])).split("Exchange")
    assert "weather_category" in above and "weather_category" not in below


def test_gold_is_one_aggregate(tables):
    text = plan(gold.weather_metrics(tables["silver"], ordered=False))
    assert text.count("Exchange") == 1 and text.count("FileScan") == 1 and "Join" not in text
    scan = text.split("ReadSchema:")[1]
    assert "kafka_offset" not in scan and "weather_category" not in scan and "temperature" in scan


def test_alerts_read_only_their_metrics(tables):
    scan = plan(gold.weather_alerts(tables["silver"])).split("ReadSchema:")[1]
    assert "humidity" not in scan and "quality_score" not in scan


def test_suite_is_one_scan(tables):
    text = plan(quality.run_suite(tables["silver"], quality.SILVER_SUITE))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_bar_features_and_regimes_share_one_shuffle(tables):
    text = plan(market.market_features(tables["bars"], ts="trading_date", long=False))
    assert text.count("Exchange") == 1 and text.count("+- Sort [") == 1 and text.count("FileScan") == 1


def test_many_short_symbols_keep_the_plain_plan(spark, tables):
    short = F.concat("symbol", F.lit("-"), F.date_format("trading_date", "yyyyMM"))
    path = new_folder(spark, "short")
    tables["bars"].withColumn("symbol", short).write.parquet(path)
    bars = spark.read.parquet(path)
    assert series.is_long(bars, 60)  # as a whole; no symbol is
    text = plan(market.market_features(bars, ts="trading_date", rows_per_task=60))
    assert text.count("Exchange") == 1 and text.count("+- Sort [") == 1 and text.count("FileScan") == 1
    assert "__chunk" not in text and "Union" not in text and "Join" not in text


def test_hot_symbols_are_told_without_a_shuffle_of_rows(spark, tables):
    hot = spark.createDataFrame([("S0",)], "symbol string")
    inside, outside = series.split_hot(tables["bars"], hot, ["symbol"])
    for text in map(plan, (inside, outside)):
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_one_time_for_a_third_of_all_rows_gives_even_tasks(spark):
    own = session_with(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    n = F.col("id")
    rows = own.range(0, 60_000, 1, 6).select(
        F.when(n % 3 == 0, 0).otherwise(n).cast("timestamp").alias("processing_timestamp"),
        (n % 4).cast("int").alias("kafka_partition"), n.alias("kafka_offset"),
        *[F.lit("x").alias(c) for c in C.DEDUP_KEYS],
    )
    sizes = sorted(r["count"] for r in rows.orderBy(*silver.newest_first()).groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] < 2 * sizes[4]


def test_strict_silver_filters_keys_before_the_window(tables):
    text = plan(silver.silver_strict(tables["bronze"], ordered=False))
    assert text.count("Exchange") == 1


def test_pages_keep_a_bounded_top(tables):
    from varve.operators.tables import page

    assert "TakeOrderedAndProject" in plan(page(tables["silver"], F.col("processing_timestamp").desc(), top=10, skip=20).select("city"))


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert cut(spark.range(3)).count() == 3
    assert spark.sparkContext.getCheckpointDir().removeprefix("file:").startswith(folder)
    assert get_session() is not None
