import datetime as dt
import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from checks import inputs as I
from varve import constants as C
from varve import schemas
from varve.operators import nested
from varve.plans import jobs, registry
from varve.session import session_with
from varve.sinks import files as sinks
from varve.sinks import kafka as kafka_sink
from varve.sources import files as sources
from varve.sources import kafka as kafka_source
from varve.sources import listing


def explain(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_stream_options():
    options = kafka_source.stream_options("weather-forecast")
    assert options["startingOffsets"] == "earliest" and "maxOffsetsPerTrigger" not in options and options["failOnDataLoss"] == "false"
    assert kafka_source.stream_options("t", max_offsets=1000)["maxOffsetsPerTrigger"] == "1000"
    producer = kafka_sink.producer_options("t")
    assert (producer["kafka.acks"], producer["kafka.retries"], producer["kafka.compression.type"]) == ("all", "3", "snappy")


def test_topic_readers_need_the_connector(spark):
    with pytest.raises(AnalysisException):
        kafka_source.consume_topic(spark, ["t"])
    with pytest.raises(AnalysisException):
        kafka_source.read_kafka_stream(spark)


def test_decode_skips_what_is_no_json(spark):
    rows = [("t", 0, i, b"k", v) for i, v in enumerate([b'{"a":1}', b"{bad", b"5", None, b"", b"null", b"[1, 2]"])]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, key binary, value binary")
    assert [r.offset for r in nested.decode_messages(df).orderBy("offset").collect()] == [0, 2, 5, 6]


def test_encode_keeps_nulls(spark):
    r = nested.encode_messages(spark.createDataFrame([(1, None)], "id int, v string"), "id").first()
    assert (r.key, json.loads(r.value)) == ("1", {"id": 1, "v": None})


def test_envelope_batches_are_bounded_and_ordered(spark):
    df = spark.createDataFrame([("A" if i < 23 else "B", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), i) for i in range(30)], "symbol string, ts timestamp, v int")
    out = nested.envelope(df.repartition(4), "symbol", ["v"], ["ts"], batch_rows=10).collect()
    got = sorted((r.key, [x["v"] for x in json.loads(r.value)["data"]]) for r in out)
    assert got == [("A", list(range(10))), ("A", list(range(10, 20))), ("A", [20, 21, 22]), ("B", list(range(23, 30)))]
    one = json.loads(nested.envelope(df, "symbol", ["v"]).first().value)
    assert set(one) == {"timestamp", "symbol", "data"} and one["data"] == {"v": 0}


def test_forecast_with_missing_nodes(spark):
    payloads = ['{"properties": {"periods": [{"temperature": 50, "temperatureUnit": "F", "relativeHumidity": null}]}}', '{"properties": {}}', "{}", "bad", None]
    df = spark.createDataFrame([(p, 35.5, -97.25) for p in payloads], "payload string, latitude double, longitude double")
    out = nested.flatten_forecast(df)
    rows = out.collect()
    assert len(rows) == 1 and len(out.columns) == 20
    assert (rows[0].grid_id, rows[0].temperature, rows[0].relative_humidity, rows[0].dewpoint_unit) == ("35.5_-97.25", 50.0, None, None)
    reading = nested.forecast_to_reading(out).first()
    assert (reading.temperature, reading.city) == (10.0, "35.5_-97.25")
    assert nested.forecast_to_reading(out).columns == ["temperature", "wind_speed", "city", "timestamp", "humidity", "pressure", "visibility"]


def test_market_payloads(spark):
    bars = '{"Meta Data": {"x": "y"}, "Time Series (5min)": {"2024-01-02 10:00:00": {"1. open": "1", "2. high": "2", "3. low": "0.5", "4. close": "1.5", "5. volume": "7"}}}'
    df = spark.createDataFrame([("A", bars), ("B", "{}"), ("C", '{"Time Series (5min)": {}}')], "symbol string, payload string")
    assert [tuple(r) for r in nested.flatten_intraday(df).collect()] == [("A", dt.datetime(2024, 1, 2, 10), "1", "2", "0.5", "1.5", "7")]
    feed = '{"feed": [{"time_published": "20240102T101500", "overall_sentiment_score": 0.25, "overall_sentiment_label": "Bullish"}]}'
    r = nested.flatten_feed(spark.createDataFrame([("A", feed), ("B", '{"feed": []}')], "symbol string, payload string")).first()
    assert (r.ts, r.overall_sentiment_score) == (dt.datetime(2024, 1, 2, 10, 15), "0.25")
    rsi = spark.createDataFrame([("A", '{"Technical Analysis: RSI": {"2024-01-02": {"RSI": "55"}, "2024-01-03": {"RSI": "60"}}}')], "symbol string, payload string")
    macd = spark.createDataFrame([("A", '{"Technical Analysis: MACD": {"2024-01-03": {"MACD": "1", "MACD_Signal": "2", "MACD_Hist": "-1"}, "2024-01-04": {"MACD": "9"}}}')], "symbol string, payload string")
    assert [tuple(r)[2:] for r in nested.flatten_indicators(rsi, macd).orderBy("ts").collect()] == [("55", None, None, None), ("60", "1", "2", "-1")]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake") / "readings")
    sinks.write_partitioned(I.readings(spark, "/root/testdata/sf0.001"), path)
    return path


def test_dates_prune_partitions(spark, lake):
    one = sources.read_for_date(sources.read_table(spark, lake), "2024-01-09")
    text = explain(one)
    assert "PartitionFilters: [isnotnull(year" in text and "(day" in text.split("PartitionFilters")[1].split("\n")[0]
    assert {(r.year, r.month, r.day) for r in one.select("year", "month", "day").distinct().collect()} == {(2024, 1, 9)}
    upto = sources.read_until(spark, lake, "20240109")
    assert "make_date" in explain(upto).split("PartitionFilters")[1].split("\n")[0]
    assert upto.agg(F.max("day")).first()[0] == 9
    for bad in ("2024-01-09", "20241301", "x"):
        with pytest.raises(ValueError):
            sources.read_until(spark, lake, bad)


def test_scan_reads_only_needed_columns(spark, lake):
    text = explain(sources.read_table(spark, lake).where("temperature > 5").select("city"))
    assert "ReadSchema: struct<temperature:double,city:string>" in text
    assert "GreaterThan(temperature,5.0)" in text


def test_dynamic_overwrite_leaves_other_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2024, 1, 1), (2, 2024, 1, 2)], "v int, year int, month int, day int")
    sinks.export_parquet(df, path)
    sinks.export_parquet(df.where("day = 2").withColumn("v", F.lit(9)), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]
    sinks.write_partitioned(df.where("day = 1"), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1]
    with pytest.raises(ValueError):
        sinks.write_partitioned(df, path, replace="some")
    assert all(".snappy." in f for _, _, fs in os.walk(path) for f in fs if f.startswith("part-"))


def test_csv_first_rows_per_file(spark, tmp_path):
    for name, n in (("a", 2000), ("b", 3)):
        (tmp_path / f"{name}.csv").write_text("i,name\n" + "".join(f"{i},{name}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        out = sources.read_csv(spark, str(tmp_path), max_rows=700).collect()
        assert sorted(r.i for r in out if r["name"] == "a") == list(range(700))
        assert sorted(r.i for r in out if r["name"] == "b") == [0, 1, 2]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sources.read_csv(spark, str(tmp_path)).count() == 2003


def test_mixed_dataset(spark, tmp_path):
    root = tmp_path / "d"
    for folder in ("year=2024/kind=01", "year=2023/kind=02", "year=2023/kind=03"):
        (root / folder).mkdir(parents=True)
    (root / "year=2024/kind=01/a.csv").write_text("id,x\n1,2.5\n2,3.5\n3,4.5\n")
    (root / "year=2023/kind=02/b.json").write_text('{"id": 4, "y": "q"}\n')
    spark.createDataFrame([(5, "p")], "id int, y string").coalesce(1).write.mode("append").parquet(str(root / "year=2023/kind=03/c"))
    (root / "year=2023/kind=03/broken.parquet").write_text("not parquet")
    (root / "readme.txt").write_text("ignored")
    with pytest.raises(Exception, match="broken.parquet"):
        sources.read_mixed_dataset(spark, str(root)).collect()
    out = sources.read_mixed_dataset(spark, str(root), csv_rows=2, skip_corrupt=True)
    got = sorted((r.id, r.x, r.y, r.year, r.kind) for r in out.select("id", "x", "y", "year", "kind").collect())
    assert got == [(1, 2.5, None, "2024", "01"), (2, 3.5, None, "2024", "01"), (4, None, "q", "2023", "02"), (5, None, "p", "2023", "03")]
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"
    with pytest.raises(FileNotFoundError):
        (tmp_path / "empty").mkdir()
        sources.read_mixed_dataset(spark, str(tmp_path / "empty"))


def test_load_by_address(spark, lake, tmp_path):
    assert sources.load(spark, lake, end_date="20240102").agg(F.max("day")).first()[0] == 2
    spark.sql("CREATE DATABASE IF NOT EXISTS load_db")
    sinks.materialize(spark.range(4), "load_db.numbers")
    assert sources.load(spark, "table://load_db/numbers").count() == 4
    assert sources.load(spark, "athena://load_db/numbers").count() == 4
    for bad in ("table://numbers", "table://a/b/c", "table://a/b;drop", "duckdb://x"):
        with pytest.raises(ValueError):
            sources.load(spark, bad)
    with pytest.raises(Exception, match="driver|Driver|suitable"):
        sources.load(spark, f"jdbc:none:{tmp_path}", dbtable="t").count()


def test_external_table_and_sample(spark, tmp_path):
    path = str(tmp_path / "ext")
    spark.range(50).write.parquet(path)
    schema = spark.range(1).schema
    for _ in range(2):
        assert sources.register_external(spark, "ext_db", "numbers", schema, path).count() == 50
    assert [r.id for r in sources.sample_table(spark, "ext_db.numbers", 3, order_by=["id"]).collect()] == [0, 1, 2]
    assert sources.sample_table(spark, "ext_db.numbers", 7).count() == 7
    with pytest.raises(ValueError):
        sources.register_external(spark, "x; drop", "t", schema, path)


def test_compact_and_repoint(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    df = spark.range(400).selectExpr("id", "2024 year", "1 month", "cast(id % 2 as int) day")
    df.repartition(8).write.partitionBy("year", "month", "day").parquet(a)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert sinks.compact(spark, a, b) == b
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before

    def files(path):
        return sum(f.endswith(".parquet") for _, _, fs in os.walk(path) for f in fs)

    assert files(a) == 16 and files(b) == 2
    assert sorted(map(tuple, spark.read.parquet(b).collect())) == sorted(map(tuple, df.collect()))
    spark.sql("CREATE DATABASE IF NOT EXISTS compact_db")
    spark.catalog.createTable("compact_db.t", path=a, source="parquet", schema=spark.read.parquet(a).schema)
    sinks.repoint(spark, "compact_db.t", b)
    assert spark.sql("DESCRIBE TABLE EXTENDED compact_db.t").where("col_name = 'Location'").first().data_type.endswith("/b")
    for bad in (a, f"{a}/inside", str(tmp_path)):
        with pytest.raises(ValueError):
            sinks.compact(spark, a, bad)


def test_land_and_copy(spark, tmp_path):
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    path = sinks.land_raw_json(spark.range(3), str(tmp_path), "raw", at)
    assert path.endswith("/raw_20240102_030405") and spark.read.json(path).count() == 3
    source = tmp_path / "src"
    spark.range(5).write.parquet(str(source))
    (source / "_temporary").mkdir()
    (source / "_temporary" / "half.parquet").write_text("x")
    (source / "notes.txt").write_text("x")
    sinks.copy_parquet(spark, str(source), str(tmp_path / "dst"))
    assert spark.read.parquet(str(tmp_path / "dst")).count() == 5
    with pytest.raises(ValueError):
        sinks.copy_parquet(spark, str(source), str(source / "copy"))


def test_publish_only_when_valid(spark, tmp_path):
    df = spark.createDataFrame([(1, 2024, 1, 1)], "v int, year int, month int, day int")
    target = str(tmp_path / "published")
    report = spark.createDataFrame([(False,)], "success boolean")
    assert sinks.publish_if_valid(df, report, target) is False and not os.path.exists(target)
    assert sinks.publish_if_valid(df, report.select(F.lit(True).alias("success")), target) is True
    with pytest.raises(ValueError):
        sinks.publish_if_valid(df, report, f"{target}/x", source=target)


def test_listing_of_a_tree(spark, tmp_path):
    root = tmp_path / "lake"
    for folder, name, size in [
        ("gold/weather/year=2024/day=1", "a.parquet", 3),
        ("gold/weather/year=2024/day=2", "b.parquet", 4),
        ("gold/weather/year=2023/day=2", "b.parquet", 5),
        ("gold/processed/year=1", "c.csv", 1),
        ("raw", "dump.v1.json", 7),
        ("raw", "other.txt", 7),
        ("raw", "bad name.csv", 7),
    ]:
        (root / folder).mkdir(parents=True, exist_ok=True)
        (root / folder / name).write_bytes(b"x" * size)
    files = listing.list_files(spark, str(root))
    got = {r.name: r for r in listing.list_datasets(files, str(root)).collect()}
    assert set(got) == {"weather_partitioned", "partitioned_data_partitioned", "dump.v1.json"}
    weather = got["weather_partitioned"]
    assert (weather.key, weather.size, weather.partition_count, weather.root_path) == ("weather", 12, 3, "gold/weather")
    assert weather.partition_info == {"year": ["2023", "2024"], "day": ["1", "2"]}
    single = got["dump.v1.json"]
    assert (single.key, single.dataset_name, single.is_partitioned, single.partition_info, single.size) == ("raw/dump.v1.json", "dump", False, None, 7)
    parts = {r.partition_key: (r.partition_values, r.total_partitions) for r in listing.list_partitions(files, "weather", str(root)).collect()}
    assert parts == {"year": (["2023", "2024"], 4), "day": (["1", "2"], 4)}
    with pytest.raises(ValueError):
        listing.list_partitions(files, "../x")


def test_order_is_kept_in_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_FILE", 37)
    own = session_with(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"})
    path, n = str(tmp_path / "t"), F.col("id")
    rows = own.range(0, 3_000, 1, 5).select(F.when(n % 3 == 0, 7).otherwise(n % 50).alias("a"), n.alias("b"), F.lit("x").alias("row"))
    sinks.write_in_order(rows, path, [F.col("a").desc(), "b"])
    assert len(list((tmp_path / "t").glob("*.parquet"))) > 80  # of 12 tasks
    got = sources.read_in_order(spark, path).collect()
    expected = sorted(((7 if i % 3 == 0 else i % 50, i) for i in range(3_000)), key=lambda r: (-r[0], r[1]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.position)] == expected
    assert sorted(r.position for r in got) == list(range(1, 3_001)) and got[0].asDict().keys() == {"a", "b", "row", "position"}
    with pytest.raises(ValueError):
        sources.read_in_order(spark, path, "a")
    sinks.write_in_order(rows.limit(0), path, ["b"])  # overwrites
    assert sources.read_in_order(spark, path).collect() == []


def test_values_come_in_pages(spark, tmp_path):
    path = str(tmp_path / "values")
    names = [("gold/hot/key=%04d/part-%d.parquet" % (i, j), 2, None) for i in range(250) for j in range(2)]
    names += [("gold/hot/key=0001/day=%d/x.parquet" % d, 1, None) for d in (1, 2, 10)] + [("gold/cold/day=1/x.parquet", 5, None), ("raw/plain.csv", 1, None)]
    files = spark.createDataFrame(names, "path string, size long, modified timestamp").repartition(5)
    listing.store_values(files, path)
    pages = {(r.dataset_name, r.partition_key, r.page): r for r in listing.value_pages(spark, path, 100).collect()}
    assert sorted(pages) == [("cold", "day", 1), ("hot", "day", 1), *[("hot", "key", p) for p in (1, 2, 3)]]
    values = [v for p in (1, 2, 3) for v in pages["hot", "key", p].partition_values]
    assert values == ["%04d" % i for i in range(250)] and pages["hot", "key", 3].value_count == 50
    assert sum(pages["hot", "key", p].size for p in (1, 2, 3)) == 1003 and pages["hot", "day", 1].partition_values == ["1", "10", "2"]
    after, seen = None, []
    while some := listing.values_after(spark, path, "hot", "key", after, 90).collect():
        seen += [r.partition_value for r in some]
        after = seen[-1]
    assert seen == values
    with pytest.raises(ValueError):
        listing.value_pages(spark, path, 0)
    with pytest.raises(ValueError):
        listing.values_after(spark, path, "../x", "key")
    counts = {r.dataset_name: r.partition_info for r in listing.list_datasets(files, with_values=False).collect()}
    assert counts == {"hot": {"key": 250, "day": 3}, "cold": {"day": 1}, "plain": None}
    listing.store_values(files.limit(0), path)
    assert listing.value_pages(spark, path).collect() == []


def test_silver_job_counts_what_it_writes(spark, lake, tmp_path):
    result = jobs.silver_job(spark, lake, str(tmp_path / "silver"))
    written = spark.read.parquet(str(tmp_path / "silver"))
    assert result.success and result.record_count == written.count()
    assert result.valid_records == written.where("is_valid").count() and result.invalid_records == written.where("not is_valid").count()
    assert result.avg_quality_score == pytest.approx(written.agg(F.avg("quality_score")).first()[0])
    assert sorted(written.columns) == sorted(schemas.SILVER.names)


def test_silver_for_date_replaces_one_date(spark, lake, tmp_path):
    path = str(tmp_path / "silver")
    for day in ("2024-01-03", "2024-01-04", "2024-01-04"):
        assert jobs.silver_for_date(spark, lake, path, day).success
    assert {r.day for r in spark.read.parquet(path).select("day").distinct().collect()} == {3, 4}
    empty = jobs.silver_for_date(spark, lake, path, "1999-01-01")
    assert (empty.success, empty.record_count, empty.avg_quality_score) == (False, 0, 0.0)
    assert {r.day for r in spark.read.parquet(path).select("day").distinct().collect()} == {3, 4}


def test_run_all_stops_at_bad_data(spark, tmp_path, sf):
    messages = I.messages(spark, sf)
    lake, out = str(tmp_path / "lake"), str(tmp_path / "out")
    with pytest.raises(ValueError):
        jobs.run_all(spark, messages, lake, f"{lake}/published")
    with pytest.raises(jobs.LayerFailed):
        jobs.run_all(spark, messages.limit(0), lake, out)
    # Three of twelve checks fail: the year, the source, and the temperatures.
    odd = messages.withColumn("value", F.encode(F.lit('{"temperature": 500.0, "city": "A"}'), "utf-8"))
    with pytest.raises(jobs.LayerFailed, match="checks failed"):
        jobs.run_all(spark, odd, str(tmp_path / "odd"), out, source="unknown", processed_at=F.lit("1999-01-01").cast("timestamp"))
    assert not os.path.exists(out)
    report = jobs.run_all(spark, messages, lake, out).first()
    assert report.success and spark.read.parquet(out).count() == report.total_records
    again = jobs.run_all(spark, messages, lake, out).first()  # the same messages once more
    assert again == report


def test_runs_add_up(spark, tmp_path, sf):
    messages, at = I.messages(spark, sf), F.col("kafka_timestamp")
    fixed = F.lit("2030-01-01").cast("timestamp")
    parts = [messages.where("offset % 2 = 0"), messages.where("offset % 2 = 1")]
    for part in parts:
        jobs.run_all(spark, part, str(tmp_path / "two"), str(tmp_path / "two_out"), processed_at=at, gold_at=fixed)
    jobs.run_all(spark, messages, str(tmp_path / "one"), str(tmp_path / "one_out"), processed_at=at, gold_at=fixed)
    one, two = (spark.read.parquet(str(tmp_path / f"{n}_out")) for n in ("one", "two"))
    exact = ["city", "max_temperature", "min_pressure", "record_count", "weather_alert_type"]
    assert one.select(*exact).exceptAll(two.select(*exact)).isEmpty()
    assert spark.read.parquet(str(tmp_path / "two/bronze")).count() == spark.read.parquet(str(tmp_path / "one/bronze")).count()
    assert one.count() == two.count()


def test_empty_bronze_leaves_silver(spark, lake, tmp_path):
    silver_path, empty = str(tmp_path / "silver"), str(tmp_path / "empty")
    assert jobs.silver_job(spark, lake, silver_path).success
    before = spark.read.parquet(silver_path).count()
    spark.read.parquet(lake).limit(0).write.parquet(empty)
    assert jobs.silver_job(spark, empty, silver_path) == jobs.NO_DATA
    assert spark.read.parquet(silver_path).count() == before > 0


def test_gold_follows_silver(spark, lake, tmp_path):
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    for day in ("2024-01-03", "2024-01-04"):
        jobs.silver_for_date(spark, lake, silver_path, day)
    jobs.gold_job(spark, silver_path, gold_path)
    spark.read.parquet(silver_path).where("day = 3").write.partitionBy("year", "month", "day").parquet(str(tmp_path / "fewer"))
    jobs.gold_job(spark, str(tmp_path / "fewer"), gold_path)
    assert {r.day for r in spark.read.parquet(gold_path).select("day").distinct().collect()} == {3}


def test_missing_table_fails_for_want_of_data(spark, tmp_path):
    report = jobs.validate(spark, str(tmp_path / "nowhere")).first()
    assert (report.success, report.total_records, report.error) == (False, 0, "No data")


def test_load_keeps_keys(spark, lake, tmp_path):
    out = sources.load(spark, lake)
    assert {"year", "month", "day"} <= set(out.columns)
    assert "PartitionFilters: [isnotnull(day" in explain(out.where("day = 3"))
    spark.range(3).write.parquet(str(tmp_path / "t/any/name"))
    assert sources.load(spark, str(tmp_path / "t")).count() == 3


def test_until_has_no_lower_bound(spark):
    df = spark.createDataFrame([(2019, 12, 31), (2020, 1, 1), (2021, 1, 1)], "year int, month int, day int")
    assert sources.until(df, "20201231").count() == 2 and sources.until(df, "20201231", "20200101").count() == 1


def test_columns_of_clashing_types_are_text(spark, tmp_path):
    root = tmp_path / "d"
    for kind in ("csv", "json"):
        (root / f"k={kind}").mkdir(parents=True)
    (root / "k=csv/a.csv").write_text("id,n\n1,2\n")
    (root / "k=json/b.json").write_text('{"id": "x", "n": 2.5}\n')
    got = sorted((r.id, float(r.n)) for r in sources.read_mixed_dataset(spark, str(root)).collect())
    assert got == [("1", 2.0), ("x", 2.5)]


def test_left_out_files_are_named(spark, tmp_path):
    from varve.sources.listing import list_files

    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "d/a"))
    (tmp_path / "d/broken.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        sources.read_local_tree(spark, str(tmp_path / "d")).count()
    out = spark.read.schema("id long").options(recursiveFileLookup="true", pathGlobFilter="*.parquet", ignoreCorruptFiles="true").parquet(str(tmp_path / "d"))
    files = list_files(spark, str(tmp_path / "d")).where("path like '%.parquet'")
    assert [r.path.rsplit("/", 1)[1] for r in sources.left_out(out, files).collect()] == ["broken.parquet"]


def test_transformer_by_name(spark, sf):
    assert "weather_category" not in registry.transformer("NOAA")(I.messages(spark, sf)).columns
    assert registry.transformer("alphavantage") is not None
    registry.register("copy", lambda df: df)
    assert registry.transformer("Copy")(1) == 1
    with pytest.raises(ValueError, match="unknown source: nasa"):
        registry.transformer("nasa")


def test_constants_name_all_layers():
    assert len(schemas.SILVER.names) == 21 and len(schemas.SILVER_STRICT.names) == 19
    assert set(C.DAILY_KEYS) <= set(schemas.SILVER.names)
