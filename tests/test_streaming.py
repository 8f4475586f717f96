import json

import pytest
from pyspark.sql import functions as F

from varve.operators import silver
from varve.sinks.files import copy_parquet
from varve.streaming import bronze as streams

SCHEMA = "value string, offset bigint, partition int, timestamp timestamp"


def drop_messages(folder, name, offsets):
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps({"value": json.dumps({"temperature": float(o), "city": "A"}) if o % 5 else "", "offset": o, "partition": 0, "timestamp": "2024-01-01T00:00:00Z"})
        for o in offsets
    ]
    (folder / name).write_text("\n".join(lines))


def source(spark, folder, **options):
    return spark.readStream.schema(SCHEMA).options(**options).json(str(folder))


def offsets(spark, path):
    return sorted(r.kafka_offset for r in spark.read.parquet(path).select("kafka_offset").collect())


def test_stream_equals_batch_and_restarts_without_repeats(spark, tmp_path):
    inbox, out, checkpoint = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "checkpoint")
    at = F.lit("2024-01-02 03:04:05").cast("timestamp")

    def run():
        q = streams.bronze_stream(source(spark, inbox), out, checkpoint, trigger=None, processed_at=at)
        assert q.name == "bronze_noaa_streaming_query"
        assert q.awaitTermination(120)

    drop_messages(inbox, "a.json", range(1, 10))
    run()
    assert offsets(spark, out) == [1, 2, 3, 4, 6, 7, 8, 9]
    run()
    assert offsets(spark, out) == [1, 2, 3, 4, 6, 7, 8, 9]
    drop_messages(inbox, "b.json", range(10, 13))
    run()
    batch = silver.bronze(spark.read.schema(SCHEMA).json(str(inbox)), processed_at=at)
    streamed = spark.read.parquet(out).select(*batch.columns)
    assert sorted(map(tuple, streamed.collect()), key=str) == sorted(map(tuple, batch.collect()), key=str)

    copy = tmp_path / "copy"
    copy_parquet(spark, out, str(copy), cols=("year", "month", "day"))
    assert offsets(spark, str(copy)) == offsets(spark, out)
    assert not (copy / "_spark_metadata").exists()


def test_rate_cap_splits_batches(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "bronze")
    for i in range(3):
        drop_messages(inbox, f"{i}.json", [10 * i + 1])
    q = streams.bronze_stream(source(spark, inbox, maxFilesPerTrigger=1), out, str(tmp_path / "c"), trigger=None)
    q.awaitTermination(120)
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [1, 1, 1]


def test_bounded_run_stops(spark, tmp_path):
    inbox = tmp_path / "in"
    drop_messages(inbox, "a.json", [1])
    q = streams.bronze_stream(source(spark, inbox), str(tmp_path / "b"), str(tmp_path / "c"), trigger="1 second")
    assert streams.run_bounded(q, 3) is False
    assert not q.isActive
    done = streams.bronze_stream(source(spark, inbox), str(tmp_path / "b2"), str(tmp_path / "c2"), trigger=None)
    assert streams.run_bounded(done, 60) is True


def test_dedup_is_no_stream_operator(spark, tmp_path):
    inbox = tmp_path / "in"
    drop_messages(inbox, "a.json", [1])
    rows = silver.silver(silver.bronze(source(spark, inbox)))
    with pytest.raises(Exception, match="NON_TIME_WINDOW_NOT_SUPPORTED_IN_STREAMING|window"):
        rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination(30)


def test_parts_of_the_messages_are_dealt_out(spark, sf, tmp_path, monkeypatch):
    """A part of many rows is several files, so no task has all of it, and still one micro-batch."""
    from checks import registry

    monkeypatch.setattr(registry, "FILE_ROWS", 100, raising=False)
    inbox = str(tmp_path / "in")
    registry._message_files(spark, sf, inbox, (0, 1))
    sizes = [r["count"] for r in spark.read.parquet(inbox).groupBy(F.input_file_name()).count().collect()]
    events = spark.read.parquet(f"{sf}/events.parquet")
    halves = [events.where(F.col("event_id") % 4 == half).count() for half in (0, 1)]
    assert sum(sizes) == sum(halves) and max(sizes) <= 2 * 100
    q = streams.bronze_stream(registry._message_stream(spark, sf, inbox), str(tmp_path / "b"), str(tmp_path / "c"), trigger=None)
    assert q.awaitTermination(120)
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == halves
