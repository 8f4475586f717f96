"""Replacement that survives lost jobs, layers that follow changes, and states that merge."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from varve import constants as C
from varve import schemas
from varve.operators import gold, quality, silver, states
from varve.operators.dedup import keep_latest
from varve.plans import changes, jobs
from varve.sinks import compaction, swap
from varve.streaming import silver as silver_streams

MESSAGE = "topic string, key binary, value string, offset bigint, partition int, timestamp timestamp"
def gold_at():
    return F.lit("2030-01-01").cast("timestamp")



def rows_of(spark, path, columns=None):
    df = spark.read.parquet(str(path))
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def files_of(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def dated(spark, rows):
    return spark.createDataFrame(rows, "v int, year int, month int, day int")


# Replacement


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    swap.replace(dated(spark, [(1, 2024, 1, 1), (2, 2024, 1, 2)]), path)
    before = files_of(path)
    value = F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int").alias("v")
    bad = spark.range(3, 5).select(value, F.lit(2024).alias("year"), F.lit(1).alias("month"), F.lit(1).alias("day"))
    for partitions in (False, True):
        with pytest.raises(Exception, match="lost"):
            swap.replace(bad, path, partitions=partitions)
    assert files_of(path) == before and rows_of(spark, path, ["v"]) == [(1,), (2,)]
    os.makedirs(tmp_path / "_t.staged-lost" / "new")  # what a driver that died leaves
    assert swap.sweep(spark, path) == 0 and swap.sweep(spark, path, 0) >= 1  # young files may belong to a job at work
    assert sorted(os.listdir(tmp_path)) == ["t"]


@pytest.mark.parametrize("fails_at", range(6))
def test_a_job_lost_between_renames_is_finished(spark, tmp_path, monkeypatch, fails_at):
    path = str(tmp_path / "t")
    swap.replace(dated(spark, [(1, 2024, 1, 1), (2, 2024, 1, 2), (3, 2024, 1, 3)]), path)
    done, move = [], swap.Folders.move

    def lost(self, source, target):
        if len(done) == fails_at:
            raise KeyboardInterrupt
        done.append(target)
        move(self, source, target)

    monkeypatch.setattr(swap.Folders, "move", lost)
    new = dated(spark, [(10, 2024, 1, 1), (40, 2024, 1, 4)])
    try:
        swap.replace(new, path, partitions=True, dates=[(2024, 1, 1), (2024, 1, 3)])
    except KeyboardInterrupt:
        pass
    monkeypatch.undo()
    decided = fails_at > 0  # the first rename sets the note down
    assert swap.recover(spark, path) == (1 if decided and len(done) == fails_at and fails_at < 5 else 0)
    assert set(rows_of(spark, path, ["v"])) == ({(2,), (10,), (40,)} if decided else {(1,), (2,), (3,)})
    assert swap.recover(spark, path) == 0


def test_replace_by_what_reads_the_table_and_null_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    swap.replace(dated(spark, [(1, 2024, 1, 1), (2, None, None, None)]), path)
    again = spark.read.parquet(path)
    assert swap.replace(again.withColumn("v", F.col("v") + 5), path) == 2
    assert rows_of(spark, path, ["v"]) == [(6,), (7,)]
    swap.replace(dated(spark, []), path, partitions=True, dates=[(None, None, None)])
    assert rows_of(spark, path, ["v"]) == [(6,)]
    swap.replace(dated(spark, []), path, partitions=True)
    assert rows_of(spark, path, ["v"]) == [(6,)]


def test_silver_job_that_fails_keeps_the_old_table(spark, tmp_path):
    bronze, path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    rows = spark.createDataFrame([reading(1, 1, 1)], MESSAGE)
    silver.bronze(rows, processed_at=at()).write.partitionBy(*C.DATE_PARTS).parquet(bronze)
    assert jobs.silver_job(spark, bronze, path).success
    before = files_of(path)
    for name in files_of(bronze):
        with open(name, "wb") as f:
            f.write(b"damaged")
    with pytest.raises(Exception):  # noqa: B017
        jobs.silver_job(spark, bronze, path)
    assert files_of(path) == before


# Layers that follow changes


def at():
    return F.col("kafka_timestamp") + F.expr("INTERVAL 90 MINUTES")


def reading(offset, day, value, hour=1, event_day=None, city="A"):
    """A message that arrives on a day; the same value and event time make a copy of a reading."""
    taken = dt.datetime(2024, 1, event_day or day, 0, 30)
    body = {"temperature": float(value), "wind_speed": "5 mph", "city": city, "timestamp": taken.strftime("%Y-%m-%dT%H:%M:%S"), "humidity": 50.0 + offset % 7, "pressure": 1000.0, "visibility": 9.0}
    return ("weather-forecast", None, json.dumps(body), offset, 0, dt.datetime(2024, 1, day, hour))


def run(spark, rows, lake, out):
    return changes.run_changes(spark, spark.createDataFrame(rows, MESSAGE), str(lake), str(out), processed_at=at(), gold_at=gold_at())


def whole(spark, rows):
    """Silver and gold of all messages at once."""
    bronze = silver.bronze(spark.createDataFrame(rows, MESSAGE), processed_at=at())
    wanted = silver.silver(bronze)
    metrics = gold.weather_metrics(wanted, gold_at())
    return wanted, metrics


def same_as_whole(spark, rows, lake, out):
    wanted, metrics = whole(spark, rows)
    assert rows_of(spark, lake / "silver", wanted.columns) == sorted((tuple(r) for r in wanted.collect()), key=repr)
    for path in (lake / "gold", out):
        assert rounded(rows_of(spark, path, metrics.columns)) == rounded(sorted((tuple(r) for r in metrics.collect()), key=repr))


def rounded(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


def damage(root, day):
    """Make the files of one date unreadable: whoever opens one fails."""
    found = [f for f in files_of(root) if f"/day={day}/" in f]
    for f in found:
        with open(f, "wb") as out:
            out.write(b"not to be read")
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    return found


def test_untouched_dates_are_neither_read_nor_written(spark, tmp_path):
    lake, out = tmp_path / "lake", tmp_path / "out"
    first = [reading(i, 1 + i % 5, i) for i in range(40)]
    run(spark, first, lake, out)
    tables = [lake / "bronze", lake / "silver", lake / "gold", out]
    untouched = [f for t in tables for day in (1, 2, 5) for f in damage(t, day)]
    assert len(untouched) >= 12
    before = {f: os.path.getmtime(f) for f in untouched}
    # New readings on day 3, and on day 4 a newer copy of one of day 3, which thereby leaves day 3.
    more = [reading(100, 3, 500), reading(101, 4, 2, hour=2, event_day=3)]
    report = run(spark, more, lake, out).first()
    assert report.success and report.total_records == 5
    assert {f: os.path.getmtime(f) for f in untouched} == before
    kept = [r for r in whole(spark, first + more)[0].collect() if r.day in (3, 4)]
    read = changes.on_dates(spark.read.schema(schemas.SILVER).parquet(str(lake / "silver")), [(2024, 1, 3), (2024, 1, 4)]).select(*schemas.SILVER.names)
    assert sorted(map(tuple, kept), key=repr) == sorted(map(tuple, read.collect()), key=repr)
    assert 500 in {r.temperature for r in kept} and 2 in {r.temperature for r in kept if r.day == 4}


def test_many_runs_equal_one(spark, tmp_path):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        day = rng.randint(1, 6)
        rows.append(reading(i, day, rng.randint(1, 15), hour=rng.randint(0, 20), event_day=rng.randint(1, day), city=rng.choice(["A", "B", None])))
    rows[7] = (*rows[7][:2], "", *rows[7][3:])
    rows[8] = (*rows[8][:2], "{broken", *rows[8][3:])
    lake, out = tmp_path / "lake", tmp_path / "out"
    for part in (rows[:50], rows[40:90], rows[90:]):
        run(spark, part, lake, out)
    same_as_whole(spark, rows, lake, out)
    assert os.listdir(lake / "_changes") == [] and sorted(os.listdir(tmp_path)) == ["lake", "out"]


def test_a_date_that_loses_all_its_rows_goes(spark, tmp_path):
    lake, out = tmp_path / "lake", tmp_path / "out"
    rows = [reading(1, 1, 7), reading(2, 2, 8)]
    run(spark, rows, lake, out)
    later = [reading(3, 4, 7, event_day=1)]
    run(spark, later, lake, out)
    same_as_whole(spark, rows + later, lake, out)
    assert {r.day for r in spark.read.parquet(str(lake / "gold")).collect()} == {2, 4}


@pytest.mark.parametrize("step", ["write_partitioned", "event_zones", "on_gold"])
def test_a_run_that_ends_early_is_taken_up(spark, tmp_path, monkeypatch, step):
    lake, out = tmp_path / "lake", tmp_path / "out"
    rows = [reading(i, 1 + i % 3, i) for i in range(9)]
    run(spark, rows, lake, out)
    more = [reading(20, 3, 1, event_day=2), reading(21, 1, 50)]

    def lost(*args, **kw):
        raise KeyboardInterrupt

    target = {"on_gold": (changes.G, "weather_metrics"), "merged_suite": (changes.Q, "merged_suite")}.get(step, (changes, step))
    monkeypatch.setattr(*target, lost)
    with pytest.raises(KeyboardInterrupt):
        run(spark, more, lake, out)
    monkeypatch.undo()
    last = [reading(30, 2, 60)]
    run(spark, last, lake, out)
    same_as_whole(spark, rows + more + last, lake, out)


def test_a_failed_report_publishes_later(spark, tmp_path):
    lake, out = tmp_path / "lake", tmp_path / "out"
    rows = [reading(i, 1 + i % 2, i + 1) for i in range(6)]
    run(spark, rows, lake, out)
    before = files_of(out)
    hard = quality.Suite("gold", (quality.row_count(low=3),))
    messages = spark.createDataFrame([reading(10, 1, 40)], MESSAGE)
    with pytest.raises(jobs.LayerFailed):
        changes.run_changes(spark, messages, str(lake), str(out), processed_at=at(), gold_at=gold_at(), suite=hard)
    assert files_of(out) == before
    with pytest.raises(jobs.LayerFailed):
        run(spark, [], tmp_path / "none", tmp_path / "none_out")
    run(spark, [], lake, out)
    same_as_whole(spark, [*rows, reading(10, 1, 40)], lake, out)


def test_a_lake_of_whole_runs_is_taken_over(spark, tmp_path):
    lake, out = tmp_path / "lake", tmp_path / "out"
    rows = [reading(i, 1 + i % 3, i) for i in range(9)]
    jobs.run_all(spark, spark.createDataFrame(rows, MESSAGE), str(lake), str(out), processed_at=at(), gold_at=gold_at())
    more = [reading(8, 3, 8), reading(9, 4, 1, event_day=2)]
    run(spark, more, lake, out)
    same_as_whole(spark, [*rows, more[1]], lake, out)


def test_dates_to_search(spark):
    def zone(day, low, high, untimed=0):
        return (2024, 1, day, low and dt.datetime(2024, 1, low), high and dt.datetime(2024, 1, high, 23), untimed)

    zones = spark.createDataFrame([zone(5, 3, 5), zone(6, 6, 6), zone(7, 1, 7), zone(8, None, None, 2)], changes.ZONES)
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 4, 12),)], "timestamp timestamp")
    assert changes.dates_to_search(zones, rows) == {(2024, 1, 5), (2024, 1, 7)}
    assert changes.dates_to_search(zones, spark.createDataFrame([(None,)], "timestamp timestamp")) == {(2024, 1, 8)}


def test_on_dates_prunes(spark, tmp_path):
    dated(spark, [(d, 2024, 1, d) for d in range(1, 6)] + [(9, None, None, None)]).write.partitionBy(*C.DATE_PARTS).parquet(str(tmp_path / "t"))
    some = changes.on_dates(spark.read.parquet(str(tmp_path / "t")), [(2024, 1, 2), (None, None, None)])
    assert sorted(r.v for r in some.collect()) == [2, 9]
    assert "PartitionFilters: [" in some._jdf.queryExecution().toString() and "DataFilters: []" in some._jdf.queryExecution().toString()
    assert changes.on_dates(spark.read.parquet(str(tmp_path / "t")), []).count() == 0


# Silver as a stream


def test_a_repeated_batch_is_applied_once(spark, tmp_path, monkeypatch):
    lake = changes.Lake(str(tmp_path / "lake"))
    first = spark.createDataFrame([reading(1, 1, 1), reading(2, 2, 2)], MESSAGE)
    assert silver_streams.apply_batch(first, 0, lake, processed_at=at())
    assert not silver_streams.apply_batch(first, 0, lake, processed_at=at())
    second = spark.createDataFrame([reading(3, 3, 1, event_day=1)], MESSAGE)

    def lost(*args, **kw):
        raise KeyboardInterrupt

    monkeypatch.setattr(changes, "event_zones", lost)
    with pytest.raises(KeyboardInterrupt):
        silver_streams.apply_batch(second, 1, lake, processed_at=at())
    monkeypatch.undo()
    # The batch comes again, with another clock: what was set down holds.
    assert silver_streams.apply_batch(second, 1, lake, processed_at=F.lit("2029-01-01").cast("timestamp"))
    assert silver_streams.last_batch(spark, lake) == 1
    wanted, _ = whole(spark, [reading(1, 1, 1), reading(2, 2, 2), reading(3, 3, 1, event_day=1)])
    assert rows_of(spark, lake.silver, wanted.columns) == sorted((tuple(r) for r in wanted.collect()), key=repr)
    assert spark.read.parquet(lake.bronze).count() == 3


# Merging states and counters


def silver_rows(spark, n=600):
    rng = random.Random(4)
    rows = [(rng.choice([None, 0.0, 1e6 + rng.random(), 5.0]), rng.choice(["A", "B", None]), rng.randint(1, 3), rng.choice([None, 0.5]), i) for i in range(n)]
    df = spark.createDataFrame(rows, "temperature double, city string, day int, quality_score double, i int")
    more = {"humidity": F.col("temperature"), "pressure": F.col("temperature"), "wind_speed": F.lit(3.0), "visibility": F.lit(None).cast("double")}
    return df.withColumns({**more, "data_source": F.lit("noaa"), "year": F.lit(2024), "month": F.lit(1), "processing_timestamp": F.timestamp_seconds("i")})


def test_states_of_batches_merge_to_those_of_the_whole(spark):
    rows = silver_rows(spark)
    parts = [states.daily_states(rows.where(F.col("i") % 7 == k)) for k in range(7)]
    merged = states.metrics_of(states.merge_states(states.merge_states(*parts[:3]), *parts[3:]))
    wanted = gold.daily_metrics(rows)
    assert merged.columns == wanted.columns
    for a, b in zip(*(sorted((tuple(r) for r in df.collect()), key=lambda r: repr(r[:5])) for df in (merged, wanted)), strict=True):
        assert a == tuple(pytest.approx(v, rel=1e-9) if isinstance(v, float) else v for v in b)


def test_keys_that_lose_rows_are_counted_again(spark):
    rows = silver_rows(spark)
    left = rows.where("i % 5 <> 0 or city = 'B'")
    touched = rows.where("i % 5 = 0 and city <> 'B' or city is null").select(*C.DAILY_KEYS)
    again = states.recount(states.daily_states(rows), left, touched)
    found, wanted = (sorted(map(tuple, df.collect()), key=lambda r: repr(r[:5])) for df in (again, states.daily_states(left)))
    assert len(found) == len(wanted)
    for a, b in zip(found, wanted, strict=True):
        assert a == tuple(pytest.approx(v, rel=1e-9, abs=1e-3) if isinstance(v, float) else v for v in b)


def test_counters_of_parts_give_the_results_of_the_whole(spark):
    df = spark.createDataFrame([(d, None if i % 3 else float(i), "noaa" if i % 4 else "x", 1) for i, d in enumerate([1, 1, 2, 2, None, 3, 3])], "day int, v double, data_source string, odd int")
    suite = quality.Suite("s", (quality.row_count(high=6), quality.not_null("v"), quality.in_set("data_source", ("noaa",)), quality.between("v", 0, 4, mostly=0.6), quality.greater_than("v", 0), quality.between("gone", 0, 1), quality.columns_match(("day",))))
    old = quality.suite_counters(df.where("day is null or day <> 2"), suite, ["day"])
    new = quality.suite_counters(df.where("day = 2"), suite, ["day"])
    assert sorted(map(tuple, quality.merged_suite(old.unionByName(new), suite, df).collect())) == sorted(map(tuple, quality.run_suite(df, suite).collect()))
    empty = quality.merged_suite(old.limit(0), suite, df)
    assert sorted(map(tuple, empty.collect())) == sorted(map(tuple, quality.run_suite(df.limit(0), suite).collect()))


# Compaction


def test_first_fit():
    assert compaction.first_fit([], 10) == []
    assert compaction.first_fit([5, 5, 5, 5, 1], 10) == [0, 0, 1, 1, 2]
    assert compaction.first_fit([9, 4, 3, 2, 1], 10) == [0, 1, 1, 1, 0]


def test_large_files_stay_untouched(spark, tmp_path):
    path = str(tmp_path / "t")
    large = spark.range(20_000).select(F.col("id").cast("int").alias("v"), F.lit(2024).alias("year"), F.lit(1).alias("month"), F.lit(1).alias("day"))
    large.coalesce(1).write.partitionBy(*C.DATE_PARTS).parquet(path)
    (kept,) = files_of(path)
    for day in (1, 1, 1, 2, 2, 3):
        dated(spark, [(day, 2024, 1, day)]).write.mode("append").partitionBy(*C.DATE_PARTS).parquet(path)
    before, rows = files_of(path), rows_of(spark, path)
    target = os.path.getsize(kept) * 2 - 100
    assert compaction.pack(spark, path, target=target) == 3
    after = files_of(path)
    assert after[kept] == before[kept] and len(after) == 4
    alone = [f for f in before if "/day=3/" in f]
    assert [f for f in after if "/day=3/" in f] == alone and after[alone[0]] == before[alone[0]]
    assert rows_of(spark, path) == rows
    assert compaction.pack(spark, path, target=target) == 0


def test_dedup_of_changes_follows_the_dedup(spark):
    """The latest copy wins over dates, nulls in keys are equal, an older copy changes nothing."""
    rows = silver.silver(silver.bronze(spark.createDataFrame([reading(1, 2, 5, city=None), reading(2, 3, 6)], MESSAGE), processed_at=at()))
    older = silver.silver(silver.bronze(spark.createDataFrame([reading(3, 2, 5, hour=0, city=None)], MESSAGE), processed_at=at()))
    added, dates = changes.silver_changes(older, rows)
    assert added.count() == 0 and dates == set()
    newer = silver.silver(silver.bronze(spark.createDataFrame([reading(4, 4, 5, event_day=2, city=None)], MESSAGE), processed_at=at()))
    added, dates = changes.silver_changes(newer, rows)
    assert added.count() == 1 and dates == {(2024, 1, 2), (2024, 1, 4)}
    both = keep_latest(rows.unionByName(newer))
    left = changes.without_keys(rows, added).unionByName(added)
    assert sorted(map(tuple, both.collect()), key=repr) == sorted(map(tuple, left.collect()), key=repr)


def test_an_old_copy_that_ties_or_is_newer_stays(spark):
    """Keys match by value over nulls, zeros of both signs and not-a-numbers; nothing of a reading changes unless the new copy is the latest of all."""
    rows = silver.silver(silver.bronze(spark.createDataFrame([reading(i, 3, i) for i in range(1, 5)], MESSAGE), processed_at=at()))
    odd = F.when(F.col("kafka_offset") == 1, None).when(F.col("kafka_offset") == 2, F.lit("nan").cast("double"))
    rows = rows.withColumn("temperature", odd.otherwise(0.0))
    added, dates = changes.silver_changes(rows, rows)
    assert added.count() == 0 and dates == set()
    later = F.col("processing_timestamp") + F.expr("INTERVAL 1 DAY")
    newer = rows.withColumns({"processing_timestamp": later, "day": F.col("day") + 1, "temperature": odd.otherwise(-0.0)})
    added, dates = changes.silver_changes(newer, rows)
    assert added.count() == 4 and dates == {(2024, 1, 3), (2024, 1, 4)}
    assert changes.without_keys(rows, added).count() == 0
    last = rows.withColumns({"processing_timestamp": later + F.expr("INTERVAL 1 DAY"), "day": F.col("day") + 2})
    added, dates = changes.silver_changes(newer, rows.unionByName(last))  # newer than one copy, not than the other
    assert added.count() == 0 and dates == set()


def test_bronze_is_searched_once_for_a_batch_that_did_not_fail(spark, tmp_path, monkeypatch):
    lake, searched, search = changes.Lake(str(tmp_path / "lake")), [], changes.unknown_messages
    monkeypatch.setattr(changes, "unknown_messages", lambda *args: searched.append(1) or search(*args))
    rows = [reading(i, 1 + i, 1 + i) for i in range(3)]
    for number in range(2):  # the second batch brings a message again
        assert silver_streams.apply_batch(spark.createDataFrame(rows[number : number + 2], MESSAGE), number, lake, processed_at=at())
    assert len(searched) == 2
    assert spark.read.parquet(lake.bronze).count() == 3 and spark.read.parquet(lake.silver).count() == 3
