import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import inputs as I
from varve import constants as C
from varve import schemas
from varve.operators import dedup, gold, silver
from varve.functions import cleaning as K

BRONZE_COLUMNS = schemas.BRONZE.names


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def make_bronze(spark, *changes):
    base = dict(
        temperature=20.0, wind_speed="5 mph", city="oslo", timestamp="2024-01-01T00:00:00", humidity=50.0, pressure=1000.0,
        visibility=10.0, processing_timestamp=dt.datetime(2024, 1, 1, 1), hour=1, minute=0, kafka_offset=1, kafka_partition=0,
        kafka_timestamp=dt.datetime(2024, 1, 1, 1), data_source="noaa", year=2024, month=1, day=1,
    )
    data = [tuple({**base, **c}[n] for n in BRONZE_COLUMNS) for c in changes]
    return spark.createDataFrame(data, schemas.BRONZE)


def messages(spark, *values):
    data = [(v.encode() if v is not None else None, i, 0, dt.datetime(2024, 1, 1)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "value binary, offset bigint, partition int, timestamp timestamp")


def test_decode_drops_empty_and_keeps_broken(spark):
    text = '{"temperature": 1.5, "wind_speed": "3 mph", "city": "A", "unknown": 1}'
    out = rows(silver.decode_readings(messages(spark, text, "", None, "{bad", '{"temperature": "x", "humidity": 3}')), "offset")
    assert [r[7] for r in out] == [0, 3, 4]
    assert out[0][:3] == (1.5, "3 mph", "A")
    assert out[1][:7] == (None,) * 7
    assert out[2][0] is None and out[2][4] == 3.0


def test_fill_touches_numbers_only(spark):
    out = silver.fill_numeric_nulls(silver.decode_readings(messages(spark, "{}"))).first()
    assert (out.temperature, out.pressure, out.wind_speed, out.city) == (0.0, 0.0, None, None)
    kept = silver.bronze(messages(spark, "{}"), fill=False).first()
    assert kept.temperature is None


def test_bronze_schema_and_stamp(spark):
    out = silver.bronze(messages(spark, "{}"), "noaa", processed_at=F.lit("2024-02-03 04:05:06").cast("timestamp"))
    assert out.schema.names == BRONZE_COLUMNS and [f.dataType for f in out.schema] == [f.dataType for f in schemas.BRONZE]
    r = out.first()
    assert (r.hour, r.minute, r.year, r.month, r.day, r.data_source, r.kafka_offset) == (4, 5, 2024, 2, 3, "noaa", 0)


def test_silver_scores_and_schema(spark):
    out = silver.silver(make_bronze(spark, {}, {"temperature": 70.0, "wind_speed": "calm", "kafka_offset": 2}))
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.SILVER]
    good, bad = out.orderBy("kafka_offset").collect()
    assert (good.quality_score, good.is_valid, good.weather_category, good.city, good.data_freshness_hours) == (1.0, True, "NORMAL", "OSLO", 1.0)
    assert (bad.quality_score, bad.is_valid, bad.weather_category, bad.wind_speed) == (0.6, False, "HOT", None)


def test_latest_copy_wins_and_ties_break_by_topic_position(spark):
    later = dt.datetime(2024, 1, 1, 2)
    out = silver.silver(make_bronze(spark, {"kafka_offset": 1}, {"kafka_offset": 9}, {"processing_timestamp": later, "kafka_offset": 3}, {"processing_timestamp": later, "kafka_offset": 5}))
    assert [r.kafka_offset for r in out.collect()] == [5]


def test_null_keys_are_one_group(spark):
    df = make_bronze(spark, {"temperature": None}, {"temperature": None, "kafka_offset": 2}, {"kafka_offset": 3})
    for keep in (dedup.keep_latest, dedup.keep_latest_by_aggregate):
        assert sorted(r.kafka_offset for r in keep(df).collect()) == [2, 3]


def test_dedup_forms_agree(spark, sf):
    cleaned = silver.clean(I.readings(spark, sf), K.clean_timestamp("timestamp", "processing_timestamp"))
    assert rows(dedup.keep_latest(cleaned)) == rows(dedup.keep_latest_by_aggregate(cleaned))


def test_strict_silver_has_no_upper_wind_bound(spark):
    df = make_bronze(spark, {"wind_speed": "10 to 15"}, {"wind_speed": None, "kafka_offset": 2}, {"visibility": None, "kafka_offset": 3}, {"timestamp": "zzz", "kafka_offset": 4})
    out = silver.silver_strict(df)
    assert sorted((r.kafka_offset, r.wind_speed, r.timestamp is None) for r in out.collect()) == [(1, 1015.0, False), (4, 5.0, True)]
    assert out.columns == schemas.SILVER_STRICT.names


def test_quality_summary_of_nothing(spark):
    r = silver.quality_summary(silver.silver(make_bronze(spark, {})).limit(0)).first()
    assert (r.total_records, r.valid_records, r.avg_quality_score, r.quality_rate) == (0, 0, None, None)


def make_silver(spark, *changes):
    base = {f.name: None for f in schemas.SILVER}
    base.update(temperature=20.0, wind_speed=5.0, city="A", humidity=50.0, pressure=1000.0, visibility=10.0, data_source="noaa", year=2024, month=1, day=1, hour=0, quality_score=1.0)
    return spark.createDataFrame([tuple({**base, **c}[f.name] for f in schemas.SILVER) for c in changes], schemas.SILVER)


def test_aggregates_leave_out_unusable_values(spark):
    df = make_silver(spark, {"temperature": 0.0, "humidity": 0.0}, {"temperature": 10.0, "wind_speed": -1.0}, {"temperature": None, "pressure": None})
    r = gold.daily_metrics(df).first()
    assert (r.avg_temperature, r.temperature_stddev, r.avg_humidity, r.avg_wind_speed, r.avg_pressure, r.record_count) == (10.0, None, 50.0, 5.0, 1000.0, 3)


@pytest.mark.parametrize(
    "change,kind,severity",
    [
        ({"temperature": 36.0}, "HIGH_TEMPERATURE", "HIGH"),
        ({"temperature": 41.0}, "HIGH_TEMPERATURE", "SEVERE"),
        ({"temperature": -10.0}, "NORMAL", "MEDIUM"),
        ({"temperature": -10.5}, "LOW_TEMPERATURE", "HIGH"),
        ({"temperature": -21.0}, "LOW_TEMPERATURE", "SEVERE"),
        ({"wind_speed": 20.0}, "NORMAL", "MEDIUM"),
        ({"wind_speed": 26.0}, "HIGH_WIND", "HIGH"),
        ({"visibility": 0.5}, "LOW_VISIBILITY", "LOW"),
        ({"pressure": 949.0}, "LOW_PRESSURE", "LOW"),
        ({}, "NORMAL", "LOW"),
        ({"temperature": None, "wind_speed": None, "visibility": None, "pressure": None}, "NORMAL", "LOW"),
    ],
)
def test_alerts(spark, change, kind, severity):
    r = gold.weather_alerts(make_silver(spark, change)).first()
    assert (r.weather_alert_type, r.alert_severity) == (kind, severity)


def test_null_keys_get_no_alert_in_either_form(spark):
    df = make_silver(spark, {}, {"city": None}, {"city": None, "temperature": 50.0}, {"data_source": None})
    at = F.lit("2024-01-01").cast("timestamp")
    one, two = gold.weather_metrics(df, at), gold.weather_metrics(df, at, joined=True)
    assert one.columns == two.columns
    assert rows(one) == rows(two)
    assert {r.city: r.weather_alert_type for r in one.where("data_source is not null").collect()} == {"A": "NORMAL", None: None}


def test_gold_forms_agree_on_whole_tables(spark, sf):
    df = silver.silver(I.readings(spark, sf))
    at = F.lit("2024-01-01").cast("timestamp")
    one, two = gold.weather_metrics(df, at), gold.weather_metrics(df, at, joined=True)
    assert rows(one.drop("avg_temperature", "temperature_stddev", "avg_humidity", "avg_pressure"), *C.DAILY_KEYS) == rows(
        two.drop("avg_temperature", "temperature_stddev", "avg_humidity", "avg_pressure"), *C.DAILY_KEYS
    )
