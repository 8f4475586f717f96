"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

import re

DAY = "2024-01-09"

# Common table expressions; each may use the ones before it.
VIEWS: dict[str, str] = {}

VIEWS["single_readings"] = """
SELECT CASE WHEN event_id % 17 = 0 THEN NULL ELSE value * 0.5::DOUBLE - 20 END AS temperature,
       CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 7 = 1 THEN 'calm'
            WHEN event_id % 7 = 2 THEN concat(user_id % 20, ' to ', user_id % 20 + 5, ' mph')
            ELSE concat(user_id % 60, ' mph') END AS wind_speed,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE concat(' city_', user_id % 12, ' ') END AS city,
       CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 11 = 1 THEN 'not-a-time'
            WHEN event_id % 11 < 5 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
            WHEN event_id % 11 < 8 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS timestamp,
       CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) * 1.1::DOUBLE END AS humidity,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) * 3.5::DOUBLE + 780 AS pressure,
       CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(user_id % 60 AS DOUBLE) END AS visibility,
       ts + INTERVAL 90 MINUTE AS processing_timestamp,
       event_id AS kafka_offset, CAST(user_id % 4 AS INTEGER) AS kafka_partition, ts AS kafka_timestamp,
       'noaa' AS data_source
FROM events"""

_TIMED = """CAST(hour(processing_timestamp) AS INTEGER) AS hour, CAST(minute(processing_timestamp) AS INTEGER) AS minute,
       CAST(year(processing_timestamp) AS INTEGER) AS year, CAST(month(processing_timestamp) AS INTEGER) AS month,
       CAST(day(processing_timestamp) AS INTEGER) AS day"""

VIEWS["readings"] = f"""
SELECT *, {_TIMED} FROM (
  SELECT * FROM single_readings
  UNION ALL
  SELECT * REPLACE (processing_timestamp + INTERVAL 1 HOUR AS processing_timestamp, kafka_offset + 10000000 AS kafka_offset)
  FROM single_readings)"""

VIEWS["bronze"] = f"""
SELECT coalesce(CASE WHEN ok THEN temperature END, 0) AS temperature,
       CASE WHEN ok THEN wind_speed END AS wind_speed, CASE WHEN ok THEN city END AS city,
       CASE WHEN ok THEN timestamp END AS timestamp,
       coalesce(CASE WHEN ok THEN humidity END, 0) AS humidity, coalesce(CASE WHEN ok THEN pressure END, 0) AS pressure,
       coalesce(CASE WHEN ok THEN visibility END, 0) AS visibility,
       processing_timestamp, kafka_offset, kafka_partition, kafka_timestamp, data_source, {_TIMED}
FROM (SELECT *, kafka_offset % 29 > 2 AS ok FROM single_readings WHERE kafka_offset % 29 NOT IN (0, 2))"""


def _cleaned(time: str, city: str, source: str = "readings") -> str:
    return f"""
SELECT temperature, wind_speed AS wind_text,
       CASE WHEN wind_speed IS NULL THEN 0.0::DOUBLE
            ELSE TRY_CAST(regexp_replace(wind_speed, '[^0-9.]', '', 'g') AS DOUBLE) END AS wind_speed,
       {city} AS city, {time} AS timestamp,
       humidity, pressure, visibility, processing_timestamp, hour, minute, data_source, year, month, day,
       kafka_offset, kafka_partition, kafka_timestamp
FROM {source}"""


def _latest(source: str) -> str:
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY temperature, wind_speed, city, timestamp, data_source
    ORDER BY processing_timestamp DESC, kafka_timestamp DESC, kafka_partition DESC, kafka_offset DESC) AS rn
  FROM {source}) WHERE rn = 1"""


def _scored(source: str) -> str:
    return f"""
SELECT temperature, wind_speed, city, timestamp, humidity, pressure, visibility, processing_timestamp, hour, minute,
       data_source, year, month, day,
       (CAST(t AS DOUBLE) + CAST(h AS DOUBLE) + CAST(p AS DOUBLE) + CAST(w AS DOUBLE) + CAST(v AS DOUBLE)) / 5 AS quality_score,
       t AND h AND p AND w AND v AS is_valid,
       CASE WHEN temperature > 30 THEN 'HOT' WHEN temperature < 0 THEN 'COLD' WHEN wind_speed > 15 THEN 'WINDY'
            WHEN visibility < 5 THEN 'FOGGY' ELSE 'NORMAL' END AS weather_category,
       (floor(epoch(processing_timestamp)) - floor(epoch(timestamp))) / 3600 AS data_freshness_hours,
       kafka_offset, kafka_partition, kafka_timestamp
FROM (SELECT *, coalesce(temperature BETWEEN -90 AND 60, false) AS t, coalesce(humidity BETWEEN 0 AND 100, false) AS h,
             coalesce(pressure BETWEEN 800 AND 1100, false) AS p, coalesce(wind_speed BETWEEN 0 AND 100, false) AS w,
             coalesce(visibility BETWEEN 0 AND 50, false) AS v FROM {source})"""


_CITY = "coalesce(trim(upper(city)), 'UNKNOWN')"
VIEWS["cleaned"] = _cleaned(
    "coalesce(date_trunc('milliseconds', TRY_CAST(timestamp AS TIMESTAMP)), processing_timestamp)", _CITY
)
VIEWS["latest"] = _latest("cleaned")
VIEWS["silver"] = _scored("latest")
_EXACT = "CASE WHEN timestamp IS NULL THEN processing_timestamp ELSE try_strptime(timestamp, '%Y-%m-%dT%H:%M:%S') END"
VIEWS["cleaned_exact"] = _cleaned(_EXACT, _CITY)
VIEWS["readings_day"] = f"SELECT * FROM readings WHERE CAST(processing_timestamp AS DATE) = DATE '{DAY}'"
VIEWS["cleaned_day"] = _cleaned(_EXACT, _CITY, "readings_day")
VIEWS["latest_day"] = _latest("cleaned_day")
VIEWS["silver_day"] = _scored("latest_day")
VIEWS["latest_exact"] = _latest("cleaned_exact")
VIEWS["silver_exact"] = _scored("latest_exact")
_CAST = "CASE WHEN timestamp IS NULL THEN processing_timestamp ELSE TRY_CAST(timestamp AS TIMESTAMP) END"
VIEWS["cleaned_cast"] = _cleaned(_CAST, "city")
VIEWS["latest_cast"] = _latest("cleaned_cast")
VIEWS["completeness"] = """
SELECT kafka_offset,
       CASE WHEN temperature IS NULL THEN 0.0::DOUBLE WHEN humidity IS NULL OR pressure IS NULL OR wind_speed IS NULL THEN 0.5::DOUBLE
            ELSE 1.0::DOUBLE END AS quality_score,
       temperature IS NOT NULL AND humidity IS NOT NULL AND pressure IS NOT NULL AND wind_speed IS NOT NULL AS is_valid
FROM readings"""


def _strict(source: str) -> str:
    return f"""
SELECT temperature, wind_speed, city, timestamp, humidity, pressure, visibility, processing_timestamp, hour, minute,
       data_source, year, month, day, 1.0::DOUBLE AS quality_score, true AS is_valid,
       kafka_offset, kafka_partition, kafka_timestamp
FROM {source}
WHERE temperature IS NOT NULL AND humidity IS NOT NULL AND pressure IS NOT NULL AND wind_text IS NOT NULL
  AND temperature BETWEEN -90 AND 60 AND humidity BETWEEN 0 AND 100 AND pressure BETWEEN 800 AND 1100
  AND wind_speed >= 0 AND visibility >= 0"""


VIEWS["silver_strict"] = _strict("latest_cast")
# A third of the readings share one processing time.
VIEWS["readings_tied"] = """
SELECT * REPLACE (CASE WHEN kafka_offset % 3 = 0 THEN TIMESTAMP '2024-01-10 12:00:00' ELSE processing_timestamp END AS processing_timestamp)
FROM readings"""
VIEWS["cleaned_tied"] = _cleaned(_CAST, "city", "readings_tied")
VIEWS["latest_tied"] = _latest("cleaned_tied")
VIEWS["strict_tied"] = _strict("latest_tied")

_USABLE = {
    "temperature": "temperature <> 0",
    "humidity": "humidity > 0",
    "pressure": "pressure > 0",
    "wind_speed": "wind_speed >= 0",
    "visibility": "visibility >= 0",
}


def _agg(function: str, metric: str) -> str:
    return f"{function}({metric}) FILTER (WHERE {_USABLE[metric]})"


def _daily(source: str) -> str:
    return f"""
SELECT data_source, year, month, day, city,
       round({_agg('avg', 'temperature')} + 1e-10, 6) AS avg_temperature, {_agg('max', 'temperature')} AS max_temperature,
       {_agg('min', 'temperature')} AS min_temperature, round({_agg('stddev_samp', 'temperature')} + 1e-10, 6) AS temperature_stddev,
       round({_agg('avg', 'humidity')} + 1e-10, 6) AS avg_humidity, {_agg('max', 'humidity')} AS max_humidity,
       {_agg('min', 'humidity')} AS min_humidity,
       round({_agg('avg', 'pressure')} + 1e-10, 6) AS avg_pressure, {_agg('max', 'pressure')} AS max_pressure,
       {_agg('min', 'pressure')} AS min_pressure,
       round({_agg('avg', 'wind_speed')} + 1e-10, 6) AS avg_wind_speed, {_agg('max', 'wind_speed')} AS max_wind_speed,
       round({_agg('avg', 'visibility')} + 1e-10, 6) AS avg_visibility, {_agg('min', 'visibility')} AS min_visibility,
       round(avg(quality_score) + 1e-10, 6) AS avg_quality_score, count(*) AS record_count,
       max(processing_timestamp) AS latest_processing_timestamp, min(processing_timestamp) AS earliest_processing_timestamp
FROM {source} GROUP BY data_source, year, month, day, city"""


def _alerts(source: str) -> str:
    return f"""
SELECT data_source, year, month, day, city,
       CASE WHEN {_agg('max', 'temperature')} > 35 THEN 'HIGH_TEMPERATURE' WHEN {_agg('min', 'temperature')} < -10 THEN 'LOW_TEMPERATURE'
            WHEN {_agg('max', 'wind_speed')} > 20 THEN 'HIGH_WIND' WHEN {_agg('min', 'visibility')} < 1 THEN 'LOW_VISIBILITY'
            WHEN {_agg('avg', 'pressure')} < 950 THEN 'LOW_PRESSURE' ELSE 'NORMAL' END AS weather_alert_type,
       CASE WHEN {_agg('max', 'temperature')} > 40 OR {_agg('min', 'temperature')} < -20 THEN 'SEVERE'
            WHEN {_agg('max', 'temperature')} > 35 OR {_agg('min', 'temperature')} < -10 OR {_agg('max', 'wind_speed')} > 25 THEN 'HIGH'
            WHEN {_agg('max', 'temperature')} > 30 OR {_agg('min', 'temperature')} < -5 OR {_agg('max', 'wind_speed')} > 15 THEN 'MEDIUM'
            ELSE 'LOW' END AS alert_severity
FROM {source} GROUP BY data_source, year, month, day, city"""


def _gold(daily: str, alerts: str) -> str:
    return f"""
SELECT d.*, a.weather_alert_type, a.alert_severity, TIMESTAMP '2030-01-01 00:00:00' AS gold_processing_timestamp
FROM {daily} d LEFT JOIN {alerts} a ON d.data_source = a.data_source AND d.year = a.year AND d.month = a.month
  AND d.day = a.day AND d.city = a.city"""


VIEWS["daily"] = _daily("silver")
VIEWS["alerts"] = _alerts("silver")
VIEWS["gold"] = _gold("daily", "alerts")

VIEWS["cleaned_bronze"] = _cleaned(
    "coalesce(date_trunc('milliseconds', TRY_CAST(timestamp AS TIMESTAMP)), processing_timestamp)", _CITY, "bronze"
)
VIEWS["latest_bronze"] = _latest("cleaned_bronze")
VIEWS["silver_bronze"] = _scored("latest_bronze")
VIEWS["daily_bronze"] = _daily("silver_bronze")
VIEWS["alerts_bronze"] = _alerts("silver_bronze")
VIEWS["gold_from_bronze"] = _gold("daily_bronze", "alerts_bronze")

VIEWS["bars"] = """
SELECT symbol, trading_date, arg_min(price, key) AS open, max(price) AS high, min(price) AS low, arg_max(price, key) AS close,
       sum(l_quantity) AS volume
FROM (SELECT concat('S', l_suppkey % 6) AS symbol, CAST(l_shipdate AS DATE) AS trading_date,
             l_extendedprice / l_quantity AS price, l_quantity,
             row(l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity) AS key FROM lineitem)
GROUP BY symbol, trading_date"""
VIEWS["customer_days"] = """
SELECT concat('S', o_custkey % 6) AS symbol, CAST(o_orderdate AS DATE) AS trading_date, max(o_orderkey) AS m, min(o_orderkey) AS n
FROM orders GROUP BY ALL"""
VIEWS["feed"] = """
SELECT symbol, trading_date,
       CASE WHEN m % 29 = 0 THEN 'n/a' ELSE concat('0.', lpad(CAST(m % 1000 AS VARCHAR), 3, '0')) END AS overall_sentiment_score,
       CASE WHEN m % 3 = 0 THEN 'Bullish' WHEN m % 3 = 1 THEN 'Neutral' ELSE 'Bearish' END AS overall_sentiment_label
FROM customer_days"""
VIEWS["indicators"] = """
SELECT symbol, trading_date, CASE WHEN m % 31 = 0 THEN 'None' ELSE CAST(m % 101 AS VARCHAR) END AS rsi,
       CAST(m % 21 - 10 AS VARCHAR) AS macd, CAST(n % 19 - 9 AS VARCHAR) AS macd_signal,
       CAST(m % 21 - n % 19 - 1 AS VARCHAR) AS macd_hist
FROM customer_days"""


def _full(function: str, column: str, rows: int) -> str:
    w = f"(PARTITION BY symbol ORDER BY trading_date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({column}) OVER {w} = {rows} THEN {function}({column}) OVER {w} END"


_W = "OVER (PARTITION BY symbol ORDER BY trading_date)"
VIEWS["bar_steps"] = f"""
SELECT *, close - lag(close) {_W} AS price_change,
       close / nullif(lag(close) {_W}, 0) - 1 AS daily_return,
       high - low AS high_low_range, {_full('avg', 'close', 20)} AS sma_20, {_full('avg', 'close', 50)} AS sma_50,
       {_full('avg', 'volume', 20)} AS volume_ma,
       close / nullif(lag(close, 5) {_W}, 0) - 1 AS price_momentum,
       volume / nullif(lag(volume, 5) {_W}, 0) - 1 AS volume_momentum
FROM bars"""
VIEWS["bar_features"] = f"""
SELECT *, {_full('stddev_samp', 'daily_return', 20)} AS volatility, volume / nullif(volume_ma, 0) AS volume_ratio,
       CASE WHEN sma_20 > sma_50 THEN 'uptrend' ELSE 'downtrend' END AS trend
FROM bar_steps"""
VIEWS["edges"] = """
SELECT symbol, quantile_cont(volatility, 1::DOUBLE / 3) AS low_edge, quantile_cont(volatility, 2::DOUBLE / 3) AS high_edge
FROM bar_features GROUP BY symbol"""
VIEWS["regimes"] = """
SELECT b.*, CASE WHEN volatility <= low_edge THEN 'low' WHEN volatility <= high_edge THEN 'medium'
                 WHEN volatility IS NOT NULL THEN 'high' END AS volatility_regime
FROM bar_features b JOIN edges USING (symbol)"""
VIEWS["sentiment"] = f"""
SELECT *, {_full('avg', 'sentiment_score', 5)} AS sentiment_ma, sentiment_score - lag(sentiment_score) {_W} AS sentiment_change
FROM (SELECT *, TRY_CAST(overall_sentiment_score AS DOUBLE) AS sentiment_score, overall_sentiment_label AS sentiment_label FROM feed)"""
VIEWS["signals"] = f"""
SELECT *, coalesce(rsi > 70, false) AS rsi_overbought, coalesce(rsi < 30, false) AS rsi_oversold,
       coalesce(macd > macd_signal AND lag(macd) {_W} <= lag(macd_signal) {_W}, false) AS macd_crossover
FROM (SELECT symbol, trading_date, TRY_CAST(rsi AS DOUBLE) AS rsi, TRY_CAST(macd AS DOUBLE) AS macd,
             TRY_CAST(macd_signal AS DOUBLE) AS macd_signal, TRY_CAST(macd_hist AS DOUBLE) AS macd_hist FROM indicators)"""
VIEWS["market"] = """
SELECT * FROM regimes LEFT JOIN sentiment USING (symbol, trading_date) LEFT JOIN signals USING (symbol, trading_date)"""
# One symbol keeps its whole series; those of the others end with each year.
VIEWS["mixed_bars"] = """
SELECT * REPLACE (CASE WHEN symbol = 'S0' THEN symbol ELSE concat(symbol, '-', year(trading_date)) END AS symbol) FROM bars"""
for _name, _source in (("bar_steps", "bars"), ("bar_features", "bar_steps"), ("edges", "bar_features")):
    VIEWS[f"mixed_{_name}"] = VIEWS[_name].replace(f"FROM {_source}", f"FROM mixed_{_source}")
VIEWS["mixed_regimes"] = VIEWS["regimes"].replace("FROM bar_features b JOIN edges", "FROM mixed_bar_features b JOIN mixed_edges")
VIEWS["mixed_market"] = VIEWS["market"].replace("FROM regimes", "FROM mixed_regimes")

VIEWS["listing"] = """
SELECT CASE WHEN event_id % 5 = 0 THEN concat('gold/weather', d, '/part-', event_id, '.parquet')
            WHEN event_id % 5 = 1 THEN concat('gold/market/', event_type, d, '/part-', event_id, '.json')
            WHEN event_id % 5 = 2 THEN concat('raw/dump_', event_id, '.v1.csv')
            WHEN event_id % 5 = 3 THEN concat('raw/notes_', event_id, '.txt')
            ELSE concat('raw/bad name ', event_id, '.csv') END AS path,
       event_id % 1000 + 1 AS size, ts AS modified, event_id, event_type, ts
FROM (SELECT *, concat('/year=', year(ts), '/month=', month(ts), '/day=', day(ts)) AS d FROM events)"""
VIEWS["data_files"] = """
SELECT *, CASE WHEN event_id % 5 = 0 THEN 'weather' WHEN event_id % 5 = 1 THEN concat('market_', event_type)
               ELSE concat('dump_', event_id) END AS dataset_name, event_id % 5 < 2 AS is_partitioned
FROM listing WHERE event_id % 5 < 3"""
VIEWS["part_values"] = """
SELECT dataset_name, partition_key, partition_value, count(*) AS files, CAST(sum(size) AS BIGINT) AS size FROM (
  SELECT dataset_name, size, 'year' AS partition_key, CAST(year(ts) AS VARCHAR) AS partition_value FROM data_files WHERE is_partitioned
  UNION ALL SELECT dataset_name, size, 'month', CAST(month(ts) AS VARCHAR) FROM data_files WHERE is_partitioned
  UNION ALL SELECT dataset_name, size, 'day', CAST(day(ts) AS VARCHAR) FROM data_files WHERE is_partitioned)
GROUP BY ALL"""

VIEWS["forecast_periods"] = """
SELECT user_id % 90 AS latitude, -(event_id % 180) AS longitude, unnest([1, 2]) AS period, user_id FROM events"""


def sql(select: str) -> str:
    """The select with the views it needs, directly or through others, in front of it."""
    needed: set[str] = set()
    for name in reversed(VIEWS):
        text = " ".join([select, *(VIEWS[n] for n in needed)])
        if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
            needed.add(name)
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in needed)
    return f"WITH {views}\n{select}" if views else select


def rounded(*columns: str) -> str:
    """``* REPLACE`` list that rounds columns to six places, and turns negative zero to zero.

    The small shift keeps values that end in a five at the seventh place from rounding apart in the two engines.
    """
    return "* REPLACE (" + ", ".join(f"round({c} + 1e-10, 6) + 0.0::DOUBLE AS {c}" for c in columns) + ")"
