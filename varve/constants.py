"""Ranges, thresholds, names and formats that results must agree with."""

from __future__ import annotations

# Inclusive valid range of each metric.
VALID_RANGES = {
    "temperature": (-90.0, 60.0),
    "precipitation": (0.0, 1000.0),
    "wind_speed": (0.0, 100.0),
    "humidity": (0.0, 100.0),
    "pressure": (800.0, 1100.0),
    "visibility": (0.0, 50.0),
}

# The metrics that make up the quality score.
SCORED_METRICS = ("temperature", "humidity", "pressure", "wind_speed", "visibility")

# The metrics that must be present for a reading to count as complete.
REQUIRED_METRICS = ("temperature", "humidity", "pressure", "wind_speed")

# Weather categories, first match wins, with the last as default.
CATEGORY_RULES = (
    ("HOT", "temperature", ">", 30),
    ("COLD", "temperature", "<", 0),
    ("WINDY", "wind_speed", ">", 15),
    ("FOGGY", "visibility", "<", 5),
)
DEFAULT_CATEGORY = "NORMAL"
CATEGORIES = ("HOT", "COLD", "WINDY", "FOGGY", "NORMAL")

# Alert types over the daily aggregates, first match wins.
ALERT_TYPE_RULES = (
    ("HIGH_TEMPERATURE", "max_temperature", ">", 35),
    ("LOW_TEMPERATURE", "min_temperature", "<", -10),
    ("HIGH_WIND", "max_wind_speed", ">", 20),
    ("LOW_VISIBILITY", "min_visibility", "<", 1),
    ("LOW_PRESSURE", "avg_pressure", "<", 950),
)
DEFAULT_ALERT_TYPE = "NORMAL"

# Severity levels, first level with any true condition wins.
ALERT_SEVERITY_RULES = (
    ("SEVERE", (("max_temperature", ">", 40), ("min_temperature", "<", -20))),
    ("HIGH", (("max_temperature", ">", 35), ("min_temperature", "<", -10), ("max_wind_speed", ">", 25))),
    ("MEDIUM", (("max_temperature", ">", 30), ("min_temperature", "<", -5), ("max_wind_speed", ">", 15))),
)
DEFAULT_SEVERITY = "LOW"

# Which readings of a metric count inside an aggregate.
USABLE_RULES = {
    "temperature": "nonzero",
    "humidity": "positive",
    "pressure": "positive",
    "wind_speed": "nonnegative",
    "visibility": "nonnegative",
}

# The aggregates each metric gets in the daily table, in column order.
DAILY_AGGREGATES = (
    ("temperature", ("avg", "max", "min", "stddev")),
    ("humidity", ("avg", "max", "min")),
    ("pressure", ("avg", "max", "min")),
    ("wind_speed", ("avg", "max")),
    ("visibility", ("avg", "min")),
)

# Key columns.
DAILY_KEYS = ("data_source", "year", "month", "day", "city")
HOURLY_KEYS = ("data_source", "year", "month", "day", "hour", "city")
DEDUP_KEYS = ("temperature", "wind_speed", "city", "timestamp", "data_source")
DATE_PARTS = ("year", "month", "day")

# Text written for a missing city.
UNKNOWN_CITY = "UNKNOWN"

# Topics, source names and accepted values.
WEATHER_TOPIC = "weather-forecast"
WEATHER_SOURCE = "noaa"
MARKET_SOURCE = "alphavantage"
GOLD_SOURCES = ("noaa", "alphavantage", "eosdis", "openweather")
SILVER_SOURCES = ("noaa",)

# Stream and producer settings.
TRIGGER_INTERVAL = "30 seconds"
BOUNDED_RUN_SECONDS = 3300
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.compression.type": "snappy",
}

# Paging and reading bounds.
MAX_PAGE_ROWS = 10_000
MAX_PAGE_SKIP = 100_000
SAMPLE_ROWS = 10_000

# Allow-lists for names, and their longest length.
SAFE_NAMES = {
    "file_name": r"^[a-zA-Z0-9_\-\.]+$",
    "dataset_name": r"^[a-zA-Z0-9_\-]+$",
    "column_name": r"^[a-zA-Z_][a-zA-Z0-9_]*$",
}
SAFE_NAME_LENGTH = 100
DATA_EXTENSIONS = ("csv", "json", "parquet")
UNNAMED_PATH_PARTS = ("", "gold", "processed")
UNNAMED_DATASET = "partitioned_data"

# Market feature windows and signal levels.
VOLATILITY_ROWS = 20
SMA_SHORT_ROWS = 20
SMA_LONG_ROWS = 50
VOLUME_ROWS = 20
SENTIMENT_ROWS = 5
MOMENTUM_ROWS = 5
RSI_OVERBOUGHT = 70
RSI_OVERSOLD = 30
REGIME_LABELS = ("low", "medium", "high")
RETURN_LIMIT = 0.5
VOLATILITY_LIMIT = 1.0
ANOMALY_PERCENT = 5
GAP_DAYS = 3
FRESHNESS_HOUR = 9
FRESHNESS_ZONE = "-05:00"
MARKET_ZONE = "America/New_York"
MARKET_OPEN = "09:30:00"
MARKET_CLOSE = "16:00:00"

# Suite bounds and pass rates.
LEAST_ROWS = 1
YEAR_BOUNDS = (2020, 2030)
MONTH_BOUNDS = (1, 12)
DAY_BOUNDS = (1, 31)
AVG_TEMPERATURE_BOUNDS = (-100, 100)
LEAST_RECORDS = 1
FRESHNESS_HOUR_BOUNDS = (0, 168)
MOSTLY = 0.8
GOLD_PASS_PERCENT = 80
SILVER_PASS_PERCENT = 100
