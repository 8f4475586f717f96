"""Market features over bars, news and indicators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import market as M
from ..functions.cleaning import known, parse_money, to_number
from ..session import cut
from .quantiles import exact_quantiles, join_null_safe
from .series import FILLED, ROWS_PER_TASK, over_series, rolling, split_hot, which_series

PRICES = ("open", "high", "low", "close", "volume")
# Rows before a row that its features read: the long mean, and the return before the first one of the volatility.
LOOKBACK = max(C.SMA_LONG_ROWS, C.VOLATILITY_ROWS + 1, C.MOMENTUM_ROWS)


def numeric_bars(bars: DataFrame) -> DataFrame:
    """Text prices to numbers; in columns of floating numbers not-a-number becomes null; others stay as they are."""
    kinds = dict(bars.dtypes)
    read = {c: parse_money(c) for c in PRICES if kinds.get(c) == "string"}
    read |= {c: known(c) for c in PRICES if kinds.get(c) in ("double", "float")}
    return bars.withColumns(read) if read else bars


def bar_features(bars: DataFrame, ts: str = "ts", rows_per_task: int = ROWS_PER_TASK, long: bool | DataFrame | None = None) -> DataFrame:
    """Changes, returns, volatility, moving means, volume ratio, momentum and trend per symbol.

    All features share one window, so a symbol is shuffled and sorted once.
    """

    def build(df: DataFrame, w) -> DataFrame:
        close, volume = FILLED + "close", FILLED + "volume"
        changed = df.withColumns(
            {
                "price_change": M.diff("close", w),
                "daily_return": M.pct_change(close, 1, w),
                "high_low_range": M.high_low_range(),
                "price_momentum": M.pct_change(close, C.MOMENTUM_ROWS, w),
                "volume_momentum": M.pct_change(volume, C.MOMENTUM_ROWS, w),
            }
        )
        means = {
            "sma_20": ("close", C.SMA_SHORT_ROWS),
            "sma_50": ("close", C.SMA_LONG_ROWS),
            "volume_ma": ("volume", C.VOLUME_ROWS),
        }
        rolled = rolling(changed, w, means, {"volatility": ("daily_return", C.VOLATILITY_ROWS)})
        ratio = F.try_divide(F.col("volume"), F.col("volume_ma"))
        return rolled.withColumns({"volume_ratio": ratio, "trend": M.trend()})

    return over_series(
        numeric_bars(bars), ["symbol"], [ts], build, lookback=LOOKBACK, fill=("close", "volume"), rows_per_task=rows_per_task, long=long
    )


def sentiment_features(feed: DataFrame, ts: str = "ts", rows_per_task: int = ROWS_PER_TASK, long: bool | DataFrame | None = None) -> DataFrame:
    scored = feed.withColumns(
        {
            "sentiment_score": to_number("overall_sentiment_score"),
            "sentiment_label": F.col("overall_sentiment_label"),
        }
    )

    def build(df: DataFrame, w) -> DataFrame:
        return df.withColumns(
            {
                "sentiment_ma": M.rolling_mean("sentiment_score", C.SENTIMENT_ROWS, w),
                "sentiment_change": M.diff("sentiment_score", w),
            }
        )

    order = [ts, "overall_sentiment_score", "overall_sentiment_label"]
    return over_series(scored, ["symbol"], order, build, lookback=C.SENTIMENT_ROWS, rows_per_task=rows_per_task, long=long)


def indicator_features(indicators: DataFrame, ts: str = "ts", rows_per_task: int = ROWS_PER_TASK, long: bool | DataFrame | None = None) -> DataFrame:
    numbers = indicators.withColumns({c: to_number(c) for c in ("rsi", "macd", "macd_signal", "macd_hist")})

    def build(df: DataFrame, w) -> DataFrame:
        return df.withColumns({**M.rsi_signals(), "macd_crossover": M.crossover("macd", "macd_signal", w)})

    return over_series(numbers, ["symbol"], [ts], build, lookback=1, rows_per_task=rows_per_task, long=long)


def combine_features(bars: DataFrame, sentiment: DataFrame | None, indicators: DataFrame | None, ts: str = "ts") -> DataFrame:
    """News and indicators left-joined onto bars by symbol and time; a missing side adds no columns."""
    out = bars
    for side in (sentiment, indicators):
        if side is not None:
            out = out.join(side, ["symbol", ts], "left")
    return out


def volatility_regime(
    df: DataFrame,
    value: str = "volatility",
    keys: tuple[str, ...] = ("symbol",),
    long: bool | DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``volatility_regime``: thirds of the values of each symbol, with exact edges.

    Not-a-number counts as missing, and the column says null for it. Short symbols get their edges from one window.
    Long ones are written once to the shared folder, and their edges, one row per symbol, are found by
    counting and joined back: broadcast where they are small, else with hot symbols split at run time. ``long`` is
    that of :func:`varve.operators.series.over_series`.
    """
    long = which_series(df, keys, rows_per_task, long)
    if isinstance(long, DataFrame):
        hot, rest = split_hot(df, long, keys)
        return volatility_regime(rest, value, keys, False).unionByName(volatility_regime(hot, value, keys, True))
    if df.schema[value].dataType.typeName() in ("double", "float"):
        df = df.withColumn(value, known(value))
    thirds = (1.0 / 3.0, 2.0 / 3.0)
    if not long:
        edges = F.percentile(F.col(value), F.array(*[F.lit(p) for p in thirds])).over(Window.partitionBy(*keys))
        marked = df.withColumn("__edges", edges)
        low, high = F.col("__edges")[0], F.col("__edges")[1]
        return marked.withColumn("volatility_regime", M.regime(value, low, high)).drop("__edges")
    kept = cut(df)
    edges = exact_quantiles(kept, list(keys), value, thirds)
    joined = join_null_safe(kept, edges, list(keys))
    return joined.withColumn("volatility_regime", M.regime(value, F.col("q0"), F.col("q1"))).drop("q0", "q1")


def market_features(
    bars: DataFrame,
    feed: DataFrame | None = None,
    indicators: DataFrame | None = None,
    ts: str = "ts",
    rows_per_task: int = ROWS_PER_TASK,
    long: bool | DataFrame | None = None,
) -> DataFrame:
    """The whole feature table: bars with their features, regime, news and indicators.

    Regimes are taken over the bars, before news join in, so several articles at one time do not weigh a bar twice.
    ``long`` is that of :func:`varve.operators.series.over_series`, for the bars. Left out, long symbols of each input are
    told by one count, and the bars' serve features and regimes both; small inputs start no job. With long symbols the
    two kinds of bars go their ways as a whole, and are united at the end.
    """
    side = {"ts": ts, "rows_per_task": rows_per_task, "long": True if long is True else None}
    long = which_series(bars, ["symbol"], rows_per_task, long)

    def price(rows: DataFrame, long: bool) -> DataFrame:
        return volatility_regime(bar_features(rows, ts, rows_per_task, long), long=long)

    if isinstance(long, DataFrame):
        hot, rest = split_hot(bars, long, ["symbol"])
        priced = price(rest, False).unionByName(price(hot, True))
    else:
        priced = price(bars, long)
    return combine_features(
        priced,
        sentiment_features(feed, **side) if feed is not None else None,
        indicator_features(indicators, **side) if indicators is not None else None,
        ts,
    )


def with_moving_average(df: DataFrame, column: str, rows: int, ts: str = "trading_date", name: str | None = None, **kw) -> DataFrame:
    """Mean over this and the ``rows - 1`` bars before, shorter windows included."""
    name = name or f"{column}_ma_{rows}"
    return over_series(
        df, ["symbol"], [ts], lambda d, w: d.withColumn(name, M.moving_average(column, rows, w)), lookback=rows, **kw
    )


def date_gaps(bars: DataFrame, max_days: int = C.GAP_DAYS, date: str = "trading_date") -> DataFrame:
    """Gaps of more than ``max_days`` after a weekday.

    Repeated dates have no gap between them, so dates are made distinct first (before the shuffle); what a task then
    sorts per symbol is bounded by the calendar.
    """
    days = bars.select("symbol", F.col(date).cast("date").alias(date)).where(F.col(date).isNotNull()).distinct()
    w = Window.partitionBy("symbol").orderBy(date)
    gaps = days.withColumn("next_date", F.lead(date).over(w))
    gaps = gaps.withColumn("days_difference", F.datediff("next_date", date))
    return gaps.where((F.col("days_difference") > max_days) & F.dayofweek(date).between(2, 6))


def stale_symbols(bars: DataFrame, as_of: Column | None = None, date: str = "trading_date") -> DataFrame:
    """Symbols with no bar on the day before ``as_of`` or later; none before nine in the morning, Eastern standard time."""
    now = F.current_timestamp() if as_of is None else as_of
    clock = F.convert_timezone(F.current_timezone(), F.lit(C.FRESHNESS_ZONE), now.cast("timestamp_ntz"))
    last = bars.groupBy("symbol").agg(F.max(F.col(date).cast("date")).alias("last_trading_date"))
    late = F.col("last_trading_date") < F.date_sub(now.cast("date"), 1)
    return last.where(late & (F.hour(clock) >= C.FRESHNESS_HOUR))


def violation_counts(bars: DataFrame) -> DataFrame:
    returns, limit = F.col("daily_return"), C.RETURN_LIMIT
    return bars.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if((returns < -limit) | (returns > limit)).alias("extreme_returns"),
        F.count_if(F.col("volatility") > C.VOLATILITY_LIMIT).alias("high_volatility"),
        F.count_if(F.col("close") <= 0).alias("invalid_prices"),
    )


def _since(date: str, since: str | dt.date) -> Column:
    day = dt.date.fromisoformat(since) if isinstance(since, str) else since
    return F.col(date) >= F.lit(day)


def price_anomalies(df: DataFrame, since: str | dt.date, percent: float = C.ANOMALY_PERCENT, date: str = "date", change: str = "price_change_pct") -> DataFrame:
    """Rows from ``since`` on whose change exceeds ``percent`` either way."""
    return df.where(_since(date, since) & (F.abs(F.col(change)) > percent))


def avg_quality_by_symbol(df: DataFrame, since: str | dt.date, date: str = "date", score: str = "data_quality_score") -> DataFrame:
    return (
        df.where(_since(date, since))
        .groupBy("symbol")
        .agg(F.avg(score).alias("avg_quality_score"), F.count(F.lit(1)).alias("record_count"))
    )
