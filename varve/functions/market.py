"""Market columns: row predicates and features that need no neighbours."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from .. import constants as C


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _seconds(clock: str) -> int:
    hours, minutes, seconds = map(int, clock.split(":"))
    return hours * 3600 + minutes * 60 + seconds


def market_hours(ts: str | Column, zone: str = "UTC") -> Column:
    """True on weekdays from open to close (both included) in the market's own zone."""
    local = F.convert_timezone(F.lit(zone), F.lit(C.MARKET_ZONE), _col(ts).cast("timestamp_ntz"))
    # Fields of a zoneless time do not depend on the session's zone.
    seconds = F.hour(local) * 3600 + F.minute(local) * 60 + F.date_part(F.lit("SECOND"), local)
    return (F.weekday(local) < 5) & seconds.between(_seconds(C.MARKET_OPEN), _seconds(C.MARKET_CLOSE))


def high_low_range() -> Column:
    return F.col("high") - F.col("low")


def rsi_signals(rsi: str = "rsi") -> dict[str, Column]:
    value = F.col(rsi)
    return {
        "rsi_overbought": F.coalesce(value > C.RSI_OVERBOUGHT, F.lit(False)),
        "rsi_oversold": F.coalesce(value < C.RSI_OVERSOLD, F.lit(False)),
    }


def trend() -> Column:
    return F.when(F.col("sma_20") > F.col("sma_50"), "uptrend").otherwise("downtrend")


def regime(value: str | Column, low: Column, high: Column) -> Column:
    """Label by two edges, each belonging to the lower side; null stays null."""
    value = _col(value)
    names = C.REGIME_LABELS
    return F.when(value <= low, names[0]).when(value <= high, names[1]).when(value.isNotNull(), names[2])


# Window columns. ``w`` is partitioned by series and ordered by time, with no frame.


def moving_average(column: str, rows: int, w: WindowSpec) -> Column:
    """Mean of this row and the ``rows - 1`` before it; shorter windows count too."""
    return F.avg(column).over(w.rowsBetween(1 - rows, 0))


def _when_full(column: str | Column, rows: int, w: WindowSpec, value: Column) -> Column:
    return F.when(F.count(column).over(w.rowsBetween(1 - rows, 0)) == rows, value)


def rolling_mean(column: str, rows: int, w: WindowSpec) -> Column:
    """Mean over a full window of known values, else null."""
    return _when_full(column, rows, w, F.avg(column).over(w.rowsBetween(1 - rows, 0)))


def rolling_std(column: str, rows: int, w: WindowSpec) -> Column:
    return _when_full(column, rows, w, F.stddev_samp(column).over(w.rowsBetween(1 - rows, 0)))


def diff(column: str, w: WindowSpec) -> Column:
    return F.col(column) - F.lag(column, 1).over(w)


def pct_change(filled: str, rows: int, w: WindowSpec) -> Column:
    """Relative change against ``rows`` rows before. ``filled`` is forward-filled; a zero base gives null."""
    return F.try_divide(F.col(filled), F.lag(filled, rows).over(w)) - F.lit(1.0)


def crossover(fast: str, slow: str, w: WindowSpec) -> Column:
    """True where ``fast`` is above ``slow`` now and was not on the row before."""
    before = F.lag(fast, 1).over(w) <= F.lag(slow, 1).over(w)
    return F.coalesce((F.col(fast) > F.col(slow)) & before, F.lit(False))
