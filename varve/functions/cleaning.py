"""Cleaning, range, scoring and date columns for readings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from .rules import all_of, first_match, holds

ColumnLike = str | Column


def _col(column: ColumnLike) -> Column:
    return F.col(column) if isinstance(column, str) else column


def known(column: ColumnLike) -> Column:
    """The number, or null where it is not a number."""
    column = _col(column)
    return F.when(~F.isnan(column), column)


def to_number(column: ColumnLike) -> Column:
    """Number in a text, or null; a text that says not-a-number has none."""
    return known(_col(column).try_cast("double"))


def parse_money(column: ColumnLike) -> Column:
    """Number in a text that may carry dollar signs and thousands commas, or null."""
    return to_number(F.regexp_replace(_col(column).cast("string"), "[$,]", ""))


def clean_wind_speed(column: ColumnLike, mode: str = "all") -> Column:
    """Wind speed as a number; a missing text is calm (0.0), an unreadable one is null.

    ``all`` keeps every digit and dot of the text (so a span like ``10 to 15 mph`` reads 1015 and is later out of
    range), ``first`` takes the first number, ``mean`` the mean of all numbers.
    """
    text = _col(column)
    if mode == "all":
        number = to_number(F.regexp_replace(text, "[^0-9.]", ""))
    elif mode == "first":
        number = to_number(F.regexp_extract(text, r"(\d+(?:\.\d+)?)", 1))
    elif mode == "mean":
        found = F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1))
        total = F.aggregate(found, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
        number = F.try_divide(total, F.size(found))
    else:
        raise ValueError(f"unknown wind speed mode: {mode}")
    return F.when(text.isNull(), F.lit(0.0)).otherwise(number)


_SECONDS = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
_WHOLE_SECONDS = rf"\A{_SECONDS}\z"
_TIME = rf"\A{_SECONDS}(\.\d{{3}}(\d{{3}})?)?(Z|[+-]\d{{2}}:\d{{2}})?\z"


def clean_timestamp(column: ColumnLike, fallback: ColumnLike) -> Column:
    """Reading time from its text, with milliseconds kept; texts with no time in them give ``fallback``.

    A text may end in a zone offset. One that looks like a time but cannot be read gives null. The pattern fixes the
    form, so that the cast, which is much faster than parsing by format, accepts no other.
    """
    text, fallback = _col(column), _col(fallback)
    read = F.date_trunc("millisecond", text.try_cast("timestamp"))
    return F.when(text.rlike(_TIME), read).when(text.isNull() | ~text.rlike(_SECONDS), fallback)


def clean_timestamp_strict(column: ColumnLike, fallback: ColumnLike, exact: bool = True) -> Column:
    """``exact``: whole seconds only; else any text that casts to a time. Unreadable texts give null."""
    text, fallback = _col(column), _col(fallback)
    read = text.try_cast("timestamp")
    return F.when(text.isNull(), fallback).when(text.rlike(_WHOLE_SECONDS) if exact else F.lit(True), read)


def clean_city(column: ColumnLike) -> Column:
    return F.coalesce(F.trim(F.upper(_col(column))), F.lit(C.UNKNOWN_CITY))


def in_range(column: ColumnLike, low: float, high: float) -> Column:
    return F.coalesce(_col(column).between(low, high), F.lit(False))


def range_flags(bounds: Mapping[str, tuple[float, float]] | None = None, metrics: Iterable[str] = C.SCORED_METRICS) -> dict[str, Column]:
    """``<metric>_valid`` per metric, for ``df.withColumns``."""
    bounds = bounds or C.VALID_RANGES
    return {f"{metric}_valid": in_range(metric, *bounds[metric]) for metric in metrics}


def quality_score(flags: Iterable[Column]) -> Column:
    """Share of the flags that are true."""
    flags = list(flags)
    return sum((f.cast("double") for f in flags[1:]), flags[0].cast("double")) / F.lit(float(len(flags)))


def is_valid(flags: Iterable[Column]) -> Column:
    return all_of(flags)


def weather_category() -> Column:
    return first_match(
        ((holds(column, how, level), label) for label, column, how, level in C.CATEGORY_RULES),
        C.DEFAULT_CATEGORY,
    )


def freshness_hours(processed: ColumnLike, read: ColumnLike) -> Column:
    return (F.unix_timestamp(_col(processed)) - F.unix_timestamp(_col(read))) / F.lit(3600)


def date_parts(column: ColumnLike) -> dict[str, Column]:
    column = _col(column)
    return {"year": F.year(column), "month": F.month(column), "day": F.dayofmonth(column)}


def completeness_score() -> Column:
    """0 with no temperature, 0.5 with any other required metric missing, else 1."""
    first, *rest = C.REQUIRED_METRICS
    missing = [(F.col(first).isNull(), 0.0)] + [(F.col(m).isNull(), 0.5) for m in rest]
    return first_match(missing, 1.0)


def completeness_flag() -> Column:
    return all_of(F.col(m).isNotNull() for m in C.REQUIRED_METRICS)


def usable(metric: str, rules: Mapping[str, str] = C.USABLE_RULES) -> Column:
    """The metric where it may enter an aggregate, else null."""
    column = F.col(metric)
    keep = {"nonzero": column != 0, "positive": column > 0, "nonnegative": column >= 0}[rules[metric]]
    return F.when(keep, column)
