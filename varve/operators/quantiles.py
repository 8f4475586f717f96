"""Exact quantiles per group, with no group held whole by one task.

Values are counted per group and cell of a logarithmic grid; the counts tell in which cell each wanted rank lies. The
same is done once more with equal parts of those cells, and only the distinct values of the parts hit are ranked. The
grid only sets how much is ranked, so the result is exact whatever the data look like: a part spans less than 1e-8
of its values, which bounds the distinct numbers in it by the precision of a double.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRID = 1e-2
PARTS = 1 << 20
TOP = 1 << 40  # cell of infinity, beyond that of any number


def _cell(value: Column) -> Column:
    """Cell number; does not decrease with the value. Zero has its own cell between the negative and positive ones."""
    shift = 800.0
    size = F.floor((F.log(F.abs(value)) + shift) / math.log1p(GRID)) + 1
    endless = F.when(value > 0, F.lit(TOP)).otherwise(F.lit(-TOP))
    finite = F.when(value == 0, F.lit(0)).when(value > 0, size).otherwise(-size)
    return F.when(F.abs(value) == float("inf"), endless).otherwise(finite).cast("bigint")


def _part(value: Column, low: Column, high: Column) -> Column:
    """Part of the cell from ``low`` to ``high``; does not decrease with the value."""
    share = F.when(low < high, F.try_divide(value - low, high - low))
    return F.coalesce(F.floor(share * PARTS), F.lit(0)).cast("bigint")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """One row per group that has values: ``keys`` and ``q0, q1, …``, linearly interpolated between ranks.

    Nulls and not-a-number are left out; infinities are values. Reads the keys and the value of ``df`` a few times; cut
    it first when it is costly.
    """
    spots = [(F.col("__total") - 1) * F.lit(float(p)) for p in probs]
    ranks = [r for s in spots for r in (F.floor(s), F.ceil(s))]

    def holds_rank(first: Column, rows: Column) -> Column:
        hit = F.lit(False)
        for r in ranks:
            hit = hit | ((r >= first) & (r < first + rows))
        return hit

    def before(*by: str, order: str) -> Column:
        earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("__rows").over(earlier), F.lit(0))

    def keep_hit(rows: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
        """Rows whose cell is wanted, with the columns of the cell."""
        return join_null_safe(rows, wanted, by, "inner")

    v = F.col(value).cast("double")
    values = df.select(*keys, v.alias("__v")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    values = values.withColumn("__cell", _cell(F.col("__v")))

    cells = values.groupBy(*keys, "__cell").agg(
        F.count(F.lit(1)).alias("__rows"), F.min("__v").alias("__low"), F.max("__v").alias("__high")
    )
    cells = cells.withColumns(
        {"__before": before(*keys, order="__cell"), "__total": F.sum("__rows").over(Window.partitionBy(*keys))}
    )
    cells = cells.where(holds_rank(F.col("__before"), F.col("__rows"))).drop("__rows")

    by_cell, by_part = [*keys, "__cell"], [*keys, "__cell", "__part"]
    inside = keep_hit(values, cells, by_cell).withColumn("__part", _part(F.col("__v"), F.col("__low"), F.col("__high")))
    parts = inside.groupBy(*by_part).agg(
        F.count(F.lit(1)).alias("__rows"), F.first("__before").alias("__before"), F.first("__total").alias("__total")
    )
    parts = parts.withColumn("__before", F.col("__before") + before(*by_cell, order="__part"))
    parts = parts.where(holds_rank(F.col("__before"), F.col("__rows"))).drop("__rows")

    distinct = inside.groupBy(*by_part, "__v").agg(F.count(F.lit(1)).alias("__rows"))
    ranked = keep_hit(distinct, parts, by_part).withColumn("__first", F.col("__before") + before(*by_part, order="__v"))
    at = [
        F.max(F.when((r >= F.col("__first")) & (r < F.col("__first") + F.col("__rows")), F.col("__v"))).alias(f"__at{i}")
        for i, r in enumerate(ranks)
    ]
    found = ranked.groupBy(*keys).agg(F.first("__total").alias("__total"), *at)
    out = []
    for i, s in enumerate(spots):
        low, high = F.col(f"__at{2 * i}"), F.col(f"__at{2 * i + 1}")
        between = (F.ceil(s) - s) * low + (s - F.floor(s)) * high
        out.append(F.when(low == high, low).otherwise(between).alias(f"q{i}"))
    return found.select(*keys, *out)


def join_null_safe(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``small``, one row per key, onto ``df``; null keys are equal to each other.

    Whether ``small`` is broadcast is left to its size; beyond that, adaptive execution splits hot keys.
    """
    right = small.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & df[k].eqNullSafe(right[f"__r_{k}"])
    return df.join(right, condition, how).drop(*[f"__r_{k}" for k in keys])
