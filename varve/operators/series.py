"""Window work over ordered series, also where one series holds a large share of all rows.

A plain window puts a whole series into one task. Series that are larger than a task should hold, and only these, are
cut into chunks of equal length instead. The cut is exact: every row gets its position in its series from
row counts per time bucket plus its position inside its bucket, and each chunk also gets the few rows before (and
after) it that its windows look at. Buckets get finer where one of them holds too many rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut

ROWS_PER_TASK = 1_000_000
FILLED = "__filled_"
POSITION = "__position"
_GROUP, _CHUNK, _HALO = "__group", "__chunk", "__halo"


BYTES_PER_ROW = 64
BROADCAST_KEYS = 100_000


def is_long(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> bool:
    """Whether a series may have more rows than a task should hold, by the optimizer's estimate of the whole input.

    An estimate that is too large only costs the count of :func:`hot_series`. No job is started.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) > rows_per_task * BYTES_PER_ROW


def hot_series(df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """The keys of the series with more than ``rows_per_task`` rows, or None where there are none.

    One count that reads the key columns only and shrinks to a row per key and task before its shuffle. The keys found
    are at most as many as tasks could be filled, and are written down once.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    hot = cut(counts.where(F.col("__rows") > rows_per_task).select(*keys))
    return None if hot.isEmpty() else hot


def split_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of the series in ``hot``, and those of all others; null keys are equal to each other.

    Up to ``BROADCAST_KEYS`` keys, which are counted first, go to every task, so that no row is shuffled for the split.
    """
    side = hot.select(F.struct(*keys).alias("__hot")).distinct()
    if hot.count() <= BROADCAST_KEYS:
        side = F.broadcast(side)
    same = F.struct(*[df[k] for k in keys]) == F.col("__hot")
    return df.join(side, same, "left_semi"), df.join(side, same, "left_anti")


def which_series(df: DataFrame, keys: Sequence[str], rows_per_task: int, long: bool | DataFrame | None) -> bool | DataFrame:
    """What ``long`` of :func:`over_series` comes to: True for all series, False for none, or the keys of the hot ones."""
    if long is not None:
        return long
    hot = hot_series(df, keys, rows_per_task) if is_long(df, rows_per_task) else None
    return False if hot is None else hot


def _ladder(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """Ever finer buckets along the order. The last one splits rows that share all order values by their partition."""
    kind = df.schema[order[0]].dataType
    time = F.col(order[0])
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        steps = [F.date_trunc("hour", time), F.date_trunc("second", time)]
    else:
        steps = [time]
    return [*steps, F.struct(*order, F.spark_partition_id().alias("__part"))]


def _largest(df: DataFrame, keys: Sequence[str], levels: Sequence[Column]) -> int:
    rows = df.select(F.struct(*keys, *[c.alias(f"__l{i}") for i, c in enumerate(levels)]).alias("__g"))
    return rows.groupBy("__g").count().agg(F.max("count")).first()[0] or 0


def position_levels(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, list[Column]]:
    """The coarsest buckets that a task can sort, by a count at each step, and the frame to use them on.

    Hours do for most series, seconds for dense ones. Only where copies of one order value are too many for a task are
    they told apart by partition, and the frame is then written out first so that its partitions stay as they are.
    """
    ladder = _ladder(df, order)
    for depth in range(1, len(ladder)):
        if _largest(df, keys, ladder[:depth]) <= rows_per_task:
            return df, ladder[:depth]
    return cut(df), ladder


def _starts(counts: DataFrame, keys: Sequence[str], buckets: Sequence[str], fill: Sequence[str]) -> DataFrame:
    """Per bucket: rows of the series before it, and the last known values before it.

    Sums run within the parent bucket only, so a task holds the children of one parent.
    """
    *parents, own = buckets
    outer = [*keys, *parents]
    earlier = Window.partitionBy(*outer).orderBy(own).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns(
        {
            "__before": F.coalesce(F.sum("__rows").over(earlier), F.lit(0)),
            **{f"__carry_{c}": F.last(f"__last_{c}", ignorenulls=True).over(earlier) for c in fill},
        }
    )
    if not parents:
        return counts
    above = counts.groupBy(*outer).agg(
        F.sum("__rows").alias("__rows"),
        *[F.max_by(f"__last_{c}", F.when(F.col(f"__last_{c}").isNotNull(), F.col(own))).alias(f"__last_{c}") for c in fill],
    )
    above = _starts(above, keys, parents, fill).select(
        F.struct(*outer).alias("__outer"),
        F.col("__before").alias("__before_above"),
        *[F.col(f"__carry_{c}").alias(f"__above_{c}") for c in fill],
    )
    joined = counts.withColumn("__outer", F.struct(*outer)).join(above, "__outer", "left")
    return joined.withColumns(
        {
            "__before": F.col("__before") + F.col("__before_above"),
            **{f"__carry_{c}": F.coalesce(f"__carry_{c}", f"__above_{c}") for c in fill},
        }
    )


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    levels: Sequence[Column],
    fill: Sequence[str] = (),
) -> DataFrame:
    """Add the exact position (from 1) of each row in its series as ``__position``.

    ``levels`` are buckets from coarse to fine, each not decreasing along the order; the finest bounds what one task
    sorts. For each column in ``fill`` a forward-filled ``__filled_<column>`` is added: the last known value at or
    before the row. Rows that share all order values may come in any order among themselves.
    """
    order_struct = F.struct(*order)
    names = [f"__level{i}" for i in range(len(levels))]
    # One struct as key: it is never null itself, and null fields in it are equal to each other.
    grouped = df.withColumn(_GROUP, F.struct(*keys, *[c.alias(n) for c, n in zip(levels, names)]))

    last_known = [
        F.max_by(c, F.when(F.col(c).isNotNull(), order_struct)).alias(f"__last_{c}") for c in fill
    ]
    counts = grouped.groupBy(_GROUP).agg(F.count(F.lit(1)).alias("__rows"), *last_known).select(f"{_GROUP}.*", "*")
    starts = _starts(counts, keys, names, fill).select(_GROUP, "__before", *[f"__carry_{c}" for c in fill])

    # The join and the window share one key, hence one shuffle.
    inside = Window.partitionBy(_GROUP).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    return grouped.join(starts, _GROUP, "left").select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("__before") + F.row_number().over(inside)).alias(POSITION),
        *[
            F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.col(f"__carry_{c}")).alias(FILLED + c)
            for c in fill
        ],
    )


def over_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    lookback: int = 0,
    lookahead: int = 0,
    fill: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
    long: bool | DataFrame | None = None,
) -> DataFrame:
    """Run ``build(df, w)``, whose windows over ``w`` reach at most ``lookback`` rows back and ``lookahead`` on.

    ``long`` says which series exceed ``rows_per_task`` and are cut: all (True), none (False), or those of a table of
    keys. Left out, none are while the input's estimated size is small; beyond that they are counted. Series that are
    not cut run through plain windows. ``fill`` columns are at hand inside ``build`` as ``__filled_<column>`` and are
    dropped afterwards.
    """
    if rows_per_task < max(lookback, lookahead, 1):
        raise ValueError("rows_per_task must cover the look-back and look-ahead")
    long = which_series(df, keys, rows_per_task, long)
    if isinstance(long, DataFrame):
        hot, rest = split_hot(df, long, keys)
        more = (keys, order, build, lookback, lookahead, fill, rows_per_task)
        return over_series(rest, *more, long=False).unionByName(over_series(hot, *more, long=True))
    helpers = [FILLED + c for c in fill]

    if not long:
        w = Window.partitionBy(*keys).orderBy(*order)
        so_far = w.rowsBetween(Window.unboundedPreceding, 0)
        filled = {FILLED + c: F.last(c, ignorenulls=True).over(so_far) for c in fill}
        return build(df.withColumns(filled) if filled else df, w).drop(*helpers)

    df, levels = position_levels(df, keys, order, rows_per_task)
    ranked = with_position(df, keys, order, levels, fill)
    index = F.col(POSITION) - 1
    own = F.floor(index / rows_per_task)
    offset = F.pmod(index, F.lit(rows_per_task))
    copies = F.array_compact(
        F.array(
            own,
            F.when(offset >= rows_per_task - lookback, own + 1),
            F.when((offset < lookahead) & (own > 0), own - 1),
        )
    )
    chunked = ranked.withColumn("__own", own).withColumn(_CHUNK, F.explode(copies))
    chunked = chunked.withColumn(_HALO, F.col(_CHUNK) != F.col("__own"))
    out = build(chunked, Window.partitionBy(*keys, _CHUNK).orderBy(POSITION))
    return out.where(~F.col(_HALO)).drop(POSITION, _CHUNK, _HALO, "__own", *helpers)


BLOCK = 5


def rolling(df: DataFrame, w: WindowSpec, means: dict[str, tuple[str, int]], stds: dict[str, tuple[str, int]] | None = None) -> DataFrame:
    """Means and sample deviations over full windows of known values, else null: ``{name: (column, rows)}``.

    A sliding frame adds up all its rows anew at each row. So only short blocks are added up, and a window is put
    together from the blocks that end in it, which works for window lengths that are multiples of the block. Blocks
    with a missing value are null and make every window over them null. Deviations combine block means and block
    sums of squares about them, so nothing large is subtracted.
    """
    stds = stds or {}
    for rows in (rows for _, rows in [*means.values(), *stds.values()]):
        if rows % BLOCK:
            raise ValueError(f"window length {rows} is no multiple of {BLOCK}")

    block = w.rowsBetween(1 - BLOCK, 0)
    reach = {}
    for c, rows in [*means.values(), *stds.values()]:
        reach[c] = max(reach.get(c, 0), rows)
    squares = {c: max(rows for col, rows in stds.values() if col == c) for c in {c for c, _ in stds.values()}}

    def full(c: str, value: Column) -> Column:
        return F.when(F.count(c).over(block) == BLOCK, value)

    blocks = {f"__mean_{c}_0": full(c, F.avg(c).over(block)) for c in reach}
    blocks |= {f"__sq_{c}_0": full(c, F.var_pop(c).over(block) * BLOCK) for c in squares}
    lags = {
        f"{prefix}_{c}_{back}": F.lag(f"{prefix}_{c}_0", back).over(w)
        for prefix, longest in (("__mean", reach), ("__sq", squares))
        for c, rows in longest.items()
        for back in range(BLOCK, rows, BLOCK)
    }

    def parts(prefix: str, c: str, rows: int) -> list[Column]:
        return [F.col(f"{prefix}_{c}_{back}") for back in range(0, rows, BLOCK)]

    def mean(c: str, rows: int) -> Column:
        return sum(parts("__mean", c, rows)[1:], parts("__mean", c, rows)[0]) / (rows // BLOCK)

    staged = df.withColumns(blocks).withColumns(lags) if lags else df.withColumns(blocks)
    out = staged.withColumns({name: mean(c, rows) for name, (c, rows) in means.items()})
    if stds:
        out = out.withColumns({f"__mid_{name}": mean(c, rows) for name, (c, rows) in stds.items()})
        spread = {}
        for name, (c, rows) in stds.items():
            apart = [m - F.col(f"__mid_{name}") for m in parts("__mean", c, rows)]
            total = sum(parts("__sq", c, rows), F.lit(0.0)) + sum((a * a for a in apart), F.lit(0.0)) * BLOCK
            spread[name] = F.sqrt(total / (rows - 1))
        out = out.withColumns(spread)
    return out.drop(*blocks, *lags, *[f"__mid_{name}" for name in stds])
