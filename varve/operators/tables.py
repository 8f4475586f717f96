"""Union and paging."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame

from .. import constants as C


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name; a column a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def page(df: DataFrame, order_by: str | Column | Sequence[str | Column], top: int, skip: int | None = None) -> DataFrame:
    """Rows ``skip`` to ``skip + top`` in the given order. Both are bounded, so each task keeps a bounded top."""
    order = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    if not order:
        raise ValueError("a page needs an order")
    if not 1 <= top <= C.MAX_PAGE_ROWS:
        raise ValueError(f"top must lie in 1..{C.MAX_PAGE_ROWS}")
    if skip is not None and not 0 <= skip <= C.MAX_PAGE_SKIP:
        raise ValueError(f"skip must lie in 0..{C.MAX_PAGE_SKIP}")
    # The limit comes first, so that the sort is a top-n and not a whole one.
    out = df.orderBy(*order).limit(top + (skip or 0))
    return out.offset(skip) if skip else out
