"""Turn tables of (label, column, comparison, level) into conditional columns."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {">": operator.gt, "<": operator.lt, ">=": operator.ge, "<=": operator.le}


def holds(column: str | Column, comparison: str, level: float) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return _COMPARE[comparison](column, F.lit(level))


def first_match(choices: Iterable[tuple[Column, object]], default: object) -> Column:
    """The value of the first condition that is true; a null condition is not true."""
    chain = F
    for condition, value in choices:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(default))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(operator.or_, conditions)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(operator.and_, conditions)
