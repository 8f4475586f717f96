"""Predicates on names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def safe_name(column: str | Column, kind: str) -> Column:
    """True for names on the allow-list of their kind; empty, long and null names are not."""
    column = F.col(column) if isinstance(column, str) else column
    short = F.length(column).between(1, C.SAFE_NAME_LENGTH)
    return F.coalesce(short & column.rlike(C.SAFE_NAMES[kind]), F.lit(False))


def data_file(column: str | Column) -> Column:
    """True for paths that end in a data file extension."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.rlike(r"\.(" + "|".join(C.DATA_EXTENSIONS) + ")$"), F.lit(False))


def check_name(name: str, kind: str) -> str:
    """Driver-side twin of :func:`safe_name` for names that go into a path or a statement."""
    import re

    if not name or len(name) > C.SAFE_NAME_LENGTH or not re.fullmatch(C.SAFE_NAMES[kind], name):
        raise ValueError(f"not a safe {kind}: {name!r}")
    return name
