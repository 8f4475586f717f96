"""File and table writers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from .. import constants as C
from ..session import session_with

ROWS_PER_FILE = 10_000_000


def _place(path: str) -> str:
    parts = urlsplit(path)
    scheme = "" if parts.scheme in ("", "file") else f"{parts.scheme}://{parts.netloc}"
    return f"{scheme}/{parts.path.strip('/')}/"


def check_apart(source: str, destination: str) -> None:
    """A copy must not lie inside what it copies, nor the other way round: later reads would mix them."""
    a, b = _place(source), _place(destination)
    if a.startswith(b) or b.startswith(a):
        raise ValueError(f"{destination} overlaps {source}")


def write_partitioned(
    df: DataFrame,
    path: str,
    cols: Sequence[str] = C.DATE_PARTS,
    fmt: str = "parquet",
    replace: str = "table",
    compression: str | None = None,
    observed: tuple[Observation, Sequence[Column]] | None = None,
) -> None:
    """Overwrite a table laid out by ``cols``; ``replace='partitions'`` replaces only the partitions that occur in ``df``,
    and ``replace='nothing'`` adds to the table.

    Rows are rebalanced by partition before the write: small partitions share a task, a large one is split over
    several, so neither many small files nor one huge task come out. ``observed`` takes metrics of the rows on their
    way; it sits in the writing stage, whose tasks count once even when they are retried.
    """
    if replace not in ("table", "partitions", "nothing"):
        raise ValueError(f"replace must be 'table', 'partitions' or 'nothing': {replace}")
    rows = df.hint("rebalance", *cols)
    if observed:
        rows = rows.observe(observed[0], *observed[1])
    writer = (
        rows.write.format(fmt)
        .mode("append" if replace == "nothing" else "overwrite")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    )
    if replace == "table" and fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if compression:
        writer = writer.option("compression", compression)
    writer.partitionBy(*cols).save(path)


def write_in_order(df: DataFrame, path: str, order: Sequence[str | Column], compression: str | None = None) -> None:
    """Overwrite a Parquet table whose files, by name, and rows, by place, follow ``order``.

    Rows are cut into ranges of the whole order, so an order that tells any two rows apart gives even tasks also where
    a third of all rows share its first value. :func:`varve.sources.files.read_in_order` gives the places back.
    """
    writer = df.orderBy(*order).write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
    writer = writer.option("partitionOverwriteMode", "static")
    (writer.option("compression", compression) if compression else writer).parquet(path)


def export_parquet(df: DataFrame, path: str, cols: Sequence[str] = C.DATE_PARTS) -> None:
    """Snappy Parquet by date; partitions that occur in ``df`` are replaced, others left alone."""
    write_partitioned(df, path, cols, replace="partitions", compression="snappy")


def compact(spark: SparkSession, source: str, destination: str, cols: Sequence[str] = C.DATE_PARTS, fmt: str = "parquet", target_bytes: int = 128 << 20) -> str:
    """Rewrite a table with few large files.

    Delta compacts in place. Other formats are rewritten to ``destination``, which the caller then points readers to
    (see :func:`repoint`), so that a lost job leaves the source whole. File size follows the advisory partition size.
    """
    if fmt == "delta":
        spark.sql(f"OPTIMIZE delta.`{source}`")
        return source
    check_apart(source, destination)
    own = session_with(spark, **{"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes)})
    write_partitioned(own.read.format(fmt).load(source), destination, cols, fmt)
    return destination


def repoint(spark: SparkSession, table: str, path: str) -> None:
    """Make a catalog table read from ``path``."""
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE IDENTIFIER(:t) SET LOCATION '{place}'", args={"t": table})
    spark.catalog.refreshTable(table)


def land_raw_json(df: DataFrame, folder: str, name: str, at: dt.datetime | None = None) -> str:
    """Land rows as JSON in a folder of their own, named after the run time."""
    at = at or dt.datetime.now(dt.timezone.utc)
    path = f"{folder.rstrip('/')}/{name}_{at:%Y%m%d_%H%M%S}"
    df.write.mode("errorifexists").json(path)
    return path


def copy_parquet(spark: SparkSession, source: str, destination: str, cols: Sequence[str] = ()) -> None:
    """Copy the data files of a table; logs, checkpoints and files still being written are left out."""
    check_apart(source, destination)
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(source)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*cols) if cols else writer).parquet(destination)


def publish_if_valid(df: DataFrame, report: DataFrame, destination: str, source: str | None = None, cols: Sequence[str] = C.DATE_PARTS) -> bool:
    """Write the published copy only when the one-row report says success.

    The copy before it stays until the new one is written and counted, see :mod:`varve.sinks.swap`.
    """
    from .swap import replace  # which writes by this module's functions

    if source:
        check_apart(source, destination)
    if not report.select("success").first()[0]:
        return False
    replace(df, destination, cols, compression="snappy")
    return True


def materialize(df: DataFrame, name: str, fmt: str = "parquet", cols: Sequence[str] = ()) -> DataFrame:
    """Rebuild a named table in full."""
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*cols) if cols else writer).saveAsTable(name)
    return df.sparkSession.table(name)
