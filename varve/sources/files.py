"""File and table readers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions.names import check_name
from ..operators.series import POSITION, with_position
from ..operators.silver import for_date
from ..operators.tables import union_all
from ..session import session_with

read_for_date = for_date


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Scan a table by path. A versioned format is read through its log, never through the files below it."""
    return spark.read.format(fmt).load(path)


def is_missing(error: AnalysisException) -> bool:
    """True when a read failed because there is no data to read."""
    return error.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_parquet_glob(spark: SparkSession, root: str, hive_layout: bool = True) -> DataFrame:
    """All Parquet files at any depth below ``root``; with a ``key=value`` layout its keys are columns and prune."""
    reader = spark.read
    return reader.parquet(root) if hive_layout else read_local_tree(spark, root)


def has_keys(spark: SparkSession, path: str) -> bool:
    """Whether a directory is laid out by ``key=value`` directories. Lists the directory itself only."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(place) and any(s.isDirectory() and "=" in s.getPath().getName() for s in files.listStatus(place))


def read_local_tree(spark: SparkSession, path: str, unite: bool = False, skip_corrupt: bool = False) -> DataFrame:
    """A Parquet file, or all Parquet files at any depth below a directory.

    The keys of a ``key=value`` layout are columns and prune; any other directories may have any names. ``unite``
    unites the columns of all files, for which it reads every footer. ``skip_corrupt`` passes over files that cannot be
    read, see :func:`left_out`; else they are an error.
    """
    reader = spark.read.options(mergeSchema=str(unite).lower(), ignoreCorruptFiles=str(skip_corrupt).lower())
    if path.endswith(".parquet") or has_keys(spark, path):
        return reader.parquet(path)
    return reader.options(recursiveFileLookup="true", pathGlobFilter="*.parquet").parquet(path)


def left_out(df: DataFrame, files: DataFrame) -> DataFrame:
    """Those of the listed ``files(path, ...)`` that gave ``df`` no row: empty ones, and those that were passed over."""
    read = df.select(F.col("_metadata.file_path").alias("path")).distinct()
    plain = F.regexp_replace("path", "^file:/+", "/")
    return files.join(read.select(plain.alias("__path")), plain == F.col("__path"), "left_anti")


def until(df: DataFrame, end_date: str, first_date: str | None = None) -> DataFrame:
    """Rows up to and including ``end_date`` (YYYYMMDD), from ``first_date`` on if given; prunes partitions."""

    def day_of(text: str) -> dt.date:
        if len(text) != 8 or not text.isdigit():
            raise ValueError(f"not a date (YYYYMMDD): {text!r}")
        return dt.datetime.strptime(text, "%Y%m%d").date()

    day = F.make_date(*[F.col(c).cast("int") for c in C.DATE_PARTS])
    rows = df.where(day <= F.lit(day_of(end_date)))
    return rows.where(day >= F.lit(day_of(first_date))) if first_date else rows


def read_until(spark: SparkSession, path: str, end_date: str, first_date: str | None = None) -> DataFrame:
    return until(spark.read.parquet(path), end_date, first_date)


def read_in_order(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """A table of :func:`varve.sinks.files.write_in_order` with the place of each row in its order, from 1.

    Files follow each other by the numbers in their names, so only their row counts are summed up, one row per file;
    nothing is sorted or ranked again.
    """
    rows = spark.read.parquet(path)
    if position in rows.columns:
        raise ValueError(f"the table has a column {position}; choose another name for the places")
    file, row = unused("file", rows), unused("row", rows)
    named = rows.select("*", F.col("_metadata.file_name").alias(file), F.col("_metadata.row_index").alias(row))
    counts = rows.groupBy(F.col("_metadata.file_name").alias(file)).agg(F.count(F.lit(1)).alias("rows"))
    task = F.regexp_extract(file, r"part-(\d+)", 1).cast("long")
    turn = F.regexp_extract(file, r"-c(\d+)\.", 1).cast("long")
    earlier = Window.orderBy(task, turn).rowsBetween(Window.unboundedPreceding, -1)
    before = unused("before", rows)
    starts = counts.select(file, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias(before))
    placed = named.join(starts, file)
    return placed.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col(before) + F.col(row) + 1).alias(position))


def unused(name: str, df: DataFrame) -> str:
    """``name``, or one like it that is no column of ``df``."""
    while name in df.columns:
        name += "_"
    return name


def _first_rows_per_file(df: DataFrame, rows: int) -> DataFrame:
    """The first rows of each file in file order. A task sorts one file split at most."""
    tagged = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__split"))
    tagged = tagged.withColumn("__row", F.monotonically_increasing_id())
    placed = with_position(tagged, ["__file"], ["__split", "__row"], [F.col("__split")])
    return placed.where(F.col(POSITION) <= rows).drop(POSITION, "__file", "__split", "__row")


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    max_rows: int | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """CSV with a header, all rows; ``max_rows`` keeps the first rows of each file only.

    Give a schema for large files: inferring one reads them twice.
    """
    reader = spark.read.option("header", "true")
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", "true").csv(path)
    return df if max_rows is None else _first_rows_per_file(df, max_rows)


def read_json(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema else reader).json(path)


def _alike(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """Frames in which a column of clashing types is text; numbers of several types are left to widen."""
    kinds: dict[str, set[T.DataType]] = {}
    for df in frames:
        for f in df.schema.fields:
            kinds.setdefault(f.name, set()).add(f.dataType)
    nested = (T.StructType, T.ArrayType, T.MapType)
    clash = {c for c, k in kinds.items() if len(k) > 1 and not all(isinstance(t, T.NumericType) for t in k)}

    def text(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        return (F.to_json(c) if isinstance(f.dataType, nested) else c.cast("string")).alias(f.name)

    return [df.select(*(text(f) if f.name in clash else F.col(f"`{f.name}`") for f in df.schema.fields)) for df in frames]


def read_mixed_dataset(spark: SparkSession, root: str, csv_rows: int | None = None, skip_corrupt: bool = False) -> DataFrame:
    """All CSV, JSON and Parquet files below ``root`` as one frame; ``key=value`` directories become text columns.

    A column that the kinds of files type differently is text. ``csv_rows`` keeps the first rows of each CSV file only.
    ``skip_corrupt`` passes over files that cannot be read, see :func:`left_out`; else they are an error.
    """
    own = session_with(spark, **{"spark.sql.sources.partitionColumnTypeInference.enabled": "false"})
    frames = []
    for kind in C.DATA_EXTENSIONS:
        reader = own.read.option("pathGlobFilter", f"*.{kind}").option("ignoreCorruptFiles", str(skip_corrupt).lower())
        if kind == "parquet":
            reader = reader.option("mergeSchema", "true")
        try:
            if kind == "csv":
                df = reader.option("header", "true").option("inferSchema", "true").csv(root)
                df = df if csv_rows is None else _first_rows_per_file(df, csv_rows)
            else:
                df = reader.format(kind).load(root)
        except AnalysisException as error:
            if not is_missing(error):
                raise
            continue  # no file of this kind
        if df.columns:
            frames.append(df)
    if not frames:
        raise FileNotFoundError(f"no readable data below {root}")
    return union_all(_alike(frames))


def load(spark: SparkSession, uri: str, end_date: str | None = None, **jdbc: str) -> DataFrame:
    """Read by address: ``table://db/name`` or ``athena://db/name`` from the catalog, ``jdbc:…`` or
    ``duckdb://file/table`` through JDBC, and anything else as Parquet files, keys of their layout included."""
    scheme = urlsplit(uri).scheme
    if scheme in ("table", "athena"):
        parts = uri.split("://", 1)[1].strip("/").split("/")
        if len(parts) != 2:
            raise ValueError(f"expected {scheme}://database/table: {uri}")
        return spark.table(".".join(f"`{check_name(p, 'column_name')}`" for p in parts))
    if scheme == "duckdb":
        file, _, table = uri.split("://", 1)[1].rpartition("/")
        if not file or not table:
            raise ValueError(f"expected duckdb://file/table: {uri}")
        options = {"driver": "org.duckdb.DuckDBDriver", **jdbc, "url": f"jdbc:duckdb:{file}", "dbtable": table}
        return spark.read.format("jdbc").options(**options).load()
    if uri.startswith("jdbc:"):
        return spark.read.format("jdbc").options(**{**jdbc, "url": uri}).load()
    if end_date:
        return read_until(spark, uri, end_date)
    return read_local_tree(spark, uri)


def sample_table(spark: SparkSession, table: str, n: int = C.SAMPLE_ROWS, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows of a table: by key when one is given, else whichever come first."""
    df = spark.table(table)
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def register_external(spark: SparkSession, database: str, table: str, schema: T.StructType, path: str) -> DataFrame:
    """Register Parquet files that lie at ``path`` as an external table, once."""
    name = f"{check_name(database, 'column_name')}.{check_name(table, 'column_name')}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return spark.table(name)
