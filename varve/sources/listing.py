"""Listings: files of a lake grouped to datasets, and the partition values of a dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.names import check_name, data_file, safe_name
from ..operators.quantiles import join_null_safe
from ..sinks.files import write_in_order
from .files import read_in_order


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, size, modified`` of all files below ``root``. File contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def _keys(files: DataFrame, root: str | None) -> DataFrame:
    """Path below the root as ``key``, with its parts."""
    path = F.col("path")
    if root:
        # ``file:/a`` and ``file:///a`` are the same path; compare after the scheme.
        bare = F.regexp_replace(path, "^[a-z0-9]+:/+", "/")
        inside = root.split("://", 1)[-1] if "://" in root else root
        inside = "/" + inside.strip("/") + "/"
        path = F.when(bare.startswith(inside), F.substring(bare, F.lit(len(inside) + 1), F.length(bare))).otherwise(bare)
    parts = F.split(path, "/")
    return files.select(
        "path",
        "size",
        "modified",
        path.alias("key"),
        F.element_at(parts, -1).alias("name"),
        F.slice(parts, F.lit(1), F.size(parts) - 1).alias("folders"),
    )


def _dataset_name(folders: Column, name: Column, partitioned: Column) -> Column:
    kept = F.filter(folders, lambda p: ~p.contains("=") & ~p.isin(list(C.UNNAMED_PATH_PARTS)))
    joined = F.array_join(kept, "_")
    folder_name = F.when(joined == "", F.lit(C.UNNAMED_DATASET)).otherwise(joined)
    return F.when(partitioned, folder_name).otherwise(F.substring_index(name, ".", 1))


def catalog_files(files: DataFrame, root: str | None = None) -> DataFrame:
    """Data files with safe names, with the dataset each belongs to and that dataset's folder."""
    keyed = _keys(files, root).where(data_file("key") & safe_name("name", "file_name"))
    partitioned = F.exists("folders", lambda p: p.contains("="))
    plain = F.filter("folders", lambda p: ~p.contains("="))
    named = keyed.withColumn("is_partitioned", partitioned).withColumn(
        "dataset_name", _dataset_name(F.col("folders"), F.col("name"), F.col("is_partitioned"))
    )
    return named.withColumn("root_path", F.array_join(plain, "/")).where(safe_name("dataset_name", "dataset_name"))


def partition_values(files: DataFrame, root: str | None = None) -> DataFrame:
    """Long form: one row per dataset, partition key and value, with file count and size. Grows without bound safely."""
    entries = catalog_files(files, root).where("is_partitioned")
    pairs = F.filter("folders", lambda p: p.contains("="))
    flat = entries.select("dataset_name", "size", F.explode(pairs).alias("__p"))
    return (
        flat.select(
            "dataset_name",
            F.substring_index("__p", "=", 1).alias("partition_key"),
            F.expr("substring(__p, instr(__p, '=') + 1)").alias("partition_value"),
            "size",
        )
        .groupBy("dataset_name", "partition_key", "partition_value")
        .agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("size"))
    )


def list_partitions(files: DataFrame, dataset: str, root: str | None = None) -> DataFrame:
    """Sorted distinct values per partition key of a dataset, with their count and the total over keys."""
    check_name(dataset, "dataset_name")
    values = partition_values(files, root).where(F.col("dataset_name") == dataset)
    lists = values.groupBy("dataset_name", "partition_key").agg(
        F.array_sort(F.collect_list("partition_value")).alias("partition_values"),
        F.count(F.lit(1)).alias("value_count"),
    )
    whole = Window.partitionBy("dataset_name")
    return lists.withColumn("total_partitions", F.sum("value_count").over(whole))


VALUE_ORDER = ("dataset_name", "partition_key", "partition_value")
PAGE_VALUES = 1_000


def store_values(files: DataFrame, path: str, root: str | None = None) -> None:
    """Write the long form of all partition values in their order, for the pages below."""
    write_in_order(partition_values(files, root), path, VALUE_ORDER)


def value_pages(spark: SparkSession, path: str, values: int = PAGE_VALUES) -> DataFrame:
    """All pages of a store: ``dataset_name, partition_key, page, partition_values, value_count, files, size``.

    A page, from 1, holds ``values`` sorted values at most, so no row grows with its dataset. Pages are told by the
    places that rows have in the store; a dataset with most of the values is neither sorted nor ranked in one task.
    """
    if values < 1:
        raise ValueError(f"a page must hold a value: {values}")
    placed = read_in_order(spark, path)
    first = placed.groupBy("dataset_name", "partition_key").agg(F.min("position").alias("__first"))
    paged = join_null_safe(placed, first, ["dataset_name", "partition_key"])
    page = F.floor((F.col("position") - F.col("__first")) / values) + 1
    return paged.groupBy("dataset_name", "partition_key", page.alias("page")).agg(
        F.array_sort(F.collect_list("partition_value")).alias("partition_values"),
        F.count(F.lit(1)).alias("value_count"),
        F.sum("files").alias("files"),
        F.sum("size").alias("size"),
    )


def values_after(spark: SparkSession, path: str, dataset: str, key: str, after: str | None = None, values: int = PAGE_VALUES) -> DataFrame:
    """The next ``values`` values of a store after ``after``, sorted; all conditions reach the scan of the sorted files."""
    check_name(dataset, "dataset_name")
    rows = spark.read.parquet(path).where((F.col("dataset_name") == dataset) & (F.col("partition_key") == key))
    rows = rows.where(F.col("partition_value") > after) if after is not None else rows
    return rows.orderBy("partition_value").limit(values)


def list_datasets(files: DataFrame, root: str | None = None, with_values: bool = True) -> DataFrame:
    """Partitioned datasets as one row each, other files singly.

    ``partition_info`` maps each partition key to its sorted values; without ``with_values`` to their number, so that no
    row grows with its dataset, and :func:`value_pages` has the values. One pass over the listing: files shrink to partitions before the first shuffle, then to values, keys and datasets.
    A partition with several keys carries its size with the first of them, so that sums count it once.
    """
    totals = {"size": F.sum, "last_modified": F.max, "partition_count": F.sum, "root_path": F.min}

    def add_up(rows: DataFrame, *by: str, **more: Column) -> DataFrame:
        return rows.groupBy(*by).agg(
            *[f(name).alias(name) for name, f in totals.items()], *[c.alias(name) for name, c in more.items()]
        )

    entries = catalog_files(files, root)
    single = ["dataset_name", "is_partitioned", "single_key", "single_name"]
    rows = entries.select(
        "dataset_name",
        "is_partitioned",
        F.when(~F.col("is_partitioned"), F.col("key")).alias("single_key"),
        F.when(~F.col("is_partitioned"), F.col("name")).alias("single_name"),
        F.filter("folders", lambda p: p.contains("=")).alias("pairs"),
        "size",
        F.col("modified").alias("last_modified"),
        F.lit(1).alias("partition_count"),
        "root_path",
    )
    by_pair = add_up(rows, *single, "pairs").select("*", F.posexplode_outer("pairs").alias("at", "pair"))
    later = F.col("at") > 0
    once = by_pair.withColumns(
        {
            "size": F.when(later, F.lit(0)).otherwise(F.col("size")),
            "partition_count": F.when(later, F.lit(0)).otherwise(F.col("partition_count")),
            "partition_key": F.substring_index("pair", "=", 1),
            "partition_value": F.expr("substring(pair, instr(pair, '=') + 1)"),
        }
    )
    by_value = add_up(once, *single, "partition_key", "partition_value")
    values = F.array_sort(F.collect_list("partition_value")) if with_values else F.count("partition_value")
    by_key = add_up(by_value, *single, "partition_key", values=values)
    entry = F.when(F.col("partition_key").isNotNull(), F.struct("partition_key", "values"))
    found = add_up(by_key, *single, entries=F.array_sort(F.collect_list(entry)))
    partitioned = F.col("is_partitioned")
    return found.select(
        F.when(partitioned, F.concat("dataset_name", F.lit("_partitioned"))).otherwise(F.col("single_name")).alias("name"),
        F.when(partitioned, F.col("dataset_name")).otherwise(F.col("single_key")).alias("key"),
        "size",
        "last_modified",
        "dataset_name",
        "is_partitioned",
        F.when(partitioned, F.col("partition_count").cast("int")).alias("partition_count"),
        F.when(partitioned, F.map_from_entries("entries")).alias("partition_info"),
        "root_path",
    )
