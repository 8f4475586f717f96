"""Compaction by packing: small files of a partition are put together, large ones stay untouched."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .swap import NOTE, STAGED, Folders, _beside, _do, recover

TARGET_BYTES = 128 << 20
BINS = "folder string, path string, file string, bin int"


def first_fit(sizes: Sequence[int], target: int) -> list[int]:
    """The bin of each size: the first one that it still fits in, the largest sizes first."""
    room: list[int] = []
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        place = next((b for b, r in enumerate(room) if r >= sizes[i]), None)
        if place is None:
            place = len(room)
            room.append(target)
        room[place] -= sizes[i]
        out[i] = place
    return out


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``(folder, path, file, size)`` of the data files of a table, from a listing; no file is opened.

    ``file`` is the name that readers give in their metadata column.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return files.select(folder.alias("folder"), "path", F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"))


def packed(files: DataFrame, target: int = TARGET_BYTES) -> DataFrame:
    """``(folder, path, file, bin)`` of files that are smaller than half of ``target`` and share a bin with others of their folder.

    A task packs the listing of one folder at a time.
    """

    def run(folder: pd.DataFrame) -> pd.DataFrame:
        bins = pd.Series(first_fit(folder["size"].tolist(), target), index=folder.index)
        out = folder[["folder", "path", "file"]].assign(bin=bins.astype("int32"))
        return out[bins.map(bins.value_counts()) > 1]

    small = files.where(F.col("size") < target // 2)
    return small.groupBy("folder").applyInPandas(run, BINS)


def pack(spark: SparkSession, path: str, cols: Sequence[str] = C.DATE_PARTS, target: int = TARGET_BYTES) -> int:
    """Put small files of a Parquet table together, up to about ``target`` bytes each, and give the number of files less.

    Files of half the target and more, and small ones that have no other to go with, keep their name and time. Every bin
    is one task and one new file. The new files are staged and counted before the small ones make way for them, by a
    note that :func:`varve.sinks.swap.recover` finishes after a failure; for that moment a reader may miss rows of
    the folders at hand, but never see one twice.
    """
    recover(spark, path)
    folders, key = Folders(spark, path), uuid.uuid4().hex
    # Of the listing, which the driver's file index holds anyway, the small files only.
    bins = packed(file_sizes(spark, path), target).orderBy("folder", "bin", "path").collect()
    if not bins:
        return 0
    number: dict[tuple[str, int], int] = {}
    place = [(r.path, r.file, number.setdefault((r.folder, r.bin), len(number))) for r in bins]
    staged = _beside(path, STAGED, key)
    whole = spark.read.option("basePath", path).parquet(*[p for p, _, _ in place])
    of_file = spark.createDataFrame([(f, n) for _, f, n in place], "__file string, __bin int")
    named = whole.withColumn("__file", F.col("_metadata.file_path")).join(of_file, "__file").drop("__file")
    spread = named.repartitionById(len(number), "__bin").drop("__bin")
    writer = spread.write.option("compression", "snappy")
    (writer.partitionBy(*cols) if cols else writer).parquet(f"{staged}/new")
    before, after = whole.count(), spark.read.schema(whole.schema).parquet(f"{staged}/new").count()
    if before != after:
        raise RuntimeError(f"{path}: {before} rows in the small files, {after} in the staged ones")
    moves: list[tuple[str | None, str]] = [(None, p) for p, _, _ in place]
    moves += [(f"{staged}/new/{f}", f"{path.rstrip('/')}/{f}") for f in _files(folders, f"{staged}/new")]
    note = _beside(path, NOTE, key)
    folders.write(note, json.dumps({"staged": staged, "moves": moves}))
    _do(folders, note)
    spark.catalog.refreshByPath(path)
    return len(place) - len(number)


def _files(folders: Folders, root: str, inside: str = "") -> Iterator[str]:
    for name in folders.names(f"{root}/{inside}".rstrip("/")):
        path = f"{inside}/{name}".lstrip("/")
        if folders.is_folder(f"{root}/{path}"):
            yield from _files(folders, root, path)
        elif name.endswith(".parquet"):
            yield path
