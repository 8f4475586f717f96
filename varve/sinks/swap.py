"""Replacement of tables and of single partitions, so that no reader and no lost job is left with half a table.

New files are written beside the table and counted. Only then a note of the renames that will follow is put down, in one
step; the renames are done, what they replace is moved aside first, and the note goes. A job that ends before the note
leaves the table as it was. One that ends after it is finished by :func:`recover`, which repeats the renames that are
missing. Of each partition, readers see the old files or the new ones.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .files import write_partitioned

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
STAGED, NOTE = "staged", "swap"


class Folders:
    """The few file-system calls that renames need, on any file system that Hadoop knows."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))] if self.exists(path) else []

    def age(self, path: str) -> float:
        """Seconds since the path was last changed."""
        return time.time() - self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def is_folder(self, path: str) -> bool:
        return self._fs.getFileStatus(self._path(path)).isDirectory()

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def write(self, path: str, text: str) -> None:
        """All of a small file or nothing of it: written under another name, then renamed."""
        part = f"{path}.part"
        out = self._fs.create(self._path(part), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(part, path)

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()


def _split(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent, name


def _beside(path: str, kind: str, key: str = "") -> str:
    """A hidden name beside the table; listings of its parent pass over it."""
    parent, name = _split(path)
    return f"{parent}/_{name}.{kind}-{key}"


def _do(folders: Folders, note: str) -> None:
    """The renames of a note, those already done left out; then the note and what was moved aside go."""
    plan = json.loads(folders.read(note))
    for i, (new, target) in enumerate(plan["moves"]):
        aside = f"{plan['staged']}/old/{i}"
        if new is None or folders.exists(new):
            if folders.exists(target) and not folders.exists(aside):
                folders.move(target, aside)
            if new is not None:
                folders.move(new, target)
    folders.delete(note)
    folders.delete(plan["staged"])


def recover(spark: SparkSession, path: str) -> int:
    """Finish the replacements of a table that were decided on but not done; how many there were.

    Call it before a job works on the table. Files that were staged but not decided on stay: see :func:`sweep`.
    """
    folders, (parent, name) = Folders(spark, path), _split(path)
    notes = [n for n in folders.names(parent) if n.startswith(f"_{name}.{NOTE}-") and not n.endswith(".part")]
    for note in sorted(notes):
        _do(folders, f"{parent}/{note}")
    return len(notes)


def sweep(spark: SparkSession, path: str, seconds: float = 86_400) -> int:
    """Delete staged files of a table that no note names and that are older than ``seconds``; how many folders there were."""
    recover(spark, path)
    folders, (parent, name) = Folders(spark, path), _split(path)
    old = [f"{parent}/{n}" for n in folders.names(parent) if n.startswith(f"_{name}.{STAGED}-")]
    old = [p for p in old if folders.age(p) >= seconds]
    for p in old:
        folders.delete(p)
    return len(old)


def _partitions(folders: Folders, root: str, depth: int) -> list[str]:
    found = [""]
    for _ in range(depth):
        found = [f"{p}/{n}" for p in found for n in folders.names(root + p) if "=" in n]
    return found


def partition_path(cols: Sequence[str], values: Sequence) -> str:
    """The folder of a partition below its table, for numbers, dates and plain names."""
    return "".join(f"/{c}={NULL_PARTITION if v is None else v}" for c, v in zip(cols, values, strict=True))


def replace(
    df: DataFrame,
    path: str,
    cols: Sequence[str] = C.DATE_PARTS,
    partitions: bool = False,
    dates: Iterable[Sequence] = (),
    compression: str | None = None,
    observed: tuple[Observation, Sequence[Column]] | None = None,
) -> int:
    """Replace a Parquet table by ``df``, laid out by ``cols``, and give its number of rows.

    With ``partitions`` only those that occur in ``df`` are replaced, and those of ``dates`` (values of ``cols``) that do
    not occur in it are removed. ``df`` may read the table itself: its files are moved only after the write. With nothing
    to write, ``partitions`` without ``dates`` leaves the table as it is.
    """
    spark = df.sparkSession
    recover(spark, path)
    folders, key = Folders(spark, path), uuid.uuid4().hex
    staged = _beside(path, STAGED, key)
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    write_partitioned(counted, f"{staged}/new", cols, compression=compression, observed=observed)
    found = spark.read.schema(df.schema).parquet(f"{staged}/new").count()
    # A plan that is known to be empty observes nothing.
    rows = seen.get["rows"] if found else 0 if df.isEmpty() else -1
    if found != rows:
        raise RuntimeError(f"{path}: {found} rows are in the staged files, not all that were written")
    if not partitions:
        moves: list[tuple[str | None, str]] = [(f"{staged}/new", path.rstrip("/"))]
    else:
        fresh = _partitions(folders, f"{staged}/new", len(cols))
        gone = {partition_path(cols, d) for d in dates} - set(fresh)
        moves = [(f"{staged}/new{p}", f"{path.rstrip('/')}{p}") for p in fresh] + [(None, f"{path.rstrip('/')}{p}") for p in sorted(gone)]
    if not moves:
        folders.delete(staged)
        return rows
    note = _beside(path, NOTE, key)
    folders.write(note, json.dumps({"staged": staged, "moves": moves}))
    _do(folders, note)
    spark.catalog.refreshByPath(path)
    return rows
