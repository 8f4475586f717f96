"""Tables in the folder that all executors share, and the package's own path for Python workers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from varve.session import shared_folder

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed and not sent with ``--py-files``."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if REPO not in known:
        env["PYTHONPATH"] = os.pathsep.join([REPO, *filter(None, known)])


def folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/varve-llm/{name}-{uuid.uuid4().hex}"


ROWS_A_TASK = 250_000


def cut(df: DataFrame, name: str = "cut", rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    Lineage ends here: a lost executor costs no earlier step, and later readers take only the columns that they need.
    ``rows`` is an upper bound of the number of narrow rows, where one is known: the last stage then has a task for
    every ``ROWS_A_TASK`` of them at most, and so do the stages that read the table. The number follows the data.
    """
    spark = df.sparkSession
    path = folder(spark, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_TASK)))
    df.write.parquet(path)
    return spark.read.schema(as_nullable(df.schema)).parquet(path)


def as_nullable(schema: StructType) -> StructType:
    return StructType([type(f)(f.name, f.dataType, True) for f in schema.fields])


def delete(df: DataFrame) -> None:
    """Remove a table that ``cut`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in {os.path.dirname(f) for f in df.inputFiles()}:
        if "/varve-llm/" in name:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
