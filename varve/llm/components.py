"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import cut


def _settled(edges: DataFrame) -> bool:
    """Whether the links are stars: no centre is a leaf, and no leaf has two centres."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    odd = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return odd.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def _large(edges: DataFrame, n: int) -> DataFrame:
    """Each larger neighbour of ``u`` is linked to the smallest neighbour of ``u`` (``u`` included)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = cut(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least", 2 * n)
    out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def _small(edges: DataFrame, n: int) -> DataFrame:
    """``u`` and its smaller neighbours are linked to the smallest of them."""
    least = cut(edges.groupBy("u").agg(F.min("v").alias("m")), "least", n)
    out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(id, component_id)`` for every id that occurs in ``edges``: the smallest id reachable, itself included.

    ``edges`` has the columns ``u`` and ``v``, in any order and number; loops and nulls are no links. Only aggregates
    with partial forms and joins that adaptive execution can split are used, so a star with a third of all links does
    not land in one task. Every round is written to the shared folder; nothing comes to the driver but whether to go on.
    """
    plain = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = cut(plain, "edges")
    n = now.count()
    while not _settled(now):
        large = cut(_large(now, n), "large", 2 * n)
        after = cut(_small(large, 2 * n), "small", 2 * n)
        now = after
    leaves = now.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return leaves.union(now.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())
