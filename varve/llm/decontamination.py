"""Benchmark items inside documents: size-partitioned MinHash containment search, then exact shingle containment.

An item is short and a document long, so their Jaccard similarity says little. Only shingles that some item has can
count towards containment; the others are dropped first, which leaves the overlap of every pair as it is and makes the
remaining sets about as small as the items. Those sets are partitioned by size. For each partition and each size of
item, the containment asked for gives the least Jaccard similarity that such a pair can have, and from it the rows per
band with which a pair is missed with a probability of at most ``MISS``. Where no banding reaches that, a shared
shingle makes a candidate. All candidates are confirmed on whole shingle sets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import cut

HASHES = 128
MISS = 1e-4
ROWS = (8, 6, 4, 3, 2, 1)
GAPS = r"[^\p{L}\p{N}]+"
SHINGLE = 5
PERCENT = 80


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), GAPS), lambda w: w != "")


def shingles(df: DataFrame, text: Column, k: int, *columns: str) -> DataFrame:
    """``columns`` and ``h``, one row per shingle (repeats included); texts with fewer than ``k`` words have none."""
    long = df.select(*columns, words(text).alias("w")).where(F.size("w") >= k)
    each = F.transform(F.sequence(F.lit(0), F.size("w") - k), lambda i: F.xxhash64(*(F.col("w")[i + j] for j in range(k))))
    return long.select(*columns, F.explode(each).alias("h"))


def signature(hashes: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda s: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, s))))


def banding(items: int, documents: int, containment: float) -> tuple[int, int]:
    """Rows per band and bands for an item of at least ``items`` shingles in a set of at most ``documents``; (0, 0) if none will do."""
    common = containment * items
    j = min(1.0, common / (items + documents - common)) if documents >= common else 1.0
    for rows in ROWS:
        p = j**rows
        bands = 1 if p >= 1 else math.ceil(math.log(MISS) / math.log1p(-p))
        if bands * rows <= HASHES:
            return rows, bands
    return 0, 0


def _keys(sets: DataFrame, values: str, own: int, plans: list[tuple[int, int, int, int]]) -> DataFrame:
    """One row per banding plan of a set's size and band; ``own`` is the place of that size in a plan."""
    of = F.array().cast("array<struct<a:int,b:int,rows:int,bands:int>>")
    for size in sorted({p[own] for p in plans}):
        here = [F.struct(*(F.lit(x).alias(n) for x, n in zip(p, ("a", "b", "rows", "bands"), strict=True))) for p in plans if p[own] == size]
        of = F.when(F.col("size_class") == size, F.array(*here)).otherwise(of)
    each = sets.withColumn("p", F.explode(of))
    bands = F.transform(F.sequence(F.lit(0), F.col("p.bands") - 1), lambda b: F.xxhash64("p.a", "p.b", b, F.slice("signature", b * F.col("p.rows") + 1, F.col("p.rows"))))
    single = F.transform(values, lambda h: F.xxhash64("p.a", "p.b", h))
    return each.withColumn("key", F.explode(F.when(F.col("p.rows") > 0, bands).otherwise(single)))


def _size_class(hashes: Column) -> Column:
    return F.floor(F.log2(F.size(hashes))).cast("int")


def contained_items(docs: DataFrame, items: DataFrame, *, k: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(doc_id, item_id, n_common, n_item, containment)``: items with at least ``percent`` of their distinct shingles in a document.

    Words are lower-cased runs of letters and digits. Null, empty and shorter texts have no shingles and match
    nothing; rows without an id cannot be named and give no pair. Rows that repeat an id are one text. Empty tables
    give no rows; further columns are ignored.

    Documents with the same shingles in common with the benchmark are searched once, so a passage that a third of all
    documents share is one set. Whether the benchmark's shingles are broadcast is left to their size.
    """
    tests = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("t")).where("item_id is not null")
    queries = shingles(tests, F.col("t"), k, "item_id").groupBy("item_id").agg(F.sort_array(F.collect_set("h")).alias("q"))
    queries = cut(queries.withColumn("size_class", _size_class(F.col("q"))).withColumn("signature", signature(F.col("q"))), "items")
    known = queries.select(F.explode("q").alias("h")).distinct()
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{doc_text}`").cast("string").alias("t")).where("doc_id is not null")
    hits = shingles(texts, F.col("t"), k, "doc_id").join(known, "h", "left_semi")
    found = hits.groupBy("doc_id").agg(F.sort_array(F.collect_set("h")).alias("d"))
    found = cut(found.select("doc_id", "d", F.xxhash64("d").alias("s1"), F.xxhash64(F.lit(1), "d").alias("s2")), "overlaps")
    sets = found.groupBy("s1", "s2").agg(F.any_value("d").alias("d"))
    sets = cut(sets.withColumn("size_class", _size_class(F.col("d"))).withColumn("signature", signature(F.col("d"))), "sets")
    sizes = [sorted(r[0] for r in t.select("size_class").distinct().collect()) for t in (sets, queries)]  # at most 31 each
    plans = [(d, q, *banding(2**q, 2 ** (d + 1) - 1, percent / 100)) for d in sizes[0] for q in sizes[1] if 100 * (2 ** (d + 1) - 1) >= percent * 2**q]
    left, right = _keys(sets, "d", 0, plans).select("s1", "s2", "key"), _keys(queries, "q", 1, plans).select("item_id", "key")
    pairs = left.join(right, "key").select("s1", "s2", "item_id")
    whole = cut(pairs.distinct(), "candidates").join(sets.select("s1", "s2", "d"), ["s1", "s2"]).join(queries.select("item_id", "q"), "item_id")
    common = F.size(F.array_intersect("d", "q"))
    exact = whole.select("s1", "s2", "item_id", common.cast("long").alias("n_common"), F.size("q").cast("long").alias("n_item"))
    exact = cut(exact.where(100 * F.col("n_common") >= percent * F.col("n_item")), "contained")
    out = found.select("doc_id", "s1", "s2").join(exact, ["s1", "s2"])
    return out.select("doc_id", "item_id", "n_common", "n_item", (F.col("n_common") / F.col("n_item")).alias("containment"))
