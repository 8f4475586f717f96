"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A sketch has ``bands * rows`` coordinates. In round ``i`` of the first half every shingle is thrown into one bin by the
hash of that round; in the second half round ``i`` throws all shingles into bin ``i``, so no bin can stay empty. A bin
keeps the least (round, hash) it saw, and filling stops after the first round with no empty bin: later rounds could
change nothing. Coordinates of two sets agree with the probability of their Jaccard similarity.

Scale. Documents with equal sets become one class first, so thousands of copies cost one row. Buckets of up to
``SMALL`` classes compare all their pairs. The members of a larger bucket are compared with its hub, the one that meets
most others, which joins most of a group of near copies. Buckets that are then still in several components are gathered
by hub, each document once, and what is outside the hub's component is compared with all of them in blocks: a task
multiplies the incidence matrices of two blocks and gives back the pairs of components that a link joins. No pair of
documents becomes a row there, and every pair of a bucket is confirmed, refused, or already joined through others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import cut, reachable
from .words import mix, shingle_sets

BANDS, ROWS = 40, 6  # a pair at 0.8 shares no bucket with a probability of 5e-6
SMALL = 12  # members of a bucket whose pairs are all compared as they are
BLOCK, COLUMNS = 512, 4096  # rows and columns of an incidence matrix
_U64 = np.uint64


def sketches(sets: list[np.ndarray], t: int) -> np.ndarray:
    """The fast similarity sketches of non-empty sets of 64-bit hashes, one row each: round in the upper, hash in the
    lower bits. All sets take a round together; those without an empty bin leave."""
    empty = np.iinfo(np.uint64).max
    out = np.full((len(sets), t), empty, dtype=np.uint64)
    flat, values = out.reshape(-1), np.concatenate(sets)
    sizes = np.array([len(s) for s in sets])
    live = np.arange(len(sets))  # the sets that still have empty bins, in the order of ``values``
    with np.errstate(over="ignore"):
        for i in range(2 * t):
            h = mix(values + _U64(i + 1) * _U64(0x9E3779B97F4A7C15))
            value = (h & _U64(0xFFFFFFFFFFFF)) | _U64(i << 48)
            if i < t:
                np.minimum.at(flat, np.repeat(live * t, sizes) + ((h >> _U64(48)) % _U64(t)).astype(np.int64), value)
            else:
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                out[live, i - t] = np.minimum(out[live, i - t], np.minimum.reduceat(value, starts))
            open_ = (out[live] == empty).any(axis=1)
            if not open_.all():
                values, live, sizes = values[np.repeat(open_, sizes)], live[open_], sizes[open_]
            if not len(live):
                break
    return out


def _groups(sizes: list[int], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of sets that hold about ``most`` hashes together."""
    start = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key per band and sketch."""
    parts = coordinates.reshape(-1, bands, rows)
    with np.errstate(over="ignore"):
        key = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * _U64(0xA24BAED4963EE407)
        for i in range(rows):
            key = mix(key * _U64(0x9FB21C651E98DF25) + parts[:, :, i])
    return key.view(np.int64)


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def _sketches(k: int, bands: int, rows: int):
    schema = pa.schema([("id", pa.int64()), ("n_shingles", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(_texts(batch.column(1)), k)
            n = [len(s) for s in sets]
            keys: list[np.ndarray | None] = [None] * len(sets)
            for a, b in _groups(n):
                some = [i for i in range(a, b) if n[i]]
                if some:
                    for i, key in zip(some, band_keys(sketches([sets[i] for i in some], bands * rows), bands, rows), strict=True):
                        keys[i] = key
            with np.errstate(over="ignore"):
                h1 = [int(mix(s).sum(dtype=np.uint64).view(np.int64)) for s in sets]
                h2 = [int(mix(s ^ _U64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) for s in sets]
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _sets(k: int):
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for s in shingle_sets(_texts(batch.column(1)), k)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], schema=schema)

    return run


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Words are runs without ASCII white space, A-Z lower-cased. Two documents are linked if
    ``100 * |intersection| >= percent * |union|`` of their sets of ``k``-word shingles, confirmed on the full sets;
    with fewer than ``k`` words the whole sequence is the one shingle. ``component_id`` is the smallest id reachable.

    Null or empty texts have an empty set and link with nothing. Rows without an id get a null component and are not
    kept apart from that (``kept`` is false). Rows that repeat an id are one document in the components. An empty table
    gives no rows. Further columns of ``docs`` are ignored, whatever their names.
    """
    reachable(docs.sparkSession)
    plain = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))
    made = cut(plain.mapInArrow(_sketches(k, bands, rows), "id long, n_shingles long, h1 long, h2 long, keys array<long>"), "sketches")
    n = made.count()
    full = made.where("id is not null and n_shingles > 0")
    # Equal sets have equal keys, so any member's will do.
    classes = cut(full.groupBy("h1", "h2", "n_shingles").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.any_value("keys").alias("keys")), "classes", n * 10)
    heads = classes.select("id", "n_shingles", "keys")
    links = verified_links(plain, heads, k, percent, n, bands)
    same = full.select("id", "h1", "h2", "n_shingles").join(classes.where("copies > 1").select("h1", "h2", "n_shingles", F.col("id").alias("rep")), ["h1", "h2", "n_shingles"]).where("id <> rep").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    # Copies follow their class; only an id with several texts makes a class reach further, which its links then carry.
    whole = cut(components(same.union(links) if links is not None else same), "components", 2 * n)
    out = made.select("id", "n_shingles").join(whole, "id", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_column), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def verified_links(plain: DataFrame, heads: DataFrame, k: int, percent: int, n: int, bands: int) -> DataFrame | None:
    """Confirmed links ``(u, v)`` between class heads, enough of them to join every linked pair of a bucket.

    ``n`` is the number of documents; it sizes the tables written on the way.
    """
    rows = heads.select("id", "n_shingles", F.explode("keys").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    crowded = cut(rows.join(sizes, "bucket"), "buckets", n * bands)
    if crowded.isEmpty():
        return None
    weights = cut(crowded.groupBy("id").agg(F.sum("size").alias("weight")), "weights", n)
    sets = cut(plain.where("text is not null").join(weights.select("id"), "id", "left_semi").mapInArrow(_sets(k), "id long, shingles array<long>"), "sets")

    def confirm(pairs: DataFrame) -> DataFrame:
        """Those of the candidate pairs whose full sets are similar enough."""
        a, b = sets.select(F.col("id").alias("u"), F.col("shingles").alias("su")), sets.select(F.col("id").alias("v"), F.col("shingles").alias("sv"))
        both = pairs.join(a, "u").join(b, "v").select("u", "v", F.size("su").alias("nu"), F.size("sv").alias("nv"), F.size(F.array_intersect("su", "sv")).alias("common"))
        return both.where(F.lit(100) * F.col("common") >= F.lit(percent) * (F.col("nu") + F.col("nv") - F.col("common"))).select("u", "v")

    def may_reach(n: Column, m: Column) -> Column:
        return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)

    small = crowded.where(F.col("size") <= SMALL)
    a, b = small.select("bucket", F.col("id").alias("v"), F.col("n_shingles").alias("m")), small.select("bucket", F.col("id").alias("u"), F.col("n_shingles").alias("n"))
    first = b.join(a, "bucket").where((F.col("u") > F.col("v")) & may_reach(F.col("n"), F.col("m"))).select("u", "v").distinct()
    links = cut(confirm(cut(first, "pairs", n * SMALL)), "links")

    large = cut(crowded.where(F.col("size") > SMALL).join(weights, "id").select("bucket", "id", "n_shingles", "weight"), "large", n * bands)
    m = large.count()
    if not m:
        return links
    # Every member of a crowded bucket is compared with its hub, the member that shares most buckets with others.
    hub = F.max(F.struct("weight", (-F.col("id")).alias("least"), "n_shingles")).alias("h")
    hubs = cut(large.groupBy("bucket").agg(hub).select("bucket", (-F.col("h.least")).alias("hub"), F.col("h.n_shingles").alias("m")), "hubs", m)
    around = large.join(hubs, "bucket").where((F.col("id") != F.col("hub")) & may_reach(F.col("n_shingles"), F.col("m")))
    pairs = cut(around.select(F.greatest("id", "hub").alias("u"), F.least("id", "hub").alias("v")).distinct(), "pairs", m)
    links = links.union(cut(confirm(pairs), "links"))
    of = cut(components(links), "components", 2 * n)
    now = large.join(of, "id", "left").join(hubs.select("bucket", "hub"), "bucket").select("bucket", "hub", "id", "n_shingles", F.coalesce("component_id", "id").alias("c"))
    now = cut(now, "now", m)
    # Buckets in several components, gathered by hub: each of their documents once.
    open_ = now.groupBy("bucket").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x < y").select("bucket")
    members = now.join(open_, "bucket", "left_semi").select("hub", "id", "n_shingles", "c").distinct()
    home = of.select(F.col("id").alias("hub"), F.col("component_id").alias("home"))
    members = cut(members.join(home, "hub", "left").withColumn("away", F.col("c") != F.coalesce("home", "hub")).drop("home"), "members", m)
    counts = members.groupBy("hub").agg(F.ceil(F.count_if("away") / BLOCK).cast("int").alias("a"), F.ceil(F.count("*") / BLOCK).cast("int").alias("b"))
    spread = members.join(cut(counts, "counts", n), "hub").join(sets, "id")
    at, zero = F.pmod(F.hash("id"), "b"), F.lit(0)
    right = F.transform(F.sequence(zero, F.col("a") - 1), lambda i: F.struct(F.lit(1).alias("side"), i.alias("i"), at.alias("j")))
    left = F.transform(F.sequence(zero, F.col("b") - 1), lambda j: F.struct(zero.alias("side"), F.pmod(F.hash("id"), "a").alias("i"), j.alias("j")))
    tasks = spread.where("a > 0").withColumn("t", F.explode(F.when(F.col("away"), F.concat(right, left)).otherwise(right)))
    tasks = tasks.select("hub", "c", "shingles", F.col("t.side").alias("side"), F.col("t.i").alias("i"), F.col("t.j").alias("j"))
    more = cut(tasks.groupBy("hub", "i", "j").applyInArrow(_between(percent), "u long, v long"), "between")
    return of.select(F.col("id").alias("u"), F.col("component_id").alias("v")).union(more)


def _between(percent: int):
    """Pairs of components that a link joins, from a block of rows against another: counts of common shingles are
    products of incidence matrices, some columns at a time."""

    def sets_of(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lists = rows.column("shingles").combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy()
        return rows.column("c").to_numpy(), sizes, lists.flatten().to_numpy()

    def incidence(row: np.ndarray, column: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
        out = np.zeros(shape, dtype=np.float32)
        out[row, column] = 1
        return out

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        (ca, na, fa), (cb, nb, fb) = (sets_of(table.filter(pa.array(side == s))) for s in (0, 1))
        common = np.zeros((len(ca), len(cb)), dtype=np.float32)
        shared = np.intersect1d(fa, fb)
        placed = []
        for flat, n in ((fa, na), (fb, nb)):
            row = np.repeat(np.arange(len(n)), n)
            at = np.minimum(np.searchsorted(shared, flat), max(0, len(shared) - 1))
            hit = shared[at] == flat if len(shared) else np.zeros(len(flat), bool)
            order = np.argsort(at[hit], kind="stable")
            placed.append((row[hit][order], at[hit][order]))
        for start in range(0, len(shared), COLUMNS):
            parts = []
            for (row, at), n in zip(placed, (len(ca), len(cb)), strict=True):
                lo, hi = np.searchsorted(at, [start, start + COLUMNS])
                parts.append(incidence(row[lo:hi], at[lo:hi] - start, (n, COLUMNS)))
            common += parts[0] @ parts[1].T
        common = common.astype(np.int64)  # sums of ones, exact below 2**24
        union = na[:, None].astype(np.int64) + nb[None, :] - common
        linked = (100 * common >= percent * union) & (ca[:, None] != cb[None, :])
        i, j = np.nonzero(linked)
        edges = np.unique(np.stack([np.maximum(ca[i], cb[j]), np.minimum(ca[i], cb[j])], axis=1), axis=0)
        return pa.table({"u": pa.array(edges[:, 0], pa.int64()), "v": pa.array(edges[:, 1], pa.int64())})

    return run
