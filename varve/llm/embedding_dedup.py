"""Near-duplicate vectors by spherical k-means cells and blocked cosine products within cells.

Each vector is a member of the cell of its nearest centre. It also visits every other cell in which a vector at the
cosine asked for could be a member: two unit vectors at cosine ``c`` are ``sqrt(2 - 2c)`` apart, so a vector whose
distance to the plane between two cells is larger has no link across it. Cells then hold all links of their members,
and nothing is lost. Members count the links of their own row only, so each is counted once.

Cells are cut into blocks of random rows, and each pair of a member block with another block is one matrix product,
whatever the size of a cell. Links are not written out: a product gives each row its count and the smallest id of its
component within the product. Equal vectors are one row with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import cut, reachable

COSINE = 0.93
SAMPLE = 20_000  # vectors that the centres are fitted on, the least by hash
CELL = 4_096  # vectors of one label aimed at in a cell
MOST_CELLS = 1_024
BLOCK = 1_024
ROUNDS = 12


def fit_centres(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means on unit vectors, begun at spread-out rows of the sample; an empty cell keeps its centre."""
    centres = [x[0]]
    nearest = x @ centres[0]
    while len(centres) < min(k, len(x)):
        centres.append(x[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, x @ centres[-1])
    c = np.array(centres)
    for _ in range(ROUNDS):
        own = np.argmax(x @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 1e-12, total / np.maximum(size, 1e-12), c)
    return c


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that neither squares nor their sum leave the range."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(centres: np.ndarray, reach: float):
    """Rows ``(cell, visitor, ...)`` for each vector's own cell and those that it visits."""
    gaps = np.linalg.norm(centres[:, None, :] - centres[None, :, :], axis=2) if len(centres) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(batch.schema.get_field_index("v"))
            dims = batch.column(batch.schema.get_field_index("dims")).to_numpy()
            row, cell, visitor = [np.empty(0, np.int64)] * 3
            flat, at = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate([[0], np.cumsum(dims)])
            row, cell, visitor = [], [], []
            usable = dims == (centres.shape[1] if len(centres) else -1)
            some = np.flatnonzero(usable)
            for start in range(0, len(some), 1024):
                rows = some[start : start + 1024]
                x = _unit(np.stack([flat[at[i] : at[i + 1]] for i in rows]))
                near = x @ centres.T
                own = np.argmax(near, axis=1)
                lead = near[np.arange(len(rows)), own][:, None] - near
                r, c = np.nonzero(lead <= reach * gaps[own] + 1e-9)
                row.append(rows[r])
                cell.append(c)
                visitor.append(c != own[r])
            rest = np.flatnonzero(~usable)
            row.append(rest)
            cell.append(np.full(len(rest), -1))
            visitor.append(np.zeros(len(rest), bool))
            row, cell, visitor = (np.concatenate(a) for a in (row, cell, visitor))
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cell, pa.int32()), pa.array(visitor, pa.bool_())], names=[*batch.schema.names, "cell", "visitor"])

    return run


def _product(cosine: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left, right = rows[rows.side == 0], rows[rows.side == 1]
        same = not len(right) and bool(rows["same"].iloc[0])
        right = left if same else right
        none = pd.DataFrame({"id": np.empty(0, np.int64), "links": np.empty(0, np.int64), "root": np.empty(0, np.int64)})
        if not len(left) or not len(right):
            return none
        a, b = _unit(np.array(left.v.tolist(), dtype=float)), _unit(np.array(right.v.tolist(), dtype=float))
        link = a @ b.T >= cosine
        if same:
            np.fill_diagonal(link, False)
        ids, others = left.id.to_numpy(), right.id.to_numpy()
        hit_a, hit_b = link.any(axis=1), link.any(axis=0)
        links = link @ right.n.to_numpy().astype(np.int64)
        link, others = link[hit_a][:, hit_b], others[hit_b]
        far = np.iinfo(np.int64).max
        root, other_root = ids[hit_a].copy(), others.copy()
        while root.size:  # the smallest id reachable within this product
            new = np.minimum(root, np.where(link, other_root[None, :], far).min(axis=1))
            new_other = np.minimum(other_root, np.where(link, new[:, None], far).min(axis=0))
            if (new == root).all() and (new_other == other_root).all():
                break
            root, other_root = new, new_other
        counted = pd.DataFrame({"id": ids[hit_a], "links": links[hit_a], "root": root})
        return pd.concat([counted, pd.DataFrame({"id": others, "links": np.zeros(len(others), np.int64), "root": other_root})]) if not same else counted

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, *, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", cells: int | None = None) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``.

    Vectors of equal, non-null labels and equal length are linked if their cosine is at least ``cosine``, in double
    precision. Null or empty vectors, zero vectors and those with a null or non-finite component link with nothing;
    neither do rows without an id, which have a null component and are not kept. ``n_links`` counts other rows, equal
    vectors among them. ``component_id`` is the smallest id reachable, itself included; rows that repeat an id share
    their links and component. Further columns are ignored; an empty table gives no rows.

    The centres are fitted on at most ``SAMPLE`` vectors; all vectors are assigned. ``cells`` is chosen from the size
    of the largest label if it is not given, ``MOST_CELLS`` at most; blocks bound every task also beyond that.
    """
    spark = vectors.sparkSession
    reachable(spark)
    named = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label_column}`").alias("label"), F.col(f"`{vector_column}`").cast("array<double>").alias("v"))
    sound = (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(sound)
    keyed = usable.withColumn("h1", F.xxhash64("label", "v")).withColumn("h2", F.xxhash64(F.lit(1), "v", "label"))
    heads = cut(keyed.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.any_value("label").alias("label"), F.any_value("v").alias("v")), "heads")
    out = named.select("id", F.when(sound & F.col("label").isNotNull(), F.xxhash64("label", "v")).alias("h1"), F.when(sound & F.col("label").isNotNull(), F.xxhash64(F.lit(1), "v", "label")).alias("h2"))
    sized = heads.withColumn("dims", F.size("v"))
    most = sized.groupBy("dims", "label").agg(F.count("*").alias("c")).groupBy("dims").agg(F.sum("c").alias("c"), F.max("c").alias("largest")).orderBy(F.col("c").desc(), "dims").first()
    centres = np.empty((0, 0))
    if most:
        k = cells or min(MOST_CELLS, math.ceil(most["largest"] / CELL))
        rows = sized.where(F.col("dims") == most["dims"]).orderBy("h1", "h2").limit(SAMPLE).select("v").collect()
        centres = fit_centres(_unit(np.array([r[0] for r in rows], dtype=float)), k)
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))
    kind = heads.schema["label"].dataType.simpleString()
    placed = cut(sized.select("id", "n", "label", "dims", "v").mapInArrow(_cells(centres, reach), f"id long, n long, label {kind}, dims int, v array<double>, cell int, visitor boolean"), "cells")
    place = ["label", "dims", "cell"]
    blocks = cut(placed.groupBy(*place).agg(F.ceil(F.count_if(~F.col("visitor")) / BLOCK).cast("int").alias("members"), F.ceil(F.count_if("visitor") / BLOCK).cast("int").alias("visitors")).where("members > 0"), "blocks")
    numbered = placed.join(blocks, place)
    own = F.when(F.col("visitor"), F.pmod(F.hash("id"), F.greatest("visitors", F.lit(1)))).otherwise(F.pmod(F.hash("id"), "members"))
    # A member block is the left side against all blocks, and the right side of other member blocks; visitors are right sides.
    members, visitors = F.sequence(F.lit(0), F.col("members") - 1), F.sequence(F.lit(0), F.col("visitors") - 1)
    against = F.transform(members, lambda b: F.struct(F.lit(0).alias("side"), own.alias("a"), b.alias("b"), F.lit(False).alias("guest")))
    guests = F.when(F.col("visitors") > 0, F.transform(visitors, lambda b: F.struct(F.lit(0).alias("side"), own.alias("a"), b.alias("b"), F.lit(True).alias("guest"))))
    as_right = F.transform(F.filter(members, lambda a: a != own), lambda a: F.struct(F.lit(1).alias("side"), a.alias("a"), own.alias("b"), F.lit(False).alias("guest")))
    as_guest = F.transform(members, lambda a: F.struct(F.lit(1).alias("side"), a.alias("a"), own.alias("b"), F.lit(True).alias("guest")))
    empty = F.array().cast("array<struct<side:int,a:int,b:int,guest:boolean>>")
    tasks = F.when(F.col("visitor"), as_guest).otherwise(F.concat(against, F.coalesce(guests, empty), as_right))
    spread = numbered.select("id", "n", "v", *place, F.explode(tasks).alias("t")).select("id", "n", "v", *place, "t.*")
    spread = spread.withColumn("same", (F.col("a") == F.col("b")) & ~F.col("guest"))
    found = cut(spread.groupBy(*place, "a", "b", "guest").applyInPandas(_product(cosine), "id long, links long, root long"), "products")
    whole = components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    heads_out = heads.select("h1", "h2", F.col("id").alias("head"), "n").join(links.withColumnRenamed("id", "head"), "head", "left")
    heads_out = heads_out.join(whole.withColumnRenamed("id", "head"), "head", "left")
    heads_out = cut(heads_out.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "head").alias("c")), "heads")
    done = out.join(heads_out, ["h1", "h2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("c", "id"))
    return done.select(F.col("id").alias(id_column), F.when(F.col("id").isNull(), F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
