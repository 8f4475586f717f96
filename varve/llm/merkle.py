"""A Merkle manifest of a table: a tree of digests per group, the groups' roots in a tree above, and a proof per row.

Rows are leaves, in each group by ascending id. Every ``FAN`` consecutive nodes have one parent, the digest of their
digests; a last run may be shorter, down to a single node. No rows are sorted to find their places: each group has a
bitmap of its ids, merged from the tasks' bitmaps and kept as its non-zero words, one row each, so that gaps take no
room. A directory of popcounts over the words, summed level by level, says how many ids lie before a word, and the bits
below an id in its word say the rest. Rows whose place follows from that are dealt to blocks of ``FAN ** LEVELS``
neighbours, where an array keyed by slot takes them and gives ``LEVELS`` levels of the tree at once. Blocks are the nodes
of the next round, until one is left. Proofs come back down the same rounds: a block hands each of its nodes the siblings
above it.

A task holds one block at a time. The hash function is SHA-256, digests are hexadecimal text where they are hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varve.operators.series import POSITION, position_levels, with_position

from .store import cut, reachable

FAN, LEVELS = 8, 3
BLOCK = FAN**LEVELS
WORD_BITS, DIGIT_BITS, DIGITS = 6, 15, 4  # ids to a word; words are numbers of 58 bits, in four digits
NO_ID = -(1 << 57) - 1  # the word of rows without an id, before all others
DIGEST = 32


def leaf_digest(values: Sequence[Column]) -> Column:
    """The digest of a row: each value as ``-`` where it is null, else as its length in bytes, ``:``, and its text."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; texts of ASCII only take the short way."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def _directory(words: DataFrame) -> DataFrame:
    """``words`` with ``before``, the rows of the group in earlier words, and ``size``, the rows of the group.

    Sums run within the words that share all digits but the last, then within what is above them, so a task orders no
    more than ``2 ** DIGIT_BITS`` of them at a time, however the ids are spread.
    """
    up = F.shiftright("word", DIGIT_BITS)
    levels = [words.select("key", "word", "n")]
    for _ in range(DIGITS - 1):
        levels.append(levels[-1].groupBy("key", up.alias("word")).agg(F.sum("n").alias("n")))
    sizes = levels[-1].groupBy("key").agg(F.sum("n").alias("size"))

    def earlier(*keys: Column | str) -> Column:
        w = Window.partitionBy(*keys).orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(w), F.lit(0))

    known = levels[-1].select("key", "word", earlier("key").alias("before"))
    for level in reversed(levels[:-1]):
        above = known.select("key", F.col("word").alias("up"), F.col("before").alias("above"))
        inside = level.select("key", "word", up.alias("up"), earlier("key", up).alias("inside"))
        known = inside.join(above, ["key", "up"]).select("key", "word", (F.col("inside") + F.col("above")).alias("before"))
    return known.join(sizes, "key")


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` (``key, id, leaf`` and more) with ``pos``, from 0, in their group by ascending id, and the group's ``size``.

    Rows without an id come first. Rows that share an id come by their leaf digest; they are told apart by exact
    positions that never put a hot id into one task.
    """
    word = F.coalesce(F.shiftright("id", WORD_BITS), F.lit(NO_ID))
    low = F.coalesce(F.col("id").bitwiseAND(2**WORD_BITS - 1), F.lit(0)).cast("int")
    at = rows.withColumns({"word": word, "low": low})
    bit = F.expr("shiftleft(1L, low)")
    words = cut(at.groupBy("key", "word").agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n")), "bitmaps")
    directory = words.join(_directory(words), ["key", "word"])
    found = at.join(directory, ["key", "word"])
    shared = F.col("n") > F.bit_count("bits")
    below = F.bitwise_not(F.expr("shiftleft(-1L, low)"))
    rank = F.bit_count(F.col("bits").bitwiseAND(below))
    columns = [*rows.columns, "size"]
    out = found.where(~shared).select(*columns, (F.col("before") + rank).alias("pos"))
    if words.where(shared).isEmpty():
        return out
    again = cut(found.where(shared).select(*columns, "word", "low", "before"), "shared")
    again, levels = position_levels(again, ["key", "word"], ["low", "leaf"])
    ordered = with_position(again, ["key", "word"], ["low", "leaf"], levels)
    return out.unionByName(ordered.select(*columns, (F.col("before") + F.col(POSITION) - 1).alias("pos")))


def _hash(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def raised(nodes: list[bytes], whole: bool) -> list[list[bytes]]:
    """The levels above the nodes of a block: ``LEVELS`` of them, or up to one node where the block is the whole tree."""
    levels = [nodes]
    while len(levels[-1]) > 1 or (not whole and len(levels) <= LEVELS):
        last = levels[-1]
        levels.append([_hash(b"".join(last[i : i + FAN])) for i in range(0, len(last), FAN)])
    return levels


def siblings(levels: list[list[bytes]], i: int, start: int = 0) -> list[tuple[bytes, bytes]]:
    """What stands left and right of node ``i`` of level ``start`` and of the nodes above it, level by level."""
    out = []
    for level in levels[start:-1]:
        first = i - i % FAN
        out.append((b"".join(level[first:i]), b"".join(level[i + 1 : first + FAN])))
        i //= FAN
    return out


def _filled(slots: np.ndarray, digests: pa.ChunkedArray, n: int) -> bytes:
    if len(slots) != n or len(np.unique(slots)) != n or slots.max() != n - 1:
        raise RuntimeError(f"{len(slots)} nodes for {n} slots")
    out = np.empty((n, DIGEST), dtype=np.uint8)
    out[slots] = np.frombuffer(b"".join(digests.to_pylist()), dtype=np.uint8).reshape(-1, DIGEST)
    return out.tobytes()


def _nodes(data: bytes) -> list[bytes]:
    text = data.hex().encode()
    return [text[i : i + 2 * DIGEST] for i in range(0, len(text), 2 * DIGEST)]


def _gathered(group: pa.Table) -> pa.Table:
    """One row of a block: its digests by slot, the digest at its top, and for leaves their ids and claimed digests."""
    key, block, size = (group.column(c)[0].as_py() for c in ("key", "block", "size"))
    n = min(BLOCK, size - block * BLOCK)
    slots = group.column("slot").to_numpy()
    digests = _filled(slots, group.column("digest"), n)
    top = raised(_nodes(digests), size <= BLOCK)[-1][0]
    columns = {"key": [key], "block": [block], "size": [size], "top": [bytes.fromhex(top.decode())], "digests": [digests]}
    if "id" in group.column_names:
        ids: list = [None] * n
        for slot, i in zip(slots.tolist(), group.column("id").to_pylist(), strict=True):
            ids[slot] = i
        columns |= {"ids": pa.array([ids], pa.list_(pa.int64())), "claimed": [_filled(slots, group.column("claimed"), n)]}
    return pa.table(columns)


_BLOCK_COLUMNS = "key string, block long, size long, top binary, digests binary"
_HANDED_COLUMNS = "key string, pos long, path array<string>, subroot string"


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """The blocks of every round, from the leaves up; the last one has one block per group, with the group's root as top.

    ``nodes`` are ``key, pos, size, digest``, and ``id, claimed`` for leaves. Groups that are done wait as a single node.
    """
    out: list[DataFrame] = []
    while True:
        extra = [c for c in ("id", "claimed") if c in nodes.columns]
        at = nodes.select("key", F.floor(F.col("pos") / BLOCK).alias("block"), F.pmod("pos", F.lit(BLOCK)).cast("int").alias("slot"), "size", "digest", *extra)
        made = at.groupBy("key", "block").applyInArrow(_gathered, _BLOCK_COLUMNS + (", ids array<long>, claimed binary" if extra else ""))
        out.append(cut(made, "blocks"))
        if out[-1].where(F.col("size") > BLOCK).isEmpty():
            return out
        nodes = out[-1].select("key", F.col("block").alias("pos"), F.ceil(F.col("size") / BLOCK).alias("size"), F.col("top").alias("digest"))


def _handed_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node of a block with its path: what stands left and right of it on each level up to the root."""
    for batch in batches:
        for row in batch.to_pylist():
            levels = raised(_nodes(row["digests"]), row["size"] <= BLOCK)
            paths = [[x.decode() for pair in siblings(levels, i) for x in pair] + row["path"] for i in range(len(levels[0]))]
            n = len(paths)
            arrays = [pa.array([row["key"]] * n), pa.array(range(row["block"] * BLOCK, row["block"] * BLOCK + n), pa.int64()), pa.array(paths, pa.list_(pa.string())), pa.array([row["subroot"]] * n)]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "pos", "path", "subroot"])


def _descend(rounds: list[DataFrame], paths: DataFrame) -> DataFrame:
    """The blocks of the lowest round with the path of each; ``paths`` are those of the highest (``key, block, path, subroot``)."""
    for blocks in reversed(rounds[1:]):
        handed = blocks.select("key", "block", "size", "digests").join(paths, ["key", "block"])
        down = handed.mapInArrow(_handed_down, _HANDED_COLUMNS)
        paths = down.withColumnRenamed("pos", "block")
    return rounds[0].join(paths, ["key", "block"])


def _proved(root: str):
    top = root.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                levels = raised(_nodes(row["digests"]), row["size"] <= BLOCK)
                outer = [x.encode() for x in row["path"]]
                outer_pairs = list(zip(outer[::2], outer[1::2], strict=True))
                proofs, folded = [], []
                for i, (leaf, claimed) in enumerate(zip(levels[0], _nodes(row["claimed"]), strict=True)):
                    if i % FAN == 0:  # neighbours share all that is above them
                        upper = [*siblings(levels, i // FAN, 1), *outer_pairs]
                        upper_text = b"".join(x for pair in upper for x in pair)
                    own = siblings(levels[:2], i)
                    proofs.append(_hash(b"".join(x for pair in own for x in pair) + upper_text).decode())
                    digest = claimed
                    for left, right in [*own, *upper]:
                        digest = _hash(left + digest + right)
                    folded.append(digest)
                n = len(proofs)
                columns = {
                    "id": pa.array(row["ids"], pa.int64()),
                    "leaf": pa.array([x.decode() for x in levels[0]]),
                    "subroot": pa.array([row["subroot"]] * n),
                    "root": pa.array([root] * n),
                    "proof_sha256": pa.array(proofs),
                    "folded_root": pa.array([x.decode() for x in folded]),
                    "verified": pa.array([x == top for x in folded]),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def merkle_manifest(docs: DataFrame, fields: Sequence[str], claimed: dict[str, Column] | None = None, *, id_column: str = "doc_id", group_column: str = "lang") -> DataFrame:
    """``(id, leaf, subroot, root, proof_sha256, folded_root, verified)``, one row per row of ``docs``.

    A leaf is the digest of the ``fields``. ``claimed`` replaces fields by what a reader holds in their place; the leaf of
    that is folded with the siblings of the true tree to ``folded_root``, and ``verified`` says whether the root comes out.
    ``proof_sha256`` is the digest of all siblings on the way up to the root, level by level from left to right.

    Ids are whole numbers. Rows without an id come first in their group; rows that share an id are leaves each, by their
    leaf digest. A null group is a group of its own and comes first, the others follow by their bytes. A lone leaf is its
    group's root. An empty table gives no rows. Columns not named are ignored.
    """
    spark = docs.sparkSession
    reachable(spark)
    value = {f: F.col(f"`{f}`") for f in fields}
    key = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_column}`").cast("string")), F.lit(""))
    held = {**value, **(claimed or {})}
    rows = docs.select(key.alias("key"), F.col(f"`{id_column}`").cast("long").alias("id"), leaf_digest([value[f] for f in fields]).alias("leaf"), leaf_digest([held[f] for f in fields]).alias("claimed"))
    rows = cut(rows, "leaves")
    rounds = _rounds(placed(rows).withColumnRenamed("leaf", "digest"))
    subroots = rounds[-1].select("key", F.col("top").alias("digest"))
    n_groups = subroots.count()
    if not n_groups:
        return spark.createDataFrame([], "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean").select(F.lit(None).cast("long").alias(id_column), "*")
    ranked = with_position(subroots.withColumn("all", F.lit(0)), ["all"], ["key"], [F.substring("key", 1, 2), F.substring("key", 1, 5), F.col("key")])
    ranked = cut(ranked.select(F.col("key").alias("group"), F.lit("").alias("key"), (F.col(POSITION) - 1).alias("pos"), F.lit(n_groups).cast("long").alias("size"), "digest"), "subroots")
    above = _rounds(ranked.drop("group"))
    root = F.lower(F.hex("top"))
    (top,) = above[-1].select(root).first()
    nothing = F.array().cast("array<string>").alias("path")
    highest = above[-1].select("key", "block", nothing, F.lit("").alias("subroot"))
    handed = _descend(above, highest).select("key", "block", "size", "digests", "path", "subroot").mapInArrow(_handed_down, _HANDED_COLUMNS)
    paths = ranked.join(handed.select("pos", "path"), "pos").select(F.col("group").alias("key"), F.lit(0).cast("long").alias("block"), "path", F.lower(F.hex("digest")).alias("subroot"))
    out = _descend(rounds, paths).select("key", "block", "size", "digests", "ids", "claimed", "path", "subroot")
    proved = out.mapInArrow(_proved(top), "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return proved.withColumnRenamed("id", id_column)

