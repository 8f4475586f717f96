"""The best documents of a whole table for each of a set of items, by an exact search of two trees at once.

A document is a vector of term values, an item a vector of term weights, a score their product. Items and documents each
stand in a tree whose nodes hold the largest value of every coordinate below them. The product of an item node's and a
document node's maxima bounds every score between the two; where it is below the weakest ``k``-th best score of the node's
items, the whole batch of pairs is left. What remains is scored in integers, so results are exact.

Documents are cut into terms once, by task; only terms that some item has are kept. A first share of the documents, by a
hash, is searched to begin with: the ``k``-th best scores in it can only be too low, so they are safe bounds for the
rest. A task builds the tree of a few thousand documents at a time, halved again and again by which of two far ones they
are nearer to, and keeps ``k`` documents an item. Items are searched in blocks of bounded size; nothing that grows with the
documents is broadcast or comes to the driver.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import cut, reachable

BEST = 50
LEAF_DOCUMENTS, FAN = 32, 8
CHUNK_DOCUMENTS, CHUNK_CELLS = 4_096, 16_000_000  # in the tree of documents that a task holds at a time, cells are documents times terms
LEAF_ITEMS = 4
BLOCK_CELLS = 2_000_000  # items times their distinct terms, in a block of items
FIRST_SHARE = 16  # one in so many documents is searched first
PIECE = 1 << 20
EXACT = 1 << 53
NO_ID = (1 << 63) - 1  # stands for a null id, which comes behind equal scores

# Bytes of a term: 0-9, A-Z, a-z and all of characters beyond ASCII.
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def term_counts(text: bytes) -> Counter:
    """How often each term occurs, A-Z lower-cased; long texts are cut between terms and counted piece by piece."""
    if len(text) <= PIECE:
        return Counter(_TERM.findall(text.lower()))
    out: Counter = Counter()
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE)
        end = gap.start() if gap else len(text)
        out.update(_TERM.findall(text[at:end].lower()))
        at = end
    return out


def _counted(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, terms, tfs = [], [], []
            for text in batch.column(1):
                found = term_counts(text.as_buffer().to_pybytes()) if text.is_valid else Counter()
                lengths.append(sum(found.values()))
                known = sorted((vocabulary[t], n) for t, n in found.items() if t in vocabulary)
                terms.append([t for t, _ in known])
                tfs.append([n for _, n in known])
            columns = [batch.column(0), batch.column(2), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "first", "n", "terms", "tfs"])

    return run


@dataclass
class Tree:
    """Nodes over vectors: ``children[i]`` are the nodes below node ``i``, ``members[i]`` the vectors of a leaf."""

    maxima: np.ndarray
    children: list[list[int]]
    members: list[np.ndarray | None]
    root: int


def halved(rows: np.ndarray) -> np.ndarray:
    """The rows by how much nearer they are to one of two far ones than to the other."""
    a = rows[np.argmin(rows @ rows.sum(axis=0))]
    b = rows[np.argmin(rows @ a)]
    return np.argsort(rows @ (a - b), kind="stable")


def item_tree(weights: np.ndarray) -> Tree:
    """A binary tree of the rows of ``weights``: the rows nearer to one of two far ones, and the others, half and half."""
    maxima: list[np.ndarray] = []
    children: list[list[int]] = []
    members: list[np.ndarray | None] = []

    def grow(rows: np.ndarray) -> int:
        below: list[int] = []
        if len(rows) > LEAF_ITEMS:
            order = halved(weights[rows])
            half = len(rows) // 2
            below = [grow(rows[order[:half]]), grow(rows[order[half:]])]
        maxima.append(weights[rows].max(axis=0))
        children.append(below)
        members.append(None if below else rows)
        return len(maxima) - 1

    root = grow(np.arange(len(weights)))
    return Tree(np.array(maxima), children, members, root)


@dataclass
class Items:
    """A block of items as tasks get it: the terms' weights, the items' rows over the terms, and the tree of the rows."""

    rows: np.ndarray
    tree: Tree
    exact: bool  # whether all scores are whole numbers that a double holds


def block_of(terms: list[list[int]], weights: np.ndarray) -> Items:
    rows = np.zeros((len(terms), len(weights)), dtype=np.float64)
    for row, held in zip(rows, terms, strict=True):
        row[held] = weights[held]
    return Items(rows, item_tree(rows), bool(rows.sum(axis=1).max(initial=0) * 1e6 < EXACT))


def _values(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    m = 50 + (50 * n * documents) // total
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


class Search:
    """The ``k`` best documents of each item among those a task has seen, with the number of pairs scored."""

    def __init__(self, items: Items, k: int, floors: np.ndarray):
        self.items, self.k = items, k
        self.floors = floors  # of each item: no document below it can be among the best
        self.weakest = floors.copy()
        self.scores = [np.empty(0, dtype=np.int64) for _ in floors]
        self.ids: list[np.ndarray] = [np.empty(0, dtype=np.int64) for _ in floors]
        self.scored = 0
        self._bounds()

    def _bounds(self) -> None:
        tree = self.items.tree
        self.least = np.empty(len(tree.children))
        for i, (below, rows) in enumerate(zip(tree.children, tree.members, strict=True)):  # children come before parents
            self.least[i] = self.weakest[rows].min() if rows is not None else min(self.least[j] for j in below)

    def take(self, item: int, scores: np.ndarray, ids: np.ndarray) -> bool:
        """Add documents of an item; whether its weakest score rose."""
        scores, ids = np.concatenate([self.scores[item], scores]), np.concatenate([self.ids[item], ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[item], self.ids[item] = scores[order], ids[order]
        if len(order) == self.k and self.scores[item][-1] > self.weakest[item]:
            self.weakest[item] = self.scores[item][-1]
            return True
        return False

    def visit(self, ids: np.ndarray, bounds: np.ndarray, terms: np.ndarray, values: np.ndarray) -> None:
        """All documents of a chunk, in the order that they stand in: entries ``bounds[i]:bounds[i + 1]`` are of document ``i``."""
        used, column = np.unique(terms, return_inverse=True)
        rows, upper = self.items.rows[:, used], self.items.tree.maxima[:, used]
        owner = np.repeat(np.arange(len(ids)), np.diff(bounds))
        nodes = [self._maxima(owner // LEAF_DOCUMENTS, column, values, -(-len(ids) // LEAF_DOCUMENTS), len(used))]
        while len(nodes[-1]) > 1:
            last = nodes[-1]
            nodes.append(np.array([last[i : i + FAN].max(axis=0) for i in range(0, len(last), FAN)]))
        stack = [(len(nodes) - 1, 0, [self.items.tree.root])]
        while stack:
            level, at, pairs = stack.pop()
            alive = self._alive(pairs, upper, nodes[level][at])
            if not alive:
                continue
            if level:
                # Both trees are gone down by one: what is left of the item nodes, split, meets each document node below.
                split = [j for i in alive for j in (self.items.tree.children[i] or [i])]
                below = range(at * FAN, min(len(nodes[level - 1]), (at + 1) * FAN))
                stack += [(level - 1, b, split) for b in reversed(below)]
                continue
            while any(self.items.tree.children[i] for i in alive):
                alive = self._alive([j for i in alive for j in (self.items.tree.children[i] or [i])], upper, nodes[0][at])
            if alive:
                members = np.concatenate([self.items.tree.members[i] for i in alive])
                members = members[self._reach(rows[members] @ nodes[0][at], self.weakest[members])]
                if len(members):
                    self._score(members, rows, ids, bounds, column, values, at)

    @staticmethod
    def _maxima(node: np.ndarray, column: np.ndarray, values: np.ndarray, n: int, width: int) -> np.ndarray:
        out = np.zeros((n, width))
        np.maximum.at(out, (node, column), values)
        return out

    @staticmethod
    def _reach(bound: np.ndarray, weakest: np.ndarray) -> np.ndarray:
        """A bound that is a sum of doubles may be rounded, so it is taken a little higher."""
        return (bound > 0) & (bound * (1 + 1e-9) >= weakest)

    def _alive(self, pairs: list[int], upper: np.ndarray, maxima: np.ndarray) -> list[int]:
        at = np.array(pairs)
        return at[self._reach(upper[at] @ maxima, self.least[at])].tolist()

    def _score(self, members: np.ndarray, rows: np.ndarray, ids: np.ndarray, bounds: np.ndarray, column: np.ndarray, values: np.ndarray, leaf: int) -> None:
        first, last = leaf * LEAF_DOCUMENTS, min(len(ids), (leaf + 1) * LEAF_DOCUMENTS)
        entries = slice(bounds[first], bounds[last])
        used, own = np.unique(column[entries], return_inverse=True)
        kind = np.float64 if self.items.exact else np.int64
        documents = np.zeros((last - first, len(used)), dtype=kind)
        documents[np.repeat(np.arange(last - first), np.diff(bounds[first : last + 1])), own] = values[entries]
        scores = (documents @ rows[members][:, used].astype(kind).T).astype(np.int64)
        self.scored += scores.size
        rose = False
        for j, item in enumerate(members.tolist()):
            good = np.flatnonzero((scores[:, j] > 0) & (scores[:, j] >= self.weakest[item]))
            if len(good):
                rose |= self.take(item, scores[good, j], ids[first + good])
        if rose:
            self._bounds()


def document_order(bounds: np.ndarray, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Documents in the order of the leaves of their tree."""
    used, column = np.unique(terms, return_inverse=True)
    rows = np.zeros((len(bounds) - 1, len(used)), dtype=np.float32)
    rows[np.repeat(np.arange(len(rows)), np.diff(bounds)), column] = values
    out, stack = [], [np.arange(len(rows))]
    while stack:
        some = stack.pop()
        if len(some) <= LEAF_DOCUMENTS:
            out.append(some)
            continue
        order = halved(rows[some])
        half = -(-len(some) // (2 * LEAF_DOCUMENTS)) * LEAF_DOCUMENTS  # leaves are whole, but for the last one
        stack += [some[order[half:]], some[order[:half]]]
    return np.concatenate(out)


def _searched(held: list[list[int]], weights: np.ndarray, k: int, floors: np.ndarray, documents: int, total: int):
    def chunk(search: Search, ids: pa.Array, n: np.ndarray, bounds: np.ndarray, terms: np.ndarray, tfs: np.ndarray) -> None:
        values = _values(tfs, np.repeat(n, np.diff(bounds)), documents, total)
        order = document_order(bounds, terms, values * weights[terms])
        sizes = np.diff(bounds)[order]
        entry = np.repeat(bounds[order] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        search.visit(ids[order], np.concatenate([[0], np.cumsum(sizes)]), terms[entry], values[entry])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(block_of(held, weights), k, floors)
        most = max(LEAF_DOCUMENTS, min(CHUNK_DOCUMENTS, CHUNK_CELLS // max(1, len(weights))))
        for batch in batches:
            ids, n = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
            bounds = batch.column(2).offsets.to_numpy().astype(np.int64)
            terms, tfs = batch.column(2).values.to_numpy(), batch.column(3).values.to_numpy()
            at = 0
            while at < len(n):
                end = min(len(n), at + most)
                part = slice(bounds[at], bounds[end])
                chunk(search, ids[at:end], n[at:end], bounds[at : end + 1] - bounds[at], terms[part], tfs[part])
                at = end
        item = np.repeat(np.arange(len(floors)), [len(s) for s in search.scores])
        scores = np.concatenate([np.empty(0, dtype=np.int64), *search.scores])
        ids = np.concatenate([np.empty(0, dtype=np.int64), *search.ids])
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["item", "id", "score"])

    return run


def item_blocks(items: Iterable[tuple[object, list[str]]], cells: int) -> Iterator[tuple[list[object], list[str], list[list[int]]]]:
    """Items with their terms, dealt to blocks of at most ``cells`` items times terms, or of one item."""
    ids: list[object] = []
    place: dict[str, int] = {}
    rows: list[list[int]] = []
    for item, terms in items:
        fresh = sum(t not in place for t in terms)
        if ids and (len(ids) + 1) * (len(place) + fresh) > cells:
            yield ids, list(place), rows
            ids, place, rows = [], {}, []
        ids.append(item)
        rows.append([place.setdefault(t, len(place)) for t in terms])
    if ids:
        yield ids, list(place), rows


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [[t.decode() for t in term_counts(x.as_buffer().to_pybytes())] if x.is_valid else [] for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.string()))], names=["item", "terms"])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by_item = Window.partitionBy("item").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, vocabulary: list[str], held: list[list[int]], k: int) -> DataFrame | None:
    place = {t.encode(): i for i, t in enumerate(vocabulary)}
    cut_up = docs.mapInArrow(_counted(place), "id long, first boolean, n long, terms array<int>, tfs array<long>")
    counted = cut(cut_up, "terms")
    documents, total = counted.where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not documents:
        return None
    df = dict(counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # at most one row per term of the block
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(vocabulary))], dtype=np.float64)
    some = counted.where(F.size("terms") > 0)

    def search(part: DataFrame, floors: np.ndarray) -> DataFrame:
        run = _searched(held, weights, k, floors, documents, total)
        return part.select("id", "n", "terms", "tfs").mapInArrow(run, "item int, id long, score long")

    floors = np.zeros(len(held))
    first = cut(_ranked(search(some.where("first"), floors), k).drop("rank"), "first")
    for item, score in first.groupBy("item").agg(F.min("score"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).select("item", "min(score)").collect():
        floors[item] = score  # one row per item of the block
    return _ranked(search(some.where("not first"), floors).unionByName(first), k)


def best_documents(docs: DataFrame, items: DataFrame, k: int = BEST, *, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text", cells: int = BLOCK_CELLS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents with the highest scores above 0 for each item.

    Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. Equal scores come
    by ascending id, rows without an id last (the largest long is taken for one). Rows that repeat a document are ranked
    each; rows that repeat an item's id are one item with all their terms. Null and empty texts have no terms: such
    documents are in no result, such items have none. Empty tables give no rows. Ids of documents are whole numbers.
    Further columns are ignored.

    ``cells`` bounds what is sent to the tasks; each block of items within that bound reads the documents once.
    """
    spark = docs.sparkSession
    reachable(spark)
    texts = docs.select(F.coalesce(F.col(f"`{id_column}`").cast("long"), F.lit(NO_ID)).alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    texts = texts.withColumn("first", F.pmod(F.xxhash64("id"), F.lit(FIRST_SHARE)) == 0)
    named = items.select(F.col(f"`{item_column}`").alias("item"), F.col(f"`{item_text_column}`").cast("string").alias("text"))
    kind = named.schema["item"].dataType.simpleString()
    terms = named.mapInArrow(_item_terms, f"item {kind}, terms array<string>").select("item", F.explode("terms").alias("t")).distinct()
    held = terms.groupBy("item").agg(F.sort_array(F.collect_set("t")).alias("terms")).orderBy("item")
    out = spark.createDataFrame([], f"`{item_column}` {kind}, rank int, `{id_column}` long, score long")
    for ids, vocabulary, rows in item_blocks(((r.item, r.terms) for r in held.toLocalIterator()), cells):
        found = _search_block(texts, vocabulary, rows, k)
        if found is not None:
            names = spark.createDataFrame(list(enumerate(ids)), f"item int, name {kind}")
            doc = F.when(F.col("id") != NO_ID, F.col("id"))
            out = out.unionByName(found.join(names, "item").select(F.col("name").alias(item_column), "rank", doc.alias(id_column), "score"))
    return out
