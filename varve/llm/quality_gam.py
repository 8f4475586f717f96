"""A quality classifier: a generalised additive model with pairwise interactions over text features.

Cyclic boosting visits the features in turn; each visit fits a shallow tree to the gradient summed by bin, and adds its
leaves to the feature's lookup table. Pairs of features that explain most of what is left are boosted the same way in
two dimensions. A score is a sum of table entries, looked up for whole batches at once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import cut, reachable

FEATURES = (
    "log_chars", "log_words", "word_length", "long_word", "distinct_words", "top_word", "repeated_next",
    "upper", "digit", "space", "stop", "comma", "symbol", "bar", "exclamation", "non_ascii", "line_words", "repeated_lines", "sentence_words", "entropy",
)
SAMPLE = 20_000  # labelled rows that a model is fitted on, the least by hash of their id
BINS, PAIR_BINS, ROUNDS, PAIRS, PAIR_ROUNDS, RATE = 24, 6, 120, 6, 40, 0.15


def _classes() -> np.ndarray:
    kind = np.zeros((256, 9), dtype=np.float64)
    byte = np.arange(256)
    kind[(byte >= 65) & (byte <= 90), 0] = 1
    kind[(byte >= 48) & (byte <= 57), 1] = 1
    kind[(byte == 32) | ((byte >= 9) & (byte <= 13)), 2] = 1
    kind[byte == ord("."), 3] = 1
    kind[byte == ord(","), 4] = 1
    kind[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,!|"], 5] = 1
    kind[byte == ord("|"), 6] = 1
    kind[byte == ord("!"), 7] = 1
    kind[byte >= 128, 8] = 1
    return kind


_KIND = _classes()


def text_features(text: str | None) -> list[float]:
    """The features of one whole text; null counts as empty, and an empty text has zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    data = text.encode("utf-8", "surrogatepass")
    count = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    share = count / len(data)
    kinds = share @ _KIND
    seen = share[share > 0]
    words = text.split()
    n = len(words) or 1
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    top = max(counts.values(), default=0)
    return [
        math.log1p(len(text)), math.log1p(len(words)), (len(text) - len(words)) / n, max(map(len, counts), default=0), len(counts) / math.sqrt(n), top / n,
        sum(map(eq, words, words[1:])) / n, *(float(k) for k in kinds), len(words) / max(1, len(lines)), 1 - len(set(lines)) / max(1, len(lines)),
        len(words) / (1 + count[46]), float(-(seen * np.log(seen)).sum()),
    ]


def features(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, x)``: the features of every whole text, one row per row."""
    reachable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [text_features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["id", "x"])

    return docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text")).mapInArrow(run, "id long, x array<double>")


@dataclass
class Gam:
    """``offset`` plus one table entry per feature and per pair; ``edges`` and ``pair_edges`` part values into bins."""

    offset: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.offset)
        for j, (edge, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edge, x[:, j], side="right")]
        coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], side="right") for j in {j for p in self.pairs for j in p}}
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _tree(gradient: np.ndarray, weight: np.ndarray, depth: int = 2) -> np.ndarray:
    """The leaf values, by bin, of a tree over binned sums of gradient and weight."""
    out = np.full(len(gradient), gradient.sum() / (weight.sum() + 1))
    if depth and len(gradient) > 1:
        g, w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
        gain = g**2 / (w + 1) + (gradient.sum() - g) ** 2 / (weight.sum() - w + 1)
        at = int(np.argmax(gain)) + 1
        out[:at], out[at:] = _tree(gradient[:at], weight[:at], depth - 1), _tree(gradient[at:], weight[at:], depth - 1)
    return out


def _pair_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree with one cut along the first axis and one along the second on either side, and its gain."""
    best, gain = np.zeros_like(gradient), 0.0
    for cut_at in range(1, gradient.shape[0]):
        made = np.empty_like(gradient)
        for side in (slice(None, cut_at), slice(cut_at, None)):
            made[side] = _tree(gradient[side].sum(0), weight[side].sum(0), 1)
        now = float((2 * gradient * made - weight * made**2).sum())
        if now > gain:
            best, gain = made, now
    return best, gain


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Fit on rows of features and labels 0 or 1. Without labels every score is 0.5; with one class, near that class."""
    if not len(y):
        return Gam()
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = Gam(offset=float(np.log(rate / (1 - rate))))
    if len(np.unique(y)) < 2:
        return model
    model.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    binned = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    total = np.full(len(y), model.offset)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, bin_ in enumerate(binned):
            g, w = slopes()
            size = len(model.tables[j])
            step = RATE * _tree(np.bincount(bin_, g, size), np.bincount(bin_, w, size))
            model.tables[j] += step
            total += step[bin_]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    sizes = [len(e) + 1 for e in model.pair_edges]
    g, w = slopes()

    def grid(a: int, b: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[a] * sizes[b] + coarse[b], v, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b])

    ranked = sorted(((_pair_tree(grid(a, b, g), grid(a, b, w))[1], a, b) for a in range(len(sizes)) for b in range(a)), reverse=True)
    model.pairs = [(a, b) for gain, a, b in ranked[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for i, (a, b) in enumerate(model.pairs):
            g, w = slopes()
            step = RATE * _pair_tree(grid(a, b, g), grid(a, b, w))[0]
            model.pair_tables[i] += step
            total += step[coarse[a], coarse[b]]
    return model


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).cast("binary")) % modulus


def training_rows(labels: DataFrame, label: str, usable: Column, rows: int, id_column: str = "doc_id") -> DataFrame:
    """At most ``rows`` labelled ids, the least by hash: ``(id, y)``, y 0 or 1. Null ids and labels teach nothing."""
    plain = labels.where(usable & F.col(f"`{id_column}`").isNotNull() & F.col(f"`{label}`").isin(0, 1))
    plain = plain.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").cast("int").alias("y")).distinct()
    return plain.orderBy(F.xxhash64("id"), "id", "y").limit(rows)


def score_quality(docs: DataFrame, labels: DataFrame, usable: Column, *, id_column: str = "doc_id", text_column: str = "text", label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, score)``, one row per row of ``docs``: the probability of label 1, from the whole text alone.

    The model is fitted on at most ``sample`` rows of ``labels`` for which ``usable`` holds and whose id is in
    ``docs``. Null and empty texts get the score of all-zero features; rows that repeat an id are scored each; null ids
    stay null. Further columns of either table are ignored. Only the sample's features reach the driver.
    """
    made = cut(features(docs, id_column, text_column), "features")
    known = labels.join(made.select(F.col("id").alias(id_column)).distinct(), id_column, "left_semi")
    chosen = cut(training_rows(known, label, usable, sample, id_column), "sample")
    rows = made.join(chosen, "id").dropDuplicates(["id", "x", "y"]).orderBy(F.xxhash64("id"), "id", "y").limit(sample).toPandas()
    model = fit(np.array(rows["x"].tolist(), dtype=float).reshape(len(rows), len(FEATURES)), rows["y"].to_numpy(dtype=float))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(1).flatten()).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=[id_column, "score"])

    return made.mapInArrow(run, f"`{id_column}` long, score double")
