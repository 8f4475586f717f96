"""Toxicity by a weighted lexicon, matched by Aho-Corasick in folded text, with exception phrases.

Folding maps look-alike letters of other scripts, wide letters and digits that stand for letters to one letter
each, drops combining marks, and makes everything that is no letter a blank. The lexicon is learned: whole words, and beginnings of words, whose
are far more frequent in texts labelled toxic than in others. Toxic texts with the same surroundings of a word count
once for it, so copies of a text teach nothing twice. Phrases in which an entry is harmless are exceptions: a match inside one
does not count. A text's sum of weights is divided by a power of its length and put through a logistic curve; power
and curve are fitted too.
"""

from __future__ import annotations

import itertools
import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality_gam import training_rows
from .store import cut, reachable

SAMPLE = 8_000  # labelled rows that a lexicon is learned from, the least by hash of their id
LEAST_SURROUNDINGS = 5
LEAST_WEIGHT = 3.0
LEAST_WORDS = 3  # different words that a beginning must stand for
BEGINNINGS = (3, 4, 5, 6, 7)
POWERS = (0.0, 0.25, 0.5, 1.0)
EXCEPTIONS = ("clown fish", "trash can", "trash bag", "worthless check")

# Letters of other scripts that look like Latin ones, and digits and signs that stand for letters. The
# digit one stands for i and for l, so these two are one letter here.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s",
    "т": "t", "у": "y", "х": "x", "ԝ": "w", "ɡ": "g", "ı": "i", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "γ": "y",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "l": "i",
}


class _Fold(dict):
    """The folded form of each character, worked out when it first occurs."""

    def __missing__(self, code: int) -> str | None:
        out = ""
        for c in unicodedata.normalize("NFKC", chr(code)).casefold():
            kind = unicodedata.category(c)
            if c in LOOKALIKES:
                out += LOOKALIKES[c]
            elif kind[0] == "L":
                out += c
            elif kind not in ("Mn", "Cf"):
                out += " "
        self[code] = out
        return out


FOLD = _Fold()


def folded(text: str | None) -> list[str]:
    """The folded words of a text."""
    return (text or "").translate(FOLD).split()


def _folded_phrase(phrase: str) -> str:
    return " ".join(folded(phrase))


@dataclass
class Lexicon:
    """Terms with weights; a term is ``" word "`` or ``" beginning"``. ``exceptions`` are folded phrases."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    power: float = 0.0
    slope: float = 0.0
    offset: float = 0.0

    def matcher(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        out = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            out.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            out.add_word(f" {phrase} ", (len(phrase) + 2, None))
        out.make_automaton()
        return out

    def score(self, total: float, words: int) -> float:
        z = self.offset + self.slope * total / (1 + words) ** self.power
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def hits(matcher: ahocorasick.Automaton | None, words: list[str]) -> tuple[float, list[int]]:
    """The weight of all words hit, each by its heaviest term, and the places where those words begin."""
    if matcher is None or not words:
        return 0.0, []
    text = f" {' '.join(words)} "
    best: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for end, (length, weight) in matcher.iter(text):
        start = end - length + 1
        if weight is None:
            excused.append((start, end))
        elif weight > best.get(start, -1e9):
            best[start] = weight
    if excused:
        # One sweep: a word is excused if a phrase that begins before it or with it reaches beyond its beginning.
        excused.sort()
        reach, at, left = -1, 0, {}
        for s in sorted(best):
            while at < len(excused) and excused[at][0] <= s:
                reach = max(reach, excused[at][1])
                at += 1
            if reach <= s:
                left[s] = best[s]
        best = left
    return sum(best.values()), sorted(best)


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word: its neighbours where it first occurs in texts of label 1; the number of texts of label 0 that have it."""
    for batch in batches:
        seen: set[tuple[str, str]] = set()
        clean: Counter[str] = Counter()
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = folded(text)
            if y:
                first: dict[str, str] = {}
                for w, a, b in zip(reversed(words), reversed(["", *words][:-1]), reversed([*words[1:], ""]), strict=True):
                    first[w] = f"{a} {b}"
                seen.update(first.items())
            else:
                clean.update(set(words))
        rows = [(w, c, 0) for w, c in seen] + [(w, "", n) for w, n in clean.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())], names=["word", "near", "clean"])


def learn(docs: DataFrame, labels: DataFrame, usable: Column, *, id_column: str = "doc_id", text_column: str = "text", label: str = "toxic", sample: int = SAMPLE, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """A lexicon from at most ``sample`` labelled rows for which ``usable`` holds. Without both labels it is empty.

    It holds every term and every exception that these rows bear out, so its size is bounded by theirs; what is
    collected are terms with several surroundings in them, never statistics of all documents.
    """
    reachable(docs.sparkSession)
    plain = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))
    chosen = cut(training_rows(labels, label, usable, sample, id_column), "sample")
    rows = cut(plain.join(chosen, "id").dropDuplicates(["id", "y"]).select("y", "text"), "labelled")
    n = {y: c for y, c in rows.groupBy("y").count().collect()}
    if set(n) != {0, 1}:
        return Lexicon({}, offset=0.0 if not n else (4.0 if 1 in n else -4.0))
    counted = rows.mapInArrow(_surroundings, "word string, near string, clean long")
    toxic = counted.where("clean = 0").select("word", "near").distinct().groupBy("word").agg(F.count("*").alias("t"), F.lit(0).cast("long").alias("c"))
    clean = counted.where("clean > 0").groupBy("word").agg(F.lit(0).cast("long").alias("t"), F.sum("clean").alias("c"))
    words = toxic.union(clean).groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    starts = F.array(*(F.when(F.length("word") > k, F.concat(F.lit(" "), F.substring("word", 1, k))) for k in BEGINNINGS))
    terms = F.concat(F.array(F.concat(F.lit(" "), "word", F.lit(" "))), F.array_compact(starts))
    weight = F.log((F.col("t") + 0.5) / (n[1] + 1)) - F.log((F.col("c") + 0.5) / (n[0] + 1))
    ranked = words.select(F.explode(terms).alias("term"), "t", "c").groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count_if(F.col("t") > 0).alias("words"))
    ranked = ranked.select("term", "t", "words", weight.alias("weight")).where((F.col("t") >= LEAST_SURROUNDINGS) & (F.col("weight") >= LEAST_WEIGHT))
    ranked = ranked.where(F.col("term").endswith(" ") | (F.col("words") >= LEAST_WORDS))
    found = ranked.orderBy(F.col("weight").desc(), F.col("t").desc(), "term").collect()
    lexicon = Lexicon({r["term"]: r["weight"] for r in found}, tuple(p for p in map(_folded_phrase, exceptions) if p))
    return _fitted(lexicon, rows)


def _fitted(lexicon: Lexicon, rows: DataFrame) -> Lexicon:
    """Learn exceptions from harmless surroundings of matches, and the curve, on the bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                words = folded(text)
                total, starts = hits(matcher, words)
                place = dict(zip(itertools.accumulate((len(w) + 1 for w in words), initial=0), range(len(words))))
                phrases = set()
                for i in map(place.__getitem__, starts):
                    phrases |= {" ".join(words[j : j + 2]) for j in (i - 1, i) if 0 <= j < len(words) - 1}
                out.append((total, len(words), sorted(phrases)))
            arrays = [batch.column(0), pa.array([o[0] for o in out], pa.float64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["y", "total", "words", "phrases"])

    schema = "y int, total double, words long, phrases array<string>"
    harmless = rows.mapInArrow(run, schema).select("y", F.explode("phrases").alias("p")).groupBy("p").agg(F.count_if(F.col("y") == 0).alias("c"), F.count_if(F.col("y") == 1).alias("t"))
    more = harmless.where((F.col("c") >= 3) & (F.col("c") > 4 * F.col("t"))).orderBy(F.col("c").desc(), "p").collect()
    lexicon.exceptions = tuple(dict.fromkeys([*lexicon.exceptions, *(r["p"] for r in more)]))
    data = rows.mapInArrow(run, schema).select("y", "total", "words").toPandas()
    y = data["y"].to_numpy(dtype=float)
    best = math.inf
    for power in POWERS:
        x = data["total"].to_numpy() / (1 + data["words"].to_numpy()) ** power
        slope, offset, loss = _logistic(x, y)
        if loss < best - 1e-9:
            best, lexicon.power, lexicon.slope, lexicon.offset = loss, power, slope, offset
    return lexicon


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Slope, offset and mean log loss of a lightly regularised logistic curve, by Newton's method on scaled values."""
    scale = float(np.abs(x).max()) or 1.0
    a = np.stack([x / scale, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (y - p) - 1e-2 * w
        step = np.linalg.solve((a.T * (p * (1 - p))) @ a + 1e-2 * np.eye(2), gradient)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    p = np.clip(1 / (1 + np.exp(-np.clip(a @ w, -30, 30))), 1e-12, 1 - 1e-12)
    return float(w[0] / scale), float(w[1]), float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def score_toxicity(docs: DataFrame, lexicon: Lexicon, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(doc_id, score, n_hits)``, one row per row of ``docs``, from the whole text alone.

    Null and empty texts have no hits. Repeated rows are scored each; null ids stay null; further columns are ignored.
    """
    reachable(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for batch in batches:
            scores, n = [], []
            for text in batch.column(1):
                words = folded(text.as_py())
                total, starts = hits(matcher, words)
                scores.append(lexicon.score(total, len(words)))
                n.append(len(starts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(n, pa.int64())], names=[id_column, "score", "n_hits"])

    plain = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").alias("text"))
    return plain.mapInArrow(run, f"`{id_column}` long, score double, n_hits long")
