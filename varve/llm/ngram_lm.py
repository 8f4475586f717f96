"""Scores of texts by a backoff automaton of n-grams that all training documents together give.

The smoothed n-grams are the arcs of an automaton. Its states are the word sequences that training texts go on from, up
to ``order - 1`` words; a state that has no arc for the next word is left by its failure arc, to the state of the sequence
without its first word. A text is read once from left to right: the state is carried, and the log-probabilities of the
arcs taken, failure arcs included, are added up. An n-gram's probability is

    p(w | h) = (1 - b) * c(h w) / c(h) + b * p(w | h without its first word),  b = WEIGHT * c(h) ** -DECAY

so ``b`` is the weight of the failure arc, and the arcs of each state sum to one. The root has the add-``ADDED`` word
probabilities, one unknown word among them.

No task holds the automaton: it grows with the corpus. Documents are cut into blocks of about ``BLOCK_TOKENS`` tokens.
A block sends each of its distinct n-grams once, with its count in the block, to the partition that the n-gram's hash
falls into; the partition adds up the counts of all blocks and sends the totals back. With these a block builds the part
of the automaton that its own texts can reach, and walks it. What is shuffled has one entry per block and distinct
n-gram, so an n-gram with a third of all tokens is one entry of each block, and the hash spreads n-grams evenly.

Words and n-grams are told apart by hashes of 64 bits, the words' being those of :mod:`varve.llm.words`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .store import cut, reachable
from .words import mix, word_hashes

ORDER = 2
ADDED = 0.1
WEIGHT, DECAY = 0.8, 0.1
BLOCK_TOKENS = 1_000_000
ENTRIES = 1_000_000  # n-grams that a partition adds up, on average

_U64 = np.uint64
_STEP = _U64(0xD6E8FEB86659FD93)
END = mix(np.array([0x656E64206F662074], dtype=np.uint64))[0]  # a text's end, which no word is


def _packed(x: np.ndarray, kind: str) -> bytes:
    """Numbers by byte planes: planes that are all zero or alike, as in small or sorted numbers, hardly take room compressed."""
    return np.ascontiguousarray(x.astype(kind).view(np.uint8).reshape(len(x), -1).T).tobytes()


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


@dataclass
class Block:
    """Texts of one block: for each its number of tokens (the end is one) and whether it teaches, and all their tokens."""

    tokens: np.ndarray
    lengths: np.ndarray
    learn: np.ndarray

    def grams(self, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each order the positions that have an n-gram of it ending there, and its key.

        A text has one end before it, as the history of its first words. The lowest bit of a key tells words from longer
        n-grams.
        """
        first = np.cumsum(self.lengths) - self.lengths
        place = np.arange(len(self.tokens)) - np.repeat(first, self.lengths)
        out = []
        with np.errstate(over="ignore"):
            for n in range(1, order + 1):
                at = np.flatnonzero(place >= n - 2) if n > 2 else np.arange(len(self.tokens))
                key = np.full(len(at), n, dtype=np.uint64)
                for back in range(n - 1, -1, -1):
                    word = np.where(place[at] >= back, self.tokens[np.maximum(at - back, 0)], END)
                    key = mix(key * _STEP + word)
                out.append((at, (key | _U64(1)) if n == 1 else (key & ~_U64(1))))
        return out


def _read(row: dict) -> Block:
    words, codes = _unpacked(row["words"], "<u8"), _unpacked(row["codes"], "<u4")
    return Block(words[codes], np.frombuffer(row["lengths"], "<i8"), np.frombuffer(row["learn"], np.bool_))


def _blocks(kind: pa.DataType, size: int):
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(kind)), ("n_tokens", pa.int64()), ("train_tokens", pa.int64()), ("train_texts", pa.int64()), ("lengths", pa.binary()), ("learn", pa.binary()), ("words", pa.binary()), ("codes", pa.binary())])

    def row(number: int, ids: list, texts: list[np.ndarray], learn: list[bool]) -> pa.RecordBatch:
        lengths = np.array([len(t) for t in texts], dtype="<i8")
        words, codes, n = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")  # frequent words get small codes
        rank = np.empty(len(order), dtype="<u4")
        rank[order] = np.arange(len(order))
        taught = np.array(learn, dtype=np.bool_)
        values = [number, ids, int(lengths.sum()), int(lengths[taught].sum()), int(taught.sum()), lengths.tobytes(), taught.tobytes(), _packed(words[order], "<u8"), _packed(rank[codes], "<u4")]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, texts, learn, held = [], [], [], 0
        for batch in batches:
            for i, text, teach in zip(batch.column(0), batch.column(1), batch.column(2).to_pylist(), strict=True):
                buffer = text.as_buffer() if text.is_valid else None
                hashes = word_hashes(buffer)[0] if buffer is not None and buffer.size else np.empty(0, np.uint64)
                ids.append(i.as_py())
                texts.append(np.append(hashes, END))
                learn.append(bool(teach))
                held += len(hashes) + 1
                if held >= size:
                    yield row(number, ids, texts, learn)
                    number, ids, texts, learn, held = number + 1, [], [], [], 0
        if ids:
            yield row(number, ids, texts, learn)

    return run


def _distinct(block: Block, order: int) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Sorted distinct keys of a block, their counts in its training texts, and per order the positions and indices."""
    grams = block.grams(order)
    keys, inverse = np.unique(np.concatenate([k for _, k in grams]), return_inverse=True)
    taught = np.repeat(block.learn, block.lengths)
    counts = np.bincount(inverse, weights=np.concatenate([taught[at] for at, _ in grams]), minlength=len(keys)).astype(np.int64)
    bounds = np.cumsum([len(at) for at, _ in grams])[:-1]
    return keys, counts, [(at, i) for (at, _), i in zip(grams, np.split(inverse, bounds), strict=True)]


def _slices(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each partition's keys begin among sorted ones; a partition has an equal range of the keys' upper 32 bits."""
    part = ((keys >> _U64(32)) * _U64(parts)) >> _U64(32)
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def _sent(order: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts, _ = _distinct(_read(row), order)
                at = _slices(keys, parts)
                some = np.flatnonzero(np.diff(at))
                columns = [
                    pa.array(some, pa.int32()),
                    pa.array(np.full(len(some), row["block"])),
                    pa.array([_packed(keys[at[p] : at[p + 1]], "<u8") for p in some], pa.binary()),
                    pa.array([_packed(counts[at[p] : at[p + 1]], "<u4") for p in some], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "keys", "counts"])

    return run


def _added(group: pa.Table) -> pa.Table:
    """The totals of a partition's n-grams, for each block in the order of the keys that it sent."""
    sent = [_unpacked(k, "<u8") for k in group.column("keys").to_pylist()]
    counts = np.concatenate([_unpacked(c, "<u4") for c in group.column("counts").to_pylist()])
    keys, inverse = np.unique(np.concatenate(sent), return_inverse=True)
    totals = np.zeros(len(keys), dtype=np.int64)
    np.add.at(totals, inverse, counts)
    ends = np.cumsum([len(k) for k in sent])
    back = [_packed(t, "<u8") for t in np.split(totals[inverse], ends[:-1])]
    words = [int(np.count_nonzero((keys & _U64(1)).astype(bool) & (totals > 0)))] + [0] * (len(sent) - 1)
    return pa.table({"part": group.column("part"), "block": group.column("block"), "totals": pa.array(back, pa.binary()), "n_words": pa.array(words, pa.int64())})


@dataclass
class Automaton:
    """The arcs that the tokens of a block can take: per order and position, the weights in log10.

    ``seen[n][i]``: the n-gram of ``n`` words that ends at ``i`` is an arc, ``arc[n][i]`` its weight, ``fail[n][i]`` that of
    the failure arc from its history. At a root, all words have an arc: those never seen share that of the unknown word.
    """

    order: int
    seen: list[np.ndarray]
    arc: list[np.ndarray]
    fail: list[np.ndarray]

    def walk(self, begin: int, end: int) -> list[float]:
        """The weights of all arcs taken from the first token to the last; a state is the length of its history."""
        seen, arc, fail = ([x[begin:end].tolist() for x in xs] for xs in (self.seen, self.arc, self.fail))
        state, out = 1 if self.order > 1 else 0, []
        for i in range(end - begin):
            while state and not seen[state + 1][i]:
                out.append(fail[state + 1][i])
                state -= 1
            out.append(arc[state + 1][i])
            state = min(state + 1, self.order - 1) if seen[state + 1][i] else 0
        return out


def automaton(block: Block, grams: list[tuple[np.ndarray, np.ndarray]], totals: np.ndarray, order: int, train_tokens: int, n_words: int, train_texts: int) -> Automaton:
    """The part of the automaton that a block's texts reach. ``train_texts`` is how often training texts begin."""
    size = len(block.tokens)
    found = np.zeros((order + 1, size), dtype=np.int64)
    for n, (at, index) in enumerate(grams, 1):
        found[n, at] = totals[index]
    first = np.cumsum(block.lengths) - block.lengths
    p = (found[1] + ADDED) / (train_tokens + ADDED * (n_words + 1))
    none = np.empty(0)  # there are no n-grams of no words
    seen, arc, fail = [none, found[1] > 0], [none, np.log10(p)], [none, none]
    for n in range(2, order + 1):
        history = np.zeros(size, dtype=np.int64)  # how often training texts go on from the n - 1 tokens before
        history[1:] = found[n - 1, :-1]
        history[first] = train_texts if n == 2 else 0
        known = np.maximum(history, 1)
        share = np.where(history > 0, WEIGHT * known**-DECAY, 1.0)
        p = np.where(history > 0, (1 - share) * found[n] / known + share * p, p)
        seen.append(found[n] > 0)
        arc.append(np.log10(p))
        fail.append(np.log10(share))
    return Automaton(order, seen, arc, fail)


def _scored(order: int, train_tokens: int, n_words: int, train_texts: int, kind: pa.DataType):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = np.argsort(right.column("part").to_numpy())
        answers = right.column("totals").to_pylist()
        totals = np.concatenate([_unpacked(answers[i], "<u8").astype(np.int64) for i in parts])
        row = left.to_pylist()[0]
        block = _read(row)
        keys, _, grams = _distinct(block, order)
        if len(keys) != len(totals):
            raise RuntimeError(f"block {row['block']}: {len(totals)} totals for {len(keys)} n-grams")
        machine = automaton(block, grams, totals, order, train_tokens, n_words, train_texts)
        ends = np.cumsum(block.lengths)
        spans = list(zip((ends - block.lengths).tolist(), ends.tolist(), strict=True))
        known = np.concatenate([[0], np.cumsum(machine.seen[1])])
        return pa.table(
            {
                "id": pa.array(row["ids"], kind),
                "n_tokens": pa.array(block.lengths, pa.int64()),
                "n_known": pa.array([int(known[b] - known[a]) for a, b in spans], pa.int64()),
                "base_score": pa.array([math.fsum(machine.arc[1][a:b].tolist()) for a, b in spans], pa.float64()),
                "score": pa.array([math.fsum(machine.walk(a, b)) for a, b in spans], pa.float64()),
            }
        )

    return run


def score_texts(docs: DataFrame, learn: Column, *, id_column: str = "doc_id", text_column: str = "text", order: int = ORDER, block_tokens: int = BLOCK_TOKENS, entries: int = ENTRIES) -> DataFrame:
    """``(id, n_tokens, n_known, train_tokens, base_score, score)``, one row per row of ``docs``.

    Tokens are the words of the text, cut at ASCII white space, A-Z lower-cased, and then one end. Rows where ``learn``
    is true teach. ``n_known`` counts tokens that training texts have, ``train_tokens`` all their tokens, ``base_score``
    sums the log10 of the add-``ADDED`` word probabilities, ``score`` is the automaton's log10 probability.

    A null text is empty, and so has its end only. Repeated rows, and rows without an id, are scored each, and teach each.
    Without training rows (none has a true ``learn``, null counting as false) every token is unknown and has the
    probability one. An empty table gives no rows. Further columns are ignored. A text is held whole by one task.
    """
    spark = docs.sparkSession
    reachable(spark)
    plain = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    name = plain.schema["id"].dataType.simpleString()
    kind = to_arrow_type(plain.schema["id"].dataType)
    made = plain.mapInArrow(_blocks(kind, block_tokens), f"block long, ids array<{name}>, n_tokens long, train_tokens long, train_texts long, lengths binary, learn binary, words binary, codes binary")
    blocks = cut(made, "blocks")
    sums = blocks.agg(F.sum("n_tokens"), F.sum("train_tokens"), F.sum("train_texts")).first()
    n_tokens, train_tokens, train_texts = (x or 0 for x in sums)
    parts = max(1, -(-order * n_tokens // entries))
    sent = blocks.mapInArrow(_sent(order, parts), "part int, block long, keys binary, counts binary")
    totals = cut(sent.groupBy("part").applyInArrow(_added, "part int, block long, totals binary, n_words long"), "totals")
    n_words = totals.agg(F.sum("n_words")).first()[0] or 0
    columns = f"id {name}, n_tokens long, n_known long, base_score double, score double"
    pairs = blocks.groupBy("block").cogroup(totals.select("block", "part", "totals").groupBy("block"))
    scored = pairs.applyInArrow(_scored(order, train_tokens, n_words, train_texts, kind), columns)
    taught = F.lit(train_tokens).cast("long").alias("train_tokens")
    return scored.select(F.col("id").alias(id_column), "n_tokens", "n_known", taught, "base_score", "score")
