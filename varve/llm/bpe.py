"""BPE encoding and decoding of whole texts by tree concatenation.

A text longer than ``leaf`` characters is halved, in the middle of words too, until its parts are short. The parts of
all texts of a batch are encoded together, each distinct word once per worker, for no token of such a vocabulary crosses
a blank. Neighbours are then put together, level by level: a window of words around the join is encoded anew as one
text, and grows until it begins with the left side's own tokens and ends with the right side's own.

A run without blanks longer than ``leaf`` is no place for such a cut. Its pre-tokens are halved by themselves, and
windows of tokens grow until their first token is the left side's own and their last the right side's own. All
neighbouring tokens of the result then stand next to each other in a whole encoding of some text, which makes it the
encoding of the joined text.
"""

from __future__ import annotations

import json
import re
import string
import sys
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .store import reachable

LEAF = 2048
KEPT_WORDS = 300_000  # distinct words that a worker remembers
MARKS = "".join(c for c in string.punctuation if c != "'")
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
ROWS, CHARS = 256, 1 << 20  # rows of a slice, and characters that are split into words at a time
Part = tuple[list[str], list[bytes]]  # words, or several of them as one, and the ids of each
_LOADED: dict[tuple[str, int], "Bpe"] = {}


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if LITTLE else np.array(ids, dtype="<u4").tobytes()


class Bpe:
    """A tokenizer file of the ``tokenizers`` library with a BPE model, applied word by word."""

    def __init__(self, path: str, leaf: int = LEAF):
        with open(path, encoding="utf-8") as file:
            text = file.read()
        self.leaf = leaf
        self.whole = Tokenizer.from_str(text)
        self.whole.no_truncation()
        self.whole.no_padding()
        spec = json.loads(text)
        self.spec = spec
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        added = [x["content"] for x in spec["added_tokens"]]
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        size = self.whole.get_vocab_size()
        self.names = [self.whole.id_to_token(i) for i in range(size)]
        self.joins = 0  # of halves of texts
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @cached_property
    def last(self) -> Tokenizer:
        """For what ends a pre-token."""
        return self._bare(self.spec["model"])

    @cached_property
    def inner(self) -> Tokenizer:
        """For what does not."""
        return self._bare(self.spec["model"] | {"end_of_word_suffix": None})

    def _bare(self, model: dict) -> Tokenizer:
        parts = {"normalizer": None, "pre_tokenizer": None, "post_processor": None, "added_tokens": []}
        return Tokenizer.from_str(json.dumps(self.spec | parts | {"model": model}))

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Words that are new in any of them are encoded together."""
        halves = [self._halves(t.replace("\n", " ").replace("\t", " ").replace("\r", " ")) for t in texts]
        split = [[part.split(" ") for part in parts] for parts in halves]
        ids, rest = self._known(set().union(*(words for parts in split for words in parts)))
        parts = {w: self._parts(w) for w in rest}
        units, new = self._known({p for ps in parts.values() for p in ps})
        short = [p for p in new if len(p) <= self.leaf]
        for p, e in zip(short, self.whole.encode_batch_fast(short, add_special_tokens=False), strict=True):
            units[p] = self.words[p] = _packed(e.ids)
        for p in new:
            if len(p) > self.leaf:
                units[p] = self.encode_unsplit(p)
        for word, ps in parts.items():
            ids[word] = units[ps[0]] if len(ps) == 1 else units[ps[0]] + units[ps[1]]
            if len(word) <= self.leaf:
                self.words[word] = ids[word]
        if len(self.words) > KEPT_WORDS // 2:
            self.words, self.older = {}, self.words
        trees = {i: [(words, [ids[w] for w in words]) for words in parts] for i, parts in enumerate(split) if len(parts) > 1}
        self._concatenate(list(trees.values()))
        return [b"".join(trees[i][0][1] if i in trees else map(ids.__getitem__, parts[0])) for i, parts in enumerate(split)]

    def _halves(self, text: str) -> list[str]:
        """The parts of a text in order, cut in the middle, but for runs without blanks of more than ``leaf`` characters."""
        out, rest = [], [text]
        while rest:
            part = rest.pop()
            at = len(part) // 2 if len(part) > self.leaf else 0
            if at:
                low, high = part.rfind(" ", 0, at), part.find(" ", at)
                if (high if high >= 0 else len(part)) - low - 1 > self.leaf:
                    at = high if high >= 0 else low + 1
            if at:
                rest += [part[at:], part[:at]]
            else:
                out.append(part)
        return out

    def _concatenate(self, trees: list[list[Part]]) -> None:
        """Put the parts of each text together, neighbours of all texts at a time."""
        while trees:
            joined = iter(self._joined([(t[i], t[i + 1]) for t in trees for i in range(0, len(t) - 1, 2)]))
            for t in trees:
                t[:] = [next(joined) for _ in range(len(t) // 2)] + t[len(t) // 2 * 2 :]
            trees = [t for t in trees if len(t) > 1]

    def _joined(self, pairs: list[tuple[Part, Part]]) -> list[Part]:
        """Each pair as one part. What is left of a window when both sides agree is one unit of the result."""
        out: list = [None] * len(pairs)
        open_, width = list(range(len(pairs))), 1
        self.joins += len(pairs)
        while open_:
            windows = []
            for at in open_:
                (left, _), (right, _) = pairs[at]
                a, b = max(0, len(left) - 1 - width), min(len(right), 1 + width)
                a, b = a + (len(left[a]) > self.leaf and a < len(left) - 1), b - (len(right[b - 1]) > self.leaf and b > 1)
                windows.append((at, a, b, [*left[a:-1], left[-1] + right[0], *right[1:b]]))
            again = []
            encoded = self.whole.encode_batch_fast([" ".join(w) for *_, w in windows], add_special_tokens=False)
            for (at, a, b, window), e in zip(windows, encoded, strict=True):
                (left, mine), (right, yours) = pairs[at]
                ids = _packed(e.ids)
                whole = len(left) - 1 - width < 0 and len(right) - 1 - width < 0
                first = mine[a] if a < len(left) - 1 and not whole else b""
                final = yours[b - 1] if b > 1 and not whole else b""
                if len(first) + len(final) <= len(ids) and ids.startswith(first) and ids.endswith(final):
                    kept, end = (a + 1 if first else a), (b - 1 if final else b)
                    inside = window[kept - a : len(window) - (b - end)]
                    unit, middle = [" ".join(inside)], [ids[len(first) : len(ids) - len(final)]]
                    out[at] = (left[:kept] + unit + right[end:], mine[:kept] + middle + yours[end:])
                else:
                    again.append(at)
            open_, width = again, width * 2
        return out

    def _known(self, words: set[str]) -> tuple[dict[str, bytes], list[str]]:
        """The ids of the words in memory, which has two halves (the older is dropped when both fill), and the others."""
        now, older = self.words, self.older
        found = {w: now[w] for w in words if w in now}
        rest = [w for w in words if w not in now]
        again = {w: older[w] for w in rest if w in older}
        if again:
            now.update(again)
            found.update(again)
            rest = [w for w in rest if w not in again]
        return found, rest

    @staticmethod
    def _parts(word: str) -> tuple[str, ...]:
        """A word, in lower case where that is the library's own, and the marks that end it apart.

        Between a letter and a mark the pre-tokenizer cuts in any case; ``'`` may begin a contraction and stays.
        """
        if "<|" in word or "\u03a3" in word or "\u0130" in word:
            return (word,)  # special tokens, and letters whose lower case depends on others
        word = word.lower()
        stem = word.rstrip(MARKS)
        return (stem, word[len(stem) :]) if len(stem) < len(word) and stem[-1:].isalpha() else (word,)

    def encode_unsplit(self, text: str) -> bytes:
        """The ids of text without blanks, of any length."""
        ids: list[int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.added:
                ids.append(self.added[part])
            elif part:
                plain = self.whole.normalizer.normalize_str(part) if self.whole.normalizer else part
                pieces = [p for p, _ in self.whole.pre_tokenizer.pre_tokenize_str(plain)] if self.whole.pre_tokenizer else [plain]
                for piece in pieces:
                    ids += self.encode_piece(piece)
        return np.array(ids, dtype="<u4").tobytes()

    def encode_piece(self, piece: str) -> list[int]:
        """The ids of one pre-token, by halves."""
        if len(piece) <= self.leaf:
            return self.last.encode(piece, add_special_tokens=False).ids
        bounds = [0, len(piece)]
        while bounds[1] > self.leaf:
            bounds = sorted({*bounds, *((a + b) // 2 for a, b in zip(bounds, bounds[1:]))})
        parts = [piece[a:b] for a, b in zip(bounds, bounds[1:])]
        done = [e.ids for e in self.inner.encode_batch_fast(parts[:-1], add_special_tokens=False)]
        done.append(self.last.encode(parts[-1], add_special_tokens=False).ids)
        while len(done) > 1:
            joined = [self.join(done[i], done[i + 1], i + 2 == len(done)) for i in range(0, len(done) - 1, 2)]
            done = joined + done[len(joined) * 2 :]
        return done[0]

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """The encoding of two neighbours; ``last`` if the right one ends the pre-token."""
        width = 4
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            ends = last and b == len(right)
            text = "".join(self.names[i] for i in left[a:] + right[:b])
            if ends and self.suffix:
                text = text[: -len(self.suffix)]
            ids = (self.last if ends else self.inner).encode(text, add_special_tokens=False).ids
            if (a == 0 or ids[0] == left[a]) and (b == len(right) or ids[-1] == right[b - 1]):
                return left[:a] + ids + right[b:]
            width *= 2

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: the library's own decoder, or names with blanks between where it has none."""
        if self.whole.decoder is None:
            return " ".join(map(self.names.__getitem__, ids.tolist()))
        return self.whole.decode(ids.tolist(), skip_special_tokens=False)


def load(path: str, leaf: int = LEAF) -> Bpe:
    """The tokenizer of a file, read once per worker."""
    if (path, leaf) not in _LOADED:
        _LOADED[path, leaf] = Bpe(path, leaf)
    return _LOADED[path, leaf]


def _apply(column: str, target: str, kind: pa.DataType, many, path: str | None, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = load(path, leaf) if path else None
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                at = batch.schema.get_field_index(column)
                values = pa.array(many(tool, batch.column(at).to_pylist()), kind)
                stay = [i for i, n in enumerate(batch.schema.names) if n not in (column, target)]
                names, rest = [batch.schema.names[i] for i in stay], [batch.column(i) for i in stay]
                yield pa.RecordBatch.from_arrays([*rest, values], names=[*names, target])

    return run


def _encoded(tool: Bpe, texts: list[str | None]) -> list[bytes]:
    out: list[bytes] = []
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= CHARS:
            out += tool.encode_all(held)
            held, size = [], 0
    return out + tool.encode_all(held)


def encode(docs: DataFrame, path: str, text_column: str = "text", ids_column: str = "ids", leaf: int = LEAF) -> DataFrame:
    """``docs`` with the text column replaced by the ids of the text as packed little-endian 32-bit integers.

    Special tokens in a text are encoded as such, none are added. Null and empty texts have no ids. All other columns
    stay as they are; one that already has the name of ``ids_column`` is replaced.
    """
    return _run(docs, text_column, ids_column, "binary", pa.binary(), _encoded, path, leaf)


def decode(tokens: DataFrame, path: str, ids_column: str = "ids", text_column: str = "decoded", leaf: int = LEAF) -> DataFrame:
    """``tokens`` with packed ids replaced by their text, special tokens included; null ids give an empty text."""
    return _run(tokens, ids_column, text_column, "string", pa.string(), lambda t, vs: [t.decode(np.frombuffer(v or b"", dtype="<u4")) for v in vs], path, leaf)


def _run(df: DataFrame, column: str, target: str, sql: str, kind: pa.DataType, many, path: str | None, leaf: int) -> DataFrame:
    reachable(df.sparkSession)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in (column, target)), f"`{target}` {sql}"])
    return df.mapInArrow(_apply(column, target, kind, many, path, leaf), schema)


def unpacked(tokens: DataFrame, ids_column: str = "ids") -> DataFrame:
    """``tokens`` with packed ids as arrays of integers."""
    return _run(tokens, ids_column, ids_column, "array<int>", pa.list_(pa.int32()), lambda t, vs: [np.frombuffer(v or b"", dtype="<i4") for v in vs], None, LEAF)


def round_trip(docs: DataFrame, path: str, text_column: str = "text", leaf: int = LEAF) -> DataFrame:
    """The other columns of ``docs`` with ``ids`` (packed) and ``decoded``; columns of these names are replaced.

    The same as ``encode`` and then ``decode`` of its ids, in one pass, so that a task has one Python worker.
    """
    reachable(docs.sparkSession)
    stay = [f for f in docs.schema.fields if f.name not in (text_column, "ids", "decoded")]
    kept = docs.select(*(F.col(f"`{f.name}`") for f in stay), F.col(f"`{text_column}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = load(path, leaf)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                ids = _encoded(tool, batch.column(len(stay)).to_pylist())
                texts = [tool.decode(np.frombuffer(x, dtype="<u4")) for x in ids]
                arrays = [*batch.columns[: len(stay)], pa.array(ids, pa.binary()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[: len(stay)], "ids", "decoded"])

    columns = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in stay), "ids binary", "decoded string"]
    return kept.mapInArrow(run, ", ".join(columns))
