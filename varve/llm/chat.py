"""Chat formatting by columnar byte assembly.

A turn is ``### role``, a line end, the text, ``</turn>`` and a line end. In texts and roles a backslash goes before
every backslash, every ``#`` and every ``</turn>``, so control strings inside them are no control strings, and taking
the backslashes away gives the text back. The parts of a whole batch are put into one buffer: segment lengths give
cumulative offsets, and index arrays scatter headers and contents to their places.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import reachable

OPEN, TAIL = "### ", "</turn>\n"
BLOCK = 1 << 20  # bytes scattered at a time
PIECE = 16 << 20  # bytes of roles and texts after which an open conversation gets a row
TURN = re.compile(rb"### ((?:[^\\\n]++|\\.)*+)\n((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)
ESCAPE = re.compile(rb"\\(.)", re.DOTALL)


def escaped(texts: pa.Array, line_ends: bool = False) -> pa.Array:
    """Texts with control strings escaped; null counts as empty. ``line_ends`` also takes line ends out of roles."""
    out = pc.fill_null(texts.cast(pa.large_string()), "")
    for plain, safe in (("\\", "\\\\"), ("#", "\\#"), ("</turn>", "\\</turn>"), *([("\n", "\\n")] if line_ends else [])):
        out = pc.replace_substring(out, plain, safe)
    return out


def unescaped(text: bytes, line_ends: bool = False) -> bytes:
    return ESCAPE.sub(lambda m: b"\n" if line_ends and m[1] == b"n" else m[1], text)


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string array."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)), offsets


def _scatter(out: np.ndarray, places: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy each segment of ``data`` to its place in ``out``, many segments at a time."""
    sizes = np.diff(offsets)
    start = 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + BLOCK)))
        stop = min(stop, len(sizes))
        if stop == start + 1:
            out[places[start] : places[start] + sizes[start]] = data[offsets[start] : offsets[stop]]
        else:
            shift = np.repeat(places[start:stop] - offsets[start:stop], sizes[start:stop])
            out[np.arange(offsets[start], offsets[stop]) + shift] = data[offsets[start] : offsets[stop]]
        start = stop


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted turns in one buffer, the offset of every turn, and where its text starts and ends."""
    heads = pc.binary_join_element_wise(pa.scalar(OPEN, pa.large_string()), escaped(roles, True), pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
    head, head_at = _buffer(heads)
    body, body_at = _buffer(escaped(texts))
    tail = np.frombuffer(TAIL.encode(), dtype=np.uint8)
    sizes = np.diff(head_at) + np.diff(body_at) + len(tail)
    turns = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(turns[-1], dtype=np.uint8)
    starts = turns[:-1] + np.diff(head_at)
    ends = starts + np.diff(body_at)
    _scatter(out, turns[:-1], head, head_at)
    _scatter(out, starts, body, body_at)
    out[ends[:, None] + np.arange(len(tail))] = tail
    return out, turns, starts, ends


FORMATTED = "conv_id long, n_turns long, formatted string, loss_starts array<long>, loss_ends array<long>, part long, offset long"


def _formatted(batches: list[pa.RecordBatch], trained: str, part: int, offset: int) -> pa.RecordBatch:
    """One row per conversation of rows that are sorted by conversation; ``part`` and ``offset`` are those of the first."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    convs, roles, texts = (rows.column(i).chunk(0) for i in (0, 1, 2))
    buffer, turns, starts, ends = assemble(roles, texts)
    keys, null = pc.fill_null(convs, 0).to_numpy(zero_copy_only=False), convs.is_null().to_numpy(zero_copy_only=False)
    new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (null[1:] != null[:-1])]))
    bounds = np.concatenate([new, [len(keys)]])
    loss = pc.fill_null(pc.equal(roles, trained), False).to_numpy(zero_copy_only=False)
    first = np.arange(len(new)) == 0
    base = np.repeat(turns[bounds[:-1]] - first * offset, np.diff(bounds))
    at = pa.array(np.concatenate([[0], np.cumsum(np.add.reduceat(loss.astype(np.int64), new))]).astype(np.int32))
    offsets = turns[bounds]
    text = pa.LargeStringArray.from_buffers(len(new), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(buffer)).cast(pa.string())
    lists = [pa.ListArray.from_arrays(at, pa.array((x - base)[loss], pa.int64())) for x in (starts, ends)]
    arrays = [convs.take(pa.array(new)), pa.array(np.diff(bounds), pa.int64()), text, *lists, pa.array(first * part, pa.int64()), pa.array(first * offset, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "n_turns", "formatted", "loss_starts", "loss_ends", "part", "offset"])


def _slices(batches: Iterator[pa.RecordBatch], piece: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches cut so that none has more than ``piece`` bytes of roles and texts, but for a single row, and the bytes of each row."""
    for batch in batches:
        sizes = sum(pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for i in (1, 2))
        total, start = np.concatenate([[0], np.cumsum(sizes)]), 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(total, total[start] + piece, side="right")) - 1)
            yield batch.slice(start, stop - start), sizes[start:stop]
            start = stop


def format_conversations(turns: DataFrame, trained: str = "assistant", piece: int = PIECE) -> DataFrame:
    """One row per conversation of ``turns(conv_id, turn, role, text)``: its formatted text and the loss mask.

    The mask holds, in order, the byte range of every text of the role ``trained``. Turns are ordered by number, nulls
    first, ties by role and text. Null roles and texts are empty; rows with a null id are one conversation; repeated
    rows are turns of their own.

    A conversation of more than ``piece`` bytes has several rows, in order: ``part`` counts them from 0, ``offset`` is
    the byte of the conversation at which a row begins, and the mask counts from the conversation's begin. Rows are
    sorted, not gathered, and a task holds two pieces at most. It formats a conversation alone, one piece after the other.
    """
    reachable(turns.sparkSession)
    plain = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"), F.col("turn").alias("turn"))
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        open_id, part, offset, size = None, 0, 0, 0
        for batch, sizes in _slices(batches, piece):
            ids = batch.column(0)
            last = ids[-1].as_py()
            same = pc.is_null(ids) if last is None else pc.fill_null(pc.equal(ids, last), False)
            open_from = int(np.argmax(same.to_numpy(zero_copy_only=False)))
            goes_on = (held or part) and ids[0].as_py() == open_id
            if held and (open_from > 0 or not goes_on):
                yield _formatted([*held, batch.slice(0, open_from)], trained, part, offset)
                held, part, offset, size = [], 0, 0, 0
            elif open_from > 0:
                yield _formatted([batch.slice(0, open_from)], trained, *((part, offset) if goes_on else (0, 0)))
                part, offset = 0, 0
            elif not goes_on:
                part, offset = 0, 0
            held.append(batch.slice(open_from))
            open_id, size = last, size + int(sizes[open_from:].sum())
            if size >= piece:
                out = _formatted(held, trained, part, offset)
                yield out
                held, part, offset, size = [], part + 1, offset + pc.binary_length(out.column(2))[0].as_py(), 0
        if held:
            yield _formatted(held, trained, part, offset)

    return ordered.mapInArrow(run, FORMATTED)


def read_back(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """Role and text of every turn; text that is no sequence of turns is an error."""
    out, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at byte {at}")
        out.append((unescaped(m[1], True), unescaped(m[2])))
        at = m.end()
    return out


def masked_texts(formatted: bytes, starts: list[int], ends: list[int]) -> list[bytes]:
    """The texts under the loss mask."""
    return [unescaped(formatted[a:b]) for a, b in zip(starts, ends, strict=True)]


class _Digest:
    """Running digests of one conversation, piece by piece."""

    def __init__(self, conv: int | None) -> None:
        self.conv, self.part, self.offset, self.turns, self.chars, self.length = conv, 0, 0, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, conv: int | None, part: int, offset: int, data: bytes, starts: list[int], ends: list[int], length: int) -> None:
        if (conv, part, offset) != (self.conv, self.part, self.offset):
            raise ValueError(f"part {part} of conversation {conv} does not follow part {self.part - 1} of {self.conv}")
        for p in read_back(data):
            self.all.update(b"%s\n%s\n" % p)
            self.turns += 1
        for text in masked_texts(data, [x - offset for x in starts], [x - offset for x in ends]):
            self.loss.update(text)
            self.chars += len(text.decode())
        self.part, self.offset, self.length = part + 1, offset + len(data), self.length + length

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.chars, self.loss.hexdigest(), self.length


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the formatted text back gives, as digests: all turns, and the texts under the loss mask.

    Rows of a conversation are read as ``format_conversations`` gives them, one after the other; a part that does not
    follow the one before it is an error.
    """
    reachable(formatted.sparkSession)
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def made(done: list[_Digest]) -> pa.RecordBatch:
        columns = zip(*(d.row() for d in done), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        for batch in batches:
            done = []
            for conv, text, starts, ends, length, part, offset in zip(*batch.columns, strict=True):
                conv, part = conv.as_py(), part.as_py()
                if part == 0:
                    done += [now] if now else []
                    now = _Digest(conv)
                elif now is None:
                    raise ValueError(f"part {part} of conversation {conv} comes first")
                now.add(conv, part, offset.as_py(), text.as_buffer().to_pybytes(), starts.as_py(), ends.as_py(), length.as_py())
            if done:
                yield made(done)
        if now:
            yield made([now])

    rows = formatted.select("conv_id", "formatted", "loss_starts", "loss_ends", F.length("formatted").cast("long").alias("formatted_chars"), "part", "offset")
    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
