"""Word and shingle hashes of whole text batches in numpy.

A word's hash is a polynomial in its bytes over the integers modulo 2**64, taken from running sums, so that a batch
costs a few array passes and no Python step per word. Words are cut at ASCII white space and A-Z are lower-cased.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> _U64(30))
        x = x * _U64(0xBF58476D1CE4E5B9)
        x ^= x >> _U64(27)
        x *= _U64(0x94D049BB133111EB)
        x ^= x >> _U64(31)
    return x


def _tables() -> tuple[np.ndarray, np.ndarray]:
    byte = np.arange(256, dtype=np.uint8)
    lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    space = (byte == 32) | ((byte >= 9) & (byte <= 13))
    return mix((lower.astype(np.uint64) + _U64(1)) * _BASE) | _U64(1), space


VALUE, SPACE = _tables()


def word_hashes(data: bytes | memoryview) -> tuple[np.ndarray, np.ndarray]:
    """Hash and byte offset of every word of ``data``, in order."""
    buf = np.frombuffer(data, dtype=np.uint8)
    hashes, starts, at = [], [], 0
    while at < len(buf):
        end = min(len(buf), at + BLOCK)
        while end < len(buf):  # cut where a word ends
            gap = np.flatnonzero(SPACE[buf[end : end + BLOCK]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(buf), end + BLOCK)
        h, s = _block(buf[at:end])
        hashes.append(h)
        starts.append(s + at)
        at = end
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def _block(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    inside[1:-1] = ~SPACE[buf]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.empty(0, np.uint64), start
    with np.errstate(over="ignore"):
        place = np.arange(len(buf), dtype=np.int64) - np.repeat(start, np.diff(np.append(start, len(buf)))) if start[0] == 0 else None
        if place is None:
            first = np.append(start, len(buf))
            place = np.arange(len(buf), dtype=np.int64)
            place[start[0] :] -= np.repeat(start, np.diff(first))
            place[: start[0]] = 0
        total = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(VALUE[buf] * _power(int(place.max()) + 1)[place], out=total[1:])
        return mix((total[end] - total[start]) ^ ((end - start).astype(np.uint64) << _U64(40))), start


_POWERS = np.ones(1, dtype=np.uint64)


def _power(n: int) -> np.ndarray:
    """At least ``n`` powers of an odd number; what one long word needs beyond the kept ones is not kept."""
    global _POWERS
    if len(_POWERS) >= n:
        return _POWERS
    with np.errstate(over="ignore"):
        powers = np.full(max(n, 4096), _BASE, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
    if n <= BLOCK:
        _POWERS = powers
    return powers


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct ``k``-word shingle hashes of every text.

    A text with fewer than ``k`` words has its whole word sequence as its one shingle; without words its set is empty.
    """
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    words, starts = word_hashes(b"\n".join(texts))
    first = np.searchsorted(starts, bounds)  # of each text's words
    with np.errstate(over="ignore"):
        n = max(0, len(words) - k + 1)
        rolled = np.zeros(n, dtype=np.uint64)
        for i in range(k):
            rolled = mix(rolled * _U64(0xD6E8FEB86659FD93) + words[i : i + n])
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= k:
                out.append(np.unique(rolled[a : b - k + 1]))
            elif b > a:
                whole = np.zeros(1, dtype=np.uint64)
                for w in words[a:b]:
                    whole = mix(whole * _U64(0xD6E8FEB86659FD93) + w)
                out.append(mix(whole ^ _U64(b - a)))
            else:
                out.append(np.empty(0, dtype=np.uint64))
    return out
