"""Vectorised hashing of words and shingles, for use inside tasks.

A word's hash is a polynomial over random values of its bytes, taken from running sums of the whole
buffer; texts are hashed in slices, so memory follows the slice and the longest word, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from inkprint.functions.shipping import ship_with_job

ship_with_job(__name__)

SLICE = 1 << 20
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTES = np.random.default_rng(20240).integers(1, 1 << 63, 256, np.int64).astype(_U) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose outputs look independent."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


def hash_words(texts: list[str | None], gaps: np.ndarray = _SPACE, starts_of: tuple[int, ...] = ()) -> tuple:
    """Hashes of all words of the texts, A-Z lower-cased, and where each text's words begin and end.

    ``gaps`` marks the bytes between words. For each length in ``starts_of`` a further array holds the hash of
    that many first bytes of each word, 0 for shorter words.
    """
    blobs = [t.encode("utf-8", "replace").lower() if t else b"" for t in texts]
    data = np.frombuffer(b"\n".join([*blobs, b""]), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~gaps[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[0::2], edges[1::2]
    hashes = np.empty(len(starts), _U)
    firsts = [np.zeros(len(starts), _U) for _ in starts_of]
    up, down, at = _powers(_BASE, SLICE), _powers(_INVERSE, SLICE), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + SLICE, "right")))
        first, length = starts[at], int(ends[to - 1] - starts[at])
        if length > len(up):
            up, down = _powers(_BASE, length), _powers(_INVERSE, length)
        sums = np.zeros(length + 1, _U)
        np.cumsum(_BYTES[data[first:first + length]] * up[:length], out=sums[1:])
        s, e = starts[at:to] - first, ends[at:to] - first
        hashes[at:to] = (sums[e] - sums[s]) * down[s]
        for size, out in zip(starts_of, firsts):
            long = e - s >= size
            out[at:to][long] = mix((sums[s[long] + size] - sums[s[long]]) * down[s[long]])
        at = to
    offsets = np.cumsum([0, *[len(b) + 1 for b in blobs]])
    return (mix(hashes), np.searchsorted(starts, offsets), *firsts)


def slices(texts: list[str | None], most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters each."""
    at, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held >= most:
            yield at, k + 1
            at, held = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def shingle_sets(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each text; a shorter text is one shingle, one without words none."""
    for first, last in slices(texts):
        words, at = hash_words(texts[first:last])
        n = max(0, len(words) - width + 1)
        rolled = np.zeros(n, _U)
        for k in range(width):
            rolled = rolled * _U(0xD6E8FEB86659FD93) + words[k:k + n]
        rolled = mix(rolled)
        for k in range(last - first):
            a, b = at[k], at[k + 1]
            if b - a >= width:
                yield np.unique(rolled[a:b - width + 1])
            else:
                whole = np.full(1, b - a, _U)
                for h in words[a:b]:
                    whole = whole * _U(0xD6E8FEB86659FD93) + h
                yield mix(whole) if b > a else np.zeros(0, _U)
