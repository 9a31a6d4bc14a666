"""Forward and backward recursions over all segmentations of words into vocabulary pieces, in log space.

Words of one length are handled together: for every piece length one array of piece numbers per start,
then one step per position. Characters that are no piece are spelled by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from inkprint.functions.shipping import ship_with_job

ship_with_job(__name__)

START = "▁"
_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15)
#: Characters of words that are handled in one step.
_CELLS = 200_000


class Pieces:
    """Lookup of piece strings by a rolling hash of their code points."""

    def __init__(self, texts: list[str]) -> None:
        hashes = np.array([self._hash(t) for t in texts], _U)
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], order
        self.longest = max((len(t) for t in texts), default=1)
        self.size = len(texts)

    @staticmethod
    def _hash(text: str) -> int:
        value = 0
        for ch in text:
            value = (value * int(_MULTIPLIER) + ord(ch) + 1) & 0xFFFFFFFFFFFFFFFF
        return value

    def arcs(self, codes: np.ndarray) -> list[np.ndarray]:
        """For lengths 1, 2, ...: piece numbers by word and start, ``size`` where there is none."""
        n, m = codes.shape
        plus, rolled, out = codes.astype(_U) + _U(1), np.zeros((n, m), _U), []
        for length in range(1, min(self.longest, m) + 1):
            rolled = rolled[:, : m - length + 1] * _MULTIPLIER + plus[:, length - 1:]
            at = np.minimum(np.searchsorted(self.keys, rolled.ravel()), len(self.keys) - 1)
            found = np.where(self.keys[at] == rolled.ravel(), self.ids[at], self.size)
            out.append(found.reshape(rolled.shape))
        return out


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, code points) of words with equal length, the start mark put before each."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        m = int(lengths[order[at]]) + 1
        same = int(np.searchsorted(lengths[order], m - 1, "right"))
        to = min(same, at + max(1, _CELLS // m))
        text = "".join(START + words[i] for i in order[at:to])
        yield order[at:to], np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(to - at, m)
        at = to


def _spelled(codes: np.ndarray, byte_scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score of each character by its bytes; the distinct characters and where each stands."""
    distinct, inverse = np.unique(codes, return_inverse=True)
    scores = np.array([byte_scores[list(chr(c).encode("utf-8", "replace"))].sum() for c in distinct])
    inverse = inverse.reshape(codes.shape)
    return scores[inverse], distinct, inverse


def _log_sum(terms: list[np.ndarray]) -> np.ndarray:
    stacked = np.stack(terms)
    top = stacked.max(axis=0)
    return top + np.log(np.exp(stacked - top).sum(axis=0))


def _weights(pieces: Pieces, scores: np.ndarray, byte_scores: np.ndarray, codes: np.ndarray):
    ids = pieces.arcs(codes)
    spelled, distinct, inverse = _spelled(codes, byte_scores)
    padded = np.append(scores, -np.inf)
    weights = [padded[i] for i in ids]
    lone = ids[0] == pieces.size
    weights[0] = np.where(lone, spelled, weights[0])
    return ids, weights, lone, distinct, inverse


def _forward(weights: list[np.ndarray], n: int, m: int) -> np.ndarray:
    alpha = np.full((n, m + 1), -np.inf)
    alpha[:, 0] = 0
    for j in range(1, m + 1):
        alpha[:, j] = _log_sum([alpha[:, j - k] + weights[k - 1][:, j - k] for k in range(1, min(j, len(weights)) + 1)])
    return alpha


def log_marginals(words: list[str], pieces: Pieces, scores: np.ndarray, byte_scores: np.ndarray) -> np.ndarray:
    """Natural log of the summed probability of all segmentations of each word."""
    out = np.zeros(len(words))
    for at, codes in _by_length(words):
        _, weights, _, _, _ = _weights(pieces, scores, byte_scores, codes)
        out[at] = _forward(weights, *codes.shape)[:, -1]
    return out


def expected_counts(words: list[str], times: np.ndarray, pieces: Pieces, scores: np.ndarray, byte_scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expected uses of each piece and byte over all segmentations, each word counted ``times``."""
    used, spelled = np.zeros(pieces.size + 1), np.zeros(256)
    for at, codes in _by_length(words):
        n, m = codes.shape
        ids, weights, lone, distinct, inverse = _weights(pieces, scores, byte_scores, codes)
        alpha = _forward(weights, n, m)
        beta = np.full((n, m + 1), -np.inf)
        beta[:, m] = 0
        for j in range(m - 1, -1, -1):
            beta[:, j] = _log_sum([beta[:, j + k] + weights[k - 1][:, j] for k in range(1, min(m - j, len(weights)) + 1)])
        total, many = alpha[:, m, None], times[at][:, None]
        for k, (i, w) in enumerate(zip(ids, weights), 1):
            share = many * np.exp(alpha[:, : m - k + 1] + w + beta[:, k:] - total)
            if k == 1:
                by_char = np.bincount(inverse[lone], share[lone], len(distinct))
                for c in np.flatnonzero(by_char):
                    for b in chr(distinct[c]).encode("utf-8", "replace"):
                        spelled[b] += by_char[c]
                share = np.where(lone, 0, share)
            used += np.bincount(i.ravel(), share.ravel(), pieces.size + 1)
    return used[:-1], spelled
