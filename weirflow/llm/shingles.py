"""Hashes of words and word shingles, by numpy over many texts at once.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. A word's hash is a polynomial in its
bytes, taken from one prefix sum over the whole buffer, so no word is ever cut out in Python.
"""

from __future__ import annotations

import numpy as np

from weirflow.llm.common import CHUNK

_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_FACTORS = np.random.default_rng(20240301).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 2 * CHUNK)
        _powers[:] = [
            np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)]))
            for b in (_BASE, pow(_BASE, -1, 2**64))
        ]
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of a buffer."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edges = np.diff(inside)
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = _power_tables(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=total[1:])
    return start, mix((total[end] - total[start]) * down[start])


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of a text's words; a long text is read piece by piece, cut at white space."""
    data, pieces, at = np.frombuffer(text, np.uint8), [], 0
    while at < len(data):
        end = at + CHUNK
        while end < len(data) and not _SPACE[data[end]]:
            gap = np.flatnonzero(_SPACE[data[end : end + CHUNK]])
            end = end + int(gap[0]) if len(gap) else end + CHUNK
        pieces.append(_words(data[at:end])[1])
        at = end
    return np.concatenate(pieces) if pieces else np.zeros(0, np.uint64)


def _windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words; with fewer words, of all of them."""
    k = min(k, len(words))
    if not k:
        return words
    n = len(words) - k + 1
    total = words[:n] * _FACTORS[0]
    for j in range(1, k):
        total += words[j : j + n] * _FACTORS[j]
    return mix(total)


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending. Callers pass texts of about CHUNK bytes together."""
    if len(texts) == 1 and len(texts[0]) > CHUNK:
        return [np.unique(_windows(word_hashes(texts[0]), k))]
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    start, words = _words(data)
    ends = np.cumsum([len(t) + 1 for t in texts])
    cuts = np.concatenate([[0], np.searchsorted(start, ends)])
    every = _windows(words, k) if len(words) >= k else words
    return [
        np.unique(every[a : b - k + 1] if b - a >= k else _windows(words[a:b], k))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())
    ]
