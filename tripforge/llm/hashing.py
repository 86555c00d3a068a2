"""Hashes of words and of runs of words for whole batches of texts, with numpy."""

from __future__ import annotations

import numpy as np

# odd multipliers modulo 2 ** 64
ODD = np.uint64(0x9E3779B97F4A7C15)
ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
PLAIN = ~_SPACE                       # bytes of words between ASCII white space


_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64) -> np.ndarray:
    """base ** 0, base ** 1, ... modulo 2 ** 64; a process keeps the longest yet."""
    p = _POWERS.get(int(base))
    if p is None or len(p) < n:
        p = np.ones(max(n, 1 << 16), np.uint64)
        step, size = base, 1
        with np.errstate(over="ignore"):
            while size < len(p):      # doubling: p[size:2 * size] = p[:size] * base ** size
                m = min(size, len(p) - size)
                p[size:size + m] = p[:m] * step
                step, size = step * step, size * 2
        if n <= 1 << 22:
            _POWERS[int(base)] = p
    return p[:n]


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def mixed(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Sum of value * base ** place over each span, brought to the span's start."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * powers(len(values), base), dtype=np.uint64, out=sums[1:])
        back = powers(len(values) + 1, inverse(base))
        return (sums[ends] - sums[starts]) * back[starts]


GROUP = 1 << 19                       # bytes hashed at a time, so that they stay in cache


def hash_words(raw: list[bytes], inside: np.ndarray, base: np.uint64 = ODD) -> tuple[np.ndarray, np.ndarray]:
    """For texts as bytes and the table of bytes that make words: the hash of
    every word in order, and the first word of each text and one past the last."""
    hashes, counts, at = [], [], 0
    while at < len(raw):
        to, size = at, 0
        while to < len(raw) and size < GROUP:
            size += len(raw[to]) + 1
            to += 1
        # a byte outside words stands between texts
        buf = np.frombuffer(b"\n".join([*raw[at:to], b""]), np.uint8)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside[buf], [False])).view(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        hashes.append(mixed(_spans(buf + np.uint64(1), starts, ends, base) + (ends - starts).astype(np.uint64)))
        counts.append(np.diff(np.searchsorted(starts, np.cumsum([len(r) + 1 for r in raw[at:to]])), prepend=0))
        at = to
    none = [np.zeros(0, np.int64)]
    return (np.concatenate(hashes or [np.zeros(0, np.uint64)]),
            np.concatenate(([0], np.cumsum(np.concatenate(counts or none)))).astype(np.int64))


def hash_runs(words: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """A hash of every ``size`` consecutive words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n].copy()
    with np.errstate(over="ignore"):
        for i in range(1, size):
            h *= base
            h += words[i:i + n]
    return mixed(h)
