"""Words of many texts at once, as numpy arrays over their joined bytes."""

from __future__ import annotations

import numpy as np

#: White space: \x20 and \x09 to \x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base^0 .. base^(n-1), modulo 2^64, kept for the next call unless large."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(have)
        if size <= 1 << 21:
            _powers[name] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """sums[i]: polynomial hash of the first i bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE[data] * _power("up", BASE, len(data)), out=sums[1:])
    return sums


def spans_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, equal for equal bytes at any place."""
    with np.errstate(over="ignore"):
        raw = (sums[stop] - sums[start]) * _power("down", BASE_INVERSE, len(sums))[start]
        return mix(raw + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, doc) of every word; words do not cross texts."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~IS_SPACE[data]
    first = np.zeros(len(data), bool)
    begins = offsets[:-1]
    first[begins[begins < len(data)]] = True
    start = np.flatnonzero(inside & (first | ~np.concatenate(([False], inside[:-1]))))
    last = np.concatenate((first[1:], [True]))
    stop = np.flatnonzero(inside & (last | ~np.concatenate((inside[1:], [False])))) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return start, stop, doc


def windows(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place of its first word) of every window of ``n`` words of one
    text; nothing for a text of fewer words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = len(hashes) - n + 1
    total = np.zeros(size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            total = total * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[i:i + size]
    place = np.flatnonzero(doc[:size] == doc[n - 1:])
    return mix(total[place]), place
