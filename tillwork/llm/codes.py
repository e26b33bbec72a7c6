"""Texts as arrays of code points, and hashes of any stretch of them by prefix sums."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


_POWERS = Powers()


class Rolling:
    """Hashes of stretches ``[begin, end)`` of a series; equal stretches have equal hashes."""

    def __init__(self, values: np.ndarray) -> None:
        _POWERS.to(len(values) + 1)
        sums = np.empty(len(values) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(mix(values) * _POWERS.up[:len(values)], dtype=np.uint64, out=sums[1:])
        self.sums = sums

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * _POWERS.down[begin])


def code_points(texts: list[str | None], between: str = "\n") -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, each followed by ``between``; and where each begins (and the end)."""
    gap = between.encode("utf-32-le")
    parts = []
    for text in texts:
        parts += ((text or "").encode("utf-32-le", "surrogatepass"), gap)
    sizes = np.array([len(p) for p in parts[::2]], np.int64) // 4 + 1
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(sizes, out=starts[1:])
    return np.frombuffer(b"".join(parts), "<u4"), starts


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches where ``inside`` holds."""
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edges[::2], edges[1::2]


@lru_cache(1)
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    table = np.zeros(0x110000, bool)
    for block in range(0, 0x110000, 0x1000):
        if block < 0x34000 or block >= 0xE0000:  # no letters are assigned between
            table[block:block + 0x1000] = [chr(c).isalpha() for c in range(block, block + 0x1000)]
    return table


def owners(starts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The text each place lies in."""
    return np.searchsorted(starts, places, side="right") - 1
