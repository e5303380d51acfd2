"""Polynomial hashes of byte ranges modulo 2**64, vectorised."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, "u8"), np.ones(1, "u8")]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse: ``size`` of each at least; kept for the worker's life."""
    if len(_powers[0]) < size:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size + (size >> 3), base, "u8")
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class Ranges:
    """Hashes of ranges of one byte string: equal ranges have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = powers(len(data) + 1)
        self.total = np.zeros(len(data) + 1, "u8")
        np.cumsum((data.astype("u8") + np.uint64(1)) * power[:len(data)], dtype="u8", out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.total[ends] - self.total[starts]) * self.inverse[starts] + (ends - starts).astype("u8"))

    def all(self, length: int) -> np.ndarray:
        """The hash of the range of ``length`` from every place on."""
        n = len(self.total) - length
        return mixed((self.total[length:] - self.total[:n]) * self.inverse[:n] + np.uint64(length))
