"""Prefix-free parsing of byte strings: rolling-hash triggers, phrases, and fingerprints of any substring.

A trigger is a place where the rolling hash of the next ``GRAM`` bytes is 0 modulo ``EVERY``. Triggers depend on those
bytes only, so equal strings have equal triggers, and no phrase (the bytes from one trigger to the next) is a proper
prefix of another that ends in the same place.
"""

from __future__ import annotations

import numpy as np

from .words import BYTE_VALUES, mix

GRAM, EVERY = 16, 64

_LEFT, _RIGHT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_HALF = np.uint64(32)

_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
_table = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _table
    if len(_table[0]) < n:
        size = max(n, 1 << 16)
        one = [np.uint64(1)]
        _table = tuple(np.concatenate([one, np.cumprod(np.full(size - 1, b, dtype=np.uint64))]) for b in (_BASE, _INVERSE))
    return _table


def _join(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """A number for each pair; not linear, and pairs in the other order have another."""
    x = one * _LEFT
    x += two * _RIGHT
    x ^= x >> _HALF
    x *= _LEFT
    x ^= x >> _HALF
    return x


class Prints:
    """Two fingerprints of substrings of one buffer, independent of each other.

    ``of`` takes prefix sums of a polynomial modulo 2**64. These collide on long texts built like the Thue-Morse word;
    ``second`` does not: it joins the numbers of halves to numbers of twice the length, mixed at every step.
    """

    def __init__(self, data: bytes):
        bytes_ = np.frombuffer(data, dtype=np.uint8)
        up, self.down = _powers(len(bytes_) + 1)
        self.sums = np.zeros(len(bytes_) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[bytes_] * up[:len(bytes_)], out=self.sums[1:])
        self._doubled: list[np.ndarray] = []

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The fingerprints of the bytes from start to before end."""
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))

    def rolling(self, size: int) -> np.ndarray:
        """The fingerprint of the next ``size`` bytes at every place that has so many."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, dtype=np.uint64)

    def _level(self, level: int) -> np.ndarray:
        """The numbers of the next ``GRAM * 2**level`` bytes at every place that has so many."""
        if not self._doubled:
            self._doubled.append(self.rolling(GRAM))
        while len(self._doubled) <= level:
            last, half = self._doubled[-1], GRAM << len(self._doubled) - 1
            self._doubled.append(_join(last[:len(last) - half], last[half:]) if len(last) > half else last[:0])
        return self._doubled[level]

    def second(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The second fingerprints of the bytes from start to before end: of their first and last largest power of two."""
        length = end - start
        level = np.frexp(np.maximum(length, 1) / GRAM)[1] - 1
        if not len(length):
            return np.zeros(0, dtype=np.uint64)
        out = self.of(start, end) if level.min() < 0 else np.empty(len(length), dtype=np.uint64)
        for each in range(max(0, int(level.min())), int(level.max()) + 1):
            numbers, size = self._level(each), GRAM << each
            if level.min() == level.max():
                return mix(_join(numbers[start], numbers[end - size]) + length.astype(np.uint64))
            here = level == each
            out[here] = mix(_join(numbers[start[here]], numbers[end[here] - size]) + length[here].astype(np.uint64))
        return out

    def triggers(self) -> np.ndarray:
        return np.flatnonzero(self._level(0) >> np.uint64(58) == 0)
