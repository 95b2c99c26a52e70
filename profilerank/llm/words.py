"""Words and word shingles of whole texts as 64-bit numbers, for many texts at once.

A word's number is a polynomial of its bytes modulo 2**64 with a random-looking value per byte, mixed at the end (a long
word's is a digest, because such polynomials collide on some texts of a thousand bytes); a shingle's is a mixed sum of its words' numbers with a factor per place. The same words give the same numbers in every
task and session.
"""

from __future__ import annotations

import hashlib

import numpy as np

_M1, _M2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: Bytes that are hashed at a time.
BLOCK_BYTES = 1 << 20
#: Words of more bytes are numbered by a digest.
LONG_WORD = 256


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every bit of the input changes every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


with np.errstate(over="ignore"):
    BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
    _WORD_BASE = np.uint64(0x2545F4914F6CDD1D)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the base."""
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1024)
        _powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, _WORD_BASE, dtype=np.uint64))])
    return _powers[:n]


def byte_table(separators: str) -> bytes:
    """A table for bytes.translate: A-Z in lower case, bytes of the ranges ("00-2F 3A-60") as blanks."""
    table = bytearray(range(256))
    for b in range(65, 91):
        table[b] = b + 32
    for part in separators.split():
        low, high = (int(x, 16) for x in part.split("-"))
        for b in range(low, high + 1):
            if not 65 <= b <= 90:
                table[b] = 32
    return bytes(table)


class Words:
    """The words of a list of texts (null is empty): numbers, places, and how many each text has."""

    def __init__(self, texts: list[bytes | None], table: bytes):
        self.data = b" ".join([t or b"" for t in texts]).translate(table)
        data = np.frombuffer(self.data, dtype=np.uint8)
        inside = np.zeros(len(data) + 2, dtype=np.int8)
        inside[1:-1] = data != 32
        edges = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        sizes = np.array([len(t or b"") + 1 for t in texts], dtype=np.int64)
        self.first = np.searchsorted(self.starts, np.cumsum(sizes) - sizes)  # each text's first word
        self.count = np.diff(np.concatenate([self.first, [len(self.starts)]]))
        self.numbers = self._hash(data)

    def _hash(self, data: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.starts), dtype=np.uint64)
        values = BYTE_VALUES.copy()
        values[32] = 0
        at = 0
        while at < len(out):
            end = max(at + 1, int(np.searchsorted(self.ends, self.starts[at] + BLOCK_BYTES, side="right")))
            low, high = self.starts[at], self.ends[end - 1]
            begin = self.starts[at:end] - low
            span = np.diff(np.concatenate([begin, [high - low]]))
            size = (self.ends[at:end] - self.starts[at:end])
            place = np.arange(high - low) - np.repeat(begin, span)
            factor = powers(int(size.max()) + 1)
            terms = values[data[low:high]] * factor[np.minimum(place, len(factor) - 1)]
            out[at:end] = mix(np.add.reduceat(terms, begin) + size.astype(np.uint64) * _GOLD)
            at = end
        for i in np.flatnonzero(self.ends - self.starts > LONG_WORD).tolist():
            digest = hashlib.blake2b(memoryview(self.data)[self.starts[i]:self.ends[i]], digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
        return out

    def shingles(self, n: int) -> np.ndarray:
        """The number of the n words from each word on; meaningless where a text has fewer left."""
        return shingle_numbers(self.numbers, n)

    def left(self) -> np.ndarray:
        """How many words of its text there are from each word on, itself included."""
        return np.repeat(self.first + self.count, self.count) - np.arange(len(self.numbers))

    def text(self, start: int, end: int) -> bytes:
        """The words from start to before end, set apart by single blanks."""
        return b" ".join(self.data[self.starts[start]:self.ends[end - 1]].split()) if end > start else b""


def shingle_numbers(numbers: np.ndarray, n: int) -> np.ndarray:
    if len(numbers) < n:
        return np.zeros(len(numbers), dtype=np.uint64)
    total = np.full(len(numbers) - n + 1, np.uint64(n), dtype=np.uint64)
    factor = _GOLD
    with np.errstate(over="ignore"):
        for i in range(n):
            total += numbers[i:len(numbers) - n + 1 + i] * factor
            factor = factor * _M1 | np.uint64(1)
    return np.concatenate([mix(total), np.zeros(n - 1, dtype=np.uint64)])


class Bloom:
    """A set of 64-bit numbers that may hold a few more: three bits per number in a table of fixed size."""

    def __init__(self, bits: int = 24, table: np.ndarray | None = None):
        self.bits = bits
        self.table = np.zeros(1 << bits >> 3, dtype=np.uint8) if table is None else table

    def _places(self, numbers: np.ndarray):
        mask = np.uint64((1 << self.bits) - 1)
        for shift in (0, 20, 40):
            place = (numbers >> np.uint64(shift)) & mask
            yield (place >> np.uint64(3)).astype(np.int64), np.left_shift(np.uint8(1), (place & np.uint64(7)).astype(np.uint8))

    def add(self, numbers: np.ndarray) -> None:
        for byte, bit in self._places(numbers):
            np.bitwise_or.at(self.table, byte, bit)

    def __contains__(self, numbers):
        raise TypeError("use has")

    def has(self, numbers: np.ndarray) -> np.ndarray:
        """Which numbers may be in the set."""
        at = np.arange(len(numbers))
        for byte, bit in self._places(numbers):
            # Most numbers leave after the first bit.
            at = at[(self.table[byte[at]] & bit[at]) != 0]
            if not len(at):
                break
        out = np.zeros(len(numbers), dtype=bool)
        out[at] = True
        return out
