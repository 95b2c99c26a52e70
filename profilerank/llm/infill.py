"""Fill-in-the-middle: a text cut in three, and its parts in another order between sentinels.

The places where a text may be cut are a set of byte offsets: 0, and the end of every code point. It is kept the way
Roaring keeps sets: offsets that agree in all but their low 16 bits share a container, which is a sorted array, a bitmap
or a list of runs, whichever is smallest, and cumulative cardinalities stand beside the containers. The k-th cut is found
by a search in these and a selection inside one container; ASCII text is one run, so the whole set costs a few bytes.

Everything about a document follows from its id, its text and the seed: no shuffle, and a repeated task gives the same
rows. Null texts are empty, null ids count as the empty string. Empty texts and texts that hold a sentinel stay as they
are (form ``plain``). Repeated rows get equal results; an empty table gives none; other columns are neither read nor
returned, whatever their names. Texts of any length are cut whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import fields, flat_map_texts, with_row

# What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

LOW_BITS = 16
_WORDS = (1 << LOW_BITS) // 64
_BITS = np.arange(64, dtype=np.uint64)


class ArrayContainer:
    """Sorted low halves."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    @staticmethod
    def size(count: int, runs: int) -> int:
        return 2 * count

    def select(self, k: int) -> int:
        return int(self.low[k])

    def rank(self, value: int) -> int:
        return int(np.searchsorted(self.low, value, side="right"))


class BitmapContainer:
    """One bit per low half, and how many bits are set before each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << LOW_BITS, dtype=np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))])

    @staticmethod
    def size(count: int, runs: int) -> int:
        return 8 * _WORDS

    def _ones(self, word: int) -> np.ndarray:
        return np.flatnonzero((self.words[word] >> _BITS) & np.uint64(1))

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        return 64 * word + int(self._ones(word)[k - int(self.before[word])])

    def rank(self, value: int) -> int:
        word, bit = divmod(value, 64)
        return int(self.before[word]) + int(np.searchsorted(self._ones(word), bit, side="right"))


class RunContainer:
    """First low half of every run of neighbours, and how many offsets lie before each run."""

    def __init__(self, low: np.ndarray):
        first = np.flatnonzero(np.concatenate([[True], np.diff(low) != 1]))
        self.start = low[first].astype(np.int64)
        self.before = np.concatenate([first, [len(low)]]).astype(np.int64)

    @staticmethod
    def size(count: int, runs: int) -> int:
        return 2 + 4 * runs

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.start[run]) + k - int(self.before[run])

    def rank(self, value: int) -> int:
        run = int(np.searchsorted(self.start, value, side="right")) - 1
        if run < 0:
            return 0
        return min(int(self.before[run]) + value - int(self.start[run]) + 1, int(self.before[run + 1]))


_KINDS = (RunContainer, ArrayContainer, BitmapContainer)


class BoundarySet:
    """A set of offsets (sorted, distinct) that answers: which is the k-th, and how many are at most a value."""

    def __init__(self, offsets: np.ndarray):
        high = offsets >> LOW_BITS
        first = np.flatnonzero(np.concatenate([[True], np.diff(high) != 0])) if len(offsets) else np.zeros(0, dtype=np.int64)
        self.keys = high[first]
        self.before = np.concatenate([first, [len(offsets)]])
        self.containers = []
        for begin, end in zip(self.before[:-1].tolist(), self.before[1:].tolist()):
            low = offsets[begin:end] & ((1 << LOW_BITS) - 1)
            runs = 1 + int(np.count_nonzero(np.diff(low) != 1))
            self.containers.append(min(_KINDS, key=lambda kind: kind.size(end - begin, runs))(low))

    @classmethod
    def of_code_points(cls, data: bytes) -> "BoundarySet":
        """Where the code points of UTF-8 bytes start, and the end of the last one."""
        starts = np.flatnonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)
        return cls(np.append(starts, len(data)))

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The offset with k smaller ones before it."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return (int(self.keys[at]) << LOW_BITS) + self.containers[at].select(k - int(self.before[at]))

    def rank(self, offset: int) -> int:
        """How many offsets are at most this one."""
        at = int(np.searchsorted(self.keys, offset >> LOW_BITS, side="right")) - 1
        if at < 0:
            return 0
        if int(self.keys[at]) < offset >> LOW_BITS:
            return int(self.before[at + 1])
        return int(self.before[at]) + self.containers[at].rank(offset & ((1 << LOW_BITS) - 1))


def transform(data: bytes, numbers: tuple[int, int, int, int], plain_percent: int = 10, spm_percent: int = 20):
    """(n, form, prefix_chars, middle_chars, output) of one text and four numbers that follow from its id."""
    cuts = BoundarySet.of_code_points(data)
    n = len(cuts) - 1
    first, second, keep, order = numbers
    if not data or any(s in data for s in (PREFIX, SUFFIX, MIDDLE)) or keep % 100 >= 100 - plain_percent:
        return n, "plain", None, None, data
    a, b = sorted((first % (n + 1), second % (n + 1)))
    low, high = cuts.select(a), cuts.select(b)
    prefix, middle, suffix = data[:low], data[low:high], data[high:]
    if order % 100 < spm_percent:
        return n, "spm", a, b - a, b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", a, b - a, b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def restore(output: bytes, form: str) -> bytes:
    """The text again. Its parts hold no sentinel, so the first of each is the one that was put there."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    left, _, rest = output[len(first):].partition(second)
    right, _, middle = rest.partition(MIDDLE)
    return left + middle + right if form == "psm" else right + middle + left


def _numbered(docs: DataFrame, id_col: str, text_col: str, seed: int) -> DataFrame:
    """(c0, c1 as bytes, h1 to h4): four 32-bit numbers from the hash of seed and id."""
    source = with_row(docs, [id_col, text_col])
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("c0").cast("string"), F.lit(""))).cast("binary"), 256)

    def number(i: int) -> Column:
        return F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}")

    return source.withColumn("_digest", digest).select("c0", F.col("c1").cast("binary").alias("c1"), *map(number, range(4)))


def _run(docs: DataFrame, id_col: str, text_col: str, seed: int, made: T.StructType, finish, options: dict) -> DataFrame:
    source = _numbered(docs, id_col, text_col, seed)
    schema = T.StructType([T.StructField(id_col, source.schema["c0"].dataType), *made])

    def setup():
        def work(part):
            numbers = zip(*[part.column(i).to_pylist() for i in range(2, 6)])
            rows = [finish(*transform(scalar.as_py() or b"", h, **options)) for scalar, h in zip(part.column(1), numbers)]
            if rows:
                yield part.column(0), *map(list, zip(*rows))

        return work

    return flat_map_texts(source, setup, schema)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, **options: int) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): every document transformed, or plain.

    ``plain_percent`` and ``spm_percent`` say how many texts stay plain, and how many of the others have the suffix first.
    """
    def finish(n, form, prefix, middle, output):
        return n, form, prefix, middle, output.decode("utf-8", "replace")

    made = fields("n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")
    return _run(docs, id_col, text_col, seed, made, finish, options)


def infill_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, **options: int) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256); the restored text is rebuilt from output and form."""
    def finish(n, form, prefix, middle, output):
        return n, form, prefix, middle, hashlib.sha256(output).hexdigest(), hashlib.sha256(restore(output, form)).hexdigest()

    made = fields("n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string")
    return _run(docs, id_col, text_col, seed, made, finish, options)
