"""Repeated passages by fixed-block anchors: every word covered by ``words`` words that also start anywhere else.

Every text is cut into blocks of ``block`` words that do not overlap; they are the index. A passage of ``words`` words
holds ``stretch`` whole blocks at least, one after another, so of its twin it is enough to probe every ``stretch``-th
stretch of ``block`` places, with every rolling window there: one of the blocks meets one of those places, whatever the
distance between the two passages. (``stretch`` 1 probes every window of the text; 3 shuffles 4 numbers per 9 words.)

A hit is a place and a block elsewhere with the same words. Hits are extended to maximal repeats in two steps, without
comparing places in pairs. First, a place and all words around it that a passage over it could hold: places that agree in
all of them are repeated as far as a passage reaches, to both sides, in one step. Second, where a hit has company that
differs somewhere around, which is at the ends of copied passages, every passage over the hit is looked up by its own
words; of places that agree entirely one is enough, counted twice.

Copies of a text share one key, so they cost one list of places, and a task hands on what it finds in a text twice at
most, however many copies it meets. Anchors are met by 64-bit numbers, which only choose what
is looked at; what decides has 128 bits: a word's numbers are two sums over its bytes, a passage's are two sums over its words, each
with a factor per place that follows no pattern, so texts of a regular build do not collide.

Nulls have no words, empty texts neither; texts below ``words`` words are kept whole, copies included. Passages do not cross
texts. Repeated rows, also with one id, repeat each other. Empty tables give empty results. Names of other columns cannot
clash: inside, columns have names of their own. Texts are read whole, of any length.
"""

from __future__ import annotations

import gc
import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import drop_stored, fields, flat_map_texts, stored, with_row
from .words import mix

WORDS, BLOCK, STRETCH = 35, 9, 3
#: Bytes of text that are worked on at a time (of a longer text, piece by piece), and texts a task remembers.
BATCH_BYTES, HELD_TEXTS = 1 << 22, 1 << 19
#: Words above so many bytes get their numbers from a cryptographic hash.
LONG_WORD = 256
_GAP, _WORD = re.compile(rb"[\x20\x09-\x0D]"), re.compile(rb"[^\x20\x09-\x0D]+")


def _factors(n: int, name: str) -> np.ndarray:
    """n odd numbers without a pattern."""
    return np.array([int.from_bytes(hashlib.blake2b(f"{name} {i}".encode(), digest_size=8).digest(), "little") | 1 for i in range(n)], dtype=np.uint64)


_WHITE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_BYTES = tuple(_factors(256, f"byte {half}") for half in ("low", "high"))
_PLACES = tuple(_factors(LONG_WORD, f"place {half}") for half in ("low", "high"))


def _numbers(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each piece, low, high): two numbers of every word, sums over its bytes with a factor per place."""
    joined = b" ".join(pieces)
    data = np.frombuffer(joined, dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_WHITE[data]
    edges = np.diff(inside)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sizes = ends - starts
    letters = data[inside[1:-1] == 1]
    first = np.cumsum(sizes) - sizes
    place = np.minimum(np.arange(len(letters)) - np.repeat(first, sizes), LONG_WORD - 1)
    size = sizes.astype(np.uint64)
    low, high = (mix(np.add.reduceat(values[letters] * factors[place], first) + size) if len(first) else np.zeros(0, dtype=np.uint64)
                 for values, factors in zip(_BYTES, _PLACES))
    for i in np.flatnonzero(sizes >= LONG_WORD).tolist():
        digest = hashlib.blake2b(joined[starts[i]:ends[i]], digest_size=16).digest()
        low[i], high[i] = int.from_bytes(digest[:8], "little"), int.from_bytes(digest[8:], "little")
    lengths = np.array([len(p) + 1 for p in pieces])
    return np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(lengths)]))), low, high


def _pieces(text: bytes):
    """The text, a long one cut at white space."""
    at = 0
    while len(text) - at > BATCH_BYTES:
        gap = _GAP.search(text, at + BATCH_BYTES)
        if not gap:
            break
        yield text[at:gap.start()]
        at = gap.start()
    yield text[at:] if at else text


def _batches(texts):
    """(owners, counts, low, high): texts one after another, of about ``BATCH_BYTES`` bytes in all, or one longer text."""
    owners, held, total = [], [], 0
    for i, text in enumerate(texts):
        if len(text or b"") > BATCH_BYTES:
            parts = [_numbers([piece]) for piece in _pieces(text)]
            yield np.array([i]), np.array([sum(int(p[0][0]) for p in parts)]), *(np.concatenate([p[j] for p in parts]) for j in (1, 2))
            continue
        owners.append(i)
        held.append(text or b"")
        total += len(held[-1])
        if total >= BATCH_BYTES:
            yield np.array(owners), *_numbers(held)
            owners, held, total = [], [], 0
    if held:
        yield np.array(owners), *_numbers(held)


class _Twice:
    """Lets a text pass twice: more copies tell nothing new, whatever their number."""

    def __init__(self):
        self.met: dict[tuple, int] = {}

    def few(self, part):
        """The rows of a batch (r1, r2, ...) that are not the third or later copy."""
        if len(self.met) > HELD_TEXTS:
            self.met = {}
        rows = []
        for i, key in enumerate(zip(part.column("r1").to_pylist(), part.column("r2").to_pylist())):
            times = self.met.get(key, 0)
            if times < 2:
                self.met[key] = times + 1
                rows.append(i)
        return part if len(rows) == part.num_rows else part.take(pa.array(rows, pa.int64()))


def _sums(values: np.ndarray, at: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The number of the words from each place on, as many as there are factors."""
    total = np.zeros(len(at), dtype=np.uint64)
    for j, factor in enumerate(factors):
        total += values[at + j] * factor
    return mix(total)


def _texts(part):
    return (scalar.as_py() for scalar in part.column("raw"))


def _anchors(source: DataFrame, block: int, stretch: int, probes: bool) -> DataFrame:
    """(h, r1, p): the blocks of every text, or the rolling windows that probe them."""
    factors = _factors(block, "anchor")

    def setup():
        met = _Twice()

        def work(part):
            part = met.few(part)
            refs = part.column("r1").to_numpy(zero_copy_only=False)
            for owners, counts, low, _ in _batches(_texts(part)):
                place = np.arange(len(low)) - np.repeat(np.cumsum(counts) - counts, counts)
                inside = place + block <= np.repeat(counts, counts)
                at = np.flatnonzero(inside & (place % (block * stretch) < block if probes else place % block == 0))
                yield _sums(low, at, factors).view(np.int64), refs[np.repeat(owners, counts)[at]], pa.array(place[at], pa.int32())

        return work

    return flat_map_texts(source.select("r1", "r2", "raw"), setup, fields("h bigint, r1 bigint, p int"))


def _around(values: np.ndarray, owner: np.ndarray, texts: int, at: np.ndarray, size: int, reach: int, factors: np.ndarray) -> np.ndarray:
    """The number of ``size`` words from ``reach`` before each place on; beyond the ends of its text stand zeros."""
    padded = np.zeros(len(values) + 2 * reach * texts, dtype=np.uint64)
    padded[np.arange(len(values)) + reach * (2 * owner + 1)] = values
    return _sums(padded, at + 2 * reach * owner[at], factors[:size])


def _occurrences(near: DataFrame, words: int, block: int) -> DataFrame:
    """(c0, r1, r2, h, x1, x2, p) of the places of every text (c0, r1, r2, raw, places)."""
    reach, size = words - block, 2 * words - block
    anchor, factors = _factors(block, "anchor"), [_factors(size + 1, f"around {half}") for half in ("low", "high")]
    schema = T.StructType([near.schema["c0"], *fields("r1 bigint, r2 bigint, h bigint, x1 bigint, x2 bigint, p int")])

    def setup():
        met = _Twice()

        def work(part):
            part = met.few(part)
            lists = part.column("places")
            for owners, counts, low, high in _batches(_texts(part)):
                first = np.cumsum(counts) - counts
                own = [np.sort(lists[i].values.to_numpy(zero_copy_only=False)).astype(np.int64) for i in owners.tolist()]
                # Two texts may share the first of their two keys; what does not fit here belongs to the other.
                own = [p[p + block <= n] if n >= words else p[:0] for p, n in zip(own, counts.tolist())]
                which = np.repeat(np.arange(len(owners)), [len(p) for p in own])
                if not len(which):
                    continue
                place = np.concatenate(own)
                at, texts = place + first[which], np.repeat(np.arange(len(owners)), counts)
                ends = (np.minimum(place, reach) * (words + 1) + np.minimum(counts[which] - place, words)).astype(np.uint64)
                x1, x2 = (mix(_around(values, texts, len(owners), at, size, reach, f) + ends * f[-1]) for values, f in zip((low, high), factors))
                take = pa.array(owners[which])
                yield (*(part.column(c).take(take) for c in ("c0", "r1", "r2")), _sums(low, at, anchor).view(np.int64), x1.view(np.int64),
                       x2.view(np.int64), pa.array(place, pa.int32()))

        return work

    return flat_map_texts(near.select("c0", "r1", "r2", "raw", "places"), setup, schema)


def _passages(near: DataFrame, words: int, block: int) -> DataFrame:
    """(r1, r2, w1, w2, at, weight): every passage over the places of a text (r1, r2, raw, rows), once per start."""
    factors = [_factors(words, f"passage {half}") for half in ("low", "high")]
    reach = words - block

    def setup():
        def work(part):
            lists = part.column("rows")
            for owners, counts, low, high in _batches(_texts(part)):
                first = np.cumsum(counts) - counts
                weight = np.zeros(len(low), dtype=np.int32)
                for i, begin, n in zip(owners.tolist(), first.tolist(), counts.tolist()):
                    for row in lists[i].as_py():
                        starts = weight[begin + max(row["p"] - reach, 0):begin + max(min(row["p"], n - words) + 1, 0)]
                        np.maximum(starts, row["weight"], out=starts)
                at = np.flatnonzero(weight)
                if len(at):
                    which = np.repeat(np.arange(len(owners)), counts)[at]
                    take = pa.array(owners[which])
                    yield (part.column("r1").take(take), part.column("r2").take(take), _sums(low, at, factors[0]).view(np.int64),
                           _sums(high, at, factors[1]).view(np.int64), pa.array(at - first[which], pa.int32()), weight[at])

        return work

    return flat_map_texts(near.select("r1", "r2", "raw", "rows"), setup, fields("r1 bigint, r2 bigint, w1 bigint, w2 bigint, at int, weight int"))


def _settle(spark) -> None:
    """Lets Spark delete the shuffle files of steps whose results are stored."""
    gc.collect()
    spark._jvm.System.gc()


def _keys(df: DataFrame) -> DataFrame:
    """``raw``, the bytes of c1, and two numbers of them that are the key of a text."""
    raw = F.col("c1").cast("binary")
    return df.withColumns({"r1": F.xxhash64(raw), "r2": F.xxhash64(F.lit("second"), raw), "raw": raw}).drop("c1")


def repeated_starts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, block: int = BLOCK,
                    stretch: int = STRETCH) -> DataFrame:
    """(r1, r2, lo, hi): where repeated passages start, per text, as stored lists of intervals."""
    if words < block * (stretch + 1) - 1:
        raise ValueError(f"passages of {words} words need not hold {stretch} whole blocks of {block}")
    spark = docs.sparkSession
    source = _keys(with_row(docs, [id_col, text_col])).where(F.octet_length("raw") >= 2 * words - 1)
    blocks = stored(_anchors(source, block, stretch, False), "blocks")
    index = blocks.groupBy("h").agg(F.count("*").alias("n"), F.min("r1").alias("one_r1"), F.min("p").alias("one_p"))
    probes = _anchors(source, block, stretch, True)
    # A block is met by itself as well; it counts if there is another one, or if the only one stands elsewhere.
    elsewhere = (F.col("n") > 1) | (F.col("r1") != F.col("one_r1")) | (F.col("p") != F.col("one_p"))
    hits = stored(probes.join(index.hint("shuffle_hash"), "h").where(elsewhere).select("h", "r1", "p", (F.col("n") > 1).alias("many")), "hits")
    _settle(spark)
    found = hits.groupBy("h").agg(F.max("many").alias("many"))
    probed = F.col("many") & (F.pmod("p", F.lit(block * stretch)) < block)  # such a block is among the hits itself
    met = blocks.join(found, "h").where(~probed).select("r1", "p")
    places = stored(hits.select("r1", "p").unionByName(met).groupBy("r1").agg(F.collect_set("p").alias("places")), "places")
    drop_stored(blocks)
    drop_stored(hits)
    _settle(spark)

    around = stored(_occurrences(source.join(places, "r1"), words, block), "around")
    drop_stored(places)
    _settle(spark)
    classes = stored(around.groupBy("x1", "x2").agg(
        F.count("*").alias("n"), F.min("h").alias("h"), F.min(F.struct("r1", "r2", "c0", "p")).alias("first")), "around_classes")
    whole = around.join(classes.where("n > 1").select("x1", "x2"), ["x1", "x2"], "left_semi").select(
        "r1", "r2", (F.col("p") - (words - block)).alias("lo"), F.col("p").alias("hi"))
    company = classes.groupBy("h").agg(F.count("*").alias("classes"), F.min("n").alias("least")).where("classes > 1 and least = 1").select("h")
    ends = classes.join(company, "h", "left_semi").select("first.*", F.least("n", F.lit(2)).cast("int").alias("weight"))
    lists = ends.groupBy("r1", "r2", "c0").agg(F.collect_list(F.struct("p", "weight")).alias("rows"))
    # One of the copies of a text stands for all.
    here = F.expr("a.r1 = b.r1 and a.r2 = b.r2 and a.c0 <=> b.c0")
    wanted = source.alias("a").join(lists.alias("b"), here).select("a.r1", "a.r2", "a.raw", "b.rows")
    passages = stored(_passages(wanted, words, block), "passages")
    _settle(spark)
    again = passages.groupBy("w1", "w2").agg(F.sum("weight").alias("n")).where("n > 1").select("w1", "w2")
    single = passages.where("weight = 1").join(again, ["w1", "w2"], "left_semi").select("r1", "r2", F.col("at").alias("lo"), F.col("at").alias("hi"))
    out = stored(whole.unionByName(single).groupBy("r1", "r2").agg(F.collect_set(F.struct("lo", "hi")).alias("s"))
                 .select("r1", "r2", F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi")), "passage_starts")
    for step in (around, classes, passages):
        drop_stored(step)
    _settle(spark)
    return out


def covered(n: int, lo, hi, words: int) -> np.ndarray:
    """Which of n words belong to a passage that starts in one of the intervals."""
    last = n - words
    change = np.zeros(n + 1, dtype=np.int32)
    if lo is not None and len(lo) and last >= 0:
        lo, hi = np.maximum(np.asarray(lo, dtype=np.int64), 0), np.minimum(np.asarray(hi, dtype=np.int64), last)
        real = lo <= hi
        np.add.at(change, lo[real], 1)
        np.add.at(change, hi[real] + words, -1)
    return np.cumsum(change[:n]) > 0


def cut(text: bytes | None, lo, hi, words: int) -> tuple[bytes, int, int, bytes]:
    """(text left, words, words removed, words left joined by one blank); a word goes with the white space after it."""
    text = text or b""
    if lo is None or not len(lo):
        own = text.split()
        return text, len(own), 0, b" ".join(own)
    spans = [m.span() for m in _WORD.finditer(text)]
    gone = covered(len(spans), lo, hi, words)
    pieces, kept, at = [], [], 0
    for i in np.flatnonzero(gone).tolist():
        start = spans[i][0]
        if start > at:
            pieces.append(text[at:start])
        at = spans[i + 1][0] if i + 1 < len(spans) else len(text)
    pieces.append(text[at:])
    kept = [text[spans[i][0]:spans[i][1]] for i in np.flatnonzero(~gone).tolist()]
    return b"".join(pieces), len(spans), int(gone.sum()), b" ".join(kept)


def _with_starts(docs: DataFrame, columns: list[str], id_col: str, text_col: str, words: int, options: dict) -> DataFrame:
    """(c0, c2, c3, ..., raw, lo, hi): all rows, with the intervals of their text."""
    starts = repeated_starts(docs, id_col, text_col, words, **options)
    return _keys(with_row(docs, [id_col, text_col, *columns])).join(starts, ["r1", "r2"], "left")


def passage_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, **options: int) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, text) of every document; ``text`` is what is left."""
    source = _with_starts(docs, [], id_col, text_col, words, options).select("c0", "raw", "lo", "hi")
    schema = T.StructType([T.StructField(id_col, source.schema["c0"].dataType), *fields("n_words bigint, n_removed bigint, kept_sha256 string, text string")])

    def setup():
        def work(part):
            rows = []
            for text, lo, hi in zip(_texts(part), part.column(2).to_pylist(), part.column(3).to_pylist()):
                left, n, removed, kept = cut(text, lo, hi, words)
                rows.append((n, removed, hashlib.sha256(kept).hexdigest(), left.decode("utf-8", "replace")))
            if rows:
                yield part.column(0), *map(list, zip(*rows))

        return work

    return flat_map_texts(source, setup, schema)


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, **options: int) -> DataFrame:
    """The documents with all their columns and the remaining text; null stays null."""
    @F.pandas_udf("string")
    def rest(text: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else cut(t, a, b, words)[0].decode("utf-8", "replace") for t, a, b in zip(text, lo, hi)], dtype=object)

    others = [c for c in docs.columns if c != text_col]
    made = _with_starts(docs, others, id_col, text_col, words, options).withColumn("rest", rest("raw", "lo", "hi"))
    place = {c: f"c{i + 2}" for i, c in enumerate(others)} | {text_col: "rest"}
    return made.select(*[F.col(place[c]).alias(c) for c in docs.columns])
