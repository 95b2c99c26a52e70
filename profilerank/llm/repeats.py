"""Repeated passages: every byte covered by a string of ``size`` bytes that also starts anywhere else.

By prefix-free parsing. Rolling-hash triggers cut every text into phrases; a dictionary entry is a phrase's stretch of
the parse up to ``size`` bytes past it, and an entry's place in the corpus order is the fingerprint of that stretch.
Entries that are equal that far share a place, so all strings that start in them are repeated, and copies of a passage
cost one row per phrase, not one per byte. Entries that have only the core in common with others (the ends of copied
passages) are ordered byte by byte, each distinct entry once, however many copies it has.

The order is by fingerprint, not alphabetical: equal stretches are neighbours either way, nothing else is asked of the
order, and a shuffle by fingerprint needs no sample of the text and has no hot range.

Strings without a trigger (a few in a thousand, and periodic text) are rows of their own; a text's own repetitions among
them are settled in the task. What counts as equal agrees in two independent fingerprints: rows in 128 bits, single
strings in 96. For 3e12 strings (100 TB) fewer than 1e-4 are expected to be taken for repeated wrongly.

Nulls are empty. Texts below ``size`` bytes have no such strings and are kept whole, copies included. Matches never
cross documents. Repeated rows, also with the same id, repeat each other. Texts are worked on in blocks.

Passages of so many words are found in the same way, over texts that have each word replaced by the eight bytes of its
number: a word belongs to a passage if all its bytes are covered. Words are set apart by white space, whatever its
length.
"""

from __future__ import annotations

import gc
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import drop_stored, fields, flat_map_texts, stored, with_row
from .phrases import GRAM, Prints
from .words import Words, mix

SIZE = 400
#: Strings of one entry start within so many bytes; more makes fewer rows and longer ends to order byte by byte.
SPAN = 100
#: Strings that start in one block.
BLOCK = 1 << 19
#: A table of so many hash buckets is broadcast to leave out documents without a match early: its bound.
BUCKETS = 1 << 19
#: Bytes of a word's number.
CODE = 8
# White space as blanks; letters keep their case.
_WORD_TABLE = bytes(32 if 9 <= b <= 13 else b for b in range(256))


def word_codes(texts: list[bytes | None]) -> list[bytes]:
    """Each text as the numbers of its words, ``CODE`` bytes a word."""
    found = Words(texts, _WORD_TABLE)
    return [found.numbers[first:first + count].tobytes() for first, count in zip(found.first.tolist(), found.count.tolist())]


def _segments(texts: list[bytes | None], size: int):
    """(text, offset, bytes) of all texts of at least ``size`` bytes, long ones in blocks that overlap."""
    for i, text in enumerate(texts):
        if text is not None and len(text) >= size:
            for start in range(0, len(text) - size + 1, BLOCK):
                yield i, start, text[start:start + BLOCK + size - 1]


def _batches(texts: list[bytes | None], size: int):
    """Segments of about one block in all."""
    held, total = [], 0
    for segment in _segments(texts, size):
        held.append(segment)
        total += len(segment[2])
        if total >= BLOCK:
            yield held
            held, total = [], 0
    if held:
        yield held


def entries(texts: list[bytes | None], size: int = SIZE, span: int = SPAN, step: int = 1):
    """Yields (text, key, entry, lo, hi, weight) arrays: strings that start from lo to hi of a text, at multiples of ``step``.

    All strings of a row hold its key. Key -1 with weight 0: strings known to be repeated. lo -1: a string that occurs
    several times in its text, there only to be met by others.
    """
    for part in _batches(texts, size):
        owner = np.array([i for i, _, _ in part])
        length = np.array([len(b) for _, _, b in part])
        ends = np.cumsum(length)
        starts = ends - length
        shift = np.array([s for _, s, _ in part]) - starts
        prints = Prints(b"".join(b for _, _, b in part))
        at = prints.triggers()
        seg = np.searchsorted(ends, at, side="right")
        inside = at + GRAM <= ends[seg]
        at, seg = at[inside], seg[inside]
        new = np.concatenate([[True], seg[1:] != seg[:-1]]) if len(seg) else np.zeros(0, dtype=bool)
        after = np.where(new, starts[seg], np.concatenate([[0], at[:-1]]) + 1)
        low, high = np.maximum(after, at - (size - GRAM)), np.minimum(at, ends[seg] - size)
        for b in range(-(-(size - GRAM + 1) // span)):
            lo, hi = np.maximum(low, at - span * b - span + 1), np.minimum(high, at - span * b)
            m = np.flatnonzero(hi >= lo)
            if not len(m):
                continue
            t, lo, hi = at[m], lo[m], hi[m]
            # The bytes that all strings of a row share, whatever lo and hi are elsewhere.
            key = prints.of(t - span * b, np.maximum(t - span * b - span + 1 + size, t + GRAM)) ^ np.uint64(b)
            entry = prints.second(lo, hi + size) ^ mix((t - lo).astype(np.uint64))
            s = seg[m]
            yield owner[s], key, entry, lo + shift[s], hi + shift[s], np.ones(len(m), dtype=np.int32)
        # Strings without a trigger: up to the last that starts too early for the next one, and after the last one.
        last = np.full(len(part), -1)
        last[seg] = at
        gap_lo = np.concatenate([after, np.where(last >= 0, last + 1, starts)])
        gap_hi = np.concatenate([np.minimum(at - (size - GRAM) - 1, ends[seg] - size), ends - size])
        gap_seg = np.concatenate([seg, np.arange(len(part))])
        m = gap_hi >= gap_lo
        if m.any():
            yield from _free(prints, gap_lo[m], gap_hi[m], gap_seg[m], owner, shift, size, step)


def _free(prints: Prints, lo, hi, seg, owner, shift, size, step):
    count = hi - lo + 1
    place = np.repeat(lo - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    seg = np.repeat(seg, count)
    if step > 1:
        real = (place + shift[seg]) % step == 0
        place, seg = place[real], seg[real]
        if not len(place):
            return
    number, second = prints.of(place, place + size), prints.second(place, place + size)
    order = np.lexsort((second, number, seg))
    number, second, place, seg = number[order], second[order], place[order], seg[order]
    start = np.flatnonzero(np.concatenate([[True], (number[1:] != number[:-1]) | (second[1:] != second[:-1]) | (seg[1:] != seg[:-1])]))
    times = np.diff(np.concatenate([start, [len(number)]]))
    single = times == 1
    at = place[start] + shift[seg[start]]
    lo_out = np.where(single, at, -1)
    yield owner[seg[start]], number[start], second[start], lo_out, lo_out, np.minimum(times, 2).astype(np.int32)
    many = np.repeat(~single, times)
    if many.any():
        p, s = place[many], seg[many]
        order = np.argsort(p)
        p, s = p[order], s[order]
        begin = np.concatenate([[True], (p[1:] != p[:-1] + step) | (s[1:] != s[:-1])])
        first = np.flatnonzero(begin)
        end = np.concatenate([first[1:], [len(p)]]) - 1
        no = np.zeros(len(first), dtype=np.uint64)
        yield owner[s[first]], no, no, p[first] + shift[s[first]], p[end] + shift[s[first]], np.zeros(len(first), dtype=np.int32)


def _parse(source: DataFrame, size: int, words: bool) -> DataFrame:
    """(c0, tx, key, entry, lo, hi, weight) of all documents."""
    schema = T.StructType([source.schema["c0"], source.schema["tx"], *fields("key bigint, entry bigint, lo int, hi int, weight int")])

    def setup():
        def work(part):
            texts = part.column(2).to_pylist()
            if words:
                texts = word_codes(texts)
            for owner, key, entry, lo, hi, weight in entries(texts, size, step=CODE if words else 1):
                take = pa.array(owner)
                yield (part.column(0).take(take), part.column(1).take(take), key.view(np.int64), entry.view(np.int64),
                       pa.array(lo, pa.int32()), pa.array(hi, pa.int32()), weight)

        return work

    return flat_map_texts(source.select("c0", "tx", "raw"), setup, schema)


def _strings(wanted: DataFrame, size: int, words: bool) -> DataFrame:
    """(c0, tx, number, other, at, weight) of every string of the wanted rows (c0, tx, raw, rows): ``other`` is half of the
    second fingerprint."""
    schema = T.StructType([wanted.schema["c0"], wanted.schema["tx"], *fields("number bigint, other int, at int, weight int")])

    def setup():
        def work(part):
            texts, rows = part.column(2).to_pylist(), part.column(3).to_pylist()
            if words:
                texts = word_codes(texts)
            for i, (text, row) in enumerate(zip(texts, rows)):
                row.sort(key=lambda x: x["lo"])
                # Neighbouring rows are fingerprinted together, far ones apart: a long text is not read whole at once.
                at = 0
                while at < len(row):
                    base, end = row[at]["lo"], at + 1
                    while end < len(row) and row[end]["hi"] - base < BLOCK:
                        end += 1
                    prints = Prints(text[base:max(r["hi"] for r in row[at:end]) + size])
                    place = np.concatenate([np.arange(r["lo"], r["hi"] + 1) for r in row[at:end]])
                    weight = np.concatenate([np.full(r["hi"] - r["lo"] + 1, r["weight"], dtype=np.int32) for r in row[at:end]])
                    if words:
                        # A passage starts where a word does.
                        place, weight = place[place % CODE == 0], weight[place % CODE == 0]
                    number = prints.of(place - base, place - base + size).view(np.int64)
                    other = (prints.second(place - base, place - base + size) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                    take = pa.array(np.full(len(place), i))
                    yield part.column(0).take(take), part.column(1).take(take), number, other, pa.array(place, pa.int32()), weight
                    at = end

        return work

    return flat_map_texts(wanted, setup, schema)


def _settle(spark) -> None:
    """Lets Spark delete the shuffle files of steps whose results are stored."""
    gc.collect()
    spark._jvm.System.gc()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    raw = F.col("c1").cast("binary")
    return with_row(docs, [id_col, text_col]).select("c0", F.xxhash64(raw).alias("tx"), raw.alias("raw"))


def _buckets(rows: DataFrame) -> DataFrame:
    """The hash buckets of the documents of these rows: at most ``BUCKETS`` numbers, so they may be broadcast."""
    return F.broadcast(rows.select(F.pmod("tx", F.lit(BUCKETS)).alias("bucket")).distinct())


def _same(left: str, right: str):
    return F.expr(f"{left}.c0 <=> {right}.c0 and {left}.tx = {right}.tx")


def repeated_starts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, words: int | None = None) -> DataFrame:
    """(c0, tx, lo, hi): where repeated strings start, per document (id and text hash), as stored lists of intervals.

    With ``words``, of the texts as word numbers: strings of so many words.
    """
    size, least = (size, size) if words is None else (CODE * words, 2 * words - 1)
    spark = docs.sparkSession
    source = _keyed(docs, id_col, text_col)
    parsed = stored(_parse(source.where(F.octet_length("raw") >= least), size, words is not None), "parse")
    real = parsed.where("weight > 0")
    shared = stored(real.groupBy("key").agg(F.sum("weight").alias("n")).where("n > 1").select("key"), "shared")
    _settle(spark)
    met = stored(real.join(shared, "key"), "met")
    known = stored(parsed.where("weight = 0").select("c0", "tx", "lo", "hi"), "known")
    drop_stored(parsed)
    drop_stored(shared)
    _settle(spark)

    dictionary = stored(met.groupBy("key", "entry").agg(
        F.sum("weight").alias("n"), F.min(F.struct("lo", "hi", "c0", "tx")).alias("first")), "dictionary")
    whole = met.join(dictionary.where("n > 1").select("key", "entry"), ["key", "entry"], "left_semi").where("lo >= 0").select("c0", "tx", "lo", "hi")
    open_keys = dictionary.groupBy("key").agg(F.count("*").alias("entries"), F.min("n").alias("least")).where("entries > 1 and least = 1")
    ends = stored(dictionary.join(open_keys.select("key"), "key", "left_semi").select(
        "first.c0", "first.tx", "first.lo", "first.hi", F.least("n", F.lit(2)).cast("int").alias("weight")).where("lo >= 0"), "ends")
    per_doc = ends.groupBy("c0", "tx").agg(F.collect_list(F.struct("lo", "hi", "weight")).alias("rows"))
    near = source.join(_buckets(ends), F.pmod("tx", F.lit(BUCKETS)) == F.col("bucket"), "left_semi")
    wanted = near.alias("a").join(per_doc.alias("b"), _same("a", "b")).select("a.c0", "a.tx", "a.raw", "b.rows")
    strings = stored(_strings(wanted, size, words is not None), "strings")
    _settle(spark)
    numbers = strings.groupBy("number", "other").agg(F.sum("weight").alias("n")).where("n > 1").select("number", "other")
    single = strings.where("weight = 1").join(numbers, ["number", "other"]).select("c0", "tx", F.col("at").alias("lo"), F.col("at").alias("hi"))
    everything = whole.unionByName(known).unionByName(single)
    out = stored(everything.groupBy("c0", "tx").agg(F.collect_set(F.struct("lo", "hi")).alias("s"))
                 .select("c0", "tx", F.col("s.lo").alias("lo"), F.col("s.hi").alias("hi")), "starts")
    for step in (met, known, dictionary, ends, strings):
        drop_stored(step)
    _settle(spark)
    return out


def covered(n: int, lo, hi, size: int) -> np.ndarray:
    """Which of n bytes belong to a string that starts in one of the intervals."""
    change = np.zeros(n + 1, dtype=np.int32)
    np.add.at(change, np.asarray(lo), 1)
    np.add.at(change, np.asarray(hi) + size, -1)
    return np.cumsum(change[:n]) > 0


def _word_cover(text: bytes, lo, hi, words: int) -> np.ndarray:
    """Which bytes belong to words of passages that start in one of the intervals, with the white space after each word."""
    found = Words([text], _WORD_TABLE)
    inside = covered(CODE * len(found.starts), lo, hi, CODE * words).reshape(-1, CODE).all(axis=1)
    change = np.zeros(len(text) + 1, dtype=np.int32)
    change[found.starts[inside]] += 1
    np.add.at(change, np.append(found.starts[1:], len(text))[inside], -1)
    return np.cumsum(change[:-1]) > 0


def _cut(text: bytes | None, lo, hi, size: int) -> tuple[bytes, int, int]:
    """(bytes left, bytes removed, runs removed)."""
    text = text or b""
    if lo is None or not len(lo):
        return text, 0, 0
    gone = covered(len(text), lo, hi, size)
    data = np.frombuffer(text, dtype=np.uint8)
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return data[~gone].tobytes(), int(gone.sum()), runs


def _both_starts(docs: DataFrame, id_col: str, text_col: str, size: int, words: int) -> DataFrame:
    """(c0, tx, lo, hi, word_lo, word_hi): the intervals of strings of ``size`` bytes and of ``words`` words."""
    of_bytes, of_words = (repeated_starts(docs, id_col, text_col, size, n) for n in (None, words))
    none = F.array().cast("array<int>")
    rows = of_bytes.select("c0", "tx", "lo", "hi", none.alias("word_lo"), none.alias("word_hi")).unionByName(
        of_words.select("c0", "tx", none.alias("lo"), none.alias("hi"), F.col("lo").alias("word_lo"), F.col("hi").alias("word_hi")))
    names = ("lo", "hi", "word_lo", "word_hi")
    grouped = rows.groupBy("c0", "tx").agg(F.collect_list(F.struct(*names)).alias("s"))
    out = stored(grouped.select("c0", "tx", *[F.flatten(f"s.{n}").alias(n) for n in names]), "both_starts")
    drop_stored(of_bytes)
    drop_stored(of_words)
    return out


def _apply(docs: DataFrame, columns: list[str], id_col: str, text_col: str, starts: DataFrame, made: str, function) -> DataFrame:
    """The columns, renamed to c2, c3, ..., and ``made``, a function of the text and the intervals. Untouched documents do not move."""
    names = starts.columns[2:]
    renamed = with_row(docs, [id_col, text_col, *columns])
    raw = F.col("c1").cast("binary")
    source = renamed.withColumns({"tx": F.xxhash64(raw), "raw": raw}).drop("c1").withColumn("bucket", F.pmod("tx", F.lit(BUCKETS)))
    buckets = _buckets(starts)
    near = source.join(buckets, "bucket", "left_semi")
    far = source.join(buckets, "bucket", "left_anti")
    joined = near.alias("a").join(starts.alias("b"), _same("a", "b"), "left").select("a.*", *[f"b.{n}" for n in names])
    none = F.lit(None).cast("array<int>")
    both = joined.unionByName(far.select("*", *[none.alias(n) for n in names]))
    return both.withColumn(made, function("raw", *names))


def _left_of_both(text: bytes | None, lo, hi, word_lo, word_hi, size: int, words: int) -> str | None:
    """What is left without repeated strings of ``size`` bytes and without repeated passages of ``words`` words."""
    if text and lo is not None:
        gone = covered(len(text), lo, hi, size) | _word_cover(text, word_lo, word_hi, words)
        text = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
    return None if text is None else text.decode("utf-8", "ignore")


def repeat_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, words: int | None = None) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every document, by strings of ``size`` bytes.

    With ``words`` also ``text``: what is left when repeated passages of at least so many words go as well, however short in
    bytes; null is empty.
    """
    made, names = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string", ["n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def row(text, lo, hi) -> tuple:
        kept, removed, runs = _cut(text, lo, hi, size)
        return len(text or b""), removed, runs, hashlib.sha256(kept).hexdigest()

    @F.pandas_udf(f"struct<{made}>")
    def digest(text: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([row(*x) for x in zip(text, lo, hi)], columns=names)

    @F.pandas_udf(f"struct<{made}, text string>")
    def digest_and_text(text: pd.Series, lo: pd.Series, hi: pd.Series, word_lo: pd.Series, word_hi: pd.Series) -> pd.DataFrame:
        rows = [(*row(t, a, b), _left_of_both(t or b"", a, b, c, d, size, words)) for t, a, b, c, d in zip(text, lo, hi, word_lo, word_hi)]
        return pd.DataFrame(rows, columns=[*names, "text"])

    if words is None:
        found = _apply(docs, [], id_col, text_col, repeated_starts(docs, id_col, text_col, size), "d", digest)
    else:
        found = _apply(docs, [], id_col, text_col, _both_starts(docs, id_col, text_col, size, words), "d", digest_and_text)
    return found.select(F.col("c0").alias(id_col), "d.*")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, words: int | None = None) -> DataFrame:
    """The documents with all their columns and the remaining text; bytes of a cut character go with it. Null stays null.

    With ``words``, repeated passages of at least so many words go too, however short in bytes, each word with the white
    space after it. Both are found in the whole texts.
    """
    @F.pandas_udf("string")
    def rest(text: pd.Series, lo: pd.Series, hi: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _cut(t, a, b, size)[0].decode("utf-8", "ignore") for t, a, b in zip(text, lo, hi)], dtype=object)

    @F.pandas_udf("string")
    def rest_of_both(text: pd.Series, lo: pd.Series, hi: pd.Series, word_lo: pd.Series, word_hi: pd.Series) -> pd.Series:
        return pd.Series([_left_of_both(*x, size, words) for x in zip(text, lo, hi, word_lo, word_hi)], dtype=object)

    others = [c for c in docs.columns if c != text_col]
    if words is None:
        made = _apply(docs, others, id_col, text_col, repeated_starts(docs, id_col, text_col, size), "rest", rest)
    else:
        made = _apply(docs, others, id_col, text_col, _both_starts(docs, id_col, text_col, size, words), "rest", rest_of_both)
    place = {c: f"c{i + 2}" for i, c in enumerate(others)} | {text_col: "rest"}
    return made.select(*[F.col(place[c]).alias(c) for c in docs.columns])
