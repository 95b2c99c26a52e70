"""Benchmark decontamination: exact occurrences of benchmark windows in documents by a prefix-filtered set join.

A window is 13 consecutive words of an item (or a shorter item as a whole). A document that holds a window holds all of
its 3-word shingles, so for a containment of 1 one shingle is the necessary prefix: the rarest one, by the frequency
of the windows' shingles in all documents. Documents are joined to windows on that shingle; its place in the window
fixes where the window would start and end (positional and length bounds), and the words there are compared one by one.

Two passes over the documents, none of them shuffled: one counts the windows' shingles, one keeps, per document, the
places of prefix shingles with the words around them. A Bloom filter of fixed size, built from the benchmark, decides
what the passes look at; what it lets through by chance falls out of the joins. Everything after is as large as the
matches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import arrow_type, fields, flat_map_texts, stored, with_row
from .words import Bloom, Words, byte_table, shingle_numbers

WINDOW, SHINGLE = 13, 3
#: log2 of the bits of a Bloom filter: 2 MB, whatever the benchmark's size.
BLOOM_BITS = 24
# Bytes that separate words, as ranges of hexadecimal numbers.
SEPARATORS = "00-2F 3A-60 7B-7F"
_TABLE = byte_table(SEPARATORS)


def _windows(bench: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """(c0 the item, words, n, shingles): every window of every item with a word."""
    source = with_row(bench, [item_col, text_col])
    schema = T.StructType([T.StructField("c0", source.schema["c0"].dataType), *fields("words string, n int, shingles array<bigint>")])

    def setup():
        def work(part):
            texts = part.column(1).cast(pa.large_binary()).to_pylist()
            rows = []
            for i, text in enumerate(texts):
                words = Words([text], _TABLE)
                total = int(words.count[0])
                n = min(size, total)
                k = min(SHINGLE, n)
                numbers = shingle_numbers(words.numbers, k).view(np.int64) if n else ()
                for s in range(total - n + 1 if n else 0):
                    rows.append((i, words.text(s, s + n).decode("utf-8", "replace"), n, numbers[s:s + n - k + 1].tolist()))
            if rows:
                at, text, n, numbers = zip(*rows)
                yield part.column(0).take(pa.array(at)), list(text), list(n), list(numbers)

        return work

    return flat_map_texts(source, setup, schema)


def _bloom(numbers: DataFrame, bits: int) -> np.ndarray:
    """The filter of a column of numbers: partial tables of fixed size, joined one after another on the driver."""
    def run(batches):
        filled = Bloom(bits)
        for batch in batches:
            filled.add(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array([filled.table.tobytes()])], ["b"])

    table = np.zeros(1 << bits >> 3, dtype=np.uint8)
    for row in numbers.coalesce(8).mapInArrow(run, "b binary").toLocalIterator():
        table |= np.frombuffer(bytes(row["b"]), dtype=np.uint8)
    return table


def _shingle_counts(source: DataFrame, lengths: list[int], bloom) -> DataFrame:
    """(h, n): how often the shingles of the filter occur in all documents."""
    def setup():
        wanted = Bloom(BLOOM_BITS, bloom.value)
        held: list[np.ndarray] = []

        def flush():
            value, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            held.clear()
            yield value.view(np.int64), n

        def work(part):
            words = Words(part.column(0).cast(pa.large_binary()).to_pylist(), _TABLE)
            left = words.left()
            for k in lengths:
                numbers = words.shingles(k)[left >= k]
                held.append(numbers[wanted.has(numbers)])
            if sum(map(len, held)) > 500_000:
                yield from flush()

        work.finish = flush
        return work

    return flat_map_texts(source, setup, fields("h bigint, n bigint")).groupBy("h").agg(F.sum("n").alias("n"))


def _candidates(source: DataFrame, lengths: list[int], bloom, reach: int) -> DataFrame:
    """(c0, n_words, found): every document with the places of prefix shingles and the words around them."""
    found = "found array<struct<h:bigint,p:int,a:int,ctx:string>>"
    schema = T.StructType([T.StructField("c0", source.schema["c0"].dataType), *fields(f"n_words bigint, {found}")])

    def setup():
        wanted = Bloom(BLOOM_BITS, bloom.value)
        kind = arrow_type(schema["found"].dataType)

        def work(part):
            words = Words(part.column(1).cast(pa.large_binary()).to_pylist(), _TABLE)
            left, rows = words.left(), [[] for _ in range(part.num_rows)]
            owner = np.repeat(np.arange(part.num_rows), words.count)
            for k in lengths:
                numbers = words.shingles(k)
                for i in np.flatnonzero(wanted.has(numbers) & (left >= k)).tolist():
                    d = int(owner[i])
                    first = int(words.first[d])
                    low, high = max(first, i - reach), min(first + int(words.count[d]), i + reach + SHINGLE)
                    rows[d].append({"h": int(numbers[i].view(np.int64)), "p": i - first, "a": i - low,
                                    "ctx": words.text(low, high).decode("utf-8", "replace")})
            yield part.column(0), pa.array(words.count), pa.array(rows, kind)

        return work

    return flat_map_texts(source, setup, schema)


def _verify(met: DataFrame) -> DataFrame:
    """(r, s, e, w): documents' places where a window stands, word for word. ``met`` has r, n_words, p, a, ctx, windows."""
    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for row in batch.to_pylist():
                words = row["ctx"].split(" ")
                for window in row["windows"]:
                    start, n = row["p"] - window["o"], window["n"]
                    low = row["a"] - window["o"]
                    if start < 0 or start + n > row["n_words"] or low < 0:
                        continue
                    if words[low:low + n] == window["words"].split(" "):
                        for column, value in zip(out, (row["r"], start, start + n, window["w"])):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32()),
                                              pa.array(out[3], pa.int64())], ["r", "s", "e", "w"])

    return met.mapInArrow(run, "r bigint, s int, e int, w bigint")


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, share: int = 20) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) of every document.

    ``contaminated``: some word is hit, and hit words times ``share`` are at least the words. Nulls and empty texts have
    no words. Repeated documents and items are rows of their own; items that are equal all count. A null item id is no
    item. An empty benchmark hits nothing.
    """
    source = with_row(docs, [id_col, text_col])
    rows = stored(_windows(bench, item_col, item_text_col, window).where("c0 is not null").withColumn("w", F.xxhash64("words", "n")), "bench_windows")
    distinct = rows.groupBy("w", "words", "n").agg(F.first("shingles").alias("shingles"))
    single = distinct.select("w", "words", "n", F.posexplode("shingles").alias("o", "h"))
    lengths = sorted(r[0] for r in rows.select(F.least("n", F.lit(SHINGLE))).distinct().collect())
    spark = docs.sparkSession
    every = spark.sparkContext.broadcast(_bloom(single.select("h").distinct(), BLOOM_BITS))
    counts = _shingle_counts(source.select("c1"), lengths, every)
    order = Window.partitionBy("w").orderBy(F.coalesce("f", F.lit(0)), "h", "o")
    rare = single.join(counts.withColumnRenamed("n", "f"), "h", "left").withColumn("i", F.row_number().over(order)).where("i = 1")
    prefix = stored(rare.groupBy("h").agg(F.collect_list(F.struct("o", "n", "words", "w")).alias("windows")), "bench_prefixes")
    chosen = spark.sparkContext.broadcast(_bloom(prefix.select("h"), BLOOM_BITS))
    places = stored(_candidates(source, lengths, chosen, window).withColumn("r", F.monotonically_increasing_id()), "bench_places")
    single_places = places.where(F.size("found") > 0).select("r", "n_words", F.explode("found").alias("f")).select("r", "n_words", "f.*")
    hits = stored(_verify(single_places.join(prefix, "h").select("r", "n_words", "p", "a", "ctx", "windows")), "bench_hits")

    # Words in the union of intervals: in order of start, each adds what lies beyond the furthest end so far.
    spans = hits.groupBy("r").agg(F.sort_array(F.collect_set(F.struct("s", "e"))).alias("spans"))
    union = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], acc["to"]))).alias("n"),
        F.greatest(x["e"], acc["to"]).alias("to")), lambda acc: acc["n"].cast("bigint"))
    covered = spans.select("r", union.alias("n_hit"))
    items = (hits.select("r", "w").distinct().join(rows.select("w", F.col("c0").cast("string").alias("item")).distinct(), "w")
             .groupBy("r").agg(F.sort_array(F.collect_set("item")).alias("items")))
    out = places.drop("found").join(covered, "r", "left").join(items, "r", "left")
    hit, found = F.coalesce("n_hit", F.lit(0).cast("bigint")), F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        F.col("c0").alias(id_col), "n_words", hit.alias("n_hit"), F.size(found).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(found, ",").cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (hit * share >= F.col("n_words"))).alias("contaminated"))


def keep_clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, that are not contaminated.

    Only ids and text hashes of contaminated documents are joined with the documents.
    """
    text_hash = F.xxhash64(F.col(f"`{text_col}`"))
    keyed = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), text_hash.alias("tx")).alias("_key"), F.col(f"`{text_col}`").alias("_text"))
    bad = contamination(keyed, bench, "_key", "_text", **options).where("contaminated").select(
        F.col("_key.id").alias("_bad_id"), F.col("_key.tx").alias("_bad_tx")).distinct()
    return docs.join(bad, docs[id_col].eqNullSafe(bad["_bad_id"]) & (text_hash == bad["_bad_tx"]), "left_anti")
