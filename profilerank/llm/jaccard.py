"""Similarity join on word shingles: documents linked by Jaccard similarity, and their connected groups.

Shingles are ordered rarest first. Two sets that are similar enough share a shingle among the first few of both (the
prefix), their sizes are close (length filter), what can still follow the first shared shingle is enough (positional
filter), and the counts of their shingles in fixed parts of the hash space do not differ too much (suffix filter: the
differences add up to at most the size of the symmetric difference). What passes is compared exactly, once per pair.

Equal sets are one class, and only classes are compared. The groups are found without all pairs of a large group: first
each class is compared with one pivot per shared prefix shingle, the class with the fewest rarer shingles; then, where
classes that share a prefix shingle are still in different groups, all pairs of different groups that pass the filters.
A pair inside a group cannot change the groups, so no link between different texts is lost.

The order by rarity uses counts of every shingle of every document in tables of fixed size: a count is the least of
two slots that hashes choose, so a common shingle is never taken for a rare one. The order is the same for every task,
and the result does not depend on it. Classes that share a prefix shingle are joined by size bands as well, so a shingle
that many groups share is not one key. Classes are told apart by a 64-bit fingerprint of the set.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import drop_stored, fields, flat_map_texts, stored, with_row
from .graph import components
from .repeats import BUCKETS, _buckets, _keyed, _same, _settle
from .words import Words, byte_table, mix, shingle_numbers

SHINGLE, PERCENT = 3, 90
#: Parts of the hash space that the suffix filter counts.
PARTS = 64
#: Slots of each of the two tables of frequencies; what is sent to the executors has two bytes a slot.
FREQUENCIES = 1 << 21
#: Slots that go through a shuffle together.
STRETCH = 1 << 16
#: Shingles a task holds before it adds them up.
HELD = 500_000
# Bytes that separate words, as ranges of hexadecimal numbers.
SEPARATORS = "09-0D 20-20"
_TABLE = byte_table(SEPARATORS)
_SALT = np.uint64(0xA0761D6478BD642F)


def shingle_sets(texts: list[bytes | None], n: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingle numbers of each text in order; a text of fewer words has one, without words none."""
    words = Words(texts, _TABLE)
    numbers = words.shingles(n)
    out = []
    for first, count in zip(words.first.tolist(), words.count.tolist()):
        if count >= n:
            out.append(np.unique(numbers[first:first + count - n + 1]))
        elif count:
            out.append(shingle_numbers(words.numbers[first:first + count], count)[:1])
        else:
            out.append(numbers[:0])
    return out


def class_of(shingles: np.ndarray) -> int:
    """A fingerprint of a set: two sums of mixed numbers, mixed into one."""
    one, two = mix(shingles).sum(dtype=np.uint64), mix(shingles ^ _SALT).sum(dtype=np.uint64)
    return int(mix(np.array([one ^ mix(np.array([two]))[0]]) + np.uint64(len(shingles))).view(np.int64)[0])


def prefix_size(n: int, percent: int) -> int:
    """Shingles of which a similar set holds at least one: n - ceil(percent * n / 100) + 1."""
    return n - -(-percent * n // 100) + 1


def _need(a: str, b: str, percent: int) -> str:
    """The shared shingles that sets of these sizes need, rounded up."""
    return f"(({percent} * ({a} + {b}) + {99 + percent}) div {100 + percent})"


def _slots(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slots of each shingle, in the first table and in the second, which follows it."""
    low = np.uint64(FREQUENCIES - 1)
    return (shingles & low).astype(np.int64), ((shingles >> np.uint64(32)) & low).astype(np.int64) + FREQUENCIES


class Counts:
    """How often shingles occur: two tables, handed on in stretches of slots."""

    def __init__(self):
        self.tables = np.zeros(2 * FREQUENCIES, dtype=np.int64)

    def add(self, shingles: np.ndarray) -> None:
        for slots in _slots(shingles):
            np.add.at(self.tables, slots, 1)

    def merge(self, place: int, counts: bytes) -> None:
        data = zlib.decompress(counts)
        self.tables[place * STRETCH:(place + 1) * STRETCH] += np.frombuffer(data, dtype=f"u{len(data) // STRETCH}").astype(np.int64)

    def stretches(self) -> tuple[list[int], list[bytes]]:
        """(places, counts) of the stretches that are not all zero, as the narrowest numbers that hold them."""
        rows = self.tables.reshape(-1, STRETCH)
        most = rows.max(axis=1)
        places = np.flatnonzero(most).tolist()
        return places, [zlib.compress(rows[i].astype(np.min_scalar_type(most[i].astype(np.uint64))).tobytes(), 1) for i in places]

    def logarithms(self) -> np.ndarray:
        """The counts on a scale that orders them and needs two bytes: 1/1024 of a doubling is one step."""
        return np.round(np.log2(1.0 + self.tables) * 1024).astype(np.uint16)


def commonness(shingles: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The least that the two tables have for each shingle: never less than its own count."""
    one, two = _slots(shingles)
    return np.minimum(scale[one], scale[two])


def _summaries(source: DataFrame, n: int) -> DataFrame:
    """(c0, tx, n, cid, parts) of every document, and rows (slot, seen): stretches of each task's counts."""
    schema = T.StructType([T.StructField("c0", source.schema["c0"].dataType), *fields("tx bigint, n bigint, cid bigint, parts binary, slot int, seen binary")])

    def setup():
        held: list[np.ndarray] = []
        state = {"size": 0}
        counts = Counts()

        def settle():
            if held:
                counts.add(np.concatenate(held))
                held.clear()
                state["size"] = 0

        def work(part):
            sets = shingle_sets(part.column(2).to_pylist(), n)
            held.extend(sets)
            state["size"] += sum(map(len, sets))
            parts = [np.minimum(np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=PARTS), 255).astype(np.uint8).tobytes() for s in sets]
            none = [None] * len(sets)
            yield part.column(0), part.column(1), [len(s) for s in sets], [class_of(s) if len(s) else None for s in sets], parts, none, none
            if state["size"] > HELD:
                settle()

        def finish():
            settle()
            places, seen = counts.stretches()
            none = [None] * len(places)
            return [(none, none, none, none, none, places, seen)]

        work.finish = finish
        return work

    return flat_map_texts(source.select("c0", "tx", "raw"), setup, schema)


def _frequencies(summaries: DataFrame) -> np.ndarray:
    """The scale of all tasks' counts. Tasks add up what they read, then each place's stretches meet; the driver gets one
    row per place."""
    def add_up(batches):
        counts = Counts()
        for batch in batches:
            for place, seen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts.merge(place, seen)
        places, seen = counts.stretches()
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(seen, pa.binary())], ["slot", "seen"])

    rows = summaries.where("slot is not null").select("slot", "seen").mapInArrow(add_up, "slot int, seen binary")
    met = rows.repartition("slot").mapInArrow(add_up, "slot int, seen binary").toArrow()
    total = Counts()
    for place, seen in zip(met["slot"].to_pylist(), met["seen"].to_pylist()):
        total.merge(place, seen)
    return total.logarithms()


def _prefixes(source: DataFrame, n: int, percent: int, table) -> DataFrame:
    """(token, cid, n, pos) of the prefix of every document's set."""
    def setup():
        scale = table.value

        def work(part):
            out = []
            for s in shingle_sets(part.column(0).to_pylist(), n):
                if len(s):
                    size = prefix_size(len(s), percent)
                    order = np.lexsort((s, commonness(s, scale)))[:size]
                    out.append((s[order].view(np.int64), np.full(size, class_of(s)), np.full(size, len(s)), np.arange(size)))
            if out:
                token, cid, length, place = (np.concatenate(x) for x in zip(*out))
                yield token, cid, pa.array(length, pa.int32()), pa.array(place, pa.int32())

        return work

    return flat_map_texts(source.select("raw"), setup, fields("token bigint, cid bigint, n int, pos int"))


def _suffix_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets can still be similar by the counts of their parts."""
    @F.pandas_udf("boolean")
    def possible(one: pd.Series, two: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        x = np.frombuffer(b"".join(one), dtype=np.uint8).reshape(-1, PARTS).astype(np.int32)
        y = np.frombuffer(b"".join(two), dtype=np.uint8).reshape(-1, PARTS).astype(np.int32)
        total = n.to_numpy() + m.to_numpy()
        shared = (total - np.abs(x - y).sum(axis=1)) // 2
        return pd.Series(100 * shared >= percent * (total - shared))

    small = classes.select("cid", "n", "parts")
    one = small.select(F.col("cid").alias("a"), F.col("n").alias("n_a"), F.col("parts").alias("p_a"))
    two = small.select(F.col("cid").alias("b"), F.col("n").alias("n_b"), F.col("parts").alias("p_b"))
    return pairs.join(one, "a").join(two, "b").where(possible("p_a", "p_b", "n_a", "n_b")).select("a", "b")


def _links(pairs: DataFrame, classes: DataFrame, source: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar: their texts are fetched and the sets compared."""
    @F.pandas_udf("boolean")
    def similar(one: pd.Series, two: pd.Series) -> pd.Series:
        out = []
        for start in range(0, len(one), 64):
            xs, ys = shingle_sets(one.iloc[start:start + 64].tolist(), n), shingle_sets(two.iloc[start:start + 64].tolist(), n)
            for x, y in zip(xs, ys):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                out.append(shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
        return pd.Series(out, dtype=bool)

    named = pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct()
    first = stored(named.join(classes, "cid").select("cid", "first.c0", "first.tx"), "pair_classes")
    near = source.join(_buckets(first), F.pmod("tx", F.lit(BUCKETS)) == F.col("bucket"), "left_semi")
    texts = stored(near.alias("x").join(first.alias("y"), _same("x", "y")).select("y.cid", "x.raw").dropDuplicates(["cid"]), "pair_texts")
    one = texts.select(F.col("cid").alias("a"), F.col("raw").alias("raw_a"))
    two = texts.select(F.col("cid").alias("b"), F.col("raw").alias("raw_b"))
    out = stored(pairs.join(one, "a").join(two, "b").where(similar("raw_a", "raw_b")).select("a", "b"), "pair_links")
    drop_stored(first)
    drop_stored(texts)
    return out


def _can_match(x: str, y: str, percent: int) -> Column:
    """Length and positional filter of two prefix rows; their columns are n and pos."""
    rest = f"1 + least({x}.n - 1 - {x}.pos, {y}.n - 1 - {y}.pos)"
    return F.expr(f"100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n) and {rest} >= {_need(f'{x}.n', f'{y}.n', percent)}")


def _band(n: str, percent: int) -> str:
    """The band of a size: sizes that the length filter lets meet are in one band or in the next."""
    return f"cast(floor(ln({n}) / ln(100.0D / {min(percent, 99)})) as int)"


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """(c0, tx, n, component_id, label) of every document, tx a hash of its text. The label tells groups apart, also those
    whose smallest ids are equal or null; it is null without words."""
    spark = docs.sparkSession
    source = _keyed(docs, id_col, text_col)
    summaries = stored(_summaries(source, shingle), "shingle_sets")
    scale = _frequencies(summaries)
    rows = summaries.where("slot is null").select("c0", "tx", "n", "cid", "parts")
    classes = stored(rows.where("n > 0").groupBy("cid").agg(
        F.first("n").cast("int").alias("n"), F.first("parts").alias("parts"), F.min("c0").alias("least"),
        F.min(F.struct("tx", "c0")).alias("first")), "set_classes")

    prefixes = stored(_prefixes(source, shingle, percent, spark.sparkContext.broadcast(scale)), "prefixes")
    tokens = stored(prefixes.groupBy("token").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).where("low <> high").select("token"), "tokens")
    _settle(spark)
    met = stored(prefixes.join(tokens, "token").distinct(), "prefixes_met")
    drop_stored(prefixes)
    drop_stored(tokens)
    _settle(spark)

    # A pivot has the fewest rarer shingles before the shared one.
    pivots = met.groupBy("token").agg(F.min(F.struct("pos", "n", "cid")).alias("p")).select("token", "p.pos", "p.n", "p.cid")
    star = met.alias("x").join(pivots.alias("y"), F.expr("x.token = y.token and x.cid <> y.cid") & _can_match("x", "y", percent))
    star = star.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()
    tried = stored(_suffix_filter(star, classes, percent), "star_pairs")
    links = _links(tried, classes, source, shingle, percent)
    labels = components(links)
    _settle(spark)

    labelled = met.join(labels.withColumnRenamed("id", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    labelled = stored(labelled, "prefixes_labelled")
    open_tokens = labelled.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("token")
    rest = stored(labelled.join(open_tokens, "token", "left_semi"), "prefixes_open")
    # The smaller set of a pair has its first shared shingle in a prefix for sets of its own size.
    index = rest.where(F.expr(f"pos <= n - {_need('n', 'n', percent)}")).withColumn("band", F.expr(
        f"explode(sequence({_band('n', percent)}, {_band(f'100L * n div {percent}', percent)}))"))
    banded = rest.withColumn("band", F.expr(_band("n", percent)))
    pairs = index.alias("x").join(banded.alias("y"), F.expr(
        "x.token = y.token and x.band = y.band and x.label <> y.label and (x.n < y.n or x.n = y.n and x.cid < y.cid)") & _can_match("x", "y", percent))
    pairs = pairs.select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b")).distinct()
    others = stored(_suffix_filter(pairs.join(tried, ["a", "b"], "left_anti"), classes, percent), "other_pairs")
    more = _links(others, classes, source, shingle, percent)
    _settle(spark)
    groups = components(links.unionByName(more))

    named = classes.select("cid", "least").join(groups.withColumnRenamed("id", "cid"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = stored(named.select("cid", "label").join(least, "label").select("cid", "component_id", "label"), "set_groups")
    joined = rows.select("c0", "tx", "n", "cid").join(of_class, "cid", "left")
    return joined.select("c0", "tx", "n", F.coalesce("component_id", "c0").alias("component_id"), "label")


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                   percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) of every document.

    Documents are linked when 100 * shared shingles >= percent * shingles in either. ``component_id`` is the smallest id
    that links reach, the own one included. Null texts and texts without words have no shingles and no links. Repeated
    ids are documents of their own; a null id is never a component's id while there is another.
    """
    found = _grouped(docs, id_col, text_col, shingle, percent)
    return found.select(F.col("c0").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents, with all their columns, one of each group: the one with the smallest id.

    Documents without words are all kept. Of rows with the same id and text one stays; documents that share an id, or have
    none, but are not similar all stay.
    """
    found = stored(_grouped(docs, id_col, text_col, shingle, percent).where("n > 0"), "grouped_rows")
    rows = found.groupBy("c0", "tx").agg(F.first("label").alias("label"), F.count("*").alias("times"))
    # A null id sorts last, so it stays only where its group has no other.
    first = rows.groupBy("label").agg(F.min(F.struct(F.col("c0").isNull().alias("none"), "c0", "tx")).alias("f")).select("label", "f")
    # Rows and those that stay meet by id and text: the label of a large group would be one key.
    best = first.select("f.c0", "f.tx", F.lit(True).alias("stays"))
    judged = rows.alias("r").join(best.alias("g"), _same("r", "g"), "left").select("r.c0", "r.tx", F.coalesce("g.stays", F.lit(False)).alias("stays"), "r.times")
    decided = stored(judged.where("not stays or times > 1"), "grouped_decisions")
    columns = docs.columns
    renamed = with_row(docs, [id_col, text_col, *columns])
    source = renamed.withColumn("tx", F.xxhash64(F.col("c1").cast("binary"))).drop("c1")
    joined = source.alias("a").join(decided.alias("b"), _same("a", "b"), "left").select("a.*", "b.stays")
    alone = joined.where("stays is null")
    repeated = joined.where("stays").dropDuplicates(["c0", "tx"])
    return alone.unionByName(repeated).select(*[F.col(f"c{i + 2}").alias(c) for i, c in enumerate(columns)])
