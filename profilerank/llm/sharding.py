"""Shards that all have the mixture of the corpus: proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source, a row's fractional rank is (rank + 1/2) / rows of the source,
and all rows are ordered by it. Any stretch of that order holds every source in proportion, so cutting it into equal
stretches gives shards whose row counts differ by one at most (law ``rows``).

Both rankings range-partition and sort; a source with a third of the rows spreads over as many partitions as it needs.
Only ids, sources, sizes and checksums move, never texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import positions, stored, with_row


def shuffle_key(id_col: str | Column, seed: str) -> Column:
    """The first 15 hexadecimal digits of the MD5 of seed, colon and id as a number; a null id counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def interleave(docs: DataFrame, shards: int, seed: str = "0", id_col: str = "doc_id", source_col: str = "source",
               text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    Null sources are one source. Null texts have size 8 and checksum 0. Repeated rows are rows of their own: equal
    keys are told apart by checksum and size, and rows equal in all of that are interchangeable. With fewer rows than
    shards some shards stay empty.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    source = with_row(docs, [id_col, source_col, text_col])
    raw = F.coalesce(F.col("c2").cast("binary"), F.lit(b""))
    rows = source.select("c0", "c1", (F.octet_length(raw) + 8).cast("bigint").alias("size"), F.crc32(raw).alias("crc"),
                         shuffle_key("c0", seed).alias("h"))
    within, _ = positions(rows, ["c1", "h", "c0", "crc", "size"], "shard_sources")
    # The first place of a source in that order and its rows: one row per source, combined before the shuffle.
    sources = stored(within.groupBy("c1").agg(F.min("_pos").alias("first"), F.count("*").alias("n")), "shard_counts")
    ranked = within.join(sources.withColumnRenamed("c1", "s"), F.col("c1").eqNullSafe(F.col("s")))
    rank = F.col("_pos") - F.col("first")
    mixed, total = positions(ranked.select("c0", "c1", "size", "crc", "h", ((rank + F.lit(0.5)) / F.col("n")).alias("part")),
                             ["part", "c1", "h", "c0", "crc", "size"], "shard_mixture")
    # Shard s gets the places from ceil(s * total / shards).
    shard = F.expr(f"_pos * {shards} div {max(total, 1)}")
    placed = mixed.withColumn("_shard", shard.cast("bigint"))
    start = F.expr(f"(_shard * {max(total, 1)} + {shards - 1}) div {shards}")
    return placed.select(
        F.col("c0").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"),
        F.col("_shard").cast("int").alias("shard"), (F.col("_pos") - start).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
