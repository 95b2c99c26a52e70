"""Scoring only what is new, and running counts of rule hits.

A run reads the files that arrived since the last one, transforms them row by row and stops. What
was read is in the stream's checkpoint, which lives in the shared folder, so a restarted run
neither repeats nor loses rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..schema import ID
from ..session import make_folder

# Rows that a task gathers before it keeps the least of each key.
_HELD_ROWS = 10_000


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, form: str = "parquet", files_per_batch: int = 100, pattern: str = "*",
) -> DataFrame:
    """New files of a folder as a stream."""
    return (
        spark.readStream.schema(schema).format(form).option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", pattern).load(folder)
    )


def read_table_stream(spark: SparkSession, path: str, schema: T.StructType, form: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    """The files of one table as a stream, whether the table is a file or a folder of part files.

    A stream takes a folder or a pattern but no single file, so the path is given as a pattern that fits itself only.
    """
    path = path.rstrip("/")
    return read_stream(spark, f"{path[:-1]}[{path[-1]}]", schema, form, files_per_batch)


def _least_rows(batches: list[pa.RecordBatch], key: str, first: list[str]) -> pa.Table:
    """Of every key the least row by ``first``; missing values come before all others."""
    table = pa.Table.from_batches(batches)
    order = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in first], null_placement="at_start").to_numpy() if first else np.arange(table.num_rows)
    codes = np.concatenate([c.indices.to_numpy() for c in table.column(key).dictionary_encode("encode").chunks])
    best = np.zeros(table.num_rows, dtype=bool)
    best[order[np.unique(codes[order], return_index=True)[1]]] = True
    return table.filter(pa.array(best))


def _least(key: str, first: list[str]):
    """Of every key in an Arrow batch the least row, so that a key with very many copies moves a few rows only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _least_rows([batch], key, first).to_batches()

    return run


def _least_of_part(key: str, first: list[str]):
    """Of every key in a partition the least row. Holds the keys of the partition, and at most as many rows again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, limit = [], 0, _HELD_ROWS
        for batch in batches:
            if not batch.num_rows:
                continue
            held, rows = [*held, batch], rows + batch.num_rows
            if rows >= limit:
                least = _least_rows(held, key, first)
                held, rows, limit = least.to_batches(), least.num_rows, max(_HELD_ROWS, 2 * least.num_rows)
        if held:
            yield from _least_rows(held, key, first).to_batches()

    return run


def new_rows(source: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Of every key the row in its earliest batch, and of that batch the least by ``order``, then by the other columns.

    Rows are dealt by key and the least ones chosen in Arrow batches, so no key costs a call of its own. Which keys have
    come is known to ``dropDuplicates``, in Spark's state store: one entry per key, kept on the executors, divided by the
    shuffle partitions and saved with the stream's checkpoint (use the RocksDB provider for more keys than fit in memory).
    A batch looks up its own keys only; a task holds its share of a batch's keys. Columns must be comparable.
    """
    first = [*(order or []), *[c for c in source.columns if c != key and c not in (order or [])]]
    dealt = source.mapInArrow(_least(key, first), source.schema).repartition(F.col(f"`{key}`"))
    return dealt.mapInArrow(_least_of_part(key, first), source.schema).dropDuplicates([key])


def stream_score(
    source: DataFrame, score: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str = ID, order: list[str] | None = None,
) -> StreamingQuery:
    """Scores rows whose ``key`` has not come before (``new_rows``) and adds them; stops when all files are read.

    Each micro-batch writes its own folder, which a repeated batch overwrites, so a failure between write and commit does
    not double rows. Neither output nor ids of earlier batches are read again.
    """
    def write(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        new_rows(source, key, order).writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after their window was closed, over the recent micro-batches of a query; they are in no count."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in json.loads(p.json)["stateOperators"])


def stream_append(source: DataFrame, out: str, checkpoint: str, form: str = "parquet") -> StreamingQuery:
    """A row-local stream added to a table of files, exactly once; for sources without repeated ids."""
    return (
        source.writeStream.format(form).option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def rule_counts(
    hits: DataFrame, time: str = "ts", rule: str = "rule", window: str = "1 day", delay: str = "1 day", flag: str = "flagged",
) -> DataFrame:
    """(window_start, rule, rows, flagged) of a stream or a table.

    In a stream, rows later than ``delay`` are left out; ``late_rows`` says how many.
    """
    timed = hits.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return timed.groupBy(F.window(time, window), rule).agg(
        F.count("*").alias("rows"), F.count_if(flag).alias("flagged")
    ).select(F.col("window.start").alias("window_start"), rule, "rows", "flagged")


def stream_rule_counts(hits: DataFrame, out: str, checkpoint: str, **options: str) -> StreamingQuery:
    """Counts per window as a table that every micro-batch completes.

    Update mode: a micro-batch holds the windows it changed, with their new totals, in a folder
    of its own; the latest total of a window is the one of the highest batch.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        rule_counts(hits, **options).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_rule_counts(spark: SparkSession, out: str, rule: str = "rule") -> DataFrame:
    """The latest counts per window and rule."""
    latest = F.max_by(F.struct("rows", "flagged"), "batch").alias("last")
    return spark.read.parquet(out).groupBy("window_start", rule).agg(latest).select("window_start", rule, "last.rows", "last.flagged")


_MARK = "mark timestamp"


def _mark_before(spark: SparkSession, folder: str, number: int):
    """The latest event time of all batches before this one; None for the first."""
    make_folder(spark, folder)
    return spark.read.schema(_MARK + ", batch bigint").parquet(folder).filter(F.col("batch") < number).agg(F.max("mark")).first()[0]


def stream_counts_and_late(
    hits: DataFrame, out: str, late: str, checkpoint: str, time: str = "ts", rule: str = "rule", window: str = "1 day", delay: str = "1 day",
    flag: str = "flagged",
) -> StreamingQuery:
    """Counts per window and rule, added to batch by batch, and a side table of the rows that came too late to count.

    A row is late when its window has ended before the watermark: the latest event time of all batches before, less
    ``delay``. Every row is either in a count or in the side table, there with the watermark that it missed; rows without a
    time are in the side table. A batch adds its
    own counts (combined before the shuffle), its late rows and its latest event time, in folders of its own that a repeated
    batch overwrites; of earlier batches it reads the latest event times only, one value each.
    """
    marks = out.rstrip("/") + "-marks"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = _mark_before(spark, marks, number)
        mark = F.lit(before).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        rows = batch.withColumn(time, F.col(time).cast("timestamp"))
        dated = rows.withColumn("_window", F.window(time, window))  # leaves out rows without a time
        missed = F.coalesce(F.col("_window.end") <= mark, F.lit(False))
        dated.filter(~missed).groupBy(F.col("_window.start").alias("window_start"), rule).agg(
            F.count("*").alias("rows"), F.count_if(flag).alias("flagged")).write.mode("overwrite").parquet(f"{out}/batch={number}")
        aside = dated.filter(missed).drop("_window").unionByName(rows.filter(F.col(time).isNull()))
        aside.withColumn("watermark", mark).write.mode("overwrite").parquet(f"{late}/batch={number}")
        rows.agg(F.max(time).alias("mark")).write.mode("overwrite").parquet(f"{marks}/batch={number}")

    return hits.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_partial_counts(spark: SparkSession, out: str, rule: str = "rule") -> DataFrame:
    """(window_start, rule, rows, flagged): what all batches have counted."""
    schema = f"window_start timestamp, `{rule}` string, rows bigint, flagged bigint, batch bigint"
    return spark.read.schema(schema).parquet(out).groupBy("window_start", rule).agg(F.sum("rows").alias("rows"), F.sum("flagged").alias("flagged"))


def read_late(spark: SparkSession, late: str) -> DataFrame:
    """The rows that were too late, with the watermark they missed and their batch."""
    return spark.read.parquet(late)
