"""Ranks, running totals, top-k and merged rankings over all partitions.

A window without partition keys would pull the whole table into one task. Here the rows are range
partitioned by the sort keys, each partition is sorted, and a row's number is its position inside
the partition plus the size of the partitions before it. The sorted table is written once, because
it is read twice; what travels to the driver is one size per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schema import ID
from ..session import materialize

# The upper 31 bits of monotonically_increasing_id are the partition, the lower 33 the position.
_POSITION_BITS = 33


def _ordered(df: DataFrame, keys: list[Column | str], keep: list[str] | None) -> DataFrame:
    """All rows in the order of the keys, sorted over range partitions, with their place in ``_pos``."""
    numbered = df.orderBy(*keys).withColumn("_pos", F.monotonically_increasing_id())
    return numbered.select(*keep, "_pos") if keep else numbered


def _part() -> Column:
    return F.shiftright("_pos", _POSITION_BITS)


def _with_offsets(ordered: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """Adds, per total, the sum over all earlier partitions. One small row per partition."""
    spark = ordered.sparkSession
    placed = ordered.withColumn("_part", _part())
    rows = placed.groupBy("_part").agg(*[c.cast("bigint").alias(n) for n, c in totals.items()]).orderBy("_part").collect()
    offsets, running = [], dict.fromkeys(totals, 0)
    for row in rows:
        offsets.append((row["_part"], *running.values()))
        running = {n: v + (row[n] or 0) for n, v in running.items()}
    schema = "_part bigint, " + ", ".join(f"`{n}` bigint" for n in totals)
    return placed.join(F.broadcast(spark.createDataFrame(offsets, schema)), "_part")


def global_rank(df: DataFrame, keys: list[Column | str], rank: str = "rank", keep: list[str] | None = None) -> DataFrame:
    """Adds 1..N in the order of ``keys``. The keys should end in a unique column.

    Only the columns to ``keep`` are stored; all by default.
    """
    placed = _with_offsets(materialize(_ordered(df, keys, keep), "ordered"), {"_before": F.count("*")})
    position = F.col("_pos") - F.shiftleft("_part", _POSITION_BITS)
    return placed.withColumn(rank, F.col("_before") + position + 1).drop("_pos", "_part", "_before")


def _add_up(names: list[str], schema: T.StructType):
    """Running sums of columns down a sorted partition; a NULL adds nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = dict.fromkeys(names, 0)
        for batch in batches:
            if batch.num_rows:
                columns = list(batch.columns)
                for name in names:
                    running = pc.cumulative_sum(pc.fill_null(batch.column(name).cast(pa.int64()), 0), start=sums[name])
                    sums[name] = running[-1].as_py()
                    columns.append(running)
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return run


def running_totals(df: DataFrame, keys: list[Column | str], totals: dict[str, str], rank: str | None = None) -> DataFrame:
    """Adds running sums (inclusive) of whole-number columns in the order of ``keys``.

    ``totals`` maps the new column to the summed one. The sums inside a partition are taken while its sorted rows pass
    by, before they are stored; what earlier partitions add comes from one row per partition. Nothing is shuffled again.
    """
    ordered = _ordered(df.withColumns({f"_s_{n}": F.col(c).cast("bigint") for n, c in totals.items()}), keys, None)
    parts = [f"_s_{n}" for n in totals]
    schema = T.StructType([*ordered.schema, *[T.StructField(f"_in{p}", T.LongType()) for p in parts]])
    summed = materialize(ordered.mapInArrow(_add_up(parts, schema), schema), "running")
    placed = _with_offsets(summed, {"_before": F.count("*"), **{f"_b_{n}": F.max_by(f"_in_s_{n}", "_pos") for n in totals}})
    out = placed.withColumns({n: F.col(f"_b_{n}") + F.col(f"_in_s_{n}") for n in totals})
    if rank:
        out = out.withColumn(rank, F.col("_before") + F.col("_pos") - F.shiftleft("_part", _POSITION_BITS) + 1)
    return out.drop("_pos", "_part", "_before", *parts, *[f"_in{p}" for p in parts], *[f"_b_{n}" for n in totals])


def _add_up_by(names: list[str], schema: T.StructType):
    """Running sums that start anew wherever ``_g`` changes; ``_later`` marks rows behind a partition's first segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, later, sums = None, False, dict.fromkeys(names, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            g = batch.column("_g").to_numpy(zero_copy_only=False)
            starts = np.concatenate([[last is not None and g[0] != last], g[1:] != g[:-1]])
            segment = np.cumsum(starts)
            made = []
            for name in names:
                values = pc.fill_null(batch.column(name).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
                total = np.cumsum(values)
                base = np.concatenate([[-sums[name]], (total - values)[starts]])
                running = total - base[segment]
                sums[name] = int(running[-1])
                made.append(pa.array(running))
            behind = (segment > 0) | later
            last, later = g[-1], bool(behind[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, *made, pa.array(behind)], schema.names)

    return run


def segmented_totals(df: DataFrame, by: str, keys: list[Column | str], totals: dict[str, str], rank: str | None = None) -> DataFrame:
    """Adds running sums (inclusive) of whole-number columns, and a rank, inside each value of ``by``, in the order of ``keys``.

    No window: a value of ``by`` may hold any share of the rows. Rows are range partitioned by value and keys, summed while
    they pass by in order, and what the partitions before add to a value that goes on comes from one row per partition.
    """
    spark = df.sparkSession
    summed = {f"_s_{n}": F.col(c).cast("bigint") for n, c in totals.items()} | {"_s__rank": F.lit(1).cast("bigint")}
    parts = list(summed)
    ordered = _ordered(df.withColumns(summed).withColumn("_g", F.xxhash64(F.col(by))), [by, *keys], None)
    schema = T.StructType([*ordered.schema, *[T.StructField(f"_in{p}", T.LongType()) for p in parts], T.StructField("_later", T.BooleanType())])
    stored = materialize(ordered.mapInArrow(_add_up_by(parts, schema), schema), "segments").withColumn("_part", _part())
    ends = stored.groupBy("_part").agg(
        F.min_by("_g", "_pos").alias("first"), F.max_by("_g", "_pos").alias("last"), F.max("_later").alias("several"),
        *[F.max_by(f"_in{p}", "_pos").alias(p) for p in parts]).orderBy("_part").collect()
    carried, open_key, held = [], None, dict.fromkeys(parts, 0)
    for row in ends:
        brought = held if row["first"] == open_key else dict.fromkeys(parts, 0)
        carried.append((row["_part"], *brought.values()))
        held = {p: row[p] + (0 if row["several"] else brought[p]) for p in parts}
        open_key = row["last"]
    offsets = F.broadcast(spark.createDataFrame(carried, "_part bigint, " + ", ".join(f"`_b{p}` bigint" for p in parts)))
    names = dict(zip(parts, [*totals, rank or "_rank"]))
    out = stored.join(offsets, "_part").withColumns({
        names[p]: F.col(f"_in{p}") + F.when(F.col("_later"), 0).otherwise(F.col(f"_b{p}")) for p in parts})
    return out.drop("_pos", "_part", "_g", "_later", *parts, *[f"_in{p}" for p in parts], *[f"_b{p}" for p in parts], *([] if rank else ["_rank"]))


def dedup_first(df: DataFrame, order: list[str], key: str = ID, count: str | None = None) -> DataFrame:
    """The first row per key in input order.

    An aggregate, not a window: it combines before the shuffle, so a key with very many copies
    costs one row per partition.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("_first")
    extra = [F.count("*").alias(count)] if count else []
    out = df.groupBy(key).agg(first, *extra)
    return out.select(key, *[F.col(f"_first.`{c}`").alias(c) for c in [*order, *rest]], *([count] if count else []))


def rank_scores(scores: DataFrame, score: str = "score", rank: str = "rank") -> DataFrame:
    """1..N by score descending, id ascending."""
    return global_rank(scores, [F.desc(score), F.asc(ID)], rank)


def demote_flagged(scores: DataFrame, flag: str, score: str = "score", rank: str = "rank") -> DataFrame:
    """1..N with all flagged rows below all clean ones, by score and id inside each group."""
    marked = scores.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return global_rank(marked, [F.asc(flag), F.desc(score), F.asc(ID)], rank)


def rerank_total(scored: DataFrame, total: str, previous: str, rank: str = "final_rank") -> DataFrame:
    """1..N by total descending, then the previous rank; rows without one come last."""
    return global_rank(scored, [F.desc(total), F.asc_nulls_last(previous), F.asc(ID)], rank)


def topn_prefix(ranked: DataFrame, n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of a ranked table, as a filter on the rank."""
    return ranked.filter(F.col(rank) <= n)


def top_n(scores: DataFrame, n: int, score: str = "score") -> DataFrame:
    """The best n rows without ranking the rest."""
    return scores.orderBy(F.desc(score), F.asc(ID)).limit(n)


def anti_tail(second: DataFrame, first: DataFrame) -> DataFrame:
    """Rows of the second ranking whose id the first one does not have."""
    return second.join(first.select(ID).distinct(), ID, "left_anti")


def merge_rankings(
    first: DataFrame, second: DataFrame, first_rank: str = "final_rank", second_rank: str = "rank",
    flag: str | None = None,
) -> DataFrame:
    """(candidate_id, source, merged_rank, initial_flag): the first ranking, then the rest of the second.

    Ids of the first ranking start without a flag; the others bring theirs.
    """
    none = F.lit(None).cast("boolean")
    head = first.select(ID, F.lit(0).alias("source"), F.col(first_rank).cast("bigint").alias("_r"), none.alias("initial_flag"))
    carried = F.col(flag).cast("boolean") if flag else none
    tail = anti_tail(second, first).select(
        ID, F.lit(1).alias("source"), F.col(second_rank).cast("bigint").alias("_r"), carried.alias("initial_flag"))
    return global_rank(head.unionByName(tail), ["source", F.asc_nulls_last("_r"), ID], "merged_rank").drop("_r")


class NotEnoughClean(ValueError):
    """The pool, or the allowed number of checks, ended before the top was filled."""


class Unaudited(ValueError):
    """A row that had to be checked has no verdict."""


def _judged(merged: DataFrame, verdicts: DataFrame, upto: int) -> DataFrame:
    """(candidate_id, merged_rank, is_honeypot) of the rows down to a rank; NULL where there is no verdict."""
    return merged.filter(F.col("merged_rank") <= upto).select(ID, "merged_rank").join(verdicts.select(ID, "is_honeypot"), ID, "left")


def gap_fill_cursor(merged: DataFrame, verdicts: DataFrame, k: int, batch: int, max_checks: int) -> int:
    """How many rows from the top are checked, in batches, until k clean ones are found.

    Only the rows that may be checked at all are read, and of those the k best clean ones. A row without a verdict is
    not clean: if one lies above the cursor, or if the clean ones do not suffice because of it, that is an error.
    """
    bound = -(-max_checks // batch) * batch
    judged = materialize(_judged(merged, verdicts, bound), "judged")
    clean = judged.filter(~F.col("is_honeypot")).select("merged_rank")
    found = clean.orderBy("merged_rank").limit(k).agg(F.count("*"), F.max("merged_rank")).first()
    last = -(-found[1] // batch) * batch if found[0] == k else bound
    open_rows = judged.filter(F.col("is_honeypot").isNull() & (F.col("merged_rank") <= last)).agg(F.count("*"), F.min(F.struct("merged_rank", ID))).first()
    if open_rows[0]:
        raise Unaudited(f"{open_rows[0]} rows down to rank {last} have no verdict, first {open_rows[1][ID]} at rank {open_rows[1]['merged_rank']}")
    if found[0] < k:
        raise NotEnoughClean(f"{found[0]} of {k} clean rows within {bound} checks")
    if last - batch >= max_checks:
        raise NotEnoughClean(f"more than {max_checks} checks are needed for {k} clean rows")
    return last


def gap_fill_topk(merged: DataFrame, verdicts: DataFrame, k: int, batch: int, max_checks: int) -> DataFrame:
    """(candidate_id, final_rank, honeypot_flag): a ranking whose first k rows are checked clean.

    Flagged rows among the checked ones go to the end. The new rank of every other row follows by
    arithmetic, so the table is not sorted again: rows below the cursor move up by the number of
    moved rows, and only the checked rows (at most ``max_checks`` and one batch) need their own count.
    """
    total = merged.agg(F.max("merged_rank")).first()[0] or 0
    cursor = min(gap_fill_cursor(merged, verdicts, k, batch, max_checks), total)
    checked = _judged(merged, verdicts, cursor).select(ID, "merged_rank", F.col("is_honeypot").alias("moved"), F.col("is_honeypot").cast("bigint").alias("_m"))
    counted = running_totals(checked, ["merged_rank"], {"moved_upto": "_m"})
    moves = counted.agg(F.coalesce(F.max("moved_upto"), F.lit(0))).first()[0]
    placed = counted.select(ID, "moved", F.when(F.col("moved"), total - moves + F.col("moved_upto"))
                            .otherwise(F.col("merged_rank") - F.col("moved_upto")).alias("new_rank"))
    joined = merged.join(placed, ID, "left")
    return joined.select(
        ID, F.coalesce("new_rank", F.col("merged_rank") - moves).alias("final_rank"),
        F.coalesce("moved", "initial_flag").alias("honeypot_flag"))


def flag_share(top: DataFrame, flag: str) -> DataFrame:
    """One row: rows, flagged rows among them, percent."""
    total, flagged = F.count("*"), F.count_if(F.coalesce(flag, F.lit(False)))
    return top.agg(total.alias("top_rows"), flagged.alias("flagged"),
                   F.coalesce(F.try_divide(flagged * 100.0, total), F.lit(0.0)).alias("flagged_percent"))


def flag_share_topk(ranked: DataFrame, flag: str, n: int = 100, rank: str = "rank") -> DataFrame:
    """``flag_share`` of the top n of a ranked table."""
    return flag_share(topn_prefix(ranked, n, rank), flag)


def check_flag_share(ranked: DataFrame, flag: str, n: int = 100, limit: float = 10.0, rank: str = "rank") -> float:
    """The flagged percent of the top n; an error above the limit."""
    percent = flag_share_topk(ranked, flag, n, rank).first()["flagged_percent"]
    if percent > limit:
        raise ValueError(f"{percent:.1f} % of the top {n} rows are flagged, more than {limit:.1f} %")
    return percent
