"""Lookups, remaining work, and what the two sides of a join miss.

Nothing here forces a broadcast: the id lists may be of any size, and the adaptive planner
broadcasts a side when its measured size allows it and splits skewed partitions otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..schema import ID


def _ids(df: DataFrame) -> DataFrame:
    """Distinct ids; combined before the shuffle, so an id with very many rows is harmless."""
    return df.select(ID).distinct()


def join_flags_left(ranked: DataFrame, flags: DataFrame, flag: str = "honeypot_flag") -> DataFrame:
    """Ranked rows with their flag; ``flag_missing`` marks rows without one, which count as clean.

    An id with several flags counts as flagged if any is true, and takes the other columns of that row.
    """
    rest = [c for c in flags.columns if c not in (ID, flag)]
    best = F.max(F.struct(F.coalesce(flag, F.lit(False)).alias(flag), *rest)).alias("_best")
    marked = flags.groupBy(ID).agg(best).select(ID, *[F.col(f"_best.`{c}`").alias(c) for c in (flag, *rest)], F.lit(True).alias("_known"))
    return ranked.join(marked, ID, "left").withColumns({
        flag: F.coalesce(flag, F.lit(False)), "flag_missing": F.col("_known").isNull()}).drop("_known")


def semi_lookup(pool: DataFrame, ids: DataFrame) -> DataFrame:
    """Full records of the given ids."""
    return pool.join(_ids(ids), ID, "left_semi")


def missing_ids(ids: DataFrame, pool: DataFrame) -> DataFrame:
    """Ids without a record."""
    return ids.select(ID).join(_ids(pool), ID, "left_anti")


def anti_done(todo: DataFrame, done: DataFrame) -> DataFrame:
    """Rows whose id has no result yet."""
    return todo.join(_ids(done), ID, "left_anti")


def remaining_passes(todo: DataFrame, done: DataFrame, passes: int) -> DataFrame:
    """``remaining`` = passes still to run per id, never below zero.

    The results are counted before the join, so an id with many of them is one row.
    """
    counts = done.groupBy(ID).agg(F.count("*").alias("_done"))
    left = F.greatest(F.lit(0), passes - F.coalesce("_done", F.lit(0)))
    return todo.join(counts, ID, "left").withColumn("remaining", left).drop("_done")


def join_features_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    return features.join(labels, ID)


def unmatched_labels(features: DataFrame, labels: DataFrame) -> DataFrame:
    """One row, the number of labels without features."""
    return missing_ids(labels, features).agg(F.count("*").alias("unmatched"))


def join_pool_labels(pool: DataFrame, labels: DataFrame, grade: str = "relevance_grade") -> DataFrame:
    """All pool rows with their grade, the highest of an id with several; rows without a label are grade 0."""
    return pool.join(labels.groupBy(ID).agg(F.max(grade).alias(grade)), ID, "left").withColumn(grade, F.coalesce(grade, F.lit(0)))


def union_parts(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def union_clean_flagged(clean: DataFrame, flagged: DataFrame) -> DataFrame:
    """Both groups with a ``group_order`` that puts the flagged ones last."""
    return clean.withColumn("group_order", F.lit(0)).unionByName(flagged.withColumn("group_order", F.lit(1)))


def minus_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct ids of the left side that the right one lacks."""
    return _ids(left).join(_ids(right), ID, "left_anti")


def conservation_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after, ids lost, ids added, ids with another number of rows.

    Counts per id are signed and added up, one shuffle for both sides.
    """
    signed = before.select(ID, F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select(ID, F.lit(0).alias("b"), F.lit(1).alias("a")))
    per_id = signed.groupBy(ID).agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    return per_id.agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("rows_in"), F.coalesce(F.sum("a"), F.lit(0)).alias("rows_out"),
        F.count_if((F.col("b") > 0) & (F.col("a") == 0)).alias("lost"),
        F.count_if((F.col("b") == 0) & (F.col("a") > 0)).alias("added"),
        F.count_if((F.col("b") > 0) & (F.col("a") > 0) & (F.col("a") != F.col("b"))).alias("changed"),
    ).withColumn("conserved", (F.col("lost") == 0) & (F.col("added") == 0) & (F.col("changed") == 0))
