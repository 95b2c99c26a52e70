"""Relevance grades from ranks, and the train and validation sets made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import flag_parse, half_even, num_coerce
from ..functions.ordinals import MAX_GRADE, label_gain, rank_to_grade
from ..schema import ID
from ..session import materialize
from .ranking import global_rank


def rank_cap(ranked: DataFrame, rank: str = "rank", max_rank: int | None = None, name: str = "llm_rank") -> DataFrame:
    """(candidate_id, llm_rank): whole-number ranks up to the cap; other rows are dropped."""
    parsed = ranked.select(ID, F.trim(F.col(rank).cast("string")).try_cast("bigint").alias(name))
    kept = parsed.filter(F.col(name).isNotNull() & F.col(ID).isNotNull())
    return kept if max_rank is None else kept.filter(F.col(name) <= max_rank)


def flagged_ids(flags: DataFrame, flag: str | None = "honeypot_flag", hits: str | None = None) -> DataFrame:
    """Ids whose flag is truthy or whose number of rule hits is above zero."""
    by_flag = flag_parse(F.col(flag)) if flag else F.lit(False)
    by_hits = num_coerce(F.col(hits)) > 0 if hits else F.lit(False)
    return flags.filter(F.coalesce(by_flag, F.lit(False)) | F.coalesce(by_hits, F.lit(False))).select(ID).distinct()


def grade_labels(ranks: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """(candidate_id, llm_rank, relevance_grade, honeypot_override_applied); flagged ids get grade 0."""
    graded = ranks.withColumn("relevance_grade", rank_to_grade(F.col("llm_rank")))
    return grade_override(graded, flagged)


def grade_override(graded: DataFrame, flagged: DataFrame | None) -> DataFrame:
    if flagged is None:
        return graded.withColumn("honeypot_override_applied", F.lit(0))
    marks = flagged.select(ID).distinct().select(ID, F.lit(1).alias("honeypot_override_applied"))
    joined = graded.join(marks, ID, "left").withColumn("honeypot_override_applied", F.coalesce("honeypot_override_applied", F.lit(0)))
    return joined.withColumn("relevance_grade", F.when(F.col("honeypot_override_applied") == 1, 0).otherwise(F.col("relevance_grade")))


def pseudo_label_union(labels: DataFrame, pool_ids: DataFrame, flagged: DataFrame | None = None, grade: int = 0) -> DataFrame:
    """Labels plus every unlabelled pool id with a default grade and no rank; flagged ids get 0."""
    rest = pool_ids.select(ID).join(labels.select(ID).distinct(), ID, "left_anti").select(
        ID, F.lit(None).cast("bigint").alias("llm_rank"), F.lit(grade).alias("relevance_grade"))
    columns = [ID, "llm_rank", "relevance_grade", "honeypot_override_applied"]
    return labels.select(*columns).unionByName(grade_override(rest, flagged).select(*columns))


def grade_histogram(labels: DataFrame, grade: str = "relevance_grade", by: tuple[str, ...] = ()) -> DataFrame:
    """(…, grade, n, percent) for all grades of every group, grades without rows included.

    One conditional count per grade, so empty grades need no join.
    """
    counts = [F.count_if(F.col(grade) == g).alias(f"g{g}") for g in range(MAX_GRADE + 1)]
    wide = labels.groupBy(*by).agg(F.count("*").alias("total"), *counts)
    entries = F.array(*[F.struct(F.lit(g).alias("grade"), F.col(f"g{g}").alias("n")) for g in range(MAX_GRADE + 1)])
    long = wide.select(*by, "total", F.explode(entries).alias("x"))
    percent = F.coalesce(F.round(F.try_divide(F.col("x.n") * 100.0, F.col("total")), 1), F.lit(0.0))
    return long.select(*by, "x.grade", "x.n", percent.alias("percent"))


def validation_size(rows: Column, fraction: float) -> Column:
    """At least one row, rounded half to even; a single row stays in training."""
    return F.when(rows > 1, F.greatest(F.lit(1), half_even(rows * F.lit(fraction)).cast("bigint"))).otherwise(0)


def stratified_split(labels: DataFrame, fraction: float = 0.15, seed: int = 42, grade: str = "relevance_grade") -> DataFrame:
    """Adds ``split`` (train or val), the same share of every grade; rows without a grade are for training.

    The order inside a grade is the hash of seed and id, and the first rows of it validate. Only keys of rows whose hash
    lies below a bound, set with a margin from the grade's count, are sorted; if a bound turns out too low it is doubled.
    The rows themselves are neither sorted nor stored: the last validation key of each grade decides.
    """
    hashed = labels.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(ID))))
    keys = hashed.filter(F.col(grade).isNotNull()).select(grade, "_h", ID)
    sizes = keys.groupBy(grade).agg(F.count("*").alias("n"))
    wanted = {r[grade]: (r["n"], r["v"]) for r in sizes.select(grade, "n", validation_size(F.col("n"), fraction).alias("v")).collect() if r["v"]}
    if not wanted:
        return hashed.withColumn("split", F.lit("train")).drop("_h")
    factor = 1.0
    while True:
        bounds = {g: min(1.0, factor * (v + 4 * v ** 0.5 + 10) / n) for g, (n, v) in wanted.items()}
        low = F.lit(False)
        for g, bound in bounds.items():
            low = low | ((F.col(grade) == g) & (F.lit(bound >= 1) | (F.col("_h") < f"{int(bound * 16 ** 8):08x}")))
        near = materialize(keys.filter(low), "split_keys")
        found = {r[grade]: r["n"] for r in near.groupBy(grade).agg(F.count("*").alias("n")).collect()}
        if all(found.get(g, 0) >= v for g, (_, v) in wanted.items()):
            break
        factor *= 2
    last, upto = [], 0
    for g in sorted(found):
        last.append(upto + wanted[g][1])
        upto += found[g]
    ends = global_rank(near, [grade, "_h", ID], "_r").filter(F.col("_r").isin(last)).collect()
    chosen = F.lit(False)
    for row in ends:
        upto_end = F.struct("_h", ID) <= F.struct(F.lit(row["_h"]), F.lit(row[ID]))
        chosen = chosen | ((F.col(grade) == row[grade]) & upto_end)
    return hashed.withColumn("split", F.when(chosen, "val").otherwise("train")).drop("_h")


def dataset_assemble(features: DataFrame, labels: DataFrame, fraction: float = 0.15, seed: int = 42) -> DataFrame:
    """Labelled feature rows with their split and gain."""
    split = stratified_split(labels.join(features.select(ID), ID, "left_semi"), fraction, seed)
    return features.join(split, ID).withColumn("label_gain", label_gain(F.col("relevance_grade")))


def dataset_metadata(dataset: DataFrame, labels: DataFrame, feature_columns: list[str], categorical: list[str],
                     fraction: float = 0.15, seed: int = 42) -> DataFrame:
    """One row that describes a training set: sizes, histograms, gains, columns."""
    def histogram(split: str) -> Column:
        return F.array(*[F.count_if((F.col("split") == split) & (F.col("relevance_grade") == g)) for g in range(MAX_GRADE + 1)])

    return dataset.agg(
        F.count("*").alias("labeled_set_size"), F.count_if(F.col("split") == "train").alias("train_group_size"),
        F.count_if(F.col("split") == "val").alias("val_group_size"), histogram("train").alias("train_grade_histogram"),
        histogram("val").alias("val_grade_histogram"),
    ).withColumns({
        "feature_columns": F.array(*[F.lit(c) for c in feature_columns]),
        "categorical_columns": F.array(*[F.lit(c) for c in categorical]),
        "label_gain": F.array(*[F.lit(2 ** g - 1) for g in range(MAX_GRADE + 1)]),
        "split_seed": F.lit(seed), "val_fraction": F.lit(fraction)})
