"""Ranking quality: graded NDCG, MAP, precision, and a composite of them, for one query per table or for many."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ordinals import MAX_GRADE, label_gain
from ..schema import ID
from .ranking import global_rank, running_totals, segmented_totals

# --- fixed values: parts of the composite, and when a grade counts as relevant ---
RELEVANT_GRADE = 3
WEIGHTS = {"ndcg_10": 0.50, "ndcg_50": 0.30, "map": 0.15, "p_10": 0.05}
GAP_ALARM = 0.15


def ranked_grades(scored: DataFrame, score: str, grade: str, threshold: int = RELEVANT_GRADE) -> DataFrame:
    """(candidate_id, pos, grade, rel, cum_rel): every row at its place, with the relevant rows so far."""
    rows = scored.select(ID, score, F.col(grade).cast("int").alias("grade")).withColumn("rel", (F.col("grade") >= threshold).cast("bigint"))
    return running_totals(rows, [F.desc(score), F.asc(ID)], {"cum_rel": "rel"}, rank="pos").drop(score)


def ranked_only(scored: DataFrame, score: str, grade: str, threshold: int = RELEVANT_GRADE) -> DataFrame:
    """(candidate_id, pos, grade, rel): enough for NDCG and precision, without the running total and its shuffle."""
    rows = scored.select(ID, score, F.col(grade).cast("int").alias("grade")).withColumn("rel", (F.col("grade") >= threshold).cast("bigint"))
    return global_rank(rows, [F.desc(score), F.asc(ID)], "pos", keep=[ID, "grade", "rel"])


def cum_precision(ranked: DataFrame) -> DataFrame:
    """Adds the share of relevant rows down to each position."""
    return ranked.withColumn("precision", F.col("cum_rel") / F.col("pos"))


def _discount(position: Column) -> Column:
    return 1.0 / F.log2(position + 1)


def dcg(grade: Column, position: Column, k: int | None = None) -> Column:
    """Aggregate: discounted gain of the first k positions, or of all."""
    gain = label_gain(grade) * _discount(position)
    return F.coalesce(F.sum(gain if k is None else F.when(position <= k, gain)), F.lit(0.0))


def ideal_dcg(grades: DataFrame, ks: list[int | None]) -> list[float]:
    """The best possible gain for each k (None: all rows).

    Only the number of rows per grade matters. Seven counts go to the driver; the positions are
    a generated range, so no table is sorted.
    """
    level = F.least(F.greatest(F.col("grade"), F.lit(0)), F.lit(MAX_GRADE))
    counts = {r["g"]: r["n"] for r in grades.groupBy(level.alias("g")).agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    last = total if None in ks else min(total, max(ks, default=0))
    positions, at, upto = grades.sparkSession.range(1, last + 1), None, 0
    for g in range(MAX_GRADE, 0, -1):
        upto += counts.get(g, 0)
        condition = F.col("id") <= upto
        at = F.when(condition, g) if at is None else at.when(condition, g)
    row = positions.select("id", at.otherwise(0).alias("g")).agg(
        *[dcg(F.col("g"), F.col("id"), k).alias(f"d{i}") for i, k in enumerate(ks)]).first()
    return list(row)


def metric_ndcg(ranked: DataFrame, ks: list[int | None]) -> DataFrame:
    """One row with ``ndcg_<k>`` per k (``ndcg_all`` for None); 0 where nothing is relevant."""
    ideals = ideal_dcg(ranked, ks)
    return ranked.agg(*_ndcg_columns(ks, ideals))


def _ndcg_columns(ks: list[int | None], ideals: list[float]) -> list[Column]:
    names = ["ndcg_all" if k is None else f"ndcg_{k}" for k in ks]
    return [(dcg(F.col("grade"), F.col("pos"), k) / ideal if ideal > 0 else F.lit(0.0)).alias(n)
            for n, k, ideal in zip(names, ks, ideals)]


def _map() -> Column:
    return F.coalesce(F.try_divide(F.sum(F.col("rel") * F.col("cum_rel") / F.col("pos")), F.sum("rel")), F.lit(0.0))


def _precision(k: int) -> Column:
    return F.coalesce(F.avg(F.when(F.col("pos") <= k, F.col("rel"))), F.lit(0.0))


def metric_map(ranked: DataFrame) -> DataFrame:
    return ranked.agg(_map().alias("map"))


def metric_precision(ranked: DataFrame, ks: list[int]) -> DataFrame:
    return ranked.agg(*[_precision(k).alias(f"p_{k}") for k in ks])


def metric_composite(ranked: DataFrame) -> DataFrame:
    """One row: NDCG@10, NDCG@50, MAP, P@10 and their weighted sum. One pass over the ranked rows."""
    ks: list[int | None] = [10, 50]
    parts = ranked.agg(*_ndcg_columns(ks, ideal_dcg(ranked, ks)), _map().alias("map"), _precision(10).alias("p_10"))
    return parts.withColumn("composite", sum((w * F.col(n) for n, w in WEIGHTS.items()), F.lit(0.0)))


def metric_pseudo(predicted: DataFrame, labels: DataFrame, score: str = "predicted_score", grade: str = "relevance_grade") -> DataFrame:
    """One row of metrics over a whole pool whose labels are incomplete; a missing label is grade 0."""
    joined = predicted.join(labels.select(ID, grade), ID, "left").withColumn(grade, F.coalesce(grade, F.lit(0)))
    ranked = ranked_grades(joined, score, grade)
    ks: list[int | None] = [10, 50, None]
    return ranked.agg(*_ndcg_columns(ks, ideal_dcg(ranked, ks)), _map().alias("map"), _precision(10).alias("p_10"), _precision(5).alias("p_5"))


def evaluate(scored: DataFrame, score: str, grade: str) -> DataFrame:
    return metric_composite(ranked_grades(scored, score, grade))


def overfit_gap(train: DataFrame, valid: DataFrame) -> DataFrame:
    """(metric, train, valid, gap, alarm) from two one-row metric tables."""
    names = ["composite", *WEIGHTS]

    def long(row: DataFrame, value: str) -> DataFrame:
        return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias(value)) for n in names])).alias("x")).select("x.*")

    both = long(train, "train").join(long(valid, "valid"), "metric")
    gap = F.col("train") - F.col("valid")
    return both.withColumns({"gap": gap, "alarm": (F.col("metric") == "composite") & (gap > GAP_ALARM)})


def _ideal_gain(k: int) -> Column:
    """The best gain of k positions, from the numbers of rows per grade in ``g1`` to ``g6``."""
    sums = [0.0]
    for position in range(1, k + 1):
        sums.append(sums[-1] + 1.0 / math.log2(position + 1))
    table, upto, gain = F.array(*[F.lit(x) for x in sums]), F.lit(0), F.lit(0.0)
    for g in range(MAX_GRADE, 0, -1):
        reached = F.least(upto + F.col(f"g{g}"), F.lit(k))
        gain = gain + (2.0 ** g - 1) * (F.get(table, reached.cast("int")) - F.get(table, F.least(upto, F.lit(k)).cast("int")))
        upto = upto + F.col(f"g{g}")
    return gain


def metric_by_query(
    ranked: DataFrame, by: str, pos: str = "pos", grade: str = "grade", threshold: int = RELEVANT_GRADE, judged: DataFrame | None = None,
    order: list[Column | str] | None = None,
) -> DataFrame:
    """One row per query: NDCG@10, NDCG@50, MAP, P@10 and the composite over the query's list, of any length.

    Rows are in the order of ``pos``, or of the columns in ``order``; a row's place is its rank in that order. ``judged``
    (query, grade) holds all judged rows: the ideal order and the number of relevant rows of MAP are taken over these, so a
    list pays for the good rows it does not hold. Without it they are those of the list. Queries without a list are
    left out. Nothing is collected per query: running sums go over range partitions, the ideal comes from grade counts.
    """
    relevant = (F.col("grade") >= threshold).cast("bigint")
    columns = [F.col(by), F.col(grade).cast("int").alias("grade")]
    keys = order or [pos]
    rows = ranked.withColumn("grade", F.col(grade).cast("int")).withColumn("rel", relevant)
    placed = segmented_totals(rows, by, keys, {"cum_rel": "rel"}, rank="pos").select(by, "grade", "rel", "cum_rel", "pos")
    gains = [dcg(F.col("grade"), F.col("pos"), k).alias(f"dcg_{k}") for k in (10, 50)]
    lists = placed.groupBy(by).agg(*gains, F.sum(F.col("rel") * F.col("cum_rel") / F.col("pos")).alias("precisions"), _precision(10).alias("p_10"))
    known = (ranked if judged is None else judged).select(*columns)
    level = F.least(F.col("grade"), F.lit(MAX_GRADE))
    counts = known.groupBy(by).agg(
        *[F.count_if(level == g).alias(f"g{g}") for g in range(1, MAX_GRADE + 1)], F.sum(relevant).alias("relevant"))
    both = lists.join(counts.withColumnRenamed(by, "_of"), F.col(by).eqNullSafe(F.col("_of")), "left")
    none = F.lit(0.0)
    out = both.select(
        by, *[F.coalesce(F.try_divide(f"dcg_{k}", _ideal_gain(k)), none).alias(f"ndcg_{k}") for k in (10, 50)],
        F.coalesce(F.try_divide("precisions", "relevant"), none).alias("map"), "p_10")
    return out.withColumn("composite", sum((w * F.col(n) for n, w in WEIGHTS.items()), none))
