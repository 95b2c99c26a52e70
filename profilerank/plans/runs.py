"""Whole jobs: documents to ranking, integrity audit, training set and model, final result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..operators import calibrate, documents, evaluate, explain, features, integrity, labels, model, ranking, relevance, responses, rules
from ..operators.joins import join_flags_left, semi_lookup
from ..schema import ID
from ..session import materialize, new_path


def relevance_run(pool: DataFrame, query: str, reference: str) -> DataFrame:
    """Pool to a ranking by text relevance with rule-flagged records at the end."""
    scores = relevance.relevance_score(documents.doc_compact(pool), query)
    flags = rules.rules_flag(pool, reference).select(ID, "honeypot_flag", "reasons")
    marked = materialize(join_flags_left(scores, flags), "marked")
    return ranking.demote_flagged(marked, "honeypot_flag")


@dataclass
class Audit:
    final: DataFrame
    verdicts: DataFrame
    disagreements: DataFrame
    asked: int


def audit_run(
    pool: DataFrame, first: DataFrame, second: DataFrame, scorer: responses.Scorer, reference: str,
    thresholds: integrity.Thresholds, k: int = 100, batch: int = 10, *, max_checks: int, cache: str | None = None,
) -> Audit:
    """Fills a clean top k: checks rows from the top with an external scorer until k are clean.

    The scorer sees the rows a batch at a time, as far down as needed. One wave asks for at least
    the k rows that are needed in any case; each further wave asks for as many as are still missing.
    Verdicts are appended to ``cache``; rows that have one there, from this or an earlier run, are not asked for.
    The pool is read once: the records that may be checked, and those that were, are looked up and stored first.
    """
    spark = pool.sparkSession
    merged = materialize(ranking.merge_rankings(first, second, flag="honeypot_flag"), "merged")
    path = cache or new_path(spark, "verdicts")
    upto, calls, last = -(-k // batch) * batch, 0, merged.agg(F.max("merged_rank")).first()[0] or 0
    # A wave starts below max_checks rows and is at most as long as the first one.
    ids = merged.filter(F.col("merged_rank") <= max_checks + upto).select(ID).union(responses.cached_rows(spark, path, f"{ID} string"))
    records = materialize(semi_lookup(pool, ids), "records")
    while True:
        wanted = semi_lookup(records, merged.filter(F.col("merged_rank") <= upto).select(ID))
        texts = documents.doc_full(wanted).join(documents.analysis_block(wanted, reference, thresholds), ID).select(
            ID, F.concat_ws("\n\n", "doc_text", "analysis").alias("doc_text"))
        calls += responses.score_remaining(texts, scorer, path, verdict=True)
        verdicts = responses.cached_rows(spark, path, responses.cache_schema(texts, verdict=True))
        clean = verdicts.join(merged.filter(F.col("merged_rank") <= upto).select(ID), ID, "left_semi").filter(~F.col("is_honeypot")).count()
        if clean >= k:
            break
        if upto >= max_checks or upto >= last:
            raise ranking.NotEnoughClean(f"{clean} of {k} clean rows after {upto} checks")
        upto += -(-(k - clean) // batch) * batch
    checks = integrity.integrity_checks(integrity.integrity_metrics(semi_lookup(records, verdicts), reference), thresholds)
    return Audit(
        final=ranking.gap_fill_topk(merged, verdicts, k, batch, max_checks), verdicts=verdicts,
        disagreements=integrity.verdict_disagree(verdicts, checks), asked=calls)


def scoring_run(texts: DataFrame, scorer: responses.Scorer, cache: str, passes: int = 1, previous: str | None = None) -> tuple[DataFrame, int]:
    """Rows scored ``passes`` times each, averaged and ranked by their total; and how many rows were asked for.

    Results are appended to ``cache``, so a run that finds all of them there asks for nothing. ``previous``, a column of
    the rows, breaks ties.
    """
    asked = responses.score_remaining(texts, scorer, cache, passes=passes)
    averaged = responses.avg_passes(semi_lookup(responses.cached_rows(texts.sparkSession, cache, responses.cache_schema(texts)), texts))
    rank = F.col(previous) if previous else F.lit(None).cast("bigint")
    scored = averaged.join(texts.select(ID, rank.alias("_previous")), ID)
    return ranking.rerank_total(scored, "total_score", "_previous").drop("_previous"), asked


def training_run(
    pool: DataFrame, ranked: DataFrame, reference: str, flagged: DataFrame | None = None, kind: str = "linear",
    max_rank: int | None = None, rank: str = "rank", **params,
) -> tuple[model.Ranker, DataFrame, DataFrame]:
    """Features, grades, split and training. Returns the ranker, the dataset and the metric gaps.

    The default kind is the one whose scores ``result_run`` can explain.
    """
    table = materialize(features.feat_all(pool, reference), "features")
    grades = labels.grade_labels(labels.rank_cap(ranked, rank, max_rank), flagged)
    dataset = materialize(labels.dataset_assemble(table, grades), "dataset")
    ranker = model.train_ranker(dataset, kind, **params)
    gaps = evaluate.overfit_gap(model.evaluate_ranker(ranker, dataset, "train"), model.evaluate_ranker(ranker, dataset, "val"))
    return ranker, dataset, gaps


def result_run(
    pool: DataFrame, table: DataFrame, ranker: model.Ranker, flags: DataFrame | None = None, n: int = 100,
) -> DataFrame:
    """(candidate_id, rank, score, reasoning): the best n rows with reasons.

    Flagged rows sort below clean ones. Only the n rows are explained and looked up in the pool.
    """
    if ranker.kind != "linear":
        raise ValueError("reasons need exact attributions, which a linear ranker has")
    scored = model.predict_pool(ranker, table)
    marked = scored.withColumn("honeypot_flag", F.lit(False)) if flags is None else join_flags_left(
        scored, flags.select(ID, "honeypot_flag")).drop("flag_missing")
    best = materialize(marked.orderBy(F.asc("honeypot_flag"), F.desc(model.SCORE), F.asc(ID)).limit(n), "best")
    ranked = ranking.global_rank(best, [F.asc("honeypot_flag"), F.desc(model.SCORE), F.asc(ID)])
    ranking.check_flag_share(ranked, "honeypot_flag", n)
    rows = materialize(semi_lookup(table, best).join(best.select(ID, "honeypot_flag"), ID), "rows")
    explained = model.attribution(ranker, rows)
    facts = documents.raw_facts(semi_lookup(pool, best))
    reasons = explain.reason_text(explained, facts, ranker.features)
    return ranked.join(reasons, ID).select(ID, "rank", F.round(model.SCORE, 6).alias("score"), "reasoning")
