"""Registered queries over rankers that learn from pairs, stop by the composite or are tuned, and over metrics of many queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import evaluate, model
from ..schema import ID
from .fixture import table
from .queries_tables import _LINE, _MAP_SQL, _MODEL_ROWS, _WEIGHED, _dcg_sql, _id, _model_dataset, _ndcg_sql, _p_sql, _rounded, _text_features
from .registry import register

# --- pairs ---

_PARTNERS, _PENALTY, _SEED = 8, 0.05, 42

# Every labelled training document draws partners of another grade; the weight of the one feature follows by Newton's steps.
_PAIRS = f"""train AS (SELECT candidate_id, words, relevance_grade AS g FROM dataset WHERE split = 'train'),
ranked AS (SELECT *, row_number() OVER (ORDER BY g, md5('{_SEED}:' || candidate_id), candidate_id) AS r FROM train),
placed_p AS (SELECT *, min(r) OVER (PARTITION BY g) AS low, count(*) OVER (PARTITION BY g) AS own, count(*) OVER () AS n FROM ranked),
drawn AS (SELECT *, 1 + ('0x' || substr(md5('{_SEED}:' || d || ':' || candidate_id), 1, 15))::BIGINT % (n - own) AS place FROM placed_p, range(1, {_PARTNERS + 1}) t(d) WHERE n > own),
pairs AS (SELECT a.candidate_id, b.candidate_id AS partner, abs((2 ** a.g) - (2 ** b.g))::DOUBLE AS weight, (a.g > b.g)::INT::DOUBLE AS label, a.words - b.words AS apart
  FROM drawn a JOIN ranked b ON b.r = a.place + CASE WHEN a.place >= a.low THEN a.own ELSE 0 END)"""


@register("grade_pairs", f"WITH {_MODEL_ROWS}, {_PAIRS} SELECT candidate_id, partner, weight, label, apart FROM pairs")
def grade_pairs(spark: SparkSession, sf: str) -> DataFrame:
    rows = _model_dataset(spark, sf).filter("split = 'train'")
    pairs = model.grade_pairs(rows, None, _PARTNERS, _SEED, "words")
    return pairs.select(ID, "partner", "weight", "label", (F.col("x") - F.col("y")).alias("apart"))


@register("train_ranker_pairwise", f"""WITH RECURSIVE {_MODEL_ROWS}, {_PAIRS}, unit AS (SELECT avg(words) AS mx, stddev_samp(words) AS sx FROM train),
scaled AS (SELECT weight, label, apart / sx AS d FROM pairs, unit),
steps AS (SELECT 0 AS i, 0::DOUBLE AS w UNION ALL
  SELECT i + 1, w - (sum(weight * (1 / (1 + exp(-w * d)) - label) * d) / sum(weight) + {_PENALTY}::DOUBLE * w)
    / (sum(weight * d * d / (2 + exp(w * d) + exp(-w * d))) / sum(weight) + {_PENALTY}::DOUBLE) FROM steps, scaled WHERE i < 30 GROUP BY i, w)
SELECT candidate_id, round(w * (words - mx) / sx, 4) AS predicted_score FROM rows, unit, steps WHERE i = 30""")
def train_ranker_pairwise(spark: SparkSession, sf: str) -> DataFrame:
    """Every document scored by a ranker that has learned from drawn pairs."""
    ranker = model.train_ranker(_model_dataset(spark, sf), "pairwise", _LINE, [], seed=_SEED, partners=_PARTNERS, regParam=_PENALTY, tol=1e-12, maxIter=200)
    return model.predict_pool(ranker, _text_features(spark, sf)).select(ID, (F.round(model.SCORE, 4) + 0.0).alias(model.SCORE))


# --- boosting, round by round ---

# Yes-no features, so that a tree of depth 1 is the choice of one of them and two means.
_FLAGS = {"is_long": "(n_chars > 1500)", "is_third": "(doc_id % 3 = 0)", "is_odd": "(n_chars % 2 = 1)", "is_fifth": "(doc_id % 5 < 2)"}
_ROUNDS = 6
_FLAG_ROWS = f"flagged AS (SELECT d.candidate_id, d.relevance_grade::INT AS grade, d.gain, d.split, {', '.join(f'{e}::INT AS {n}' for n, e in _FLAGS.items())} FROM dataset d JOIN documents USING (doc_id))"


def _boost_sql(step: float, rounds: int, tag: str = "b") -> str:
    """Boosting by squared error: a first tree on the gains, then trees on twice what is left, times the step."""
    parts = [f"{tag}0 AS (SELECT *, 0::DOUBLE AS s FROM flagged)"]
    for t in range(1, rounds + 1):
        left = "gain" if t == 1 else "2 * (gain - s)"
        weight = 1.0 if t == 1 else step
        means = " UNION ALL ".join(f"SELECT '{n}' AS f, {n} AS side, avg({left}) AS m, count(*) AS c FROM {tag}{t - 1} WHERE split = 'train' GROUP BY {n}" for n in _FLAGS)
        side = "CASE f " + " ".join(f"WHEN '{n}' THEN {n}" for n in _FLAGS) + " END"
        parts.append(f"{tag}m{t} AS ({means}), {tag}c{t} AS (SELECT f AS best FROM {tag}m{t} GROUP BY f ORDER BY sum(c * m * m) DESC LIMIT 1)")
        parts.append(f"{tag}{t} AS (SELECT x.* REPLACE (s + {weight}::DOUBLE * m AS s) FROM {tag}{t - 1} x JOIN (SELECT * FROM {tag}m{t} JOIN {tag}c{t} ON f = best) ON side = {side})")
    return ", ".join(parts)


def _metrics_sql(source: str) -> str:
    """Metrics per value of ``q`` of a table (q, candidate_id, grade, s)."""
    return f"""placed_q AS (SELECT q, grade, (grade >= 3)::INT AS rel, row_number() OVER (PARTITION BY q ORDER BY s DESC, candidate_id) AS pos, row_number() OVER (PARTITION BY q ORDER BY grade DESC, candidate_id) AS ideal FROM {source}),
cum AS (SELECT *, sum(rel) OVER (PARTITION BY q ORDER BY pos) AS cum_rel FROM placed_q),
parts AS (SELECT q, {_ndcg_sql(10)} AS ndcg_10, {_ndcg_sql(50)} AS ndcg_50, {_MAP_SQL} AS map, {_p_sql(10)} AS p_10 FROM cum GROUP BY q)"""


_NAMES = "round(ndcg_10, 9) AS ndcg_10, round(ndcg_50, 9) AS ndcg_50, round(map, 9) AS map, round(p_10, 9) AS p_10"
_PREFIXES = " UNION ALL ".join(f"SELECT {t} AS q, candidate_id, grade, round(s, 9) AS s FROM b{t} WHERE split = 'val'" for t in range(1, _ROUNDS + 1))


def _flag_dataset(spark: SparkSession, sf: str) -> DataFrame:
    flags = table(spark, sf, "documents").select(_id("doc_id").alias(ID), *[F.expr(e).cast("int").alias(n) for n, e in _FLAGS.items()])
    return _model_dataset(spark, sf).drop("is_long").join(flags, ID)


@register("train_ranker_prefixes", f"""WITH {_MODEL_ROWS}, {_FLAG_ROWS}, {_boost_sql(0.5, _ROUNDS)}, prefixes AS ({_PREFIXES}), {_metrics_sql('prefixes')},
whole AS (SELECT *, {_WEIGHED} AS composite FROM parts)
SELECT q AS rounds, {_NAMES}, round(composite, 9) AS composite, q = (SELECT q FROM whole ORDER BY round(composite, 9) DESC, q LIMIT 1) AS kept FROM whole""")
def train_ranker_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    """The metrics of a boosted ranker after every round, and which number of rounds the early stop keeps."""
    dataset = _flag_dataset(spark, sf)
    options = {"features": list(_FLAGS), "categorical": [], "maxIter": _ROUNDS, "maxDepth": 1, "stepSize": 0.5}
    every, kept = (model.train_ranker(dataset, "gbt", stop=stop, **options) for stop in ("none", "composite"))
    return _rounded(model.prefix_metrics(every, dataset)).withColumn("kept", F.col("rounds") == kept.params["rounds"])


_SPACE = {"maxIter": [1, 2, 3, 5], "stepSize": [0.1, 0.9]}
_TUNE_SEED = 10
_TRIALS = model.sample_params(5, _TUNE_SEED, _SPACE)


def _trials_sql() -> str:
    steps = sorted({p["stepSize"] for p in _TRIALS})
    boosts = ", ".join(_boost_sql(s, max(_SPACE["maxIter"]), f"s{i}_") for i, s in enumerate(steps))
    rows = " UNION ALL ".join(f"SELECT {n} AS q, candidate_id, grade, round(s, 9) AS s FROM s{steps.index(p['stepSize'])}_{p['maxIter']} WHERE split = 'val'" for n, p in enumerate(_TRIALS))
    named = ", ".join(f"({n}, {p['maxIter']}, {p['stepSize']}::DOUBLE)" for n, p in enumerate(_TRIALS))
    return f"""WITH {_MODEL_ROWS}, {_FLAG_ROWS}, {boosts}, trials AS ({rows}), {_metrics_sql('trials')}
SELECT q::INT AS trial, rounds::INT AS rounds, step, round({_WEIGHED}, 9) AS composite FROM parts JOIN (VALUES {named}) v(t, rounds, step) ON t = q"""


@register("tune_ranker_boosted", _trials_sql())
def tune_ranker_boosted(spark: SparkSession, sf: str) -> DataFrame:
    """Five trials, several at a time, whose rounds and steps give different orders."""
    _, trials = model.tune_ranker(_flag_dataset(spark, sf), trials=5, seed=_TUNE_SEED, space=_SPACE, kind="gbt", stop="none",
                                  features=list(_FLAGS), categorical=[], maxDepth=1)
    rows = [(t["trial"], t["params"]["maxIter"], t["params"]["stepSize"], t["composite"]) for t in trials]
    return _rounded(spark.createDataFrame(rows, "trial int, rounds int, step double, composite double"))


# --- metrics of many queries, one of which holds a third of all rows ---

_ORDERS = """judged AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END AS query, o_orderkey, o_totalprice, o_orderkey * 7 % 11 % 7 AS grade FROM orders),
listed AS (SELECT * FROM judged WHERE o_orderkey % 4 <> 1)"""


@register("metric_by_query_judged", f"""WITH {_ORDERS}, placed AS (SELECT query, grade, (grade >= 3)::INT AS rel, row_number() OVER (PARTITION BY query ORDER BY o_totalprice DESC, o_orderkey) AS pos FROM listed),
cum AS (SELECT *, sum(rel) OVER (PARTITION BY query ORDER BY pos) AS cum_rel FROM placed),
best AS (SELECT query, grade, (grade >= 3)::INT AS rel, row_number() OVER (PARTITION BY query ORDER BY grade DESC, o_orderkey) AS ideal FROM judged),
lists AS (SELECT query, {_dcg_sql('pos', 10)} AS d10, {_dcg_sql('pos', 50)} AS d50, sum(rel * cum_rel / pos::DOUBLE) AS ps, {_p_sql(10)} AS p_10 FROM cum GROUP BY query),
ideals AS (SELECT query, {_dcg_sql('ideal', 10)} AS i10, {_dcg_sql('ideal', 50)} AS i50, sum(rel) AS relevant FROM best GROUP BY query),
parts AS (SELECT query, coalesce(d10 / nullif(i10, 0), 0) AS ndcg_10, coalesce(d50 / nullif(i50, 0), 0) AS ndcg_50, coalesce(ps / nullif(relevant, 0), 0)::DOUBLE AS map, p_10 FROM lists JOIN ideals USING (query))
SELECT query, {_NAMES}, round({_WEIGHED}, 9) AS composite FROM parts""")
def metric_by_query_judged(spark: SparkSession, sf: str) -> DataFrame:
    """The orders of every customer by price; a quarter of what was judged is missing in the lists."""
    query = F.when(F.col("o_orderkey") % 3 == 0, -1).otherwise(F.col("o_custkey"))
    judged = table(spark, sf, "orders").select(query.alias("query"), "o_orderkey", "o_totalprice", (F.col("o_orderkey") * 7 % 11 % 7).alias("grade"))
    listed = judged.filter("o_orderkey % 4 <> 1")
    return _rounded(evaluate.metric_by_query(listed, "query", judged=judged, order=[F.desc("o_totalprice"), "o_orderkey"]))
