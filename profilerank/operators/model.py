"""Training, tuning, prediction and attribution with pyspark.ml.

Pointwise rankers learn the label gain of single rows: boosted trees, or a linear model whose attributions are exact. The
pairwise ranker learns from pairs of rows of one query which of the two has the higher grade; pairs are drawn, a bounded
number per row, so a query may hold any share of the rows. All of them train distributed over any number of rows.
"""

from __future__ import annotations

import json
import random
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.numbers import num_coerce
from ..functions.ordinals import label_gain
from ..schema import ID
from ..session import materialize
from .evaluate import evaluate, metric_by_query
from .features import CATEGORICAL_COLUMNS, FEATURE_COLUMNS
from .ranking import global_rank

SCORE = "predicted_score"

#: What an absent value is to the learner: trees can split it off from every real value, a linear model takes zero.
MISSING = {"gbt": -1e6, "linear": 0.0, "pairwise": 0.0}

#: Partners that a row is compared with in pairwise training.
PARTNERS = 8

# --- fixed values: choices of the random search ---
SEARCH_SPACE = {
    "maxDepth": [3, 4, 5, 6],
    "minInstancesPerNode": [10, 20, 30, 50, 80],
    "stepSize": [0.02, 0.03, 0.05, 0.08],
    "subsamplingRate": [0.6, 0.7, 0.8, 1.0],
    "featureSubsetStrategy": ["0.6", "0.7", "0.8", "all"],
    "maxBins": [16, 32, 64],
    "minInfoGain": [0.0, 0.001, 0.01],
    "maxIter": [20, 30, 40],
}


@dataclass
class Ranker:
    model: PipelineModel
    features: list[str]
    categorical: list[str]
    kind: str
    params: dict = field(default_factory=dict)


def coerce_features(
    df: DataFrame, features: list[str] = FEATURE_COLUMNS, categorical: list[str] = CATEGORICAL_COLUMNS,
    missing: float | None = None,
) -> DataFrame:
    """Feature columns as doubles; unknown columns and values are NULL, or ``missing`` when given.

    Categorical columns are whole codes in an order of their own, -1 where the value is unknown.
    """
    def one(name: str):
        value = num_coerce(F.col(name)) if name in df.columns else F.lit(None).cast("double")
        if name in categorical:
            return F.floor(F.coalesce(value, F.lit(-1.0))).cast("double")
        return value if missing is None else F.coalesce(F.nanvl(value, F.lit(missing)), F.lit(missing))

    kept = [c for c in df.columns if c not in features]
    return df.select(*kept, *[one(c).alias(c) for c in features])


def _pipeline(kind: str, features: list[str], params: dict, seed: int, by_error: bool = True) -> Pipeline:
    assembler = VectorAssembler(inputCols=features, outputCol="_raw", handleInvalid="error")
    if kind == "gbt":
        stop = {"validationIndicatorCol": "_val"} if by_error else {}
        learner = GBTRegressor(featuresCol="_raw", labelCol="label_gain", predictionCol=SCORE, seed=seed,
                               **{"maxIter": 30, "maxDepth": 4, "stepSize": 0.1, **stop, **params})
        return Pipeline(stages=[assembler, learner])
    scaler = StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True)
    if kind == "pairwise":
        return Pipeline(stages=[assembler, scaler])
    learner = LinearRegression(featuresCol="_scaled", labelCol="label_gain", predictionCol=SCORE,
                               **{"regParam": 0.1, "elasticNetParam": 0.0, "maxIter": 50, **params})
    return Pipeline(stages=[assembler, scaler, learner])


def train_ranker(
    dataset: DataFrame, kind: str = "gbt", features: list[str] = FEATURE_COLUMNS,
    categorical: list[str] = CATEGORICAL_COLUMNS, seed: int = 42, stop: str = "error", query: str | None = None,
    partners: int = PARTNERS, **params,
) -> Ranker:
    """A ranker from a dataset with ``split``, ``label_gain`` and, for pairs and for the composite, ``relevance_grade``.

    Boosting keeps the rounds up to where the validation rows stop improving: by their error while it trains, or with
    ``stop="composite"`` by the composite of every number of rounds, of which the best is kept; ``"none"`` keeps all. The other
    kinds see training rows only. ``pairwise`` compares rows of one ``query`` (all rows are one without it); see ``grade_pairs``.
    """
    if stop not in ("error", "composite", "none"):
        raise ValueError(f"a ranker stops by error, composite or none, not by {stop}")
    rows = coerce_features(dataset, features, categorical, MISSING[kind]).withColumn("_val", F.col("split") == "val")
    by_error = stop == "error"
    pipeline = _pipeline(kind, features, params, seed, by_error)
    if kind == "pairwise":
        model = _fit_pairs(pipeline, rows.filter(~F.col("_val")), query, partners, seed, params)
        return Ranker(model, features, categorical, kind, params)
    used = rows if kind == "gbt" and by_error else rows.filter(~F.col("_val"))
    ranker = Ranker(pipeline.fit(used), features, categorical, kind, params)
    return ranker if kind != "gbt" or stop != "composite" else cut_ranker(ranker, best_round(prefix_metrics(ranker, dataset)))


def grade_pairs(rows: DataFrame, query: str | None, partners: int, seed: int = 42, carry: str = "_scaled") -> DataFrame:
    """(id, partner, weight, label, x, y): every row with ``partners`` rows of another grade in its query.

    Rows of a query lie in the order of grade and a hash. A row draws, by hash, places outside the stretch of its own
    grade, so every draw is a pair that tells something, all pairs are never built, and a query of any size is worked on
    by all tasks: places come from a global rank, and a draw finds its row by the key (query, place). A row whose query has
    one grade only draws none. ``x`` and ``y`` are what the two rows carry; the weight is the difference of their gains.
    """
    drawn = F.col(query) if query else F.lit(0)
    keyed = rows.select(ID, drawn.alias("_q"), F.col("relevance_grade").alias("_grade"), F.col(carry).alias("_x"),
                        F.md5(F.concat(F.lit(f"{seed}:"), ID)).alias("_h"))
    ranked = materialize(global_rank(keyed, ["_q", "_grade", "_h", ID], "_rank"), "pair_ranks")
    blocks = ranked.groupBy("_q", "_grade").agg(F.min("_rank").alias("_low"), F.count("*").alias("_own"))
    queries = ranked.groupBy("_q").agg(F.min("_rank").alias("_first"), F.count("*").alias("_all"))
    # Two joins of rows with aggregates: a hot query is split by adaptive execution, its other side is one row.
    both = ranked.join(blocks, ["_q", "_grade"]).join(queries, "_q").where(F.col("_all") > F.col("_own"))
    draws = both.withColumn("_draw", F.explode(F.sequence(F.lit(1), F.lit(partners))))
    number = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), "_draw", F.lit(":"), ID)), 1, 15), 16, 10).cast("bigint")
    place = F.col("_first") + F.pmod(number, F.col("_all") - F.col("_own"))
    at = draws.withColumn("_at", place + F.when(place >= F.col("_low"), F.col("_own")).otherwise(0))
    other = ranked.select(F.col("_rank").alias("_at"), F.col(ID).alias("partner"), F.col("_grade").alias("_other"), F.col("_x").alias("y"))
    gain = F.abs(label_gain(F.col("_grade")) - label_gain(F.col("_other")))
    return at.join(other, "_at").select(ID, "partner", gain.alias("weight"), (F.col("_grade") > F.col("_other")).cast("double").alias("label"),
                                        F.col("_x").alias("x"), "y")


def _fit_pairs(pipeline: Pipeline, rows: DataFrame, query: str | None, partners: int, seed: int, params: dict) -> PipelineModel:
    """A logistic model without intercept on differences of the scaled features: its margin is the score of a row."""
    prepared = pipeline.fit(rows)
    pairs = grade_pairs(prepared.transform(rows), query, partners, seed)
    apart = array_to_vector(F.zip_with(vector_to_array("x"), vector_to_array("y"), lambda a, b: a - b))
    learner = LogisticRegression(featuresCol="_scaled", labelCol="label", weightCol="weight", fitIntercept=False, standardization=False,
                                 **{"regParam": 0.01, "maxIter": 100, "tol": 1e-9, **params})
    fitted = learner.fit(materialize(pairs.select(apart.alias("_d"), "weight", "label"), "pairs").withColumnRenamed("_d", "_scaled"))
    return PipelineModel(stages=[*prepared.stages, fitted])


def _score_column(kind: str) -> Column:
    return F.get(vector_to_array("rawPrediction"), 1) if kind == "pairwise" else F.col(SCORE)


def prefix_scores(ranker: Ranker, rows: DataFrame, keep: tuple[str, ...] = (ID, "relevance_grade")) -> DataFrame:
    """(keep..., rounds, predicted_score): the scores of a boosted ranker after every number of rounds, from one pass."""
    assembler, boosted = ranker.model.stages
    scored = assembler.transform(coerce_features(rows, ranker.features, ranker.categorical, MISSING["gbt"]))
    sums: list[Column] = []
    for i, (tree, weight) in enumerate(zip(boosted.trees, boosted.treeWeights)):
        scored = tree.copy({tree.featuresCol: "_raw", tree.predictionCol: f"_t{i}"}).transform(scored)
        own = F.col(f"_t{i}") * F.lit(float(weight))
        sums.append(sums[-1] + own if sums else own)
    return scored.select(*keep, F.posexplode(F.array(*sums)).alias("_p", SCORE)).select(*keep, (F.col("_p") + 1).alias("rounds"), SCORE)


def prefix_metrics(ranker: Ranker, dataset: DataFrame, split: str = "val") -> DataFrame:
    """The metrics of one split after every number of rounds; one row per number."""
    scored = prefix_scores(ranker, dataset.filter(F.col("split") == split))
    return metric_by_query(scored, "rounds", grade="relevance_grade", order=[F.desc(SCORE), F.asc(ID)])


def best_round(metrics: DataFrame) -> int:
    """The smallest number of rounds with the highest composite; as many rows as rounds."""
    return metrics.orderBy(F.desc("composite"), "rounds").first()["rounds"]


def cut_ranker(ranker: Ranker, rounds: int) -> Ranker:
    """The boosted ranker with its first trees only."""
    assembler, boosted = ranker.model.stages
    gateway = SparkSession.getActiveSession().sparkContext._gateway
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = boosted.trees[i]._java_obj, float(boosted.treeWeights[i])
    made = gateway.jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"{boosted.uid}_{rounds}", trees, weights)
    short = GBTRegressionModel(made)
    short.setFeaturesCol("_raw")
    short.setPredictionCol(SCORE)
    return Ranker(PipelineModel(stages=[assembler, short]), ranker.features, ranker.categorical, ranker.kind, {**ranker.params, "rounds": rounds})


def predict_pool(ranker: Ranker, pool: DataFrame, keep: tuple[str, ...] = (ID,)) -> DataFrame:
    """(keep…, predicted_score) for every row. A feature the pool has no column for is an error, a NULL is a missing value."""
    absent = [f for f in ranker.features if f not in pool.columns]
    if absent:
        raise ValueError(f"the pool lacks features the ranker was trained on: {', '.join(absent)}")
    rows = coerce_features(pool, ranker.features, ranker.categorical, MISSING[ranker.kind])
    return ranker.model.transform(rows).select(*keep, _score_column(ranker.kind).alias(SCORE))


def evaluate_ranker(ranker: Ranker, dataset: DataFrame, split: str) -> DataFrame:
    scored = predict_pool(ranker, dataset.filter(F.col("split") == split), (ID, "relevance_grade"))
    return evaluate(scored, SCORE, "relevance_grade")


def sample_params(trials: int, seed: int = 42, space: dict | None = None) -> list[dict]:
    rng = random.Random(seed)
    return [{name: rng.choice(choices) for name, choices in (space or SEARCH_SPACE).items()} for _ in range(trials)]


class CompositeEvaluator(Evaluator):
    """The composite of a scored table, for pyspark.ml's own tuning as well."""

    def __init__(self, score: str = SCORE, grade: str = "relevance_grade"):
        super().__init__()
        self.score, self.grade = score, grade

    def _evaluate(self, dataset: DataFrame) -> float:
        return evaluate(dataset, self.score, self.grade).first()["composite"]

    def isLargerBetter(self) -> bool:
        return True


def tune_ranker(
    dataset: DataFrame, trials: int = 5, seed: int = 42, space: dict | None = None, parallel: int = 4, **kwargs,
) -> tuple[Ranker, list[dict]]:
    """Random search by validation composite; returns the best trial's ranker and the trials, best first.

    ``parallel`` trials run at a time, each as jobs over the whole cluster: while one fits a small last stage, others use
    the rest. Equal composites go to the earlier trial. A trial that fails ends the search with its error.
    """
    valid, evaluator = dataset.filter(F.col("split") == "val"), CompositeEvaluator()

    def run(task: tuple[int, dict]) -> tuple[dict, Ranker]:
        number, params = task
        ranker = train_ranker(dataset, seed=seed, **kwargs, **params)
        scored = predict_pool(ranker, valid, (ID, evaluator.grade))
        return {"trial": number, "composite": evaluator.evaluate(scored), "params": params}, ranker

    with ThreadPool(max(1, min(parallel, trials))) as pool:
        done = pool.map(inheritable_thread_target(dataset.sparkSession)(run), list(enumerate(sample_params(trials, seed, space))), 1)
    done.sort(key=lambda r: (-r[0]["composite"], r[0]["trial"]))
    return done[0][1], [r for r, _ in done]


def attribution(ranker: Ranker, rows: DataFrame) -> DataFrame:
    """Adds ``contributions`` (one per feature), ``bias`` and ``predicted_score`` of a linear ranker.

    The contribution of a feature is its coefficient times the distance from the mean, so that
    contributions and bias add up to the score. Meant for the top rows only.
    """
    if ranker.kind != "linear":
        raise ValueError("exact attributions need a linear ranker")
    learner = ranker.model.stages[-1]
    # The row travels along as one value; nothing is joined back.
    kept = [c for c in rows.columns if c != SCORE]
    whole = rows.select(*rows.columns, F.struct(*kept).alias("_row"))
    scored = ranker.model.transform(coerce_features(whole, ranker.features, ranker.categorical, MISSING["linear"]))
    weights = F.array(*[F.lit(float(w)) for w in learner.coefficients])
    parts = F.zip_with(vector_to_array("_scaled"), weights, lambda x, w: x * w)
    return scored.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept], SCORE, parts.alias("contributions"),
                         F.lit(float(learner.intercept)).alias("bias"))


def save_ranker(ranker: Ranker, path: str) -> None:
    """Writes the fitted model and what scoring needs to know beside it."""
    ranker.model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    facts = json.dumps({"features": ranker.features, "categorical": ranker.categorical, "kind": ranker.kind, "params": ranker.params})
    spark.createDataFrame([(facts,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")


def load_ranker(spark: SparkSession, path: str) -> Ranker:
    """The ranker that ``save_ranker`` wrote, in this or another job."""
    return Ranker(PipelineModel.load(f"{path}/model"), **json.loads(spark.read.text(f"{path}/facts").first()[0]))


def attribution_error(explained: DataFrame) -> DataFrame:
    """One row: the greatest difference between a score and its explained parts."""
    parts = F.aggregate("contributions", F.col("bias"), lambda a, x: a + x)
    return explained.agg(F.max(F.abs(parts - F.col(SCORE))).alias("max_error"))
