"""Applying an external scorer in waves, and combining its answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import responses as R
from ..functions.numbers import half_even
from ..functions.responses import DISQUALIFIED_CAP, SUBSCORES
from ..schema import ID
from ..session import make_folder, materialize
from .joins import remaining_passes

Scorer = Callable[[list[str]], list[str]]


def _parsed(raw: DataFrame, column: str, fields: str) -> DataFrame:
    """Adds the object of a raw answer as text and as a struct, each computed once per row."""
    found = raw.withColumn("_object", R.json_extract_object(F.col(column)))
    return found.withColumns({
        "_row": R.parse_object(F.col("_object"), fields),
        "_out": F.get_json_object("_object", "$.hard_disqualifier")})


def with_verdict(raw: DataFrame, column: str = "raw") -> DataFrame:
    """Adds ``result``: the validated verdict of a raw answer, NULL when unusable."""
    parsed = _parsed(raw, column, R.VERDICT_FIELDS)
    return parsed.withColumn("result", R.verdict_validate(F.col("_row"))).drop("_object", "_row", "_out")


def with_score(raw: DataFrame, column: str = "raw") -> DataFrame:
    """Adds ``result``: the validated subscores of a raw answer, NULL when unusable."""
    parsed = _parsed(raw, column, R.SCORE_FIELDS)
    return parsed.withColumn("result", R.score_validate(F.col("_row"), F.col("_out"))).drop("_object", "_row", "_out")


def _call(scorer: Scorer, text: str, batch: int):
    """Answers batch by batch. Only the texts of one call are Python objects, those of the Arrow batch stay in its buffers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, texts = rows.column(ID), rows.column(text)
            for start in range(0, rows.num_rows, batch):
                asked = texts.slice(start, batch).to_pylist()
                answers = scorer(asked)
                if len(answers) != len(asked):
                    raise ValueError(f"{len(answers)} answers to {len(asked)} texts")
                yield pa.RecordBatch.from_arrays([ids.slice(start, batch), pa.array(answers, pa.string(), from_pandas=True)], [ID, "raw"])

    return run


def pointwise_apply(
    rows: DataFrame, scorer: Scorer, validated: Callable[[DataFrame], DataFrame], text: str = "doc_text",
    max_retries: int = 2, batch: int = 32,
) -> DataFrame:
    """(candidate_id, raw, result, attempt): one answer per row, the scorer called again only for failures.

    ``scorer`` maps a list of texts to a list of raw answers and runs inside the tasks, batch by
    batch. Each wave is written once; the next one is what has no valid result yet. Rows that fail
    in every wave keep their last raw answer and a NULL result.
    """
    return _waves(materialize(rows.select(ID, text), "texts"), scorer, validated, text, max_retries, batch)


def _waves(
    texts: DataFrame, scorer: Scorer, validated: Callable[[DataFrame], DataFrame], text: str, max_retries: int = 2, batch: int = 32,
) -> DataFrame:
    """``pointwise_apply`` to rows that are stored."""
    todo, waves = texts, []
    for attempt in range(max_retries + 1):
        raw = todo.mapInArrow(_call(scorer, text, batch), f"{ID} string, raw string")
        wave = materialize(validated(raw).withColumn("attempt", F.lit(attempt)), "wave")
        good = wave.filter("result IS NOT NULL")
        if attempt == max_retries:
            waves.append(wave)
            break
        waves.append(good)
        failed = wave.filter("result IS NULL").select(ID)
        if not failed.limit(1).count():
            break
        todo = texts.join(failed, ID, "left_semi")
    out = waves[0]
    for wave in waves[1:]:
        out = out.unionByName(wave)
    return out


def cached_rows(spark: SparkSession, cache: str, schema: T.StructType | str) -> DataFrame:
    """What runs have appended to a cache so far; a cache that is not there yet is made and empty."""
    make_folder(spark, cache)
    return spark.read.schema(schema).parquet(cache)


def cache_schema(rows: DataFrame, verdict: bool = False) -> T.StructType:
    """The columns that a cache of answers for the rows has."""
    empty = fallback_row(rows.select(ID, F.lit("").alias("raw"), _no_result(verdict).alias("result")), verdict)
    return T.StructType([*empty.schema.fields, T.StructField("pass", T.IntegerType())])


def score_remaining(
    rows: DataFrame, scorer: Scorer, cache: str, verdict: bool = False, passes: int = 1, text: str = "doc_text", **options,
) -> int:
    """Asks for the rows that have fewer than ``passes`` results in the cache and appends the answers, pass by pass.

    A stopped run continues where its last appended pass ended. The cache is counted once, and the texts that are
    still asked for are stored once. An id is expected once. Returns the number of rows asked for.
    """
    spark, asked, schema = rows.sparkSession, 0, cache_schema(rows, verdict)
    done = cached_rows(spark, cache, schema).select(ID, "pass")
    todo = materialize(remaining_passes(rows.select(ID, text), done, passes).filter("remaining > 0"), "texts")
    counts = {left: count for left, count in todo.groupBy("remaining").count().collect()}
    for number in range(passes - max(counts, default=0), passes):
        # A row that has n results takes part from pass n on.
        own = todo.filter(F.col("remaining") >= passes - number)
        answers = _waves(own.select(ID, text), scorer, with_verdict if verdict else with_score, text, **options)
        fallback_row(answers, verdict).withColumn("pass", F.lit(number)).select(*schema.names).write.mode("append").parquet(cache)
        asked += sum(count for left, count in counts.items() if left >= passes - number)
    return asked


def _no_result(verdict: bool) -> Column:
    """A typed NULL in place of a validated answer."""
    if verdict:
        return R.verdict_validate(R.parse_object(F.lit(""), R.VERDICT_FIELDS))
    return R.score_validate(R.parse_object(F.lit(""), R.SCORE_FIELDS), F.lit(None).cast("string"))


def fallback_row(answers: DataFrame, verdict: bool = False, attempts: int = 3) -> DataFrame:
    """Flat result rows; an unusable answer is score zero or "not flagged", marked ``fallback``.

    Its whole text is in ``fallback_answer``, which is NULL for usable answers.
    """
    missing = F.col("result").isNull()
    note = F.lit(f"no usable answer in {attempts} attempts")
    rationale = F.when(missing, note).otherwise(F.col("result.brief_rationale")).alias("brief_rationale")
    answer = F.when(missing, F.coalesce("raw", F.lit(""))).alias("fallback_answer")
    if verdict:
        return answers.select(
            ID, F.coalesce("result.is_honeypot", F.lit(False)).alias("is_honeypot"),
            F.col("result.violation_category").alias("violation_category"), F.col("result.evidence").alias("evidence"),
            rationale, missing.alias("fallback"), answer)
    return answers.select(
        ID, *[F.coalesce(f"result.{n}", F.lit(0)).alias(n) for n in SUBSCORES],
        F.coalesce("result.hard_disqualifier", F.lit(False)).alias("hard_disqualifier"),
        F.col("result.disqualifier_reason").alias("disqualifier_reason"), rationale,
        F.coalesce("result.total_score", F.lit(0)).alias("total_score"), missing.alias("fallback"), answer)


def avg_passes(passes: DataFrame, order: str = "pass") -> DataFrame:
    """One row per id over its passes: rounded mean subscores, any disqualifier, recomputed total.

    All parts are aggregates that combine before the shuffle.
    """
    flagged_reason = F.when(F.col("hard_disqualifier") & (F.coalesce("disqualifier_reason", F.lit("")) != ""),
                            F.struct(order, "disqualifier_reason"))
    means = {n: half_even(F.avg(n)).cast("int") for n in SUBSCORES}
    averaged = passes.groupBy(ID).agg(
        *[c.alias(n) for n, c in means.items()], F.bool_or("hard_disqualifier").alias("hard_disqualifier"),
        F.min(flagged_reason)["disqualifier_reason"].alias("disqualifier_reason"),
        F.min(F.struct(F.col(order), F.coalesce("brief_rationale", F.lit("")).alias("r")))["r"].alias("brief_rationale"))
    total: Column = sum((F.col(n) for n in SUBSCORES), F.lit(0))
    return averaged.withColumn("total_score", F.when(F.col("hard_disqualifier"), F.least(total, F.lit(DISQUALIFIED_CAP))).otherwise(total))


def category_breakdown(verdicts: DataFrame, category: str = "violation_category") -> DataFrame:
    """(category, flagged), most frequent first, over positive verdicts."""
    return (
        verdicts.filter("is_honeypot").groupBy(F.col(category).alias("category")).agg(F.count("*").alias("flagged"))
        .orderBy(F.desc("flagged"), "category")
    )


def flag_rate(verdicts: DataFrame, min_checked: int = 20, limit: float = 0.25) -> DataFrame:
    """One row: checked, flagged, rate, and an alarm for an implausible rate."""
    checked, flagged = F.count("*"), F.count_if("is_honeypot")
    rate = F.coalesce(F.try_divide(flagged.cast("double"), checked), F.lit(0.0))
    return verdicts.agg(checked.alias("checked"), flagged.alias("flagged"), rate.alias("rate"),
                        ((checked >= min_checked) & (rate > limit)).alias("alarm"))


# --- fixed values: score bands and their least total ---
BANDS = {"80-100": 80, "60-79": 60, "40-59": 40, "20-39": 20, "0-19": None}


def score_bands(scored: DataFrame, total: str = "total_score") -> DataFrame:
    """(band, rows) for every band, empty ones included."""
    band = None
    for name, least in list(BANDS.items())[:-1]:
        band = F.when(F.col(total) >= least, name) if band is None else band.when(F.col(total) >= least, name)
    counted = scored.groupBy(band.otherwise(list(BANDS)[-1]).alias("band")).agg(F.count("*").alias("n"))
    all_bands = scored.sparkSession.createDataFrame([(b,) for b in BANDS], "band string")
    return all_bands.join(counted, "band", "left").select("band", F.coalesce("n", F.lit(0)).alias("rows"))


def score_range(scored: DataFrame, total: str = "total_score") -> DataFrame:
    """One row: least, greatest and mean total, and the disqualified rows."""
    return scored.agg(F.min(total).alias("least"), F.max(total).alias("greatest"), F.round(F.avg(total), 6).alias("mean"),
                      F.count_if("hard_disqualifier").alias("disqualified"))
