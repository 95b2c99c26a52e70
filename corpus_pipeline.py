"""A corpus pipeline: quality, near duplicates, repeated passages, benchmark passages, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes what a stage returns as Parquet to the
shared folder and gives the next stage the table read again. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from profilerank.llm import bpe, contamination, jaccard, language, quality, repeats
from profilerank.llm.common import owned, release, stored, table
from profilerank.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(function: Stage) -> Stage:
    """A stage that first deletes what the stage before it has stored on its way."""
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, __name__)
        with owned(__name__):
            return function(spark, docs, sf_dir)

    return run_stage


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model does not reject. It learns from the labelled rows of this stage's input."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"), ~language.held_out("doc_id", 3, 1))
    return quality.keep_good(docs, model)


@_stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones (five words, similarity 0.8): the one with the smallest id."""
    return jaccard.keep_one(docs, shingle=5, percent=80)


@_stage
def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without its repeated passages, of 400 bytes or of over 50 words; ``n_chars`` follows the text."""
    left = repeats.remove_repeats(docs, words=51)
    return left.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), "n_chars")).select(*docs.columns)


@_stage
def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return contamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


@_stage
def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token counts and digests of every document that is left."""
    return bpe.round_trip(docs, tokenizer_path())


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeat_stage),
    ("benchmark", benchmark_stage),
    ("tokens", token_stage),
]

#: No stage but the join has a form in SQL that DuckDB could run; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}", keep=True)
    release(spark, __name__)
    return docs


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
