"""Checks of a result table; one row per violation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schema import ID, ID_PATTERN
from ..session import materialize
from .ranking import global_rank

# --- fixed values: the result format ---
RESULT_COLUMNS = ["candidate_id", "rank", "score", "reasoning"]
RESULT_ROWS = 100
_FLOAT = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$"


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """A result CSV as text columns in file order, blank rows skipped; the header must be exact.

    ``n_columns`` is the number of fields a row really has. Spark pads short rows and cuts long ones, so the file is read
    with one column more than the format has, and fields beyond that are found in the corrupt-record column.
    """
    options = {"quote": '"', "escape": '"', "multiLine": True}
    header = spark.read.options(**options).option("header", True).csv(path).columns
    if header != RESULT_COLUMNS:
        raise ValueError(f"the header must be {','.join(RESULT_COLUMNS)}, found {','.join(header)}")
    wide = ", ".join(f"{c} string" for c in [*RESULT_COLUMNS, "_more", "_bad"])
    read = spark.read.options(**options).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_bad").option("columnPruning", False).schema(wide).csv(path)
    filled = sum((F.col(c).isNotNull().cast("int") for c in RESULT_COLUMNS), F.lit(0))
    # A row of another width than the schema's has its text in the corrupt-record column; a right one lacks only "_more".
    fields = F.when(F.col("_more").isNotNull(), len(RESULT_COLUMNS) + 1).when(F.col("_bad").isNotNull(), _fields(F.col("_bad"))).otherwise(filled)
    return read.select(*RESULT_COLUMNS, fields.alias("n_columns")).withColumn("row_num", F.monotonically_increasing_id())


def _fields(line: Column) -> Column:
    """Number of fields of a line: commas outside quotes and one."""
    bare = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _violation(rows: DataFrame, rule: str, item: Column) -> DataFrame:
    return rows.select(F.lit(rule).alias("rule"), item.cast("string").alias("item"))


def _found(rows: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """All rules on single rows in one pass: name -> (condition, item)."""
    entries = [F.when(c, F.struct(F.lit(n).alias("rule"), item.cast("string").alias("item"))) for n, (c, item) in rules.items()]
    return rows.select(F.explode_outer(F.array_compact(F.array(*entries))).alias("v")).filter("v IS NOT NULL").select("v.*")


def result_validate(result: DataFrame, expected_rows: int = RESULT_ROWS) -> DataFrame:
    """(rule, item): row width, row count, ids, ranks, scores, order and tie-break. Empty for a valid table.

    ``row_num`` gives the order of the rows, and ``n_columns``, if there, the fields each row has in its file. The rows are stored once. Neighbours by rank are joined
    through their position, so a table of any length is checked without collecting it.
    """
    wide = F.col("n_columns") if "n_columns" in result.columns else F.lit(len(RESULT_COLUMNS))
    trimmed = result.select("row_num", wide.alias("n_columns"), *[F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in RESULT_COLUMNS[:3]])
    whole = F.when(F.col("rank").rlike(r"^(0|-?[1-9]\d*)$"), F.col("rank").try_cast("bigint"))
    number = F.when(F.col("score").rlike(_FLOAT), F.col("score").try_cast("double"))
    rows = materialize(trimmed.select("row_num", "n_columns", ID, whole.alias("rank_value"), number.alias("score_value")), "result")
    rank, given = F.col("rank_value"), F.col(ID) != ""
    in_range = rank.between(1, expected_rows)
    well_formed = given & F.col(ID).rlike(ID_PATTERN)

    def repeated(kept: DataFrame, column: str, rule: str) -> DataFrame:
        counted = kept.groupBy(column).agg(F.count("*").alias("n")).filter("n > 1")
        return _violation(counted, rule, F.col(column))

    ranks = result.sparkSession.range(1, expected_rows + 1).select(F.col("id").alias("rank_value"))
    used = rows.filter(in_range).select("rank_value").distinct()
    ordered = global_rank(rows.filter(rank.isNotNull() & F.col("score_value").isNotNull() & given), ["rank_value", "row_num"], "place")
    following = ordered.select((F.col("place") - 1).alias("place"), F.col("score_value").alias("next_score"), F.col(ID).alias("next_id"))
    count = rows.agg(F.count("*").alias("n")).filter(F.col("n") != expected_rows)
    found = [
        _found(rows, {
            "column_count": (F.col("n_columns") != len(RESULT_COLUMNS), F.col("row_num")),
            "id_missing": (~given, F.col("row_num")), "id_pattern": (given & ~well_formed, F.col(ID)),
            "rank_not_integer": (rank.isNull(), F.col("row_num")), "rank_out_of_range": (~in_range, rank),
            "score_not_float": (F.col("score_value").isNull(), F.col("row_num"))}),
        _found(ordered.join(following, "place"), {
            "score_increases": (F.col("score_value") < F.col("next_score"), rank),
            "tie_order": ((F.col("score_value") == F.col("next_score")) & (F.col(ID) > F.col("next_id")), rank)}),
        _violation(count, "row_count", F.col("n")),
        repeated(rows.filter(well_formed), ID, "id_duplicate"),
        repeated(rows.filter(in_range), "rank_value", "rank_duplicate"),
        _violation(ranks.join(used, "rank_value", "left_anti"), "rank_missing", rank),
    ]
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def reason_unique(result: DataFrame, reason: str = "reasoning") -> DataFrame:
    """One row: reasons, empty reasons, distinct reasons, duplicates.

    Reasons are counted by value first, so a reason shared by very many rows combines before the shuffle.
    """
    text = F.coalesce(F.col(reason), F.lit(""))
    per_text = result.groupBy(text.alias("t")).agg(F.count("*").alias("n"))
    return per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("reasons"),
        F.coalesce(F.sum(F.when(F.trim("t") == "", F.col("n"))), F.lit(0)).alias("empty"),
        F.count("*").alias("distinct_reasons"), F.coalesce(F.sum("n") - F.count("*"), F.lit(0)).alias("duplicates"))
