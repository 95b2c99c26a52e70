"""Readers. All declare a schema; a value of the wrong type is NULL and the row survives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schema import CORRUPT, ID, pool_schema
from ..session import spread
from .arrays import array_objects

SCORE_FIELDS = "candidate_id string, score double"


def file_order() -> Column:
    """A sortable position of a row: file, block of the file, row inside the block."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))


def _read_json(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)


def _read_arrays(spark: SparkSession, path: str, schema: T.StructType, check: bool) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    parsed = F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return array_objects(spark, path, check).select(parsed.alias("_row")).select("_row.*")


def scan_pool(
    spark: SparkSession, path: str, signals_field: str = "signals", array: bool | None = None, check: bool = True,
) -> DataFrame:
    """Nested profiles from JSON lines, gzipped JSON lines, or JSON arrays (``*.json``).

    Rows without an id are skipped. With ``check``, a line that is no JSON is an error, raised by
    the job that meets it, so that no extra pass over the files is needed. The objects of an array are
    cut out of it by several tasks and stored. Few files that cannot be split are spread over all cores.
    """
    as_array = path.endswith(".json") if array is None else array
    schema = pool_schema(signals_field)
    read = _read_arrays(spark, path, schema, check) if as_array else _read_json(spark, path, schema)
    known = F.coalesce(ID, F.lit("")) != ""
    if check:
        # A line that cannot be parsed has all fields NULL; a wrong value alone leaves the others.
        broken = F.col(CORRUPT).isNotNull()
        for name in schema.fieldNames():
            broken = broken & F.col(name).isNull()
        error = F.raise_error(F.concat(F.lit(f"not JSON, in {path}: "), F.substring(CORRUPT, 1, 100)))
        known = F.when(broken, error.cast("boolean")).otherwise(known)
    if path.endswith(".gz"):
        read = spread(read)
    return read.filter(known).drop(CORRUPT).withColumnRenamed(signals_field, "signals")


def scan_scores_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """(candidate_id, score, source_pos) of all matching CSV files; rows without two cells are left out."""
    full = T.StructType.fromDDL(SCORE_FIELDS).add(CORRUPT, T.StringType())
    read = (
        spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).csv(pattern)
    )
    return read.select("candidate_id", "score", CORRUPT, file_order().alias("source_pos")).filter(
        F.col(CORRUPT).isNull()).drop(CORRUPT)


def scan_cache_tolerant(
    spark: SparkSession, path: str | list[str], fields: str, version: str | None = None, latest: bool = True,
    order: str | None = None,
) -> DataFrame:
    """Entries of an append-only JSON cache; broken lines and other versions are left out.

    With ``latest`` the last entry per id wins, found by an aggregate that combines before the
    shuffle: last by the column ``order``, or by file (in the order of modification) and line.
    """
    schema = T.StructType.fromDDL(fields)
    names = schema.fieldNames()
    read = _read_json(spark, path, schema)
    current = F.lit(True) if version is None else F.col("rubric_version") == version
    rows = read.select(
        *names, (F.col(order) if order else F.struct(
            F.col("_metadata.file_modification_time").alias("written"), file_order().alias("pos"))).alias("_at"),
    ).filter((F.coalesce(ID, F.lit("")) != "") & current)
    if not latest:
        return rows.drop("_at")
    rest = [n for n in names if n != ID]
    last = rows.groupBy(ID).agg(F.max_by(F.struct(*rest), F.col("_at")).alias("_last"))
    return last.select(ID, *[F.col(f"_last.{n}").alias(n) for n in rest])


def col_alias_resolve(df: DataFrame, aliases: list[str], name: str, required: bool = True) -> DataFrame:
    """Renames the first column found among ``aliases`` to ``name``."""
    found = next((a for a in aliases if a in df.columns), None)
    if found is None:
        if required:
            raise ValueError(f"none of the columns {aliases} in {df.columns}")
        return df
    return df if found == name else df.drop(*([name] if name in df.columns else [])).withColumnRenamed(found, name)


# --- fixed values: column names under which ranks, flags and grades are found ---
RANK_ALIASES = ["final_rank", "rank"]
LABEL_RANK_ALIASES = ["llm_rank", "rank"]
FLAG_ALIASES = ["honeypot_flag", "is_honeypot", "flagged"]
HIT_ALIASES = ["honeypot_rule_hits", "rule_hits", "num_rule_hits"]
GRADE_ALIASES = ["relevance_grade", "grade", "label"]


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A flat table: parquet, or CSV with a header and all columns as text."""
    if path.endswith((".csv", ".csv.gz")) or path.endswith(".csv/"):
        return spark.read.option("header", True).option("escape", '"').option("multiLine", False).csv(path)
    return spark.read.parquet(path)
