"""Reference dates, distributions over the whole pool, and thresholds taken from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.dates import date_parse_prefix, date_parse_strict
from ..schema import ID
from ..session import materialize
from .integrity import Thresholds, integrity_metrics
from .ranking import running_totals

# --- fixed values: percentiles of a summary, and the calibration rules below ---
PERCENTILES = [50, 90, 95, 99, 99.5, 99.8, 99.9, 99.95, 100]
NO_DATE_FLOOR = "1970-01-01"
NO_DATE_FALLBACK = "2026-01-01"


def percentile_name(p: float) -> str:
    return "p" + str(p).replace(".", "_")


def latest_date(strict: bool = False) -> Column:
    """Aggregate over a pool: the latest sign-up, activity, start or end date.

    Without any date it is 1970-01-01 in the strict reading (whole-string dates) and 2026-01-01
    in the other one.
    """
    parse = date_parse_strict if strict else date_parse_prefix
    fields = F.concat(
        F.array(F.col("signals.signup_date"), F.col("signals.last_active_date")),
        F.coalesce(F.transform("career_history", lambda h: h["start_date"]), F.array().cast("array<string>")),
        F.coalesce(F.transform("career_history", lambda h: h["end_date"]), F.array().cast("array<string>")))
    latest = F.max(F.array_max(F.transform(fields, parse)))
    if strict:
        latest = F.greatest(latest, F.lit(NO_DATE_FLOOR).cast("date"))
    return F.coalesce(latest, F.lit(NO_DATE_FALLBACK).cast("date"))


def ref_date_fields(pool: DataFrame, strict: bool = False) -> DataFrame:
    """One row, ``reference_date``: the latest date of the date fields of all records."""
    return pool.agg(latest_date(strict).alias("reference_date"))


def _string_leaves(column: Column, dtype: T.DataType) -> Column | None:
    """All strings inside a value as one array, or None when its type holds none."""
    if isinstance(dtype, T.StringType):
        return F.array(column)
    if isinstance(dtype, T.StructType):
        parts = [x for f in dtype.fields if (x := _string_leaves(column[f.name], f.dataType)) is not None]
        return F.concat(*parts) if parts else None
    if isinstance(dtype, T.MapType):
        return _string_leaves(F.map_values(column), T.ArrayType(dtype.valueType))
    if isinstance(dtype, T.ArrayType):
        none = F.array().cast("array<string>")
        if isinstance(dtype.elementType, T.StringType):
            return F.coalesce(column, none)
        fields = dtype.elementType.fields if isinstance(dtype.elementType, T.StructType) else []
        flat = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
        if flat and all(isinstance(f.dataType, T.AtomicType) for f in fields):  # a field of all entries is an array already
            return F.concat(*[F.coalesce(column[n], none) for n in flat])
        probe = _string_leaves(F.lit(None).cast(dtype.elementType), dtype.elementType)
        if probe is None:
            return None
        inner = F.flatten(F.transform(column, lambda x: _string_leaves(x, dtype.elementType)))
        return F.coalesce(inner, F.array().cast("array<string>"))
    return None


def ref_date_any_string(df: DataFrame) -> DataFrame:
    """One row, ``reference_date``: the latest date any string of any record starts with."""
    leaves = [x for f in df.schema.fields if (x := _string_leaves(F.col(f.name), f.dataType)) is not None]
    # Few strings start with a digit; no other can start with a date.
    numbers = F.filter(F.concat(*leaves), lambda x: (x >= "0") & (x < ":"))
    return df.agg(F.max(F.array_max(F.transform(numbers, date_parse_prefix))).alias("reference_date"))


def reference_date(pool: DataFrame, any_string: bool = True, override: str | None = None) -> str:
    """The reference date as a literal, so that every later plan is reproducible."""
    if override:
        return dt.date.fromisoformat(override).isoformat()
    value = (ref_date_any_string(pool) if any_string else ref_date_fields(pool)).first()[0]
    if value is None:
        raise ValueError("the pool holds no ISO date; give a reference date")
    return value.isoformat()


def summary_dist(values: DataFrame, by: str = "metric", value: str = "value") -> DataFrame:
    """Count, mean, deviation, least value and exact percentiles (linear interpolation) per group.

    Equal values are counted first, combining before the shuffle, and the counted values are
    ordered over all partitions. A percentile is then read off the running counts, so neither a
    frequent value nor a group with many distinct values ends up in one task.
    """
    counted = values.filter(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("n"))
    ordered = running_totals(counted, [F.col(by), F.col(value)], {"upto": "n"})
    sizes = ordered.groupBy(by).agg(
        F.sum("n").alias("total"), F.min(F.col("upto") - F.col("n")).alias("before"),
        F.sum(F.col(value) * F.col("n")).alias("s1"), F.min(value).alias("least"))
    # One row per group, stored: its size is known, so the planner decides how to join it, and a group with very many
    # distinct values is a skewed join key that adaptive execution splits.
    placed = ordered.join(materialize(sizes, "groups"), by).withColumns({
        "first": F.col("upto") - F.col("n") - F.col("before"), "last": F.col("upto") - F.col("before") - 1,
        "mean": F.col("s1") / F.col("total")})

    def at(position: Column) -> Column:
        return F.max(F.when((F.col("first") <= position) & (position <= F.col("last")), F.col(value)))

    reads: list[Column] = []
    for p in PERCENTILES:
        place = (F.col("total") - 1) * F.lit(p / 100)
        reads += [at(F.floor(place)).alias(f"{percentile_name(p)}_lo"), at(F.ceil(place)).alias(f"{percentile_name(p)}_hi")]
    spread = F.sqrt(F.sum((F.col(value) - F.col("mean")) ** 2 * F.col("n")) / F.max("total"))
    read = placed.groupBy(by).agg(
        F.max("total").alias("count"), F.max("mean").alias("mean"), spread.alias("std"), F.max("least").alias("min"), *reads)

    def interpolated(p: float) -> Column:
        name, place = percentile_name(p), (F.col("count") - 1) * F.lit(p / 100)
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        return F.round(low + (high - low) * (place - F.floor(place)), 3).alias(name)

    return read.select(by, "count", *[F.round(c, 3).alias(c) for c in ("mean", "std", "min")],
                       *[interpolated(p) for p in PERCENTILES])


def metric_values(metrics: DataFrame, zero_counts: bool = True) -> DataFrame:
    """(metric, value) rows of the seven distributions; gap and excess keep their positive side."""
    def entry(name: str, value: Column, condition: Column | None = None) -> Column:
        kept = value.cast("double") if condition is None else F.when(condition, value.cast("double"))
        return F.struct(F.lit(name).alias("metric"), kept.alias("value"))

    scalars = F.array(
        entry("stated_years", F.col("stated_years")), entry("history_entries", F.col("history_entries")),
        entry("gap_years", F.col("gap_years"), F.col("gap_years") > 0),
        entry("single_role_excess_years", F.col("single_role_excess_years"), F.col("single_role_excess_years") > 0),
        entry("zero_expert_count", F.col("zero_expert_count")), entry("edu_invalid_count", F.col("edu_invalid_count")))
    overlaps = F.transform("overlap_months", lambda m: F.struct(F.lit("overlap_months").alias("metric"), m.cast("double").alias("value")))
    return metrics.select(F.explode_outer(F.concat(scalars, overlaps)).alias("x")).select("x.*").filter("value IS NOT NULL")


def pool_counts(metrics: DataFrame) -> DataFrame:
    """One row: records, records with a career span, records with an expert skill never used."""
    total, zero = F.count("*"), F.count_if(F.col("zero_expert_count") > 0)
    return metrics.agg(
        total.alias("n_total"), F.count("span_months").alias("n_with_span"), zero.alias("n_with_zero_expert"),
        F.coalesce(F.round(F.try_divide(zero * 100.0, total), 4), F.lit(0.0)).alias("pct_with_zero_expert"))


def calibrate_thresholds(summaries: DataFrame) -> DataFrame:
    """One row of thresholds; NULL where the distribution behind a threshold is empty."""
    def of(metric: str, percentile: float) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col(percentile_name(percentile))))

    def half_year_up(value: Column, least: float) -> Column:
        return F.when(value.isNotNull(), F.greatest(F.lit(least), F.ceil(value * 2) / 2))

    overlap, experts = of("overlap_months", 95), of("zero_expert_count", 99)
    return summaries.agg(
        half_year_up(of("gap_years", 99.9), 2.0).alias("span_gap_tolerance_years"),
        half_year_up(of("single_role_excess_years", 99.9), 1.0).alias("single_role_tolerance_years"),
        F.when(overlap.isNotNull(), F.greatest(F.lit(2), F.ceil(overlap).cast("int"))).alias("min_overlap_months"),
        F.when(experts >= 1, 2).when(experts.isNotNull(), 1).alias("zero_duration_expert_min_count"))


def thresholds_resolve(calibrated: DataFrame | None = None, **overrides: float) -> Thresholds:
    """Given value, else calibrated value, else default. The calibrated input is one row."""
    row = calibrated.first().asDict() if calibrated is not None else {}
    names = Thresholds.__dataclass_fields__
    chosen = {n: overrides.get(n) if overrides.get(n) is not None else row.get(n) for n in names}
    return Thresholds(**{n: v for n, v in chosen.items() if v is not None})


def population_stats(pool: DataFrame, reference: str | None = None) -> dict[str, DataFrame | str]:
    """Reference date, counts, distributions and thresholds of a pool in one go."""
    day = reference_date(pool, override=reference)
    metrics = materialize(integrity_metrics(pool, day).drop("overlap_pairs"), "metrics")
    summaries = materialize(summary_dist(metric_values(metrics)), "summaries")
    return {"reference_date": day, "counts": pool_counts(metrics), "summaries": summaries,
            "thresholds": calibrate_thresholds(summaries), "metrics": metrics}
