"""Population-calibrated integrity metrics and checks.

Calibration and checking share these definitions. Everything is row-local; overlaps are compared
inside one record, whose size the source record bounds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import date_parse_prefix, months_whole
from ..functions.text import plain
from ..schema import ID

# --- fixed values: names of the checks, in reporting order ---
CHECKS = {
    "gap_exceeds": "CAREER_SPAN_EXCEEDS_EXPERIENCE",
    "single_role_exceeds": "SINGLE_ROLE_EXCEEDS_EXPERIENCE",
    "zero_expert_exceeds": "ZERO_DURATION_EXPERT_SKILL",
    "edu_invalid": "INVALID_EDUCATION_DATES",
    "overlap_exceeds": "OVERLAPPING_FULL_TIME_ROLES",
}


@dataclass(frozen=True)
class Thresholds:
    """Tolerances of the checks; the values here hold when nothing else is known."""

    span_gap_tolerance_years: float = 2.0
    single_role_tolerance_years: float = 4.0
    min_overlap_months: int = 3
    zero_duration_expert_min_count: int = 1


def _parsed_roles(history: Column, reference: Column) -> Column:
    """Roles with parsed dates; a current role without an end runs to the reference date."""
    def role(h: Column, i: Column) -> Column:
        has_end = F.coalesce(h["end_date"], F.lit("")) != ""
        end = F.when(has_end, date_parse_prefix(h["end_date"])).when(h["is_current"], reference)
        return F.struct(i.alias("pos"), date_parse_prefix(h["start_date"]).alias("s"), end.alias("e"),
                        F.concat(plain(h["title"]), F.lit(" at "), plain(h["company"])).alias("label"))

    return F.transform(history, role)


def overlap_pairs(roles: Column) -> Column:
    """Pairs of roles that share at least one whole month, as (i, j, months, role_a, role_b).

    Only overlapping pairs are built. Missing dates compare as NULL and drop out.
    """
    def with_later(a: Column) -> Column:
        shared = F.filter(roles, lambda b: (b["pos"] > a["pos"]) & (a["s"] < a["e"]) & (b["s"] < b["e"])
                          & (a["s"] < b["e"]) & (b["s"] < a["e"]))
        return F.filter(F.transform(shared, lambda b: F.struct(
            a["pos"].alias("i"), b["pos"].alias("j"),
            months_whole(F.greatest(a["s"], b["s"]), F.least(a["e"], b["e"])).alias("months"),
            a["label"].alias("role_a"), b["label"].alias("role_b"))), lambda x: x["months"] > 0)

    return F.flatten(F.transform(roles, with_later))


def integrity_metrics(
    pool: DataFrame, reference_date: str, keep: tuple[str, ...] = (ID,), detail: bool = False,
) -> DataFrame:
    """One row per record with span, gap, longest role, expert, education and overlap metrics."""
    reference = F.lit(reference_date).cast("date")
    history, skills, education = F.col("career_history"), F.col("skills"), F.col("education")
    durations = F.filter(F.transform(history, lambda h: h["duration_months"]), lambda d: d.isNotNull())
    parsed = pool.select(
        *keep, F.col("profile.years_of_experience").alias("stated_years"),
        F.greatest(F.size(history), F.lit(0)).alias("history_entries"),
        F.coalesce(F.aggregate(durations, F.lit(0.0), lambda a, d: a + d), F.lit(0.0)).alias("total_months"),
        F.array_max(F.filter(durations, lambda d: d >= 0)).alias("max_role_months"),
        _parsed_roles(history, reference).alias("roles"),
        F.filter(skills, lambda s: (s["proficiency"] == "expert") & (s["duration_months"] == 0)).alias("zero_expert"),
        F.greatest(F.size(F.filter(education, lambda e: e["end_year"] < e["start_year"])), F.lit(0)).alias("edu_invalid_count"),
        *([history.alias("history")] if detail else []),
    )
    spans = parsed.withColumns({
        "earliest_start": F.array_min(F.transform("roles", lambda r: r["s"])),
        "latest_end": F.array_max(F.transform("roles", lambda r: r["e"])),
        "overlap_pairs": F.coalesce(overlap_pairs(F.col("roles")), F.array().cast(
            "array<struct<i:int,j:int,months:int,role_a:string,role_b:string>>")),
    })
    span = months_whole(F.col("earliest_start"), F.col("latest_end"))
    metrics = spans.withColumn("span_months", span).withColumns({
        "span_years": F.col("span_months") / 12,
        "gap_years": F.col("stated_years") - F.col("span_months") / 12,
        "single_role_excess_years": F.col("max_role_months") / 12 - F.col("stated_years"),
        "zero_expert_count": F.greatest(F.size("zero_expert"), F.lit(0)),
        "overlap_months": F.transform("overlap_pairs", lambda o: o["months"]),
    })
    extra: list[Column] = []
    if detail:
        longest = F.get(F.filter("history", lambda h: h["duration_months"] == F.col("max_role_months")), 0)
        extra = [
            F.concat(plain(longest["title"]), F.lit(" at "), plain(longest["company"])).alias("max_role_title"),
            F.coalesce(F.transform("zero_expert", lambda s: plain(s["name"])), F.array().cast("array<string>")).alias("zero_expert_skills"),
        ]
    return metrics.select(
        *keep, "stated_years", "history_entries", "total_months", "max_role_months", "earliest_start", "latest_end",
        "span_months", "span_years", "gap_years", "single_role_excess_years", "zero_expert_count", "edu_invalid_count",
        "overlap_months", "overlap_pairs", *extra,
    )


def integrity_checks(metrics: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Adds the five checks, their disjunction and the names of those that hold.

    The two year differences are compared after rounding to two decimals.
    """
    t = thresholds
    span = F.round(F.col("span_months") / 12, 2)
    rounded = metrics.withColumns({
        "gap_checked": F.round(F.col("stated_years") - span, 2),
        "single_role_excess_checked": F.round(F.round(F.col("max_role_months") / 12, 2) - F.col("stated_years"), 2),
        "overlap_pairs": F.filter("overlap_pairs", lambda o: o["months"] >= t.min_overlap_months),
    })
    checked = rounded.withColumns({
        "gap_exceeds": F.coalesce(F.col("gap_checked") > t.span_gap_tolerance_years, F.lit(False)),
        "single_role_exceeds": F.coalesce(F.col("single_role_excess_checked") > t.single_role_tolerance_years, F.lit(False)),
        "zero_expert_exceeds": F.col("zero_expert_count") >= t.zero_duration_expert_min_count,
        "edu_invalid": F.col("edu_invalid_count") > 0,
        "overlap_exceeds": F.size("overlap_pairs") > 0,
    })
    tripped = F.array_compact(F.array(*[F.when(F.col(c), F.lit(name)) for c, name in CHECKS.items()]))
    return checked.withColumn("tripped", tripped).withColumn("any_check", F.size("tripped") > 0)


def interval_overlap_pairs(pool: DataFrame, reference_date: str, min_months: int = 1) -> DataFrame:
    """One row per pair of roles of a record that overlap by at least ``min_months``."""
    roles = pool.select(ID, _parsed_roles(F.col("career_history"), F.lit(reference_date).cast("date")).alias("roles"))
    return (
        roles.select(ID, F.explode_outer(overlap_pairs(F.col("roles"))).alias("o"))
        .filter(F.col("o.months") >= min_months)
        .select(ID, "o.i", "o.j", "o.months", "o.role_a", "o.role_b")
    )


def interval_pairs(rows: DataFrame, key: str, start: str, end: str, pos: str, bucket_seconds: int | None = None) -> DataFrame:
    """(key, i, j, overlap_seconds): pairs of intervals of one key that overlap, of a flat table with one row per interval.

    Of two overlapping intervals the later one starts inside the earlier one. Time is cut into buckets; an interval is
    asked for in the buckets it covers and stands in the one it starts in, so an equi-join on key and bucket meets every
    pair once, and the work follows the overlaps, not the square of a key's rows. A key with very many rows is spread over
    its buckets. Without ``bucket_seconds`` a bucket is as long as nine of ten intervals at most. Equal starts go by ``pos``,
    which is unique within a key. Rows with a missing bound, and empty or reversed intervals, overlap nothing.
    """
    timed = rows.select(F.col(key).alias("k"), F.unix_micros(F.col(start).cast("timestamp")).alias("s"),
                        F.unix_micros(F.col(end).cast("timestamp")).alias("e"), F.col(pos).alias("p")).filter("s < e")
    if bucket_seconds is None:
        usual = timed.agg(F.percentile_approx(F.col("e") - F.col("s"), 0.9)).first()[0]
        bucket_seconds = max(1, -(-(usual or 1) // 1_000_000))
    width = F.lit(bucket_seconds * 1_000_000)

    def bucket(at: Column) -> Column:
        return F.floor(at / width).cast("bigint")

    asks = timed.select("k", F.col("s").alias("s1"), F.col("e").alias("e1"), F.col("p").alias("i"),
                        F.explode(F.sequence(bucket(F.col("s")), bucket(F.col("e") - 1))).alias("b"))
    stands = timed.select(F.col("k").alias("k2"), F.col("s").alias("s2"), F.col("e").alias("e2"), F.col("p").alias("j"), bucket(F.col("s")).alias("b2"))
    later = (F.col("s2") > F.col("s1")) | ((F.col("s2") == F.col("s1")) & (F.col("j") > F.col("i")))
    met = asks.join(stands, F.col("k").eqNullSafe(F.col("k2")) & (F.col("b") == F.col("b2")) & later & (F.col("s2") < F.col("e1")))
    return met.select(F.col("k").alias(key), "i", "j", ((F.least("e1", "e2") - F.col("s2")) / 1_000_000).alias("overlap_seconds"))


def verdict_disagree(verdicts: DataFrame, checks: DataFrame) -> DataFrame:
    """Verdicts of "clean" on records where a check holds, for review; the verdict itself stays."""
    tripped = checks.filter("any_check").select(ID, "tripped")
    return verdicts.filter(~F.col("is_honeypot")).join(tripped, ID)
