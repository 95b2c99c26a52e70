"""Hard integrity rules: one hit flags the record, and a rule can hit more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import date_parse_strict, months_cal
from ..functions.text import strip
from ..schema import ID

# --- fixed values: patterns of a founding year, the first that matches decides ---
FOUNDING_YEAR = [
    r"founded(?: the company)? in (\d{4})",
    r"since (?:its |the company'?s )?founding in (\d{4})",
    r"established in (\d{4})",
    r"launched in (\d{4})",
    r"company was founded in (\d{4})",
    r"co-founded in (\d{4})",
    r"started the company in (\d{4})",
]

# --- fixed values: reason names and limits ---
CURRENT_HAS_END = "current_role_has_end_date"
END_BEFORE_START = "end_date_before_start_date"
DURATION_MISMATCH = "duration_months_inconsistent_with_dates"
PREDATES_FOUNDING = "career_predates_company_founding"
MULTI_CURRENT = "multiple_current_roles"
OVERLAP_ADJACENT = "overlapping_employment_dates"
EDU_REVERSED = "education_end_before_start"
HISTORY_EXCEEDS = "career_history_exceeds_stated_experience"
SINGLE_ROLE_EXCEEDS = "single_role_exceeds_stated_experience"
EXPERT_ZERO = "expert_skill_zero_duration"
SKILL_OVER_MAX = "skill_duration_exceeds_schema_max_experience"
COMPLETE_BUT_EMPTY = "high_completeness_but_empty_core_fields"
MAX_MONTH_DIFFERENCE = 2
MAX_OVERLAP_DAYS = 60
MAX_SKILL_MONTHS = 600
HISTORY_FACTOR, EXPERIENCE_SLACK = 1.4, 12
MIN_COMPLETENESS, MIN_SUMMARY = 95, 15


def founding_year(description: Column) -> Column:
    """The year in the first founding phrase that matches, else NULL."""
    found = [F.nullif(F.regexp_extract(description, "(?i)" + p, 1), F.lit("")) for p in FOUNDING_YEAR]
    return F.coalesce(*found).cast("int")


def parsed_roles(history: Column) -> Column:
    """The role fields the rules need, with parsed dates."""
    return F.transform(history, lambda h, i: F.struct(
        i.alias("pos"), date_parse_strict(h["start_date"]).alias("s"), date_parse_strict(h["end_date"]).alias("e"),
        F.coalesce(h["is_current"], F.lit(False)).alias("current"), h["duration_months"].alias("months"),
        h["company"].alias("company"), founding_year(h["description"]).alias("founded")))


def role_reasons(role: Column) -> Column:
    """Reasons one role gives on its own, as an array."""
    s, e = role["s"], role["e"]
    wrong_length = F.abs(months_cal(s, e) - role["months"]) > MAX_MONTH_DIFFERENCE
    return F.array_compact(F.array(
        F.when(role["current"] & e.isNotNull(), CURRENT_HAS_END),
        F.when(e < s, END_BEFORE_START).when(wrong_length, DURATION_MISMATCH),
        F.when(F.year(s) < role["founded"], PREDATES_FOUNDING)))


def role_intervals(roles: Column, reference: Column) -> Column:
    """Roles with both ends known, by start date; a current role ends at the reference date."""
    return F.array_sort(F.transform(
        F.filter(roles, lambda r: r["s"].isNotNull() & (r["current"] | r["e"].isNotNull())),
        lambda r: F.struct(r["s"].alias("s"), r["pos"].alias("pos"),
                           F.when(r["current"], reference).otherwise(r["e"]).alias("e"), r["company"].alias("company"))))


def adjacent_overlaps(intervals: str) -> Column:
    """Neighbours of a column of intervals, at different companies, that overlap by more than 60 days.

    The neighbour comes from a second array, not from the first one inside the lambda, where the
    optimizer could put the whole sort.
    """
    following = F.slice(intervals, F.lit(2), F.greatest(F.size(intervals), F.lit(0)))
    pairs = F.arrays_zip(F.col(intervals).alias("a"), following.alias("b"))
    return F.filter(pairs, lambda p: ~p["a"]["company"].eqNullSafe(p["b"]["company"])
                    & (F.datediff(p["a"]["e"], p["b"]["s"]) > MAX_OVERLAP_DAYS))


def _repeat(reason: str, times: Column) -> Column:
    return F.array_repeat(F.lit(reason), F.greatest(F.coalesce(times, F.lit(0)), F.lit(0)))


def _once(reason: str, condition: Column) -> Column:
    return _repeat(reason, F.coalesce(condition, F.lit(False)).cast("int"))


def rules_flag(pool: DataFrame, reference_date: str, keep: tuple[str, ...] = (ID,)) -> DataFrame:
    """(candidate_id, honeypot_flag, hit_count, reasons); reasons in rule order, with repeats."""
    reference = F.lit(reference_date).cast("date")
    parsed = pool.select(
        *keep, F.col("profile.years_of_experience").alias("years"), F.col("profile.headline").alias("headline"),
        F.col("profile.summary").alias("summary"), F.col("signals.profile_completeness_score").alias("completeness"),
        F.coalesce(parsed_roles(F.col("career_history")), F.array().cast(
            "array<struct<pos:int,s:date,e:date,current:boolean,months:double,company:string,founded:int>>")).alias("roles"),
        "education", "skills").withColumn("intervals", role_intervals(F.col("roles"), reference))
    limit = F.col("years") * 12
    total = F.aggregate("roles", F.lit(0.0), lambda a, r: a + F.coalesce(r["months"], F.lit(0.0)))
    skill_reasons = F.flatten(F.transform("skills", lambda s: F.array_compact(F.array(
        F.when((F.lower(s["proficiency"]) == "expert") & (s["duration_months"] <= 1), EXPERT_ZERO),
        F.when(s["duration_months"] > MAX_SKILL_MONTHS, SKILL_OVER_MAX)))))
    no_headline = strip(F.coalesce("headline", F.lit(""))) == ""
    short_summary = F.length(strip(F.coalesce("summary", F.lit("")))) < MIN_SUMMARY
    reasons = F.concat(
        F.flatten(F.transform("roles", role_reasons)),
        _once(MULTI_CURRENT, F.size(F.filter("roles", lambda r: r["current"])) > 1),
        _repeat(OVERLAP_ADJACENT, F.size(adjacent_overlaps("intervals"))),
        _repeat(EDU_REVERSED, F.size(F.filter("education", lambda e: e["end_year"] < e["start_year"]))),
        _once(HISTORY_EXCEEDS, (total > 0) & (total > limit * HISTORY_FACTOR + EXPERIENCE_SLACK)),
        _once(SINGLE_ROLE_EXCEEDS, F.exists("roles", lambda r: F.coalesce(r["months"] > limit + EXPERIENCE_SLACK, F.lit(False)))),
        F.coalesce(skill_reasons, F.array().cast("array<string>")),
        _once(COMPLETE_BUT_EMPTY, (F.col("completeness") >= MIN_COMPLETENESS) & (no_headline | short_summary)),
    )
    return parsed.select(*keep, reasons.alias("reasons")).select(
        *keep, (F.size("reasons") > 0).alias("honeypot_flag"), F.size("reasons").alias("hit_count"), "reasons")


def rule_histogram(flags: DataFrame) -> DataFrame:
    """(reason, hits), most frequent first."""
    return (
        # An outer explode: the plain one adds a filter that would compute the reasons twice.
        flags.select(F.explode_outer("reasons").alias("reason")).filter("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("hits"))
        .orderBy(F.desc("hits"), "reason")
    )


def flagged_share(flags: DataFrame) -> DataFrame:
    """One row: records checked, records flagged, percent flagged."""
    total, flagged = F.count("*"), F.count_if("honeypot_flag")
    return flags.agg(total.alias("checked"), flagged.alias("flagged"),
                     F.round(F.try_divide(flagged * 100.0, total), 2).alias("flagged_percent"))
