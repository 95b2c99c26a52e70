"""Ordinal codes and small scores of single profile values."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# --- fixed values: ordinal tables ---
COMPANY_SIZE = {
    "1-10": 0, "11-50": 1, "51-200": 2, "201-500": 3,
    "501-1000": 4, "1001-5000": 5, "5001-10000": 6, "10001+": 7,
}
PROFICIENCY = {"beginner": 1, "intermediate": 2, "advanced": 3, "expert": 4}
EDUCATION_TIER = {"tier_1": 4, "tier_2": 3, "tier_3": 2, "tier_4": 1, "unknown": 0}
WORK_MODE = {"remote": 0, "hybrid": 1, "onsite": 2, "flexible": 3}

# --- fixed values: seniority level of a title, by level ---
SENIORITY = {
    1: [r"\bintern\b", r"\bjunior\b", r"\bassociate\b", r"\btrainee\b"],
    3: [r"\bsenior\b", r"\bsr\.?\b"],
    4: [r"\bstaff\b", r"\blead\b", r"\bprincipal\b"],
    5: [r"\barchitect\b", r"\bdirector\b", r"\bhead of\b", r"\bvp\b", r"\bmanager\b", r"\bengineering manager\b"],
}
SENIORITY_DEFAULT = 2

# --- fixed values: city groups ---
CITIES = {
    3: ["pune", "noida"],
    2: ["hyderabad", "mumbai", "delhi", "gurgaon", "gurugram", "ncr", "delhi ncr", "new delhi"],
    1: ["bangalore", "bengaluru", "chennai", "kolkata"],
}

# --- fixed values: last rank of each relevance grade ---
GRADE_LIMITS = {6: 5, 5: 10, 4: 25, 3: 50, 2: 150, 1: 1000}
MAX_GRADE = 6


def ord_map(value: Column, table: dict[str, int], default: int) -> Column:
    """The code of ``value`` in ``table``, or ``default``."""
    pairs = F.expr("map(" + ", ".join(f"'{k}', {v}" for k, v in table.items()) + ")")
    return F.coalesce(F.try_element_at(pairs, F.coalesce(value, F.lit(""))), F.lit(default))


def contains_any(text: Column, words: list[str]) -> Column:
    """Whether any of the substrings occurs; false for NULL."""
    return F.coalesce(text.rlike("|".join(re.escape(w) for w in words)), F.lit(False))


def seniority_level(title: Column) -> Column:
    """The highest level whose words occur in the lower-cased title."""
    levels = [F.when(title.rlike("|".join(words)), F.lit(level)) for level, words in SENIORITY.items()]
    return F.coalesce(F.greatest(*levels), F.lit(SENIORITY_DEFAULT))


def location_tier(location: Column, country: Column) -> Column:
    """3, 2 or 1 by city, 0 for the rest of the home country, -1 elsewhere."""
    place, land = F.lower(location), F.lower(country)
    tier = F.when(contains_any(place, CITIES[3]), 3)
    for level in (2, 1):
        tier = tier.when(contains_any(place, CITIES[level]), level)
    return tier.when(land.contains("india") | (land == "in"), 0).otherwise(-1)


def experience_fit(years: Column) -> Column:
    """1 inside the 5 to 9 year band, falling linearly to 0 over 5 years below and 10 above."""
    below = 1.0 - (5 - years) / 5.0
    above = 1.0 - (years - 9) / 10.0
    return (
        F.when(years.isNull(), F.lit(0.0))
        .when(years.between(5, 9), F.lit(1.0))
        .otherwise(F.greatest(F.lit(0.0), F.when(years < 5, below).otherwise(above)))
    )


def rank_to_grade(rank: Column) -> Column:
    """Relevance grade of a rank: the first limit the rank does not exceed decides."""
    grade = None
    for value, limit in GRADE_LIMITS.items():
        grade = F.when(rank <= limit, value) if grade is None else grade.when(rank <= limit, value)
    return grade.otherwise(0)


def label_gain(grade: Column) -> Column:
    """2^grade - 1, with the grade brought into the known range."""
    return F.pow(F.lit(2.0), F.least(F.greatest(grade, F.lit(0)), F.lit(MAX_GRADE))) - 1
