"""Reading JSON answers of an external scorer: extraction and validation, never trusting a value."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import clamp, half_even
from .text import strip

# --- fixed values: greatest value of each subscore, and the caps of the total ---
SUBSCORES = {
    "retrieval_score": 30, "evaluation_score": 20, "applied_ml_score": 25, "credibility_score": 15, "bonus_score": 10,
}
TOTAL_CAP, DISQUALIFIED_CAP = 100, 20

# --- fixed values: categories of a positive verdict ---
CATEGORIES = [
    "CAREER_SPAN_EXCEEDS_EXPERIENCE",
    "SINGLE_ROLE_EXCEEDS_EXPERIENCE",
    "ZERO_DURATION_EXPERT_SKILL",
    "INVALID_EDUCATION_DATES",
    "OVERLAPPING_FULL_TIME_ROLES",
    "OTHER_LOGICAL_IMPOSSIBILITY",
]

THINK_START, THINK_END = "<think>", "</think>"


def json_extract_object(raw: Column) -> Column:
    """From the first ``{`` to the last ``}``, after the thinking part and without code fences."""
    thought = raw.contains(THINK_START) & raw.contains(THINK_END)
    answer = F.when(thought, F.substring(raw, F.instr(raw, THINK_END) + len(THINK_END), F.length(raw))).otherwise(raw)
    bare = F.replace(F.replace(answer, F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))
    return F.nullif(F.regexp_extract(bare, r"(?s)\{.*\}", 0), F.lit(""))


def parse_object(text: Column, fields: str) -> Column:
    """The object as a struct, NULL when the text is not exactly one JSON object.

    The reader stops after the first value, so the text is read as the only element of a list.
    """
    read = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<struct<{fields}>>", {"allowSingleQuotes": "false"})
    return F.when(F.size(read) == 1, read[0])


def score_total(subscores: list[Column], disqualified: Column) -> Column:
    """Sum of the subscores, capped lower for disqualified rows."""
    total = sum(subscores[1:], subscores[0])
    return F.least(total, F.when(disqualified, DISQUALIFIED_CAP).otherwise(TOTAL_CAP))


SCORE_FIELDS = ", ".join(f"{n} double" for n in SUBSCORES) + (
    ", hard_disqualifier boolean, disqualifier_reason string, brief_rationale string")
VERDICT_FIELDS = "is_honeypot boolean, violation_category string, evidence string, brief_rationale string"


def score_validate(row: Column, disqualifier_text: Column) -> Column:
    """A struct of clamped subscores and a recomputed total, or NULL for an unusable answer.

    ``row`` is the object read with SCORE_FIELDS and ``disqualifier_text`` the raw text of its
    disqualifier. A missing or non-numeric subscore, or a disqualifier that is there but no boolean,
    makes the answer unusable.
    """
    usable = row.isNotNull() & (row["hard_disqualifier"].isNotNull() | disqualifier_text.isNull())
    for name in SUBSCORES:
        usable = usable & row[name].isNotNull()
    scores = {n: clamp(half_even(row[n]), 0, top).cast("int") for n, top in SUBSCORES.items()}
    out = F.coalesce(row["hard_disqualifier"], F.lit(False))
    reason = F.when(F.coalesce(row["disqualifier_reason"], F.lit("")) != "", strip(row["disqualifier_reason"]))
    return F.when(usable, F.struct(
        *[c.alias(n) for n, c in scores.items()], out.alias("hard_disqualifier"), reason.alias("disqualifier_reason"),
        strip(F.coalesce(row["brief_rationale"], F.lit(""))).alias("brief_rationale"),
        score_total(list(scores.values()), out).cast("int").alias("total_score")))


def verdict_validate(row: Column) -> Column:
    """A struct of the verdict, or NULL. A positive one needs a known category and evidence.

    ``row`` is the object read with VERDICT_FIELDS.
    """
    evidence = strip(row["evidence"])
    grounded = row["violation_category"].isin(*CATEGORIES) & (evidence != "")
    positive = row["is_honeypot"]
    usable = row.isNotNull() & positive.isNotNull() & (~positive | F.coalesce(grounded, F.lit(False)))
    return F.when(usable, F.struct(
        positive.alias("is_honeypot"), F.when(positive, row["violation_category"]).alias("violation_category"),
        F.when(positive, evidence).alias("evidence"),
        strip(F.coalesce(row["brief_rationale"], F.lit(""))).alias("brief_rationale")))
