"""Record to text, as DataFrame operators. All are row-local: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from ..functions.numbers import number_text
from ..schema import ID
from .integrity import Thresholds, integrity_checks, integrity_metrics

_SECTIONS = ("profile", "career_history", "education", "skills", "certifications", "signals")


def _sections() -> list[Column]:
    return [F.col(name) for name in _SECTIONS]


def doc_compact(pool: DataFrame, **limits: int) -> DataFrame:
    """(candidate_id, doc_text): the record as labelled lines, all sections whole unless limits are given."""
    return pool.select(ID, T.record_text(*_sections(), **limits).alias("doc_text"))


def doc_full(pool: DataFrame) -> DataFrame:
    """(candidate_id, doc_text) with role dates, assessment scores and activity as well."""
    return pool.select(ID, T.record_text(*_sections(), detailed=True).alias("doc_text"))


def text_bundle(pool: DataFrame) -> DataFrame:
    """The record's id and its six lower-cased text bundles."""
    bundles = T.text_bundle(F.col("profile"), F.col("career_history"), F.col("skills"))
    return pool.select(ID, *[c.alias(n) for n, c in bundles.items()]).withColumn(
        "full_text", T.full_text(*[F.col(n) for n in ("skills_text", "narrative_text", "titles_text", "industries_text")])
    )


def raw_facts(pool: DataFrame) -> DataFrame:
    """The facts a sentence about one record may state."""
    p, s = F.col("profile"), F.col("signals")
    school = F.get(F.col("education"), 0)
    from_profile = ("years_of_experience", "location", "country", "current_title", "current_company",
                    "current_industry", "headline")
    from_signals = ("notice_period_days", "recruiter_response_rate", "last_active_date", "open_to_work_flag",
                    "willing_to_relocate", "preferred_work_mode", "github_activity_score")
    return pool.select(
        ID, *[p[f].alias(f) for f in from_profile], *[s[f].alias(f) for f in from_signals],
        T.top_skill_names(F.col("skills")).alias("top_skill_names"),
        T.current_role(F.col("career_history"))["duration_months"].alias("current_role_tenure_months"),
        school["degree"].alias("education_degree"), school["field_of_study"].alias("education_field"),
        school["institution"].alias("education_institution"),
    )


def analysis_block(pool: DataFrame, reference_date: str, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """(candidate_id, analysis): the integrity numbers and the outcome of every check as text."""
    checked = integrity_checks(integrity_metrics(pool, reference_date, keep=(ID,), detail=True), thresholds)

    def verdict(name: str) -> Column:
        return F.when(F.col(name), "TRUE").otherwise("FALSE")

    def line(needed: Column | None, *parts: Column | str) -> Column:
        text = F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
        return text if needed is None else F.when(needed, text)

    n = lambda c: number_text(F.col(c))
    return checked.select(ID, F.concat_ws(
        "\n",
        line(None, "stated years of experience: ", n("stated_years")),
        line(None, "sum of role durations: ", n("total_months"), " months (", number_text(F.round(F.col("total_months") / 12, 2)), " years)"),
        line(F.col("max_role_months").isNotNull(), "longest role: ", number_text(F.round(F.col("max_role_months") / 12, 2)),
             " years (", n("max_role_months"), " months), ", F.col("max_role_title")),
        line(F.col("single_role_excess_checked").isNotNull(), "longest role minus stated years: ", n("single_role_excess_checked"),
             f" years, limit {thresholds.single_role_tolerance_years:.1f} -> ", verdict("single_role_exceeds")),
        line(F.col("span_months").isNotNull(), "career span: ", number_text(F.round(F.col("span_months") / 12, 2)), " years (",
             n("span_months"), " months), ", F.col("earliest_start").cast("string"), " to ", F.col("latest_end").cast("string")),
        line(F.col("gap_checked").isNotNull(), "stated years minus career span: ", n("gap_checked"),
             f" years, limit {thresholds.span_gap_tolerance_years:.1f} -> ", verdict("gap_exceeds")),
        line(None, "expert skills never used: ", n("zero_expert_count"),
             f", limit {thresholds.zero_duration_expert_min_count} -> ", verdict("zero_expert_exceeds"), ": ",
             F.when(F.size("zero_expert_skills") > 0, F.array_join("zero_expert_skills", ", ")).otherwise("none")),
        line(None, "education ending before it starts -> ", verdict("edu_invalid"), ": ", n("edu_invalid_count")),
        line(None, f"roles overlapping {thresholds.min_overlap_months}+ months -> ", verdict("overlap_exceeds"), ": ",
             F.when(F.size("overlap_pairs") > 0, F.array_join(F.transform("overlap_pairs", lambda o: F.concat(
                 o["role_a"], F.lit(" / "), o["role_b"], F.lit(": "), o["months"].cast("string"), F.lit(" months"))), "; ")
             ).otherwise("none")),
    ).alias("analysis"))
