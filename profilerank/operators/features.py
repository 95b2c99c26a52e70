"""The deterministic feature table: 127 numeric columns per record, all row-local.

Two narrow steps. The first works on the nested arrays (lambda expressions, interpreted) and
lowers them to scalars and text bundles; the second scans the bundles for keywords and combines
scalars inside generated code. Nothing is shuffled; the only value from outside the row is the
reference date, a literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import keywords as K
from ..functions import ordinals as O
from ..functions.dates import date_parse_prefix, days_between
from ..functions.text import current_role, full_text, plain, text_bundle
from ..schema import ID

# --- fixed values: limits and defaults ---
LLM_CUTOFF = "2022-11-01"
RECENT_DAYS = 365
NEVER_ACTIVE = 99999
JUMP_TENURE, JUMP_YEARS, JUMPS_FOR_FLAG = 18, 5, 3
ASSESSMENT_FAMILIES = (
    "retrieval_embeddings", "vector_db_hybrid_search", "evaluation_ranking_metrics", "learning_to_rank_models",
)
AI_FAMILIES = ("retrieval_embeddings", "vector_db_hybrid_search", "learning_to_rank_models", "llm_finetuning")
CERT_FAMILIES = ("retrieval_embeddings", "learning_to_rank_models")

SIGNAL_FEATURES = [
    "profile_completeness_score", "days_on_platform", "days_since_active", "open_to_work_flag",
    "profile_views_received_30d", "applications_submitted_30d", "recruiter_response_rate", "avg_response_time_hours",
    "num_assessments_taken", "assessment_score_mean", "assessment_score_max", "assessment_score_jd_relevant_mean",
    "connection_count", "endorsements_received", "notice_period_days", "expected_salary_min_lpa",
    "expected_salary_max_lpa", "expected_salary_mid_lpa", "expected_salary_width_lpa", "preferred_work_mode_ord",
    "willing_to_relocate", "has_github", "github_activity_score", "search_appearance_30d", "saved_by_recruiters_30d",
    "interview_completion_rate", "has_offer_history", "offer_acceptance_rate", "verified_email", "verified_phone",
    "linkedin_connected", "availability_tilt_score",
]
CAREER_FEATURES = [
    "num_career_entries", "avg_tenure_months", "min_tenure_months", "max_tenure_months", "tenure_stdev_months",
    "avg_company_size_ord", "service_firm_months", "service_firm_month_fraction", "pure_services_career_flag",
    "current_industry_is_tech", "current_industry_is_services", "title_chasing_jump_count", "title_chasing_flag",
    "computed_career_span_years", "years_experience_consistency_gap", "recent_llm_only_experience_flag",
    "has_pre_llm_ml_background", "pure_research_flag", "management_pivot_18mo_plus_flag", "wrong_domain_flag",
]
SKILL_FEATURES = [
    "num_skills", "avg_skill_proficiency", "max_skill_proficiency", "total_skill_endorsements",
    "high_proficiency_low_duration_count", "has_python_skill", "python_proficiency", "python_duration_months",
]
EDUCATION_FEATURES = [
    "num_education_entries", "highest_education_tier_ord", "has_relevant_degree_field", "num_certifications",
    "has_relevant_certification",
]
FIT_FEATURES = [
    "years_of_experience", "experience_band_fit", "location_tier", "current_company_size_ord",
    "current_title_seniority_level", "marketing_nontech_title_flag", "title_skill_mismatch_flag",
]
KEYWORD_FEATURES = [f"{f}_{k}" for f in K.FAMILIES for k in ("narrative_hits", "skills_hits", "inflation_gap")]
FEATURE_COLUMNS = (
    SIGNAL_FEATURES + CAREER_FEATURES + SKILL_FEATURES + EDUCATION_FEATURES + FIT_FEATURES + KEYWORD_FEATURES
    + ["closed_source_only_flag"]
)
CATEGORICAL_COLUMNS = [
    "current_company_size_ord", "preferred_work_mode_ord", "highest_education_tier_ord",
    "current_title_seniority_level", "location_tier",
]


def _int(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def _or(value: Column, default: float) -> Column:
    return F.coalesce(value, F.lit(float(default)))


def _sum(array: Column) -> Column:
    return F.coalesce(F.aggregate(array, F.lit(0.0), lambda a, x: a + x), F.lit(0.0))


def _mean(array: Column, default: float) -> Column:
    return F.when(F.size(array) > 0, _sum(array) / F.size(array)).otherwise(float(default))


def _count(array: Column) -> Column:
    return F.greatest(F.size(array), F.lit(0))


def _role_texts(roles: Column) -> Column:
    """The texts of some roles as one, so far apart that no pattern of the families asked for spans two."""
    return F.coalesce(F.array_join(F.transform(roles, lambda r: r["text"]), "\n;\n"), F.lit(""))


def _patterns(families: tuple[str, ...]) -> list[str]:
    return [p for f in families for p in K.FAMILIES[f]]


def array_stats(array: Column) -> dict[str, Column]:
    """Mean, least, greatest and population deviation of a numeric array; 0 when empty."""
    mean = _mean(array, 0.0)
    # The mean travels as part of the state; inside the lambda it would be computed per element.
    start = F.struct(F.lit(0.0).alias("s"), mean.alias("m"))
    squares = F.aggregate(array, start, lambda a, x: F.struct((a["s"] + (x - a["m"]) * (x - a["m"])).alias("s"), a["m"].alias("m")), lambda a: a["s"])
    spread = F.sqrt(squares / F.size(array))
    return {
        "mean": mean, "min": _or(F.array_min(array), 0), "max": _or(F.array_max(array), 0),
        "stdev": F.when(F.size(array) > 1, spread).otherwise(0.0), "sum": _sum(array),
    }


def availability_score(notice: Column, open_to_work: Column, response: Column, idle_days: Column) -> Column:
    """0 to 10, starting from 5."""
    score = (
        F.when((notice <= 30) & (open_to_work == 1), 2).otherwise(0)
        + F.when(response >= 0.6, 1).otherwise(0)
        + F.when(idle_days <= 30, 1).otherwise(0)
        - F.when(notice > 60, 1).otherwise(0)
        - F.when((idle_days > 180) & (open_to_work == 0) & (response < 0.2), 2).otherwise(0)
    )
    return F.greatest(F.lit(0), F.least(F.lit(10), score + 5))


def _signal_columns(reference: Column) -> dict[str, Column]:
    s = F.col("signals")
    scores = s["skill_assessment_scores"]
    relevant = F.expr(f"map_values(map_filter(signals.skill_assessment_scores, (k, v) -> {K.kw_any_sql('lower(k)', _patterns(ASSESSMENT_FAMILIES))}))")
    salary = s["expected_salary_range_inr_lpa"]
    low, high = _or(salary["min"], 0), _or(salary["max"], 0)
    github, offers = _or(s["github_activity_score"], -1), _or(s["offer_acceptance_rate"], -1)
    numbers = ("profile_completeness_score", "profile_views_received_30d", "applications_submitted_30d",
               "recruiter_response_rate", "avg_response_time_hours", "connection_count", "endorsements_received",
               "notice_period_days", "search_appearance_30d", "saved_by_recruiters_30d", "interview_completion_rate")
    flags = ("open_to_work_flag", "willing_to_relocate", "verified_email", "verified_phone", "linkedin_connected")
    return {
        **{n: _or(s[n], 0) for n in numbers}, **{n: _int(s[n]) for n in flags},
        "days_on_platform": F.coalesce(days_between(reference, date_parse_prefix(s["signup_date"])), F.lit(0)),
        "days_since_active": F.coalesce(days_between(reference, date_parse_prefix(s["last_active_date"])), F.lit(NEVER_ACTIVE)),
        "num_assessments_taken": _count(scores),
        "assessment_score_mean": _mean(F.map_values(scores), 0),
        "assessment_score_max": _or(F.array_max(F.map_values(scores)), 0),
        "assessment_score_jd_relevant_mean": _mean(relevant, 0),
        "expected_salary_min_lpa": low, "expected_salary_max_lpa": high, "expected_salary_mid_lpa": (low + high) / 2,
        "expected_salary_width_lpa": F.greatest(F.lit(0.0), high - low),
        "preferred_work_mode_ord": O.ord_map(s["preferred_work_mode"], O.WORK_MODE, -1),
        "has_github": _int(github >= 0), "github_activity_score": github,
        "has_offer_history": _int(offers >= 0), "offer_acceptance_rate": offers,
    }


def is_service_role(role: Column) -> Column:
    return O.contains_any(F.lower(role["company"]), K.SERVICE_FIRMS) | O.contains_any(
        F.lower(role["industry"]), K.SERVICE_INDUSTRIES)


def dated_roles(history: Column) -> Column:
    """Roles with a start date, oldest first; equal dates keep the order of the record."""
    dated = F.transform(history, lambda h, i: F.struct(
        date_parse_prefix(h["start_date"]).alias("s"), i.alias("pos"),
        _or(h["duration_months"], 0).alias("months"), O.seniority_level(F.lower(plain(h["title"]))).alias("level"),
        F.concat(F.lower(plain(h["description"])), F.lit(" "), F.lower(plain(h["title"]))).alias("text")))
    return F.sort_array(F.filter(dated, lambda r: r["s"].isNotNull()))


def title_jumps(dated: Column, reference: Column) -> Column:
    """Moves of the last five years to a higher title after less than 18 months."""
    since = F.add_months(reference, -12 * JUMP_YEARS)
    moves = F.transform(dated, lambda r, i: F.struct(r.alias("a"), F.get(dated, i + 1).alias("b")))
    return F.coalesce(F.size(F.filter(moves, lambda m: (m["b"]["s"] >= since) & (m["a"]["months"] < JUMP_TENURE)
                                      & (m["b"]["level"] > m["a"]["level"]))), F.lit(0))


def _career_columns(reference: Column) -> dict[str, Column]:
    history = F.col("career_history")
    tenure = array_stats(F.col("_months"))
    service_months = _sum(F.transform(F.filter(history, is_service_role), lambda h: _or(h["duration_months"], 0)))
    sizes = F.filter(F.transform(history, lambda h: O.ord_map(h["company_size"], O.COMPANY_SIZE, -1).cast("double")), lambda x: x >= 0)
    industry = F.lower(plain(F.col("profile.current_industry")))
    span = F.when(F.size("_dated") > 0, days_between(reference, F.get("_dated", 0)["s"]) / 365.25).otherwise(0.0)
    recent = F.filter("_dated", lambda r: F.datediff(reference, r["s"]) <= RECENT_DAYS)
    early = F.filter("_dated", lambda r: r["s"] < F.lit(LLM_CUTOFF).cast("date"))
    return {
        "num_career_entries": _count(history), "avg_tenure_months": tenure["mean"], "min_tenure_months": tenure["min"],
        "max_tenure_months": tenure["max"], "tenure_stdev_months": tenure["stdev"],
        "avg_company_size_ord": _mean(sizes, -1), "service_firm_months": service_months,
        "service_firm_month_fraction": F.coalesce(F.try_divide(service_months, tenure["sum"]), F.lit(0.0)),
        "pure_services_career_flag": _int((F.size(history) > 0) & F.forall(history, is_service_role)),
        "current_industry_is_tech": _int(O.contains_any(industry, K.TECH_INDUSTRIES)),
        "current_industry_is_services": _int(O.contains_any(industry, K.SERVICE_INDUSTRIES)),
        "title_chasing_jump_count": F.greatest(title_jumps(F.col("_dated"), reference), F.lit(0)),
        "computed_career_span_years": span, "_recent_text": _role_texts(recent), "_early_text": _role_texts(early),
        "_current_months": _or(current_role(history)["duration_months"], 0),
    }


def _skill_columns() -> dict[str, Column]:
    skills = F.col("skills")
    levels = F.transform(skills, lambda s: O.ord_map(s["proficiency"], O.PROFICIENCY, 0).cast("double"))
    python = F.get(F.filter(skills, lambda s: F.lower(s["name"]) == "python"), 0)
    doubtful = F.filter(skills, lambda s: (O.ord_map(s["proficiency"], O.PROFICIENCY, 0) >= 3) & (_or(s["duration_months"], 0) < 6))
    return {
        "num_skills": _count(skills), "avg_skill_proficiency": _mean(levels, 0),
        "max_skill_proficiency": _or(F.array_max(levels), 0),
        "total_skill_endorsements": _sum(F.transform(skills, lambda s: _or(s["endorsements"], 0))),
        "high_proficiency_low_duration_count": _count(doubtful), "has_python_skill": _int(python.isNotNull()),
        "python_proficiency": F.when(python.isNotNull(), O.ord_map(python["proficiency"], O.PROFICIENCY, 0)).otherwise(0),
        "python_duration_months": _or(python["duration_months"], 0),
    }


def _education_columns() -> dict[str, Column]:
    education, certificates = F.col("education"), F.col("certifications")
    tiers = F.transform(education, lambda e: O.ord_map(e["tier"], O.EDUCATION_TIER, 0))
    certs = F.coalesce(F.array_join(F.transform(certificates, lambda c: F.concat(
        F.lower(plain(c["name"])), F.lit(" "), F.lower(plain(c["issuer"])))), " "), F.lit(""))
    return {
        "num_education_entries": _count(education),
        "highest_education_tier_ord": F.coalesce(F.array_max(tiers), F.lit(0)),
        "has_relevant_degree_field": _int(F.exists(education, lambda e: O.contains_any(F.lower(e["field_of_study"]), K.DEGREE_FIELDS))),
        "num_certifications": _count(certificates), "_certs": certs,
    }


def _fit_columns() -> dict[str, Column]:
    p = F.col("profile")
    years = _or(p["years_of_experience"], 0)
    return {
        "years_of_experience": years, "experience_band_fit": O.experience_fit(years),
        "location_tier": O.location_tier(p["location"], p["country"]),
        "current_company_size_ord": O.ord_map(p["current_company_size"], O.COMPANY_SIZE, -1),
        "_title": F.lower(plain(p["current_title"])),
    }


def _nested_step(pool: DataFrame, reference: Column) -> DataFrame:
    """Scalars and text bundles out of the nested record."""
    history = F.col("career_history")
    prepared = pool.withColumns({
        "_dated": dated_roles(history),
        "_months": F.transform(history, lambda h: _or(h["duration_months"], 0)),
    })
    columns = {
        **_signal_columns(reference), **_career_columns(reference), **_skill_columns(), **_education_columns(),
        **_fit_columns(), **text_bundle(F.col("profile"), history, F.col("skills")),
    }
    every = _patterns(tuple(K.FAMILIES))
    joined = prepared.select(ID, *[c.alias(n) for n, c in columns.items()]).withColumns({
        "full_text": full_text(*[F.col(n) for n in ("skills_text", "narrative_text", "titles_text", "industries_text")]),
        "titles_industries": F.concat_ws(" ", "titles_text", "industries_text")})
    tokens = joined.withColumns({
        "narrative_tokens": K.token_hits("narrative_text", every), "skills_tokens": K.token_hits("skills_text", every),
        "titles_tokens": K.token_hits("titles_industries", every)})
    return tokens.withColumn("full_tokens", F.concat("narrative_tokens", "skills_tokens", "titles_tokens"))


def _keyword_step(step: DataFrame) -> DataFrame:
    """Keyword hits per family and the flags that rest on them."""
    fam, c = K.FAMILIES, F.col
    scanned = step.withColumns({
        **{f"{f}_narrative_hits": K.kw_hits("narrative_text", p, "narrative_tokens") for f, p in fam.items()},
        **{f"{f}_skills_hits": K.kw_hits("skills_text", p, "skills_tokens") for f, p in fam.items()},
        "_recent_llm": K.kw_any("_recent_text", fam["llm_only_recent"]),
        "has_pre_llm_ml_background": _int(K.kw_any("_early_text", fam["pre_llm_ml_background"])),
        "_research": K.kw_any("titles_industries", fam["research_only"], "titles_tokens"),
        "_cv": K.kw_any("full_text", fam["cv_speech_robotics_domain"], "full_tokens"),
        "_nlp": K.kw_any("full_text", fam["nlp_ir_domain"], "full_tokens"),
        "_retrieval": K.kw_any("full_text", fam["retrieval_embeddings"], "full_tokens"),
        "_open_source": K.kw_any("full_text", fam["open_source_validation"], "full_tokens"),
        "_manager": K.kw_any("_title", fam["management_architect_titles"]),
        "marketing_nontech_title_flag": _int(K.kw_any("_title", fam["marketing_nontech_titles"])),
        "current_title_seniority_level": O.seniority_level(c("_title")),
        "has_relevant_certification": _int(K.kw_any("_certs", _patterns(CERT_FAMILIES)) | O.contains_any(c("_certs"), K.CERT_VENDORS)),
    })
    ai_skills = sum((c(f"{f}_skills_hits") for f in AI_FAMILIES), F.lit(0))
    ai_narrative = sum((c(f"{f}_narrative_hits") for f in AI_FAMILIES), F.lit(0))
    return scanned.withColumns({
        **{f"{f}_inflation_gap": K.inflation_gap(c(f"{f}_skills_hits"), c(f"{f}_narrative_hits")) for f in fam},
        "availability_tilt_score": availability_score(
            c("notice_period_days"), c("open_to_work_flag"), c("recruiter_response_rate"), c("days_since_active")),
        "title_chasing_flag": _int(c("title_chasing_jump_count") >= JUMPS_FOR_FLAG),
        "years_experience_consistency_gap": F.abs(c("years_of_experience") - c("computed_career_span_years")),
        "recent_llm_only_experience_flag": _int(c("_recent_llm") & (c("has_pre_llm_ml_background") == 0)),
        "pure_research_flag": _int(c("_research") & (c("production_deployment_narrative_hits") == 0)),
        "management_pivot_18mo_plus_flag": _int(c("_manager") & (c("_current_months") >= 18)),
        "wrong_domain_flag": _int(c("_cv") & ~c("_nlp") & ~c("_retrieval")),
        "title_skill_mismatch_flag": _int((c("marketing_nontech_title_flag") == 1) & (ai_skills >= 3) & (ai_narrative == 0)),
        "closed_source_only_flag": _int((c("years_of_experience") >= 5) & (c("has_github") == 0) & ~c("_open_source")),
    })


def feat_all(pool: DataFrame, reference_date: str) -> DataFrame:
    """candidate_id and the 127 feature columns."""
    return _keyword_step(_nested_step(pool, F.lit(reference_date).cast("date"))).select(ID, *FEATURE_COLUMNS)


def feat_block(pool: DataFrame, reference_date: str, columns: list[str]) -> DataFrame:
    """candidate_id and some feature columns; the optimizer drops what they do not need."""
    return feat_all(pool, reference_date).select(ID, *columns)


def kw_family_matrix(texts: DataFrame, families: dict[str, list[str]], narrative: str, skills: str, keep: tuple[str, ...]) -> DataFrame:
    """Three columns per family over any table with a narrative and a skills text (lower case)."""
    every = [p for patterns in families.values() for p in patterns]
    split = texts.select(*dict.fromkeys((*keep, narrative, skills))).withColumns({
        "_n": K.token_hits(narrative, every), "_s": K.token_hits(skills, every)})
    hits = split.select(
        *keep,
        *[K.kw_hits(narrative, p, "_n").alias(f"{f}_narrative_hits") for f, p in families.items()],
        *[K.kw_hits(skills, p, "_s").alias(f"{f}_skills_hits") for f, p in families.items()])
    return hits.withColumns({
        f"{f}_inflation_gap": K.inflation_gap(F.col(f"{f}_skills_hits"), F.col(f"{f}_narrative_hits")) for f in families})
