"""The feature table on hand-made records."""

import pytest
from pyspark.sql import functions as F

from profilerank.operators import documents, features

NOW = "2024-02-29"


def row_of(pool):
    return features.feat_all(pool, NOW).first().asDict()


def test_columns():
    assert len(features.FEATURE_COLUMNS) == 127 and len(set(features.FEATURE_COLUMNS)) == 127


def test_empty_record(records):
    row = row_of(records({}))
    assert row["days_since_active"] == 99999 and row["days_on_platform"] == 0
    assert row["preferred_work_mode_ord"] == -1 and row["github_activity_score"] == -1 and row["avg_company_size_ord"] == -1
    assert row["pure_services_career_flag"] == 0 and row["location_tier"] == -1 and row["current_title_seniority_level"] == 2
    assert row["availability_tilt_score"] == 3
    assert all(value is not None for value in row.values())


def test_signals(records):
    row = row_of(records({"signals": {
        "open_to_work_flag": True, "notice_period_days": 30, "recruiter_response_rate": 0.6, "last_active_date": "2024-01-30",
        "signup_date": "2024-01-01T08:00", "skill_assessment_scores": {"RAG design": 80, "Excel": 20, "NDCG": 60},
        "expected_salary_range_inr_lpa": {"min": 10, "max": 30}, "preferred_work_mode": "flexible", "github_activity_score": 0, "offer_acceptance_rate": -1}}))
    assert (row["days_since_active"], row["days_on_platform"], row["availability_tilt_score"]) == (30, 59, 9)
    assert (row["num_assessments_taken"], row["assessment_score_max"], row["assessment_score_jd_relevant_mean"]) == (3, 80.0, 70.0)
    assert (row["expected_salary_mid_lpa"], row["expected_salary_width_lpa"], row["preferred_work_mode_ord"]) == (20.0, 20.0, 3)
    assert (row["has_github"], row["has_offer_history"]) == (1, 0)


def test_availability_floor(records):
    row = row_of(records({"signals": {"notice_period_days": 61, "last_active_date": "2023-01-01"}}))
    assert row["availability_tilt_score"] == 2


def test_career(records):
    def role(start, months, title, **more):
        return {"start_date": start, "duration_months": months, "title": title, **more}

    row = row_of(records({
        "profile": {"current_title": "Engineering Manager", "current_industry": "Retail", "years_of_experience": 6},
        "career_history": [
            role("2023-06-01", 18, "Director", is_current=True, company="TCS", company_size="10001+", description="langchain work"),
            role("2019-03-01", 6, "Junior Engineer", industry="Consulting", company_size="1-10"),
            role("2019-09-01", 12, "Engineer", company="Acme", company_size="unknown", description="machine learning"),
            role("2021-01-01", 17, "Senior Engineer", company="Acme"),
            role("2022-12-01", None, "Staff Engineer", company="Acme")]}))
    assert row["title_chasing_jump_count"] == 4 and row["title_chasing_flag"] == 1
    assert (row["num_career_entries"], row["avg_tenure_months"], row["min_tenure_months"], row["max_tenure_months"]) == (5, 10.6, 0.0, 18.0)
    assert row["tenure_stdev_months"] == pytest.approx(6.8, abs=0.01)
    assert row["avg_company_size_ord"] == 3.5 and row["service_firm_months"] == 24.0
    assert row["service_firm_month_fraction"] == pytest.approx(24 / 53) and row["pure_services_career_flag"] == 0
    assert row["current_industry_is_tech"] == 1  # "ai" is in "retail"
    assert row["computed_career_span_years"] == pytest.approx(1826 / 365.25)
    assert row["has_pre_llm_ml_background"] == 1 and row["recent_llm_only_experience_flag"] == 0
    assert row["management_pivot_18mo_plus_flag"] == 1


def test_recent_llm_only(records):
    row = row_of(records({"career_history": [{"start_date": "2023-03-01", "title": "LLM engineer"}]}))
    assert (row["recent_llm_only_experience_flag"], row["has_pre_llm_ml_background"]) == (1, 0)
    row = row_of(records({"career_history": [{"start_date": "2023-02-28", "title": "LLM engineer"}]}))
    assert row["recent_llm_only_experience_flag"] == 0


def test_skills_and_education(records):
    row = row_of(records({
        "skills": [{"name": "PYTHON", "proficiency": "expert", "duration_months": 5, "endorsements": 2}, {"name": "Python", "proficiency": "beginner", "duration_months": 9},
                   {"name": "Go", "proficiency": "Expert"}],
        "education": [{"tier": "tier_3", "field_of_study": "Applied Mathematics"}, {"tier": "odd"}],
        "certifications": [{"name": "Vector Search", "issuer": "X"}]}))
    assert (row["num_skills"], row["max_skill_proficiency"], row["total_skill_endorsements"]) == (3, 4.0, 2.0)
    assert row["avg_skill_proficiency"] == pytest.approx(5 / 3) and row["high_proficiency_low_duration_count"] == 1
    assert (row["has_python_skill"], row["python_proficiency"], row["python_duration_months"]) == (1, 4, 5.0)
    assert (row["num_education_entries"], row["highest_education_tier_ord"], row["has_relevant_degree_field"], row["has_relevant_certification"]) == (2, 2, 1, 1)


def test_keywords_and_flags(records):
    row = row_of(records({
        "profile": {"current_title": "Marketing Manager", "headline": "Growth", "years_of_experience": 5},
        "skills": [{"name": n} for n in ("RAG", "FAISS", "LoRA", "NDCG")]}))
    assert row["retrieval_embeddings_skills_hits"] == 1 and row["retrieval_embeddings_inflation_gap"] == 1
    assert row["llm_finetuning_skills_hits"] == 1  # the other pattern wants "lockra"
    assert (row["marketing_nontech_title_flag"], row["title_skill_mismatch_flag"], row["closed_source_only_flag"]) == (1, 1, 1)


def test_wrong_domain_and_research(records):
    row = row_of(records({"profile": {"summary": "computer vision on lidar", "current_title": "Postdoc"}}))
    assert (row["wrong_domain_flag"], row["pure_research_flag"]) == (1, 1)
    row = row_of(records({"profile": {"summary": "computer vision and nlp in production", "current_title": "Postdoc"}}))
    assert (row["wrong_domain_flag"], row["pure_research_flag"]) == (0, 0)


def test_no_shuffle(records):
    plan = features.feat_all(records({}), NOW)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_documents(records):
    pool = records({
        "profile": {"headline": "H", "years_of_experience": 5.5, "location": "Pune"},
        "career_history": [{"title": f"T{i}", "duration_months": 3, "end_date": "" if i else "2020-01-01"} for i in range(8)],
        "skills": [{"name": "Python", "proficiency": "expert"}], "signals": {"open_to_work_flag": True, "skill_assessment_scores": {"Python": 91.5}}})
    short, full = documents.doc_compact(pool).first()[1], documents.doc_full(pool).first()[1]
    assert short.startswith("[headline] H\n[experience] 5.5 years\n[place] Pune\n[roles]\n* T0 | 3 months\n* T1 | 3 months")
    assert "T7" in short and "T7" in full  # no section is cut unless a limit is given
    limited = documents.doc_compact(pool, max_roles=6).first()[1]
    assert "T5" in limited and "T6" not in limited
    assert "[schools]" not in short and "[certificates]" not in full and "[position]" not in short
    assert "[skills]\n* Python | expert\n" in short and short.endswith("[terms] open true | pay unspecified")
    assert "* Python | expert | 91.5 points" in full
    assert "* T0 | ? to 2020-01-01 | 3 months" in full and "* T1 | ? to now | 3 months" in full


def test_raw_facts(records):
    facts = documents.raw_facts(records({
        "skills": [{"name": n, "proficiency": p, "endorsements": e} for n, p, e in
                   (("a", "beginner", 9), ("b", "EXPERT", 1), ("c", "expert", 1), (None, "expert", 5), ("d", "advanced", None))],
        "career_history": [{"is_current": False, "duration_months": 1}, {"is_current": True, "duration_months": 2}, {"is_current": True, "duration_months": 3}]})).first()
    assert facts["top_skill_names"] == ["b", "c"] and facts["current_role_tenure_months"] == 2.0 and facts["education_degree"] is None


def test_kw_matrix_on_any_table(spark):
    df = spark.createDataFrame([(1, "rag rag", "rag faiss")], "k int, n string, s string")
    out = features.kw_family_matrix(df, {"x": [r"\brag\b", r"\bfaiss\b"]}, "n", "s", ("k",)).select(F.expr("x_narrative_hits"), "x_skills_hits", "x_inflation_gap")
    assert tuple(out.first()) == (1, 2, 1)
