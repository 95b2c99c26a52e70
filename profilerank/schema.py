"""The nested profile record.

Every field is nullable. Numbers are doubles because a record may hold 12 or 12.5; a value of
the wrong type reads as NULL and leaves the rest of the record intact.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID = "candidate_id"
ID_PATTERN = r"^CAND_[0-9]{7}$"
CORRUPT = "_corrupt_record"

_S, _D, _B = T.StringType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


PROFILE = _struct(
    headline=_S, summary=_S, location=_S, country=_S, years_of_experience=_D,
    current_title=_S, current_company=_S, current_company_size=_S, current_industry=_S,
)
ROLE = _struct(
    company=_S, title=_S, start_date=_S, end_date=_S, duration_months=_D, is_current=_B,
    industry=_S, company_size=_S, description=_S,
)
EDUCATION = _struct(
    degree=_S, field_of_study=_S, institution=_S, start_year=T.IntegerType(),
    end_year=T.IntegerType(), tier=_S,
)
SKILL = _struct(name=_S, proficiency=_S, duration_months=_D, endorsements=_D)
CERTIFICATION = _struct(name=_S, issuer=_S, year=T.IntegerType())
SALARY = _struct(min=_D, max=_D)
SIGNALS = _struct(
    profile_completeness_score=_D, signup_date=_S, last_active_date=_S, open_to_work_flag=_B,
    profile_views_received_30d=_D, applications_submitted_30d=_D, recruiter_response_rate=_D,
    avg_response_time_hours=_D, skill_assessment_scores=T.MapType(_S, _D), connection_count=_D,
    endorsements_received=_D, notice_period_days=_D, expected_salary_range_inr_lpa=SALARY,
    preferred_work_mode=_S, willing_to_relocate=_B, github_activity_score=_D,
    search_appearance_30d=_D, saved_by_recruiters_30d=_D, interview_completion_rate=_D,
    offer_acceptance_rate=_D, verified_email=_B, verified_phone=_B, linkedin_connected=_B,
)


def pool_schema(signals_field: str = "signals") -> T.StructType:
    """The record schema; ``signals_field`` is the name the activity block has in the files."""
    return T.StructType([
        T.StructField(ID, _S, True),
        T.StructField("profile", PROFILE, True),
        T.StructField("career_history", T.ArrayType(ROLE), True),
        T.StructField("education", T.ArrayType(EDUCATION), True),
        T.StructField("skills", T.ArrayType(SKILL), True),
        T.StructField("certifications", T.ArrayType(CERTIFICATION), True),
        T.StructField(signals_field, SIGNALS, True),
    ])


POOL = pool_schema()
