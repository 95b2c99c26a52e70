"""Registered queries over the nested pool: texts, keywords, rules, metrics, features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import dates as D
from ..functions import keywords as K
from ..functions import ordinals as O
from ..functions import text as TX
from ..functions.numbers import number_text
from ..operators import calibrate, documents, features, integrity, rules
from ..schema import ID
from ..session import spread
from .fixture import pool, table
from .registry import register
from .sql import (
    BUNDLES, DOC_ID, METRICS, PAIRS, REF, ROLES, any_hit, any_word, cal, codes, dprefix, dstrict, family_columns, fold, hits,
    num, over_pool, strip, whole,
)

_REFERENCE: dict[tuple[str, str], str] = {}


def reference(spark: SparkSession, sf: str) -> str:
    """The pool's reference date, read once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _REFERENCE:
        _REFERENCE[key] = calibrate.reference_date(pool(spark, sf))
    return _REFERENCE[key]


# --- record to text ---

_RANGE = (
    "CASE WHEN signals.salary IS NULL THEN 'unspecified' ELSE " + num("signals.salary.lo") + " || '-' || " + num("signals.salary.hi") + " || ' LPA' END"
)


def _amount(x: str, after: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN {num(x)} || '{after}' END"


def _line(label: str, *parts: str) -> str:
    said = f"concat_ws(' | ', {', '.join(parts)})"
    return f"CASE WHEN {said} <> '' THEN '[{label}] ' || {said} END"


def _list(label: str, array: str, *parts: str, limit: int | None = None) -> str:
    kept = f"{array}[1:{limit}]" if limit else array
    lines = f"array_to_string(list_transform({kept}, lambda x: concat_ws(' | ', {', '.join(parts)})), chr(10) || '* ')"
    return f"CASE WHEN len({array}) > 0 THEN '[{label}]' || chr(10) || '* ' || {lines} END"


_SPAN = "coalesce(x.start_date, '?') || ' to ' || coalesce(nullif(x.end_date, ''), 'now')"
_ASSESSED = "list_filter(signals.scores, lambda y: y.name = x.name)[1].score"


def _record_sql(detailed: bool, roles: int | None = None, schools: int | None = None, skills: int | None = None, certificates: int | None = None) -> str:
    span = [_SPAN] if detailed else []
    more = _amount(_ASSESSED, " points") if detailed else _amount("x.endorsements", " endorsements")
    last = ["'seen ' || signals.last_active_date", _amount("signals.recruiter_response_rate", " of messages answered")] if detailed else [f"'pay ' || {_RANGE}"]
    parts = [
        _line("headline", "profile.headline"),
        _line("position", "profile.current_title", "profile.current_company", "profile.current_company_size || ' people'", "profile.current_industry"),
        _line("experience", _amount("profile.years_of_experience", " years")),
        _line("place", "profile.location", "profile.country"),
        _line("summary", "profile.summary"),
        _list("roles", "career_history", "x.title", "x.company", "x.industry", "x.company_size || ' people'", *span,
              _amount("x.duration_months", " months"), "x.description", limit=roles),
        _list("schools", "education", "x.degree", "x.field_of_study", "x.institution", "'from ' || x.start_year", "'until ' || x.end_year", limit=schools),
        _list("skills", "skills", "x.name", "x.proficiency", _amount("x.duration_months", " months"), more, limit=skills),
        _list("certificates", "certifications", "x.name", "x.issuer", "x.year::VARCHAR", limit=certificates),
        _line("terms", "'open ' || signals.open_to_work_flag", "signals.preferred_work_mode", "'moves ' || signals.willing_to_relocate",
              _amount("signals.notice_period_days", " days of notice"), *last),
    ]
    return over_pool(f"SELECT candidate_id, concat_ws(chr(10), {', '.join(parts)}) AS doc_text FROM pool")


@register("doc_compact", _record_sql(False))
def doc_compact(spark: SparkSession, sf: str) -> DataFrame:
    return documents.doc_compact(pool(spark, sf))


@register("doc_compact_limited", _record_sql(False, 6, 4, 25, 10))
def doc_compact_limited(spark: SparkSession, sf: str) -> DataFrame:
    """The limits are the feature of this query: a text of bounded length."""
    return documents.doc_compact(pool(spark, sf), max_roles=6, max_education=4, max_skills=25, max_certifications=10)


@register("doc_full", _record_sql(True))
def doc_full(spark: SparkSession, sf: str) -> DataFrame:
    return documents.doc_full(pool(spark, sf))


@register("fmt_range", over_pool(f"SELECT candidate_id, {_RANGE} AS salary FROM pool"))
def fmt_range(spark: SparkSession, sf: str) -> DataFrame:
    return pool(spark, sf).select(ID, TX.fmt_range(F.col("signals.expected_salary_range_inr_lpa")).alias("salary"))


@register("text_bundle", over_pool(BUNDLES + " SELECT * FROM texts"))
def text_bundle(spark: SparkSession, sf: str) -> DataFrame:
    return documents.text_bundle(pool(spark, sf))


_TOP_SKILLS = """(SELECT string_agg(x.name, ';' ORDER BY r) FROM (
   SELECT x, row_number() OVER (ORDER BY CASE lower(x.proficiency) WHEN 'expert' THEN 4 WHEN 'advanced' THEN 3 WHEN 'intermediate' THEN 2 WHEN 'beginner' THEN 1 ELSE 0 END DESC,
                                coalesce(x.endorsements, 0) DESC, i) AS r
   FROM (SELECT unnest(skills) AS x, generate_subscripts(skills, 1) AS i)) WHERE r <= 3)"""


@register("raw_facts", over_pool(f"""SELECT candidate_id, profile.years_of_experience AS years_of_experience, profile.location AS location,
  profile.country AS country, profile.current_title AS current_title, profile.current_company AS current_company,
  profile.current_industry AS current_industry, profile.headline AS headline, signals.notice_period_days AS notice_period_days,
  signals.recruiter_response_rate AS recruiter_response_rate, signals.last_active_date AS last_active_date,
  signals.open_to_work_flag AS open_to_work_flag, signals.willing_to_relocate AS willing_to_relocate,
  signals.preferred_work_mode AS preferred_work_mode, signals.github_activity_score AS github_activity_score,
  coalesce({_TOP_SKILLS}, '') AS top_skill_names,
  list_filter(career_history, lambda h: h.is_current)[1].duration_months AS current_role_tenure_months,
  education[1].degree AS education_degree, education[1].field_of_study AS education_field,
  education[1].institution AS education_institution FROM pool"""))
def raw_facts(spark: SparkSession, sf: str) -> DataFrame:
    facts = documents.raw_facts(pool(spark, sf))
    return facts.withColumn("top_skill_names", F.coalesce(F.array_join("top_skill_names", ";"), F.lit("")))


_Y = "round({} / 12::DOUBLE, 2)"
_ANALYSIS = over_pool(REF + ROLES + PAIRS + METRICS + f""", long_overlaps AS (
  SELECT candidate_id, string_agg(role_a || ' / ' || role_b || ': ' || months || ' months', '; ' ORDER BY i, j) AS listed
  FROM shared WHERE months >= 3 GROUP BY candidate_id),
longest_role AS (
  SELECT m.candidate_id, min_by(label, i) AS label FROM metrics2 m JOIN spans_in s
  ON s.candidate_id = m.candidate_id AND s.h.duration_months = m.max_role_months GROUP BY m.candidate_id),
experts AS (SELECT candidate_id, array_to_string(list_transform(list_filter(skills, lambda k: k.proficiency = 'expert' AND k.duration_months = 0), lambda k: k.name), ', ') AS listed FROM pool)
SELECT candidate_id, concat_ws(chr(10),
  'stated years of experience: ' || {num('stated_years')},
  'sum of role durations: ' || {num('total_months')} || ' months (' || {num(_Y.format('total_months'))} || ' years)',
  CASE WHEN max_role_months IS NOT NULL THEN 'longest role: ' || {num(_Y.format('max_role_months'))} || ' years (' || {num('max_role_months')} || ' months), ' || r.label END,
  CASE WHEN excess_checked IS NOT NULL THEN 'longest role minus stated years: ' || {num('excess_checked')} || ' years, limit 4.0 -> ' || CASE WHEN excess_checked > 4 THEN 'TRUE' ELSE 'FALSE' END END,
  CASE WHEN span_months IS NOT NULL THEN 'career span: ' || {num(_Y.format('span_months'))} || ' years (' || span_months || ' months), ' || earliest_start::VARCHAR || ' to ' || latest_end::VARCHAR END,
  CASE WHEN gap_checked IS NOT NULL THEN 'stated years minus career span: ' || {num('gap_checked')} || ' years, limit 2.0 -> ' || CASE WHEN gap_checked > 2 THEN 'TRUE' ELSE 'FALSE' END END,
  'expert skills never used: ' || zero_expert_count || ', limit 1 -> ' || CASE WHEN zero_expert_count >= 1 THEN 'TRUE' ELSE 'FALSE' END || ': ' || CASE WHEN zero_expert_count > 0 THEN x.listed ELSE 'none' END,
  'education ending before it starts -> ' || CASE WHEN edu_invalid_count > 0 THEN 'TRUE' ELSE 'FALSE' END || ': ' || edu_invalid_count,
  'roles overlapping 3+ months -> ' || CASE WHEN o.listed IS NOT NULL THEN 'TRUE' ELSE 'FALSE' END || ': ' || coalesce(o.listed, 'none')) AS analysis
FROM metrics2 LEFT JOIN long_overlaps o USING (candidate_id) LEFT JOIN longest_role r USING (candidate_id) LEFT JOIN experts x USING (candidate_id)""")


@register("analysis_block", _ANALYSIS)
def analysis_block(spark: SparkSession, sf: str) -> DataFrame:
    return documents.analysis_block(pool(spark, sf), reference(spark, sf))


# --- keywords ---

# Families that occur in the invented prose of ``documents``.
PROSE_FAMILIES = {
    "english": [r"\bthe\b", r"\band\b", r"\bof\b"],
    "german": [r"\b(der|die|und)\b", r"\bnicht\b"],
    "french": [r"\b(les?|des)\b", r"\bdans\b"],
    "spanish": [r"\b(el|los)\b"],
    "license": [r"\blicen[sc]e"],
    "contact": [r"[\w.]+@[\w.]+\.\w+", r"\b\d{3}[- ]\d{3,4}"],
    "junk": [r"[%*#]{3,}"],
    "number": [r"\b\d+\b"],
}
_FOLDED = f"(SELECT doc_id, {fold('lower(text)')} AS t FROM documents)"


@register("kw_hits", f"SELECT doc_id, {', '.join(f'{hits('t', p)} AS {n}' for n, p in PROSE_FAMILIES.items())} FROM {_FOLDED}")
def kw_hits(spark: SparkSession, sf: str) -> DataFrame:
    texts = spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.lower("text").alias("t"))
    return texts.select("doc_id", *[K.kw_hits("t", p).alias(n) for n, p in PROSE_FAMILIES.items()])


@register("kw_any", f"SELECT doc_id, {', '.join(f'{any_hit('t', p)} AS {n}' for n, p in PROSE_FAMILIES.items())} FROM {_FOLDED}")
def kw_any(spark: SparkSession, sf: str) -> DataFrame:
    texts = spread(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.lower("text").alias("t"))
    return texts.select("doc_id", *[K.kw_any("t", p).alias(n) for n, p in PROSE_FAMILIES.items()])


_FOLDED_TEXTS = f""", folded AS (SELECT candidate_id, {fold('narrative_text')} AS n, {fold('skills_text')} AS s,
  {fold('full_text')} AS f, {fold("titles_text || ' ' || industries_text")} AS ti FROM texts)"""


@register("kw_family_matrix", over_pool(BUNDLES + _FOLDED_TEXTS + f" SELECT candidate_id, {family_columns('n', 's')} FROM folded"))
def kw_family_matrix(spark: SparkSession, sf: str) -> DataFrame:
    bundles = documents.text_bundle(pool(spark, sf))
    return features.kw_family_matrix(bundles, K.FAMILIES, "narrative_text", "skills_text", (ID,))


@register("kw_contains", over_pool(BUNDLES + f""" SELECT candidate_id, {any_word('companies_text', K.SERVICE_FIRMS)} AS service_firm,
  {any_word('industries_text', K.TECH_INDUSTRIES)} AS tech_industry, {any_word('industries_text', K.SERVICE_INDUSTRIES)} AS service_industry FROM texts"""))
def kw_contains(spark: SparkSession, sf: str) -> DataFrame:
    bundles = documents.text_bundle(pool(spark, sf))
    return bundles.select(
        ID, O.contains_any(F.col("companies_text"), K.SERVICE_FIRMS).alias("service_firm"),
        O.contains_any(F.col("industries_text"), K.TECH_INDUSTRIES).alias("tech_industry"),
        O.contains_any(F.col("industries_text"), K.SERVICE_INDUSTRIES).alias("service_industry"))


_FOUNDED = "coalesce(" + ", ".join(
    f"nullif(regexp_extract(h.description, '(?i){p.replace(chr(39), chr(39) * 2)}', 1), '')" for p in rules.FOUNDING_YEAR) + ")::INT"


@register("founding_year", over_pool(REF + ROLES + f" SELECT candidate_id, i, {_FOUNDED} AS founded FROM roles WHERE {_FOUNDED} IS NOT NULL"))
def founding_year(spark: SparkSession, sf: str) -> DataFrame:
    roles = pool(spark, sf).select(ID, F.posexplode("career_history").alias("i", "h"))
    return roles.select(ID, "i", rules.founding_year(F.col("h.description")).alias("founded")).filter("founded IS NOT NULL")


# --- dates and scalar scores ---

@register("date_parse_strict", over_pool(REF + ROLES + f" SELECT candidate_id, i, {dstrict('h.start_date')}::VARCHAR AS strict_date FROM roles"))
def date_parse_strict(spark: SparkSession, sf: str) -> DataFrame:
    roles = pool(spark, sf).select(ID, F.posexplode("career_history").alias("i", "h"))
    return roles.select(ID, "i", D.date_parse_strict(F.col("h.start_date")).cast("string").alias("strict_date"))


@register("date_parse_prefix", over_pool(REF + ROLES + f""" SELECT candidate_id, i,
  {dprefix("h.start_date || 'T10:00'")}::VARCHAR AS prefix_date, {dstrict("h.start_date || 'T10:00'")}::VARCHAR AS strict_date FROM roles"""))
def date_parse_prefix(spark: SparkSession, sf: str) -> DataFrame:
    roles = pool(spark, sf).select(ID, F.posexplode("career_history").alias("i", "h"))
    timed = F.concat(F.col("h.start_date"), F.lit("T10:00"))
    return roles.select(ID, "i", D.date_parse_prefix(timed).cast("string").alias("prefix_date"),
                        D.date_parse_strict(timed).cast("string").alias("strict_date"))


_ORDER_DATES = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate::DATE AS a, l_shipdate::DATE AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def _order_dates(spark: SparkSession, sf: str) -> DataFrame:
    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("o_orderdate").cast("date").alias("a"), F.col("l_shipdate").cast("date").alias("b"))


@register("months_cal", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {cal('a', 'b')}::INT AS months FROM ({_ORDER_DATES})")
def months_cal(spark: SparkSession, sf: str) -> DataFrame:
    return _order_dates(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", D.months_cal(F.col("a"), F.col("b")).alias("months"))


@register("months_whole", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {whole('a', 'b')}::INT AS months FROM ({_ORDER_DATES})")
def months_whole(spark: SparkSession, sf: str) -> DataFrame:
    return _order_dates(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", D.months_whole(F.col("a"), F.col("b")).alias("months"))


@register("days_between", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (b - a)::INT AS days FROM ({_ORDER_DATES})")
def days_between(spark: SparkSession, sf: str) -> DataFrame:
    return _order_dates(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", D.days_between(F.col("b"), F.col("a")).alias("days"))


@register("ord_map", over_pool(f"""SELECT candidate_id, {codes('profile.current_company_size', O.COMPANY_SIZE, -1)} AS size_ord,
  {codes('skills[1].proficiency', O.PROFICIENCY, 0)} AS proficiency_ord, {codes('education[1].tier', O.EDUCATION_TIER, 0)} AS tier_ord,
  {codes('signals.preferred_work_mode', O.WORK_MODE, -1)} AS mode_ord FROM pool"""))
def ord_map(spark: SparkSession, sf: str) -> DataFrame:
    return pool(spark, sf).select(
        ID, O.ord_map(F.col("profile.current_company_size"), O.COMPANY_SIZE, -1).alias("size_ord"),
        O.ord_map(F.get("skills", 0)["proficiency"], O.PROFICIENCY, 0).alias("proficiency_ord"),
        O.ord_map(F.get("education", 0)["tier"], O.EDUCATION_TIER, 0).alias("tier_ord"),
        O.ord_map(F.col("signals.preferred_work_mode"), O.WORK_MODE, -1).alias("mode_ord"))


def _seniority_sql(title: str) -> str:
    parts = [f"CASE WHEN {any_hit(title, words)} THEN {level} END" for level, words in O.SENIORITY.items()]
    return f"coalesce(greatest({', '.join(parts)}), {O.SENIORITY_DEFAULT})"


@register("seniority_level", over_pool(REF + ROLES + f" SELECT candidate_id, i, {_seniority_sql('lower(h.title)')} AS level FROM roles"))
def seniority_level(spark: SparkSession, sf: str) -> DataFrame:
    roles = pool(spark, sf).select(ID, F.posexplode("career_history").alias("i", "h"))
    return roles.select(ID, "i", O.seniority_level(F.lower("h.title")).alias("level"))


_LOC = "lower(profile.location)"
_TIER = (
    f"CASE WHEN {any_word(_LOC, O.CITIES[3])} THEN 3 WHEN {any_word(_LOC, O.CITIES[2])} THEN 2 WHEN {any_word(_LOC, O.CITIES[1])} THEN 1 "
    "WHEN contains(lower(profile.country), 'india') OR lower(profile.country) = 'in' THEN 0 ELSE -1 END"
)


@register("location_tier", over_pool(f"SELECT candidate_id, {_TIER} AS tier FROM pool"))
def location_tier(spark: SparkSession, sf: str) -> DataFrame:
    return pool(spark, sf).select(ID, O.location_tier(F.col("profile.location"), F.col("profile.country")).alias("tier"))


def _fit_sql(y: str) -> str:
    return (
        f"(CASE WHEN {y} IS NULL THEN 0 WHEN {y} BETWEEN 5 AND 9 THEN 1 WHEN {y} < 5 THEN greatest(0, 1 - (5 - {y}) / 5) "
        f"ELSE greatest(0, 1 - ({y} - 9) / 10) END)::DOUBLE"
    )


@register("experience_fit", over_pool(f"SELECT candidate_id, round({_fit_sql('profile.years_of_experience')}, 6) AS fit FROM pool"))
def experience_fit(spark: SparkSession, sf: str) -> DataFrame:
    return pool(spark, sf).select(ID, F.round(O.experience_fit(F.col("profile.years_of_experience")), 6).alias("fit"))


# --- features ---

_R2 = "round({}, 6)"


def _f(x: str, default: str = "0") -> str:
    return f"coalesce({x}, {default})::DOUBLE"


def _mean_sql(array: str, default: str = "0") -> str:
    return f"(CASE WHEN len({array}) > 0 THEN list_sum({array}) / len({array}) ELSE {default} END)::DOUBLE"


_ASSESS = [p for f in features.ASSESSMENT_FAMILIES for p in K.FAMILIES[f]]
_SIGNAL_SQL = f"""sig AS (
  SELECT candidate_id,
    {_f('signals.profile_completeness_score')} AS profile_completeness_score,
    coalesce((SELECT d FROM ref) - {dprefix('signals.signup_date')}, 0) AS days_on_platform,
    coalesce((SELECT d FROM ref) - {dprefix('signals.last_active_date')}, 99999) AS days_since_active,
    coalesce(signals.open_to_work_flag, false)::INT AS open_to_work_flag,
    {_f('signals.profile_views_received_30d')} AS profile_views_received_30d,
    {_f('signals.applications_submitted_30d')} AS applications_submitted_30d,
    {_f('signals.recruiter_response_rate')} AS recruiter_response_rate,
    {_f('signals.avg_response_time_hours')} AS avg_response_time_hours,
    len(signals.scores) AS num_assessments_taken,
    {_R2.format(_mean_sql('list_transform(signals.scores, lambda x: x.score)'))} AS assessment_score_mean,
    coalesce(list_max(list_transform(signals.scores, lambda x: x.score)), 0)::DOUBLE AS assessment_score_max,
    {_R2.format(_mean_sql(f'list_transform(list_filter(signals.scores, lambda x: {any_hit("lower(x.name)", _ASSESS)}), lambda x: x.score)'))} AS assessment_score_jd_relevant_mean,
    {_f('signals.connection_count')} AS connection_count, {_f('signals.endorsements_received')} AS endorsements_received,
    {_f('signals.notice_period_days')} AS notice_period_days,
    {_f('signals.salary.lo')} AS expected_salary_min_lpa, {_f('signals.salary.hi')} AS expected_salary_max_lpa,
    ({_f('signals.salary.lo')} + {_f('signals.salary.hi')}) / 2 AS expected_salary_mid_lpa,
    greatest(0, {_f('signals.salary.hi')} - {_f('signals.salary.lo')}) AS expected_salary_width_lpa,
    {codes('signals.preferred_work_mode', O.WORK_MODE, -1)} AS preferred_work_mode_ord,
    coalesce(signals.willing_to_relocate, false)::INT AS willing_to_relocate,
    (coalesce(signals.github_activity_score, -1) >= 0)::INT AS has_github, {_f('signals.github_activity_score', '-1')} AS github_activity_score,
    {_f('signals.search_appearance_30d')} AS search_appearance_30d, {_f('signals.saved_by_recruiters_30d')} AS saved_by_recruiters_30d,
    {_f('signals.interview_completion_rate')} AS interview_completion_rate,
    (coalesce(signals.offer_acceptance_rate, -1) >= 0)::INT AS has_offer_history, {_f('signals.offer_acceptance_rate', '-1')} AS offer_acceptance_rate,
    signals.verified_email::INT AS verified_email, signals.verified_phone::INT AS verified_phone, signals.linkedin_connected::INT AS linkedin_connected
  FROM pool),
signal_features AS (SELECT *, greatest(0, least(10, 5
    + CASE WHEN notice_period_days <= 30 AND open_to_work_flag = 1 THEN 2 ELSE 0 END + CASE WHEN recruiter_response_rate >= 0.6 THEN 1 ELSE 0 END
    + CASE WHEN days_since_active <= 30 THEN 1 ELSE 0 END - CASE WHEN notice_period_days > 60 THEN 1 ELSE 0 END
    - CASE WHEN days_since_active > 180 AND open_to_work_flag = 0 AND recruiter_response_rate < 0.2 THEN 2 ELSE 0 END))::INT AS availability_tilt_score
  FROM sig)"""
_SERVICE = f"({any_word('lower(h.company)', K.SERVICE_FIRMS)} OR {any_word('lower(h.industry)', K.SERVICE_INDUSTRIES)})"
_SPAN_YEARS = "(CASE WHEN first_start IS NULL THEN 0 ELSE ((SELECT d FROM ref) - first_start) / 365.25::DOUBLE END)"
_CAREER_SQL = f"""tenure AS (SELECT *, coalesce(h.duration_months, 0) AS m, {_SERVICE} AS service FROM roles),
tenure_agg AS (
  SELECT candidate_id, avg(m) AS a, min(m) AS lo, max(m) AS hi, stddev_pop(m) AS sd, sum(m) AS total,
    avg(CASE WHEN h.company_size IN ('1-10','11-50','51-200','201-500','501-1000','1001-5000','5001-10000','10001+') THEN {codes('h.company_size', O.COMPANY_SIZE, -1)} END) AS size_avg,
    sum(CASE WHEN service THEN m ELSE 0 END) AS service_months, bool_and(service) AS all_service
  FROM tenure GROUP BY candidate_id),
dated AS (
  SELECT *, {dprefix('h.start_date')} AS s, {_seniority_sql('lower(h.title)')} AS level,
    lower(h.description) || ' ' || lower(h.title) AS words
  FROM tenure WHERE {dprefix('h.start_date')} IS NOT NULL),
steps AS (
  SELECT *, lead(s) OVER w AS next_s, lead(level) OVER w AS next_level FROM dated WINDOW w AS (PARTITION BY candidate_id ORDER BY s, i)),
step_agg AS (
  SELECT candidate_id, min(s) AS first_start,
    count(*) FILTER (WHERE next_s >= (SELECT d FROM ref) - INTERVAL 60 MONTH AND m < 18 AND next_level > level) AS jumps,
    bool_or((SELECT d FROM ref) - s <= 365 AND {any_hit('words', K.FAMILIES['llm_only_recent'])}) AS recent_llm,
    bool_or(s < DATE '2022-11-01' AND {any_hit('words', K.FAMILIES['pre_llm_ml_background'])}) AS pre_llm
  FROM steps GROUP BY candidate_id),
career_features AS (
  SELECT candidate_id, len(career_history) AS num_career_entries, {_R2.format(_f('a'))} AS avg_tenure_months, {_f('lo')} AS min_tenure_months,
    {_f('hi')} AS max_tenure_months, {_R2.format(_f('sd'))} AS tenure_stdev_months, {_R2.format(_f('size_avg', '-1'))} AS avg_company_size_ord,
    {_f('service_months')} AS service_firm_months, {_R2.format(_f('service_months / nullif(total, 0)'))} AS service_firm_month_fraction,
    coalesce(all_service, false)::INT AS pure_services_career_flag,
    {any_word('lower(profile.current_industry)', K.TECH_INDUSTRIES)}::INT AS current_industry_is_tech,
    {any_word('lower(profile.current_industry)', K.SERVICE_INDUSTRIES)}::INT AS current_industry_is_services,
    coalesce(jumps, 0)::INT AS title_chasing_jump_count, (coalesce(jumps, 0) >= 3)::INT AS title_chasing_flag,
    {_R2.format(_SPAN_YEARS)} AS computed_career_span_years,
    {_R2.format(f"abs(coalesce(profile.years_of_experience, 0) - {_SPAN_YEARS})")} AS years_experience_consistency_gap,
    (coalesce(recent_llm, false) AND NOT coalesce(pre_llm, false))::INT AS recent_llm_only_experience_flag,
    coalesce(pre_llm, false)::INT AS has_pre_llm_ml_background,
    ({any_hit('ti', K.FAMILIES['research_only'])} AND NOT {any_hit('n', K.FAMILIES['production_deployment'])})::INT AS pure_research_flag,
    ({any_hit('lower(profile.current_title)', K.FAMILIES['management_architect_titles'])}
      AND coalesce(list_filter(career_history, lambda h: h.is_current)[1].duration_months, 0) >= 18)::INT AS management_pivot_18mo_plus_flag,
    ({any_hit('f', K.FAMILIES['cv_speech_robotics_domain'])} AND NOT {any_hit('f', K.FAMILIES['nlp_ir_domain'])}
      AND NOT {any_hit('f', K.FAMILIES['retrieval_embeddings'])})::INT AS wrong_domain_flag
  FROM pool LEFT JOIN tenure_agg USING (candidate_id) LEFT JOIN step_agg USING (candidate_id) JOIN folded USING (candidate_id))"""
_PROF = codes("x.proficiency", O.PROFICIENCY, 0)
_PY = "list_filter(skills, lambda x: lower(x.name) = 'python')[1]"
_SKILL_SQL = f"""skill_features AS (
  SELECT candidate_id, len(skills) AS num_skills, {_R2.format(_mean_sql(f'list_transform(skills, lambda x: {_PROF})'))} AS avg_skill_proficiency,
    coalesce(list_max(list_transform(skills, lambda x: {_PROF})), 0)::DOUBLE AS max_skill_proficiency,
    coalesce(list_sum(list_transform(skills, lambda x: coalesce(x.endorsements, 0))), 0)::DOUBLE AS total_skill_endorsements,
    len(list_filter(skills, lambda x: {_PROF} >= 3 AND coalesce(x.duration_months, 0) < 6)) AS high_proficiency_low_duration_count,
    ({_PY} IS NOT NULL)::INT AS has_python_skill, {codes(f'{_PY}.proficiency', O.PROFICIENCY, 0)} AS python_proficiency,
    {_f(f'{_PY}.duration_months')} AS python_duration_months FROM pool)"""
_CERT_TEXTS = "array_to_string(list_transform(certifications, lambda x: lower(x.name) || ' ' || lower(x.issuer)), ' ')"
_EDU_SQL = f"""education_features AS (
  SELECT candidate_id, len(education) AS num_education_entries,
    coalesce(list_max(list_transform(education, lambda x: {codes('x.tier', O.EDUCATION_TIER, 0)})), 0) AS highest_education_tier_ord,
    (len(list_filter(education, lambda x: {any_word('lower(x.field_of_study)', K.DEGREE_FIELDS)})) > 0)::INT AS has_relevant_degree_field,
    len(certifications) AS num_certifications,
    ({any_hit(_CERT_TEXTS, [p for f in features.CERT_FAMILIES for p in K.FAMILIES[f]])} OR {any_word(_CERT_TEXTS, K.CERT_VENDORS)})::INT AS has_relevant_certification
  FROM pool)"""
_AI_S = " + ".join(hits("s", K.FAMILIES[f]) for f in features.AI_FAMILIES)
_AI_N = " + ".join(hits("n", K.FAMILIES[f]) for f in features.AI_FAMILIES)
_NONTECH = any_hit("lower(profile.current_title)", K.FAMILIES["marketing_nontech_titles"])
_FIT_SQL = f"""fit_features AS (
  SELECT candidate_id, {_f('profile.years_of_experience')} AS years_of_experience,
    {_R2.format(_fit_sql('coalesce(profile.years_of_experience, 0)'))} AS experience_band_fit, {_TIER} AS location_tier,
    {codes('profile.current_company_size', O.COMPANY_SIZE, -1)} AS current_company_size_ord,
    {_seniority_sql('lower(profile.current_title)')} AS current_title_seniority_level, {_NONTECH}::INT AS marketing_nontech_title_flag,
    ({_NONTECH} AND ({_AI_S}) >= 3 AND ({_AI_N}) = 0)::INT AS title_skill_mismatch_flag
  FROM pool JOIN folded USING (candidate_id))"""
_KEYWORD_SQL = f"keyword_features AS (SELECT candidate_id, {family_columns('n', 's')} FROM folded)"
_CROSS_SQL = f"""cross_features AS (
  SELECT candidate_id, (coalesce(profile.years_of_experience, 0) >= 5 AND coalesce(signals.github_activity_score, -1) < 0
    AND NOT {any_hit('f', K.FAMILIES['open_source_validation'])})::INT AS closed_source_only_flag FROM pool JOIN folded USING (candidate_id))"""
_PRE = REF + ROLES + BUNDLES + _FOLDED_TEXTS + ", "
_FLOATS = {
    "assessment_score_mean", "assessment_score_jd_relevant_mean", "avg_tenure_months", "tenure_stdev_months", "avg_company_size_ord",
    "service_firm_month_fraction", "computed_career_span_years", "years_experience_consistency_gap", "avg_skill_proficiency",
    "experience_band_fit",
}


def _block(name: str, columns: list[str], sql: str, source: str) -> None:
    @register(name, over_pool(_PRE + sql + f" SELECT candidate_id, {', '.join(columns)} FROM {source}"))
    def query(spark: SparkSession, sf: str) -> DataFrame:
        block = features.feat_block(pool(spark, sf), reference(spark, sf), columns)
        return block.withColumns({c: F.round(c, 6) for c in columns if c in _FLOATS}) if _FLOATS & set(columns) else block


_block("feat_signals", features.SIGNAL_FEATURES, _SIGNAL_SQL, "signal_features")
_block("feat_career", features.CAREER_FEATURES, _CAREER_SQL, "career_features")
_block("feat_skills", features.SKILL_FEATURES, _SKILL_SQL, "skill_features")
_block("feat_education", features.EDUCATION_FEATURES, _EDU_SQL, "education_features")
_block("feat_fit", features.FIT_FEATURES, _FIT_SQL, "fit_features")
_block("feat_keywords", features.KEYWORD_FEATURES, _KEYWORD_SQL, "keyword_features")
_block("feat_all", features.FEATURE_COLUMNS,
       ", ".join([_SIGNAL_SQL, _CAREER_SQL, _SKILL_SQL, _EDU_SQL, _FIT_SQL, _KEYWORD_SQL, _CROSS_SQL]),
       "signal_features JOIN career_features USING (candidate_id) JOIN skill_features USING (candidate_id) "
       "JOIN education_features USING (candidate_id) JOIN fit_features USING (candidate_id) "
       "JOIN keyword_features USING (candidate_id) JOIN cross_features USING (candidate_id)")


@register("availability_score", over_pool(_PRE + _SIGNAL_SQL + " SELECT candidate_id, availability_tilt_score AS score FROM signal_features"))
def availability_score(spark: SparkSession, sf: str) -> DataFrame:
    block = features.feat_block(pool(spark, sf), reference(spark, sf), ["availability_tilt_score"])
    return block.withColumnRenamed("availability_tilt_score", "score")


@register("title_jumps", over_pool(_PRE + _CAREER_SQL + """ SELECT candidate_id, title_chasing_jump_count AS jumps,
  title_chasing_flag AS flag FROM career_features WHERE title_chasing_jump_count > 0"""))
def title_jumps(spark: SparkSession, sf: str) -> DataFrame:
    dated = pool(spark, sf).select(ID, features.dated_roles(F.col("career_history")).alias("dated"))
    jumps = features.title_jumps(F.col("dated"), F.lit(reference(spark, sf)).cast("date"))
    counted = dated.select(ID, jumps.alias("jumps")).filter("jumps > 0")
    return counted.withColumn("flag", (F.col("jumps") >= features.JUMPS_FOR_FLAG).cast("int"))


@register("array_stats", over_pool("""SELECT candidate_id, round(coalesce(list_avg(m), 0), 6) AS mean, coalesce(list_min(m), 0)::DOUBLE AS least,
  coalesce(list_max(m), 0)::DOUBLE AS greatest, round(coalesce(list_stddev_pop(m), 0), 6) AS deviation, coalesce(list_sum(m), 0)::DOUBLE AS total
  FROM (SELECT candidate_id, list_transform(skills, lambda x: coalesce(x.duration_months, 0)) AS m FROM pool)"""))
def array_stats(spark: SparkSession, sf: str) -> DataFrame:
    months = pool(spark, sf).select(ID, F.transform("skills", lambda s: F.coalesce(s["duration_months"], F.lit(0.0))).alias("m"))
    stats = features.array_stats(F.col("m"))
    return months.select(ID, F.round(stats["mean"], 6).alias("mean"), stats["min"].alias("least"), stats["max"].alias("greatest"),
                         F.round(stats["stdev"], 6).alias("deviation"), stats["sum"].alias("total"))


# --- hard rules ---

_N = rules
_RULE_HITS: dict[str, tuple[str, str]] = {
    "rule_current_has_end": (_N.CURRENT_HAS_END, "SELECT candidate_id, i AS o, 1 AS part FROM rules_in WHERE cur AND e IS NOT NULL"),
    "rule_end_before_start": (_N.END_BEFORE_START, "SELECT candidate_id, i AS o, 2 AS part FROM rules_in WHERE e < s"),
    "rule_duration_mismatch": (_N.DURATION_MISMATCH, f"SELECT candidate_id, i AS o, 2 AS part FROM rules_in WHERE e >= s AND abs({cal('s', 'e')} - h.duration_months) > 2"),
    "rule_predates_founding": (_N.PREDATES_FOUNDING, f"SELECT candidate_id, i AS o, 3 AS part FROM rules_in WHERE year(s) < {_FOUNDED}"),
    "rule_multi_current": (_N.MULTI_CURRENT, "SELECT candidate_id, 1000 AS o, 1 AS part FROM rules_in GROUP BY candidate_id HAVING count(*) FILTER (WHERE cur) > 1"),
    "rule_overlap_adjacent": (_N.OVERLAP_ADJACENT, """SELECT candidate_id, 2000 AS o, 1 AS part FROM (
        SELECT *, lead(s) OVER w AS s2, lead(h.company) OVER w AS c2, lead(1) OVER w AS has_next
        FROM (SELECT *, CASE WHEN cur THEN (SELECT d FROM ref) ELSE e END AS stop FROM rules_in WHERE s IS NOT NULL AND (cur OR e IS NOT NULL))
        WINDOW w AS (PARTITION BY candidate_id ORDER BY s, i)) WHERE has_next = 1 AND c2 IS DISTINCT FROM h.company AND stop - s2 > 60"""),
    "rule_edu_reversed": (_N.EDU_REVERSED, "SELECT candidate_id, 3000 AS o, 1 AS part FROM (SELECT candidate_id, unnest(education) AS x FROM pool) WHERE x.end_year < x.start_year"),
    "rule_history_exceeds": (_N.HISTORY_EXCEEDS, """SELECT candidate_id, 4000 AS o, 1 AS part FROM rules_in GROUP BY candidate_id, yoe
        HAVING sum(h.duration_months) > 0 AND sum(h.duration_months) > yoe * 12 * 1.4::DOUBLE + 12"""),
    "rule_single_role_exceeds": (_N.SINGLE_ROLE_EXCEEDS, "SELECT DISTINCT candidate_id, 5000 AS o, 1 AS part FROM rules_in WHERE h.duration_months > yoe * 12 + 12"),
    "rule_expert_zero": (_N.EXPERT_ZERO, "SELECT candidate_id, 6000 + n AS o, 1 AS part FROM skill_in WHERE lower(x.proficiency) = 'expert' AND x.duration_months <= 1"),
    "rule_skill_over_max": (_N.SKILL_OVER_MAX, "SELECT candidate_id, 6000 + n AS o, 2 AS part FROM skill_in WHERE x.duration_months > 600"),
    "rule_complete_but_empty": (_N.COMPLETE_BUT_EMPTY, f"""SELECT candidate_id, 9000 AS o, 1 AS part FROM pool WHERE signals.profile_completeness_score >= 95
        AND ({strip("coalesce(profile.headline, '')")} = '' OR len({strip("coalesce(profile.summary, '')")}) < 15)"""),
}
_SKILL_IN = ", skill_in AS (SELECT candidate_id, unnest(skills) AS x, generate_subscripts(skills, 1) AS n FROM pool)"


def _rule(name: str, reason: str, sql: str) -> None:
    @register(name, over_pool(REF + ROLES + _SKILL_IN + f" SELECT candidate_id, count(*)::INT AS hits FROM ({sql}) GROUP BY candidate_id"))
    def query(spark: SparkSession, sf: str) -> DataFrame:
        flags = rules.rules_flag(pool(spark, sf), reference(spark, sf))
        count = F.size(F.filter("reasons", lambda r: r == reason))
        return flags.select(ID, count.alias("hits")).filter("hits > 0")


for _name, (_reason, _sql) in _RULE_HITS.items():
    _rule(_name, _reason, _sql)

_ALL_HITS = REF + ROLES + _SKILL_IN + ", hits AS (" + " UNION ALL ".join(
    f"SELECT candidate_id, '{reason}' AS reason, o, part FROM ({sql})" for reason, sql in _RULE_HITS.values()) + ")"
_FLAGS = _ALL_HITS + """, flags AS (
  SELECT candidate_id, count(reason) > 0 AS honeypot_flag, count(reason)::INT AS hit_count, coalesce(string_agg(reason, ';' ORDER BY o, part), '') AS reasons
  FROM pool LEFT JOIN hits USING (candidate_id) GROUP BY candidate_id)"""


@register("rules_flag", over_pool(_FLAGS + " SELECT * FROM flags"))
def rules_flag(spark: SparkSession, sf: str) -> DataFrame:
    return rules.rules_flag(pool(spark, sf), reference(spark, sf)).withColumn("reasons", F.array_join("reasons", ";"))


@register("rule_histogram", over_pool(_ALL_HITS + " SELECT reason, count(*) AS hits FROM hits GROUP BY reason"))
def rule_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return rules.rule_histogram(rules.rules_flag(pool(spark, sf), reference(spark, sf)))


@register("rule_flagged_share", over_pool(_FLAGS + """ SELECT count(*) AS checked, count(*) FILTER (WHERE honeypot_flag) AS flagged,
  round(100.0::DOUBLE * count(*) FILTER (WHERE honeypot_flag) / count(*), 2) AS flagged_percent FROM flags"""))
def rule_flagged_share(spark: SparkSession, sf: str) -> DataFrame:
    return rules.flagged_share(rules.rules_flag(pool(spark, sf), reference(spark, sf)))


@register("consecutive_overlap", over_pool(REF + ROLES + " SELECT candidate_id, count(*)::INT AS overlaps FROM ("
                                           + _RULE_HITS["rule_overlap_adjacent"][1] + ") GROUP BY candidate_id"))
def consecutive_overlap(spark: SparkSession, sf: str) -> DataFrame:
    roles = pool(spark, sf).select(ID, rules.parsed_roles(F.col("career_history")).alias("roles"))
    found = roles.select(ID, rules.role_intervals(F.col("roles"), F.lit(reference(spark, sf)).cast("date")).alias("intervals"))
    return found.select(ID, F.size(rules.adjacent_overlaps("intervals")).alias("overlaps")).filter("overlaps > 0")


# --- calibrated metrics ---

_M = REF + ROLES + PAIRS + METRICS


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.integrity_metrics(pool(spark, sf), reference(spark, sf))


@register("metric_span", over_pool(_M + """ SELECT candidate_id, earliest_start::VARCHAR AS earliest_start, latest_end::VARCHAR AS latest_end,
  span_months::INT AS span_months, round(span_years, 6) AS span_years FROM metrics2"""))
def metric_span(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, sf).select(
        ID, F.col("earliest_start").cast("string").alias("earliest_start"), F.col("latest_end").cast("string").alias("latest_end"),
        "span_months", F.round("span_years", 6).alias("span_years"))


@register("metric_gap", over_pool(_M + """ SELECT candidate_id, round(gap_years, 6) AS gap_years, gap_checked,
  coalesce(gap_checked > 2, false) AS gap_exceeds FROM metrics2"""))
def metric_gap(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.integrity_checks(_metrics(spark, sf)).select(ID, F.round("gap_years", 6).alias("gap_years"), "gap_checked", "gap_exceeds")


@register("metric_single_role", over_pool(_M + """ SELECT candidate_id, max_role_months, round(single_role_excess_years, 6) AS excess_years,
  coalesce(excess_checked > 4, false) AS exceeds FROM metrics2"""))
def metric_single_role(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.integrity_checks(_metrics(spark, sf)).select(
        ID, "max_role_months", F.round("single_role_excess_years", 6).alias("excess_years"), F.col("single_role_exceeds").alias("exceeds"))


@register("metric_zero_expert", over_pool(_M + " SELECT candidate_id, zero_expert_count::INT AS zero_expert_count, zero_expert_count >= 1 AS exceeds FROM metrics2"))
def metric_zero_expert(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.integrity_checks(_metrics(spark, sf)).select(ID, "zero_expert_count", F.col("zero_expert_exceeds").alias("exceeds"))


@register("metric_edu_invalid", over_pool(_M + " SELECT candidate_id, edu_invalid_count::INT AS edu_invalid_count, edu_invalid_count > 0 AS invalid FROM metrics2"))
def metric_edu_invalid(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.integrity_checks(_metrics(spark, sf)).select(ID, "edu_invalid_count", F.col("edu_invalid").alias("invalid"))


@register("metric_overlaps", over_pool(_M + """, o AS (SELECT candidate_id, count(*) AS n, sum(months) AS total, max(months) AS longest, count(*) FILTER (WHERE months >= 3) > 0 AS exceeds
  FROM shared GROUP BY candidate_id)
  SELECT candidate_id, coalesce(n, 0)::INT AS n, coalesce(total, 0)::BIGINT AS total, longest::INT AS longest, coalesce(exceeds, false) AS exceeds FROM pool LEFT JOIN o USING (candidate_id)"""))
def metric_overlaps(spark: SparkSession, sf: str) -> DataFrame:
    m = _metrics(spark, sf)
    checked = integrity.integrity_checks(m).select(ID, "overlap_months", F.col("overlap_exceeds").alias("exceeds"))
    return checked.select(ID, F.size("overlap_months").alias("n"), F.aggregate("overlap_months", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"),
                          F.array_max("overlap_months").alias("longest"), "exceeds")


@register("interval_overlap_pairs", over_pool(_M + " SELECT candidate_id, i::INT AS i, j::INT AS j, months::INT AS months, role_a, role_b FROM shared"))
def interval_overlap_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.interval_overlap_pairs(pool(spark, sf), reference(spark, sf))


_CHECKS = _M + """, long_overlaps AS (SELECT DISTINCT candidate_id FROM shared WHERE months >= 3),
checks AS (SELECT candidate_id, concat_ws(';', CASE WHEN gap_checked > 2 THEN 'CAREER_SPAN_EXCEEDS_EXPERIENCE' END,
  CASE WHEN excess_checked > 4 THEN 'SINGLE_ROLE_EXCEEDS_EXPERIENCE' END, CASE WHEN zero_expert_count >= 1 THEN 'ZERO_DURATION_EXPERT_SKILL' END,
  CASE WHEN edu_invalid_count > 0 THEN 'INVALID_EDUCATION_DATES' END, CASE WHEN o.candidate_id IS NOT NULL THEN 'OVERLAPPING_FULL_TIME_ROLES' END) AS tripped
  FROM metrics2 LEFT JOIN long_overlaps o USING (candidate_id))"""


@register("check_any", over_pool(_CHECKS + " SELECT candidate_id, tripped, tripped <> '' AS any_check FROM checks"))
def check_any(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.integrity_checks(_metrics(spark, sf)).select(ID, F.array_join("tripped", ";").alias("tripped"), "any_check")


@register("verdict_disagree", over_pool(_CHECKS + f""", verdicts AS (SELECT {DOC_ID} AS candidate_id, n_chars % 3 = 0 AS is_honeypot FROM documents)
  SELECT candidate_id, is_honeypot, tripped FROM verdicts JOIN checks USING (candidate_id) WHERE NOT is_honeypot AND tripped <> ''"""))
def verdict_disagree(spark: SparkSession, sf: str) -> DataFrame:
    verdicts = table(spark, sf, "documents").select(
        F.concat(F.lit("CAND_"), F.lpad(F.col("doc_id").cast("string"), 7, "0")).alias(ID), (F.col("n_chars") % 3 == 0).alias("is_honeypot"))
    found = integrity.verdict_disagree(verdicts, integrity.integrity_checks(_metrics(spark, sf)))
    return found.withColumn("tripped", F.array_join("tripped", ";"))


# --- population statistics ---

_FIELD_DATES = """, field_dates AS (SELECT unnest([signals.signup_date, signals.last_active_date]) AS s FROM pool
  UNION ALL SELECT unnest([h.start_date, h.end_date]) FROM (SELECT unnest(career_history) AS h FROM pool))"""


@register("ref_date_fields", over_pool(_FIELD_DATES + f""" SELECT coalesce(max({dprefix('s')}), DATE '2026-01-01')::VARCHAR AS loose,
  greatest(max({dstrict('s')}), DATE '1970-01-01')::VARCHAR AS strict FROM field_dates"""))
def ref_date_fields(spark: SparkSession, sf: str) -> DataFrame:
    source = pool(spark, sf)
    return source.agg(*[calibrate.latest_date(strict).cast("string").alias(n) for n, strict in (("loose", False), ("strict", True))])


@register("ref_date_any_string", over_pool(REF + " SELECT d::VARCHAR AS reference_date FROM ref"))
def ref_date_any_string(spark: SparkSession, sf: str) -> DataFrame:
    return calibrate.ref_date_any_string(pool(spark, sf)).select(F.col("reference_date").cast("string").alias("reference_date"))


def summary_sql(source: str, by: str = "metric", value: str = "value") -> str:
    percentiles = ", ".join(
        f"round(quantile_cont({value}, {p / 100}), 3) AS {calibrate.percentile_name(p)}" for p in calibrate.PERCENTILES)
    return (
        f"SELECT {by}, count({value}) AS count, round(avg({value}), 3) AS mean, round(stddev_pop({value}), 3) AS std, "
        f"round(min({value}), 3) AS min, {percentiles} FROM {source} WHERE {value} IS NOT NULL GROUP BY {by}"
    )


_VALUES = _M + """, vals AS (SELECT 'stated_years' AS metric, stated_years AS value FROM metrics2 UNION ALL SELECT 'history_entries', history_entries FROM metrics2
  UNION ALL SELECT 'gap_years', gap_years FROM metrics2 WHERE gap_years > 0
  UNION ALL SELECT 'single_role_excess_years', single_role_excess_years FROM metrics2 WHERE single_role_excess_years > 0
  UNION ALL SELECT 'zero_expert_count', zero_expert_count FROM metrics2 UNION ALL SELECT 'edu_invalid_count', edu_invalid_count FROM metrics2
  UNION ALL SELECT 'overlap_months', months FROM shared)"""
_SUMMARIES = over_pool(_VALUES + ", summaries AS (" + summary_sql("vals") + ")")


@register("summary_dist", over_pool(_VALUES + " " + summary_sql("vals")))
def summary_dist(spark: SparkSession, sf: str) -> DataFrame:
    return calibrate.summary_dist(calibrate.metric_values(_metrics(spark, sf)))


@register("summary_dist_prices", summary_sql("lineitem", "l_returnflag", "l_extendedprice"))
def summary_dist_prices(spark: SparkSession, sf: str) -> DataFrame:
    return calibrate.summary_dist(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")


@register("summary_positive_side", over_pool(_VALUES + " " + summary_sql("(SELECT * FROM vals WHERE metric IN ('gap_years', 'single_role_excess_years'))")))
def summary_positive_side(spark: SparkSession, sf: str) -> DataFrame:
    values = calibrate.metric_values(_metrics(spark, sf))
    return calibrate.summary_dist(values.filter(F.col("metric").isin("gap_years", "single_role_excess_years")))


@register("pool_counts", over_pool(_M + """ SELECT count(*) AS n_total, count(span_months) AS n_with_span, count(*) FILTER (WHERE zero_expert_count > 0) AS n_with_zero_expert,
  round(100.0::DOUBLE * count(*) FILTER (WHERE zero_expert_count > 0) / count(*), 4) AS pct_with_zero_expert FROM metrics2"""))
def pool_counts(spark: SparkSession, sf: str) -> DataFrame:
    return calibrate.pool_counts(_metrics(spark, sf))


_CALIBRATED = """SELECT greatest(2, ceil(max(p99_9) FILTER (WHERE metric = 'gap_years') * 2) / 2)::DOUBLE AS span_gap_tolerance_years,
  greatest(1, ceil(max(p99_9) FILTER (WHERE metric = 'single_role_excess_years') * 2) / 2)::DOUBLE AS single_role_tolerance_years,
  greatest(2, ceil(max(p95) FILTER (WHERE metric = 'overlap_months')))::INT AS min_overlap_months,
  CASE WHEN max(p99) FILTER (WHERE metric = 'zero_expert_count') >= 1 THEN 2 ELSE 1 END AS zero_duration_expert_min_count FROM summaries"""


@register("calibrate_thresholds", _SUMMARIES + " " + _CALIBRATED)
def calibrate_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    return calibrate.calibrate_thresholds(calibrate.summary_dist(calibrate.metric_values(_metrics(spark, sf))))


@register("thresholds_resolve", _SUMMARIES + f""" SELECT 2.5::DOUBLE AS span_gap_tolerance_years, single_role_tolerance_years, min_overlap_months,
  zero_duration_expert_min_count FROM ({_CALIBRATED})""")
def thresholds_resolve(spark: SparkSession, sf: str) -> DataFrame:
    calibrated = calibrate.calibrate_thresholds(calibrate.summary_dist(calibrate.metric_values(_metrics(spark, sf))))
    return spark.createDataFrame(
        [tuple(vars(calibrate.thresholds_resolve(calibrated, span_gap_tolerance_years=2.5)).values())],
        "span_gap_tolerance_years double, single_role_tolerance_years double, min_overlap_months int, zero_duration_expert_min_count int")
