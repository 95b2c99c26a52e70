"""Text blocks for the SQL twins (DuckDB)."""

from __future__ import annotations

from ..functions.keywords import FAMILIES
from .fixture import POOL_SQL

DOC_ID = "'CAND_' || lpad(doc_id::VARCHAR, 7, '0')"


def over_pool(rest: str) -> str:
    """A statement over the table ``pool``; ``rest`` may begin with further table expressions."""
    return f"WITH {POOL_SQL}{rest if rest.lstrip().startswith(',') else ' ' + rest}"


def dstrict(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST({x} AS DATE) END)"


def dprefix(x: str) -> str:
    return dstrict(f"substr({x}, 1, 10)")


def cal(a: str, b: str) -> str:
    return f"((year({b}) - year({a})) * 12 + month({b}) - month({a}))"


def whole(a: str, b: str) -> str:
    return f"(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN greatest({cal(a, b)} - CASE WHEN day({b}) < day({a}) THEN 1 ELSE 0 END, 0) END)"


def num(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN '' WHEN {x} = floor({x}) THEN ({x})::BIGINT::VARCHAR ELSE ({x})::VARCHAR END)"


def fold(x: str) -> str:
    """Letters outside ASCII as ``_``, other such signs as a blank: word boundaries then agree."""
    return f"regexp_replace(regexp_replace({x}, '[^\\x00-\\x7F\\p{{L}}\\p{{N}}]', ' ', 'g'), '[^\\x00-\\x7F]', '_', 'g')"


def strip(x: str) -> str:
    return f"trim({x}, E' \\t\\n\\r\\f\\x0b')"


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def hits(text: str, patterns: list[str]) -> str:
    return "(" + " + ".join(f"regexp_matches({text}, {quoted(p)})::INT" for p in patterns) + ")"


def any_hit(text: str, patterns: list[str]) -> str:
    return "(" + " OR ".join(f"regexp_matches({text}, {quoted(p)})" for p in patterns) + ")"


def any_word(text: str, words: list[str]) -> str:
    return "coalesce(" + " OR ".join(f"contains({text}, {quoted(w)})" for w in words) + ", false)"


def codes(x: str, table: dict, default: int) -> str:
    return f"(CASE {x} " + " ".join(f"WHEN {quoted(k)} THEN {v}" for k, v in table.items()) + f" ELSE {default} END)"


def family_columns(narrative: str, skills: str, families: dict[str, list[str]] = FAMILIES) -> str:
    """The three columns of each family."""
    parts = []
    for name, patterns in families.items():
        n, s = hits(narrative, patterns), hits(skills, patterns)
        parts.append(f"{n} AS {name}_narrative_hits, {s} AS {name}_skills_hits, greatest(0, {s} - {n}) AS {name}_inflation_gap")
    return ",\n".join(parts)


# The latest date any string of any record starts with.
REF = f""", strings AS (
  SELECT unnest([profile.headline, profile.summary, profile.location, profile.country, profile.current_title,
    profile.current_company, profile.current_company_size, profile.current_industry,
    signals.signup_date, signals.last_active_date, signals.preferred_work_mode]) AS s FROM pool
  UNION ALL SELECT unnest([h.company, h.title, h.start_date, h.end_date, h.industry, h.company_size, h.description])
    FROM (SELECT unnest(career_history) AS h FROM pool)
  UNION ALL SELECT unnest([h.degree, h.field_of_study, h.institution, h.tier]) FROM (SELECT unnest(education) AS h FROM pool)
  UNION ALL SELECT unnest([h.name, h.proficiency]) FROM (SELECT unnest(skills) AS h FROM pool)
  UNION ALL SELECT unnest([h.name, h.issuer]) FROM (SELECT unnest(certifications) AS h FROM pool)),
ref AS (SELECT max({dprefix('s')}) AS d FROM strings)"""

# One row per role with parsed dates: i counts from 0, strict and prefix dates.
ROLES = f""", roles AS (
  SELECT candidate_id, profile.years_of_experience AS yoe, generate_subscripts(career_history, 1) - 1 AS i,
         unnest(career_history) AS h FROM pool),
rules_in AS (
  SELECT *, {dstrict('h.start_date')} AS s, {dstrict('h.end_date')} AS e, coalesce(h.is_current, false) AS cur FROM roles),
spans_in AS (
  SELECT candidate_id, i, yoe, h, {dprefix('h.start_date')} AS s,
         CASE WHEN coalesce(h.end_date, '') <> '' THEN {dprefix('h.end_date')} WHEN h.is_current THEN (SELECT d FROM ref) END AS e,
         coalesce(h.title, '') || ' at ' || coalesce(h.company, '') AS label FROM roles)"""

PAIRS = f""", pairs AS (
  SELECT a.candidate_id, a.i, b.i AS j, {whole('greatest(a.s, b.s)', 'least(a.e, b.e)')} AS months, a.label AS role_a, b.label AS role_b
  FROM spans_in a JOIN spans_in b ON a.candidate_id = b.candidate_id AND a.i < b.i
  WHERE a.s IS NOT NULL AND a.e IS NOT NULL AND b.s IS NOT NULL AND b.e IS NOT NULL AND greatest(a.s, b.s) < least(a.e, b.e)),
shared AS (SELECT * FROM pairs WHERE months > 0)"""

METRICS = f""", span_rows AS (
  SELECT candidate_id, min(s) AS s0, max(e) AS e1, max(CASE WHEN h.duration_months >= 0 THEN h.duration_months END) AS longest,
         sum(h.duration_months) AS total_months
  FROM spans_in GROUP BY candidate_id),
metrics AS (
  SELECT p.candidate_id, p.profile.years_of_experience AS stated_years, len(career_history) AS history_entries,
    coalesce(total_months, 0) AS total_months, longest AS max_role_months, s0 AS earliest_start, e1 AS latest_end,
    {whole('s0', 'e1')} AS span_months,
    (SELECT count(*) FROM (SELECT unnest(p.skills) AS k) WHERE k.proficiency = 'expert' AND k.duration_months = 0) AS zero_expert_count,
    (SELECT count(*) FROM (SELECT unnest(p.education) AS k) WHERE k.end_year < k.start_year) AS edu_invalid_count
  FROM pool p LEFT JOIN span_rows USING (candidate_id)),
metrics2 AS (
  SELECT *, span_months / 12::DOUBLE AS span_years, stated_years - span_months / 12::DOUBLE AS gap_years,
         max_role_months / 12 - stated_years AS single_role_excess_years,
         round(stated_years - round(span_months / 12::DOUBLE, 2), 2) AS gap_checked,
         round(round(max_role_months / 12, 2) - stated_years, 2) AS excess_checked
  FROM metrics)"""

BUNDLES = """, bundles AS (
  SELECT candidate_id,
    lower(array_to_string(list_transform(skills, lambda x: coalesce(x.name, '')), ' ; ')) AS skills_text,
    lower(array_to_string([coalesce(profile.headline, ''), coalesce(profile.summary, '')] || list_transform(career_history, lambda x: coalesce(x.description, '')), ' ; ')) AS narrative_text,
    lower(array_to_string([coalesce(profile.current_title, '')] || list_transform(career_history, lambda x: coalesce(x.title, '')), ' ; ')) AS titles_text,
    lower(array_to_string([coalesce(profile.current_industry, '')] || list_transform(career_history, lambda x: coalesce(x.industry, '')), ' ; ')) AS industries_text,
    lower(array_to_string([coalesce(profile.current_company, '')] || list_transform(career_history, lambda x: coalesce(x.company, '')), ' ; ')) AS companies_text
  FROM pool),
texts AS (SELECT *, skills_text || ' ; ' || narrative_text || ' ; ' || titles_text || ' ; ' || industries_text AS full_text FROM bundles)"""
