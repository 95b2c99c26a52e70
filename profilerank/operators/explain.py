"""Short reason texts from score contributions, for the top rows of a ranking.

What is said about a feature stands in a table of templates: a feature, a condition, and a text with slots. One renderer
turns any such table into columns, so a caller can bring an own one. Everything happens inside the row: contributions
and clauses sit in one array that is filtered, sorted and joined.
"""

from __future__ import annotations

from string import Formatter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import fmt_value, null_clean
from ..schema import ID
from .features import FEATURE_COLUMNS

#: A contribution counts if it is beyond this share of the row's greatest one.
DRIVER_SHARE = 0.10
FLAG = "honeypot_flag"


class Template(NamedTuple):
    """``text`` is said about ``feature`` where ``when`` holds (SQL over the row) and every slot is known.

    Slots are ``{value}``, the feature itself, columns of the row, and ``{facts.name}``; ``{name:0}`` and ``{name:1}``
    print a number with so many digits.
    """

    feature: str
    when: str
    text: str


def _family_templates() -> list[Template]:
    """Three sentences for each keyword family, by the names of its columns."""
    said = {"_narrative_hits": "career text touches on {label} {{value}} times", "_skills_hits": "{{value}} listed skills concern {label}",
            "_inflation_gap": "{{value}} listed skills in {label} without a trace in the career text"}
    out = []
    for column in FEATURE_COLUMNS:
        for ending, text in said.items():
            if column.endswith(ending):
                out.append(Template(column, f"{column} > 0", text.format(label=column.removesuffix(ending).replace("_", " "))))
    return out


#: What is said by default. The first template that applies counts; without one the value and its direction are given.
TEMPLATES = [
    Template("experience_band_fit", "experience_band_fit >= 0.6", "{facts.years_of_experience:1} years in the job suit the role"),
    Template("experience_band_fit", "experience_band_fit < 0.6", "{facts.years_of_experience:1} years in the job are not what the role asks for"),
    Template("location_tier", "location_tier >= 2", "lives in {facts.location}, where the role is"),
    Template("location_tier", "location_tier >= 0", "lives in {facts.location}, away from the role"),
    Template("location_tier", "facts.willing_to_relocate", "lives abroad in {facts.location} but would move"),
    Template("location_tier", "true", "lives abroad in {facts.location}"),
    Template("availability_tilt_score", "availability_tilt_score >= 5", "is easy to reach and soon free"),
    Template("availability_tilt_score", "true", "is hard to reach or long bound"),
    Template("notice_period_days", "notice_period_days > 30", "is bound for {value:0} more days"),
    Template("notice_period_days", "true", "is free in {value:0} days"),
    Template("recent_llm_only_experience_flag", "recent_llm_only_experience_flag <> 0", "knows language models only from their interfaces"),
    Template("has_pre_llm_ml_background", "has_pre_llm_ml_background <> 0", "built models before language models were common"),
    Template("pure_research_flag", "pure_research_flag <> 0", "has research but nothing in use to show"),
    Template("wrong_domain_flag", "wrong_domain_flag <> 0", "comes from images, speech or robots rather than text"),
    Template("pure_services_career_flag", "pure_services_career_flag <> 0", "has only worked for service firms"),
    Template("closed_source_only_flag", "closed_source_only_flag <> 0", "has no public work to look at"),
    Template("management_pivot_18mo_plus_flag", "management_pivot_18mo_plus_flag <> 0", "has managed rather than programmed for a while"),
    Template("title_skill_mismatch_flag", "title_skill_mismatch_flag <> 0", "lists skills that neither title nor career bear out"),
    Template("marketing_nontech_title_flag", "marketing_nontech_title_flag <> 0", "works as {facts.current_title}, not a technical job"),
    Template("has_github", "has_github <> 0", "publishes code, with an activity of {facts.github_activity_score:0}"),
    Template("title_chasing_flag", "title_chasing_flag <> 0", "moved up by changing jobs every few months"),
    Template("has_python_skill", "has_python_skill = 0", "lists no Python"),
    Template("has_python_skill", "true", "lists Python"),
    Template("highest_education_tier_ord", "true", "holds a {facts.education_degree} in {facts.education_field}"),
    Template("assessment_score_jd_relevant_mean", "num_assessments_taken > 0", "scored {value:0} on average in {num_assessments_taken:0} relevant tests"),
    Template(FLAG, f"{FLAG} <> 0", "the record contradicts itself"),
    *_family_templates(),
]
DIRECTIONS = {"positive": "in favour", "negative": "against"}
LEAD_INS = ["Less convincing: ", "On the other side: ", "To be weighed: "]
NOTHING, ONLY_AGAINST, WARNING = "Nothing about this record stands out.", "Little speaks for this record: ", " Caution: "


def stable_choice(seed: Column, options: list[str]) -> Column:
    """One of three options by the MD5 of the seed; 16 leaves 1 modulo 3, so digits can be added."""
    if len(options) != 3:
        raise ValueError("three options are needed")
    digits = F.transform(F.split(F.md5(seed), ""), lambda c: F.instr(F.lit("0123456789abcdef"), c) - 1)
    total = F.aggregate(digits, F.lit(0), lambda a, d: a + d)
    return F.element_at(F.array(*[F.lit(o) for o in options]), (total % 3 + 1).cast("int"))


def _slot(name: str, digits: str, feature: str, known: set[str]) -> Column:
    """The text of a slot; NULL where its column is absent or empty."""
    column = feature if name == "value" else name
    if not column.startswith("facts.") and column not in known:
        return F.lit(None).cast("string")
    value = F.col(column)
    if digits:
        number = value.cast("double")
        return F.when(number.isNotNull(), F.bround(number).cast("bigint").cast("string") if digits == "0" else F.format_string(f"%.{digits}f", number))
    return F.when(value.isNotNull(), fmt_value(value)) if column == feature else F.nullif(value.cast("string"), F.lit(""))


def render(template: Template, known: set[str]) -> Column:
    """The text of a template for each row, NULL where it does not apply. ``known`` are the row's columns."""
    parts = []
    for text, name, digits, _ in Formatter().parse(template.text):
        if text:
            parts.append(F.lit(text))
        if name:
            parts.append(_slot(name, digits, template.feature, known))
    return F.when(F.expr(template.when), F.concat(*parts))


def clause_columns(features: list[str], direction: str, templates: list[Template]) -> dict[str, Column]:
    """Feature -> clause. Facts are in the struct ``facts``. Templates over columns the row lacks are passed over."""
    known = {*features, FLAG}
    every = {*FEATURE_COLUMNS, FLAG}
    out = {}
    for name in [*features, FLAG]:
        texts = [render(t, known) for t in templates if t.feature == name and not any(
            word in every and word not in known for word in t.when.replace("(", " ").replace(")", " ").split())]
        plain = F.concat(F.lit(name.removesuffix("_flag").replace("_", " ") + ": "), fmt_value(F.col(name)), F.lit(f", {direction}"))
        out[name] = F.coalesce(*texts, F.lit(None).cast("string") if name == FLAG else plain)
    return out


def _drivers(pairs: Column, limit: Column, sign: int) -> Column:
    """Pairs beyond the limit on one side, strongest first, equal ones in column order."""
    kept = F.filter(pairs, lambda p: p["c"] * sign > limit)
    return F.array_sort(F.transform(kept, lambda p: F.struct((p["c"] * -sign).alias("k"), *[p[f].alias(f) for f in ("i", "feature", "c", "clause")])))


def _with_drivers(explained: DataFrame, features: list[str], clauses: dict[str, list[Column]] | None = None) -> DataFrame:
    """Adds ``positive`` and ``negative``: arrays of (k, i, feature, c, clause)."""
    names = F.array(*[F.lit(f) for f in features])
    none = F.lit(None).cast("array<string>")
    sides = {side: F.array(*clauses[side]) if clauses else none for side in ("positive", "negative")}

    def pairs(side: str) -> Column:
        zipped = F.arrays_zip(names.alias("feature"), F.col("contributions").alias("c"), sides[side].alias("clause")) if clauses else (
            F.arrays_zip(names.alias("feature"), F.col("contributions").alias("c")))
        return F.transform(zipped, lambda x, i: F.struct(
            i.alias("i"), x["feature"].alias("feature"), x["c"].alias("c"),
            (x["clause"] if clauses else F.lit(None).cast("string")).alias("clause")))

    limit = F.array_max(F.transform("contributions", F.abs)) * DRIVER_SHARE
    prepared = explained.withColumns({"_limit": limit, "_pos": pairs("positive"), "_neg": pairs("negative")})
    return prepared.withColumns({
        "positive": _drivers(F.col("_pos"), F.col("_limit"), 1), "negative": _drivers(F.col("_neg"), F.col("_limit"), -1),
    }).drop("_limit", "_pos", "_neg")


def top_drivers(explained: DataFrame, features: list[str], n: int | None = None) -> DataFrame:
    """Adds ``positive`` and ``negative``: arrays of (feature, c) above a tenth of the row's greatest contribution.

    Strongest first, equal ones in column order; n limits each array.
    """
    def named(side: str) -> Column:
        pairs = F.transform(side, lambda p: F.struct(p["feature"].alias("feature"), p["c"].alias("c")))
        return F.slice(pairs, 1, n) if n else pairs

    found = _with_drivers(explained, features)
    return found.withColumns({side: named(side) for side in ("positive", "negative")})


_FACTS = (
    "struct<years_of_experience:double,location:string,current_title:string,current_company:string,"
    "notice_period_days:double,recruiter_response_rate:double,willing_to_relocate:boolean,"
    "github_activity_score:double,education_degree:string,education_field:string,top_skill_names:array<string>>"
)


def reason_clauses(explained: DataFrame, facts: DataFrame | None, features: list[str], templates: list[Template] | None = None) -> DataFrame:
    """Adds ``positive_clauses`` and ``negative_clauses`` in order of strength, and ``warning``.

    ``explained`` holds the feature columns and ``contributions`` of the rows to narrate; missing
    values count as 0. ``facts`` may lack rows.
    """
    table = TEMPLATES if templates is None else templates
    flag = F.coalesce(F.col(FLAG).cast("int"), F.lit(0)) if FLAG in explained.columns else F.lit(0)
    wanted = [c for c in explained.columns if c not in features and c != FLAG]
    rows = explained.select(*wanted, *[null_clean(F.col(f)).alias(f) for f in features], flag.alias(FLAG))
    if facts is None:
        rows = rows.withColumn("facts", F.lit(None).cast(_FACTS))
    else:
        rows = rows.join(facts.select(ID, F.struct(*[c for c in facts.columns if c != ID]).alias("facts")), ID, "left")
    said = {side: clause_columns(features, direction, table) for side, direction in DIRECTIONS.items()}
    found = _with_drivers(rows, features, {side: [said[side][f] for f in features] for side in said})
    return found.withColumns({
        **{f"{side}_clauses": F.array_compact(F.transform(side, lambda d: d["clause"])) for side in said},
        "warning": said["positive"][FLAG]})


def _capital(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))


def reason_text(
    explained: DataFrame, facts: DataFrame | None, features: list[str], max_positive: int = 3, max_negative: int = 1,
    max_chars: int = 320, templates: list[Template] | None = None,
) -> DataFrame:
    """(candidate_id, reasoning): what speaks for a row, what against it, and its warning.

    Clauses are left out from the weaker end until the text has at most ``max_chars`` characters; one clause in favour (or
    else against) and the warning always stay.
    """
    rows = reason_clauses(explained, facts, features, templates)
    lead_in = stable_choice(F.col(ID), LEAD_INS)
    warned = F.coalesce(F.concat(F.lit(WARNING), F.col("warning"), F.lit(".")), F.lit(""))

    def version(positive: int, negative: int) -> Column:
        good, bad = F.slice("positive_clauses", 1, positive), F.slice("negative_clauses", 1, negative)
        against = F.array_join(bad, "; ")
        said = F.when(F.size(good) > 0, F.concat(
            _capital(F.array_join(good, "; ")), F.lit("."), F.when(F.size(bad) > 0, F.concat(F.lit(" "), lead_in, against, F.lit("."))).otherwise("")))
        said = said.when(F.size("negative_clauses") > 0, F.concat(
            F.lit(ONLY_AGAINST), F.array_join(F.slice("negative_clauses", 1, max(negative, 1)), "; "), F.lit(".")))
        return F.concat(said.otherwise(NOTHING), warned)

    sizes = [(p, max_negative) for p in range(max_positive, 0, -1)] + [(1, n) for n in range(max_negative - 1, -1, -1)]
    texts = rows.select(ID, F.array(*[version(*size) for size in sizes]).alias("t"))
    fits = F.filter("t", lambda t: F.length(t) <= max_chars)
    return texts.select(ID, F.coalesce(F.get(fits, 0), F.element_at("t", -1)).alias("reasoning"))


def reason_payload(
    explained: DataFrame, facts: DataFrame, features: list[str], max_positive: int = 3, max_negative: int = 2,
    templates: list[Template] | None = None,
) -> DataFrame:
    """(candidate_id, payload, fact_blob, has_concerns): the facts a generated text may use, as JSON and as one text."""
    rows = reason_clauses(explained, facts, features, templates)
    concerns = F.concat(F.array_compact(F.array("warning")), F.slice("negative_clauses", 1, max_negative))
    built = rows.select(ID, F.struct(
        F.col("facts.years_of_experience").alias("years_of_experience"), F.col("facts.current_title").alias("current_title"),
        F.col("facts.current_company").alias("current_company"), F.col("facts.location").alias("location"),
        F.col("facts.top_skill_names").alias("top_skills"), F.slice("positive_clauses", 1, max_positive).alias("strengths"),
        concerns.alias("concerns"), (F.col(FLAG) != 0).alias("is_honeypot_flagged")).alias("p"))
    p = F.col("p")
    listed = F.flatten(F.array(F.coalesce(p["top_skills"], F.array().cast("array<string>")), p["strengths"], p["concerns"]))
    blob = F.lower(F.concat_ws(
        " | ", ID, p["years_of_experience"].cast("string"), p["current_title"], p["current_company"], p["location"],
        F.array_join(listed, " | "), p["is_honeypot_flagged"].cast("string")))
    return built.select(ID, F.to_json("p").alias("payload"), blob.alias("fact_blob"), (F.size(p["concerns"]) > 0).alias("has_concerns"))
