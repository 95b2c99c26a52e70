"""Each hard rule and each calibrated check on hand-made records."""

import pytest

from profilerank.operators import calibrate, integrity, rules

NOW = "2024-02-29"


def role(start="2020-01-01", end="2021-01-01", months=12, company="A", current=False, **more):
    return {"start_date": start, "end_date": end, "duration_months": months, "company": company, "is_current": current, **more}


def person(*roles, years=20, **more):
    return {"profile": {"years_of_experience": years, "headline": "h", "summary": "a summary that is long"}, "career_history": list(roles), **more}


def reasons(pool):
    return rules.rules_flag(pool, NOW).first()["reasons"]


@pytest.mark.parametrize("record,wanted", [
    (person(role()), []),
    (person(role(current=True, months=50)), [rules.CURRENT_HAS_END, rules.DURATION_MISMATCH]),
    (person(role(end="2019-01-01")), [rules.END_BEFORE_START]),
    (person(role(months=14)), []), (person(role(months=15)), [rules.DURATION_MISMATCH]), (person(role(months=10)), []),
    (person(role(months=9)), [rules.DURATION_MISMATCH]), (person(role(months=None)), []), (person(role(start="2020-1-1")), []),
    (person(role(description="The company was founded in 2021.")), [rules.PREDATES_FOUNDING]),
    (person(role(description="Founded in 2020.")), []), (person(role(description="launched in 2019, FOUNDED IN 2021")), [rules.PREDATES_FOUNDING]),
    (person(role(start=None, end=None, current=True), role(start=None, end=None, current=True)), [rules.MULTI_CURRENT]),
    # 61 days of overlap count, 60 do not; the same company does not count.
    (person(role(), role("2020-11-01", "2021-11-01", company="B")), [rules.OVERLAP_ADJACENT]),
    (person(role(), role("2020-11-02", "2021-11-02", company="B")), []),
    (person(role(), role("2020-11-01", "2021-11-01")), []),
    (person(role(company=None), role("2020-11-01", "2021-11-01", company=None)), []),
    # Only neighbours by start date are compared, and a past role without an end is left out.
    (person(role("2018-01-01", "2022-01-01", 48, "A"), role("2018-02-01", "2018-03-01", 1, "A"), role("2018-04-01", "2018-05-01", 1, "B")), []),
    (person(role("2023-01-01", None, 13, "A", True), role("2023-06-01", None, 8, "B")), []),
    (person(role("2023-01-01", None, 13, "A", True), role("2023-12-01", "2024-02-01", 2, "B")), [rules.OVERLAP_ADJACENT]),
    (person(role(), education=[{"start_year": 2010, "end_year": 2009}, {"start_year": 2010, "end_year": 2010}, {"start_year": 2012, "end_year": 2011}]), [rules.EDU_REVERSED] * 2),
    (person(role(None, None, 28), years=1), [rules.SINGLE_ROLE_EXCEEDS]),
    (person(role(None, None, 14), role(None, None, 14), years=1), []),
    (person(role(None, None, 14), role(None, None, 15), years=1), [rules.HISTORY_EXCEEDS]),
    (person(role(None, None, 24), years=1), []), (person(role(None, None, 25), years=1), [rules.SINGLE_ROLE_EXCEEDS]),
    (person(role(None, None, 500), years=None), []),
    (person(skills=[{"proficiency": "expert", "duration_months": d} for d in (0, 1, 2, None)] + [{"proficiency": "EXPERT", "duration_months": 0}]), [rules.EXPERT_ZERO] * 3),
    (person(skills=[{"proficiency": "beginner", "duration_months": d} for d in (600, 601)]), [rules.SKILL_OVER_MAX]),
    ({"profile": {"headline": "h", "summary": " 12345678901234 "}, "signals": {"profile_completeness_score": 95}}, [rules.COMPLETE_BUT_EMPTY]),
    ({"profile": {"headline": "h", "summary": "123456789012345"}, "signals": {"profile_completeness_score": 95}}, []),
    ({"profile": {"headline": " \t", "summary": "123456789012345"}, "signals": {"profile_completeness_score": 95}}, [rules.COMPLETE_BUT_EMPTY]),
    ({"profile": {"headline": "", "summary": ""}, "signals": {"profile_completeness_score": 94}}, []),
    ({}, []),
])
def test_rule(records, record, wanted):
    assert reasons(records(record)) == wanted


def test_flag_and_histogram(records):
    flags = rules.rules_flag(records(person(role(months=30)), person(role()), person(role(end="2019-01-01"), role(end="2019-01-01"))), NOW)
    assert [(r["honeypot_flag"], r["hit_count"]) for r in flags.orderBy("candidate_id").collect()] == [(True, 1), (False, 0), (True, 2)]
    assert [tuple(r) for r in rules.rule_histogram(flags).collect()] == [(rules.END_BEFORE_START, 2), (rules.DURATION_MISMATCH, 1)]
    assert tuple(rules.flagged_share(flags).first()) == (3, 2, 66.67)


def test_metrics(records):
    rows = integrity.integrity_metrics(records(
        person(role("2020-01-15", "2021-01-14", 12), role("2021-01-20T00:00", "", 37, current=True), years=10,
               skills=[{"proficiency": "expert", "duration_months": 0}, {"proficiency": "Expert", "duration_months": 0}, {"proficiency": "expert", "duration_months": 1}]),
        {}), NOW).orderBy("candidate_id").collect()
    first, empty = rows
    assert (first["span_months"], first["max_role_months"], first["zero_expert_count"], first["overlap_months"]) == (49, 37.0, 1, [])
    assert first["gap_years"] == pytest.approx(10 - 49 / 12)
    assert (empty["span_months"], empty["max_role_months"], empty["gap_years"], empty["zero_expert_count"], empty["history_entries"]) == (None, None, None, 0, 0)


@pytest.mark.parametrize("years,tripped", [(3.0, False), (3.01, True)])
def test_gap_is_strict(records, years, tripped):
    checked = integrity.integrity_checks(integrity.integrity_metrics(records(person(role(), years=years)), NOW)).first()
    assert checked["gap_exceeds"] is tripped and checked["any_check"] is tripped
    assert checked["tripped"] == (["CAREER_SPAN_EXCEEDS_EXPERIENCE"] if tripped else [])


def test_overlaps(records):
    pool = records(person(role("2020-01-01", "2021-01-01"), role("2020-10-01", "2022-01-01", 15), role("2020-12-15", "2021-01-10", 1), role("2022-01-01", "2022-02-01", 1)))
    pairs = [tuple(r)[1:4] for r in integrity.interval_overlap_pairs(pool, NOW).orderBy("i", "j").collect()]
    assert pairs == [(0, 1, 3)]  # under one month is dropped, touching is no overlap
    checked = integrity.integrity_checks(integrity.integrity_metrics(pool, NOW), integrity.Thresholds(min_overlap_months=4)).first()
    assert not checked["overlap_exceeds"]


def test_reference_dates(records):
    pool = records(
        {"career_history": [role("2020-01-01", "2021-05-05T00:00")], "signals": {"signup_date": "2020-02-02"}},
        {"profile": {"summary": "2023-03-03 is in a text"}, "skills": [{"name": "2022-01-01"}]})
    assert calibrate.ref_date_fields(pool).first()[0].isoformat() == "2021-05-05"
    assert calibrate.ref_date_fields(pool, strict=True).first()[0].isoformat() == "2020-02-02"
    assert calibrate.reference_date(pool) == "2023-03-03"
    assert calibrate.reference_date(pool, override="2030-01-01") == "2030-01-01"
    nothing = records({})
    assert calibrate.ref_date_fields(nothing).first()[0].isoformat() == "2026-01-01"
    assert calibrate.ref_date_fields(nothing, strict=True).first()[0].isoformat() == "1970-01-01"
    with pytest.raises(ValueError):
        calibrate.reference_date(nothing)


def test_summary_against_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    data = {"a": rng.integers(0, 5, 1000).astype(float), "b": np.round(rng.normal(size=333), 2), "c": np.array([7.0])}
    rows = [(k, float(x)) for k, xs in data.items() for x in xs]
    got = {r["metric"]: r for r in calibrate.summary_dist(spark.createDataFrame(rows, "metric string, value double")).collect()}
    for k, xs in data.items():
        assert got[k]["count"] == len(xs)
        assert got[k]["mean"] == pytest.approx(xs.mean(), abs=6e-4) and got[k]["std"] == pytest.approx(xs.std(), abs=6e-4)
        for p in calibrate.PERCENTILES:
            assert got[k][calibrate.percentile_name(p)] == pytest.approx(np.percentile(xs, p), abs=6e-4)


def test_thresholds(spark):
    summaries = spark.createDataFrame(
        [("gap_years", 0.522, 0.433, 0.35), ("single_role_excess_years", 4.0, 4.0, 4.0), ("zero_expert_count", 0.0, 0.0, 0.0)],
        "metric string, p99_9 double, p99 double, p95 double")
    calibrated = calibrate.calibrate_thresholds(summaries)
    assert tuple(calibrated.first()) == (2.0, 4.0, None, 1)
    assert calibrate.thresholds_resolve(calibrated) == integrity.Thresholds(2.0, 4.0, 3, 1)
    assert calibrate.thresholds_resolve(calibrated, min_overlap_months=9).min_overlap_months == 9
    assert calibrate.thresholds_resolve() == integrity.Thresholds()


def test_disagreement(spark, records):
    checks = integrity.integrity_checks(integrity.integrity_metrics(records(person(role(), years=9), person(role(), years=1)), NOW))
    verdicts = spark.createDataFrame([("CAND_0000000", False), ("CAND_0000001", False)], "candidate_id string, is_honeypot boolean")
    assert [r["candidate_id"] for r in integrity.verdict_disagree(verdicts, checks).collect()] == ["CAND_0000000"]
