"""Answers in waves, passes, grades, splits, metrics, relevance, models and explanations."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from profilerank.operators import checks, evaluate, explain, labels, model, relevance, responses
from profilerank.schema import ID


def ident(i):
    return f"CAND_{i:07d}"


def test_waves_ask_only_for_failures(spark):
    def scorer(texts):
        return ['{"is_honeypot": false}' if "good" in t else "?" for t in texts]

    rows = spark.createDataFrame([(ident(0), "good"), (ident(1), "bad")], "candidate_id string, doc_text string")
    answers = responses.pointwise_apply(rows, scorer, responses.with_verdict, max_retries=2)
    assert {r[ID]: (r["attempt"], r["result"] is None) for r in answers.collect()} == {ident(0): (0, False), ident(1): (2, True)}
    flat = {r[ID]: r for r in responses.fallback_row(answers, verdict=True).collect()}
    assert flat[ident(1)]["fallback"] and not flat[ident(1)]["is_honeypot"] and flat[ident(1)]["fallback_answer"] == "?"
    assert not flat[ident(0)]["fallback"]


def test_passes(spark):
    schema = ("candidate_id string, pass int, retrieval_score int, evaluation_score int, applied_ml_score int, credibility_score int, "
              "bonus_score int, hard_disqualifier boolean, disqualifier_reason string, brief_rationale string")
    rows = [("a", 2, 3, 10, 10, 1, 1, True, "second", "two"), ("a", 1, 2, 10, 10, 0, 1, False, "ignored", "one"), ("a", 3, 2, 11, 10, 0, 1, True, "third", "three"),
            ("b", 1, 5, 5, 5, 5, 5, False, None, None)]
    got = {r[ID]: r for r in responses.avg_passes(spark.createDataFrame(rows, schema)).collect()}
    assert (got["a"]["retrieval_score"], got["a"]["evaluation_score"], got["a"]["total_score"]) == (2, 10, 20)
    assert (got["a"]["disqualifier_reason"], got["a"]["brief_rationale"], got["b"]["brief_rationale"], got["b"]["total_score"]) == ("second", "one", "", 25)
    halves = [("a", n, v, 0, 0, 0, 0, False, None, None) for n, v in enumerate((2, 3))]
    assert responses.avg_passes(spark.createDataFrame(halves, schema)).first()["retrieval_score"] == 2


def test_split_counts(spark):
    # The published sizes of a set of 10,000 labels at 15 percent.
    sizes = {0: 9000, 1: 850, 2: 100, 3: 25, 4: 15, 5: 5, 6: 5}
    rows = [(ident(i), g) for i, g in enumerate(g for g, n in sizes.items() for _ in range(n))]
    split = labels.stratified_split(spark.createDataFrame(rows, "candidate_id string, relevance_grade int"))
    counted = {(r["split"], r["grade"]): r["n"] for r in labels.grade_histogram(split, by=("split",)).collect()}
    assert [counted["val", g] for g in range(7)] == [1350, 128, 15, 4, 2, 1, 1]
    assert [counted["train", g] for g in range(7)] == [7650, 722, 85, 21, 13, 4, 4]
    again = labels.stratified_split(spark.createDataFrame(rows[::-1], "candidate_id string, relevance_grade int"))
    assert split.select(ID, "split").exceptAll(again.select(ID, "split")).count() == 0


def test_single_row_stays_in_training(spark):
    split = labels.stratified_split(spark.createDataFrame([(ident(0), 6), (ident(1), 5), (ident(2), 5)], "candidate_id string, relevance_grade int"))
    assert sorted((r["relevance_grade"], r["split"]) for r in split.collect()) == [(5, "train"), (5, "val"), (6, "train")]


def test_labels(spark):
    ranks = labels.rank_cap(spark.createDataFrame([("a", "1"), ("b", "7"), ("c", "x"), ("d", "2000"), (None, "3")], "candidate_id string, rank string"), max_rank=1500)
    flags = labels.flagged_ids(spark.createDataFrame([("a", "no", "2"), ("b", "", "0"), ("e", "YES", None)], "candidate_id string, honeypot_flag string, hits string"), hits="hits")
    known = labels.grade_labels(ranks, flags)
    assert {tuple(r) for r in known.collect()} == {("a", 1, 0, 1), ("b", 7, 5, 0)}
    pool = spark.createDataFrame([(x,) for x in "abef"], "candidate_id string")
    assert {tuple(r) for r in labels.pseudo_label_union(known, pool, flags, grade=1).collect()} == {("a", 1, 0, 1), ("b", 7, 5, 0), ("e", None, 0, 1), ("f", None, 1, 0)}


def numpy_metrics(grades, scores):
    order = sorted(range(len(grades)), key=lambda i: (-scores[i], i))
    rel = [grades[i] for i in order]

    def ndcg(k):
        gain = lambda xs: sum((2 ** x - 1) / math.log2(n + 2) for n, x in enumerate(xs[:k]))
        best = gain(sorted(rel, reverse=True))
        return gain(rel) / best if best else 0.0

    hit = [int(x >= 3) for x in rel]
    precision = [sum(hit[:n + 1]) / (n + 1) for n in range(len(hit))]
    ap = sum(p * h for p, h in zip(precision, hit)) / sum(hit) if sum(hit) else 0.0
    return ndcg(10), ndcg(50), ap, float(np.mean(hit[:10]))


@pytest.mark.parametrize("n,top", [(400, 6), (7, 6), (100, 2), (30, 0)])
def test_metrics(spark, n, top):
    rng = random.Random(n)
    grades, scores = [rng.randint(0, top) for _ in range(n)], [float(rng.randrange(9)) for _ in range(n)]
    df = spark.createDataFrame([(ident(i), s, g) for i, (g, s) in enumerate(zip(grades, scores))], "candidate_id string, s double, g int")
    row = evaluate.evaluate(df, "s", "g").first()
    wanted = numpy_metrics(grades, scores)
    assert [row["ndcg_10"], row["ndcg_50"], row["map"], row["p_10"]] == pytest.approx(list(wanted))
    assert row["composite"] == pytest.approx(0.5 * wanted[0] + 0.3 * wanted[1] + 0.15 * wanted[2] + 0.05 * wanted[3])
    assert 0 <= row["composite"] <= 1


def test_pseudo_metrics_count_missing_as_zero(spark):
    predicted = spark.createDataFrame([("a", 3.0), ("b", 2.0), ("c", 1.0)], "candidate_id string, predicted_score double")
    row = evaluate.metric_pseudo(predicted, spark.createDataFrame([("b", 4)], "candidate_id string, relevance_grade int")).first()
    assert row["map"] == 0.5 and row["p_5"] == pytest.approx(1 / 3) and row["ndcg_all"] == pytest.approx(1 / math.log2(3))


def test_relevance(spark):
    docs = [("a", "red fox"), ("b", "Red red-red bird"), ("c", "...blue"), ("d", ""), ("e", None), ("f", "redfox")]
    got = {r[ID]: r["score"] for r in relevance.relevance_score(spark.createDataFrame(docs, "candidate_id string, doc_text string"), "Red FOX red").collect()}
    lengths = {"a": 2, "b": 4, "c": 1, "d": 0, "e": 0, "f": 1}
    mean = sum(lengths.values()) / 6

    def part(tf, df, length):
        return math.log(1 + (6 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))

    assert got["a"] == pytest.approx(part(1, 2, 2) + part(1, 1, 2)) and got["b"] == pytest.approx(part(3, 2, 4))
    assert [got[x] for x in "cdef"] == [0.0] * 4
    counts = {r[ID]: r["length"] for r in relevance.term_counts(spark.createDataFrame(docs, "candidate_id string, doc_text string"), ["red"], ID, "doc_text").collect()}
    assert counts == lengths


def test_coerce(spark):
    df = spark.createDataFrame([("a", "3", "x", None), ("b", None, "2.5", "4")], "candidate_id string, c string, v string, w string")
    got = {r[ID]: tuple(r)[1:] for r in model.coerce_features(df, ["c", "v", "w", "gone"], ["c"]).collect()}
    assert got == {"a": (3.0, None, None, None), "b": (-1.0, 2.5, 4.0, None)}


def explained(spark, contributions, **values):
    base = {"experience_band_fit": 0.9, "location_tier": 3, "saved_by_recruiters_30d": 4.0, "retrieval_embeddings_inflation_gap": 2}
    base.update(values)
    names = list(base)
    schema = "candidate_id string, contributions array<double>, " + ", ".join(f"{n} double" for n in names) + ", honeypot_flag int"
    flag = base.pop("honeypot_flag", 0)
    names = [n for n in names if n != "honeypot_flag"]
    schema = "candidate_id string, contributions array<double>, " + ", ".join(f"{n} double" for n in names) + ", honeypot_flag int"
    return spark.createDataFrame([(ident(7), [float(c) for c in contributions], *[None if base[n] is None else float(base[n]) for n in names], flag)], schema), names


def facts(spark, **values):
    base = {"years_of_experience": 6.0, "location": "Pune", "current_title": "Engineer", "current_company": "Acme", "notice_period_days": 15.0,
            "recruiter_response_rate": 0.5, "willing_to_relocate": True, "github_activity_score": 10.0, "education_degree": None, "education_field": None,
            "top_skill_names": ["Python"]}
    base.update(values)
    schema = ("candidate_id string, years_of_experience double, location string, current_title string, current_company string, notice_period_days double, "
              "recruiter_response_rate double, willing_to_relocate boolean, github_activity_score double, education_degree string, education_field string, top_skill_names array<string>")
    return spark.createDataFrame([(ident(7), *base.values())], schema)


def reason(spark, contributions, known=None, **values):
    df, names = explained(spark, contributions, **values)
    return explain.reason_text(df, known, names).first()["reasoning"]


def test_reason_with_facts(spark):
    place, years = "Lives in Pune, where the role is", "6.0 years in the job suit the role"
    assert reason(spark, [0.5, 2.0, 0.1, 0.0], facts(spark)) == f"{place}; {years}."
    text = reason(spark, [0.5, 2.0, 0.1, -1.0], facts(spark))
    lead_in = next(w for w in explain.LEAD_INS if w in text)
    assert text.startswith(f"{place}; {years}. {lead_in}") and len(text) <= 320


def test_reason_small_drivers_are_left_out(spark):
    assert reason(spark, [0.0, 0.0, 1.0, 0.1]) == "Saved by recruiters 30d: 4, in favour."
    assert reason(spark, [0.0, 0.0, 0.0, 0.0]) == reason(spark, [0.0, 0.0, 0.0, 0.0], facts(spark)) == explain.NOTHING


def test_reason_with_nothing_in_favour(spark):
    assert reason(spark, [0, 0, -1.0, 0], saved_by_recruiters_30d=2.5) == explain.ONLY_AGAINST + "saved by recruiters 30d: 2.50, against."


def test_reason_warning_comes_last(spark):
    assert reason(spark, [0, 0, 1.0, 0], honeypot_flag=1) == "Saved by recruiters 30d: 4, in favour. Caution: the record contradicts itself."


def test_reason_missing_values_are_zero(spark):
    assert reason(spark, [0, 0, 1.0, 0], saved_by_recruiters_30d=None) == "Saved by recruiters 30d: 0, in favour."


def test_reason_length_is_kept_by_fewer_clauses(spark):
    df, names = explained(spark, [1.0, 2.0, -3.0, 4.0])
    long = explain.reason_text(df, facts(spark), names).first()["reasoning"]
    short = explain.reason_text(df, facts(spark), names, max_chars=len(long) - 1).first()["reasoning"]
    assert len(short) < len(long) and short.endswith(".")


def test_reason_with_own_templates(spark):
    df, names = explained(spark, [0.0, 0.0, 1.0, 0.0])
    own = [explain.Template("saved_by_recruiters_30d", "saved_by_recruiters_30d > 3", "kept by {value:1} people in {facts.location}")]
    assert explain.reason_text(df, facts(spark), names, templates=own).first()["reasoning"] == "Kept by 4.0 people in Pune."
    assert explain.reason_text(df, None, names, templates=own).first()["reasoning"] == "Saved by recruiters 30d: 4, in favour."


def test_payload_grounds_its_own_text(spark):
    from profilerank.functions.grounding import ground_numbers
    df, names = explained(spark, [0.5, 2.0, 0.1, -1.0])
    payload = explain.reason_payload(df, facts(spark), names)
    row = payload.join(explain.reason_text(df, facts(spark), names), ID).select("has_concerns", "payload", ground_numbers(F.lower("reasoning"), F.col("fact_blob")).alias("ok")).first()
    assert row["has_concerns"] and row["ok"] and '"top_skills":["Python"]' in row["payload"]


def result(spark, rows):
    return spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "row_num int, candidate_id string, rank string, score string, reasoning string")


def good_rows():
    return [[ident(i), str(i), str(round(1 - i / 1000, 3)), "r"] for i in range(1, 101)]


@pytest.mark.parametrize("row,cell,value,rules", [
    (3, 0, "", {"id_missing"}), (3, 0, "CAND_12", {"id_pattern"}), (3, 0, ident(1), {"id_duplicate"}), (3, 1, "4.0", {"rank_not_integer", "rank_missing"}),
    (3, 1, "04", {"rank_not_integer", "rank_missing"}), (99, 1, "101", {"rank_out_of_range", "rank_missing"}), (99, 1, "99", {"rank_duplicate", "rank_missing"}),
    (3, 2, "high", {"score_not_float"}), (3, 2, "0.1", {"score_increases"}), (3, 2, "1e-3", {"score_increases"}), (0, 0, ident(999), set()),
])
def test_result_checks(spark, row, cell, value, rules):
    rows = good_rows()
    rows[row][cell] = value
    assert {r["rule"] for r in checks.result_validate(result(spark, rows)).collect()} == rules


def test_result_ties_and_counts(spark):
    rows = good_rows()
    rows[4][2] = rows[5][2]
    rows[4][0], rows[5][0] = rows[5][0], rows[4][0]
    assert [tuple(r) for r in checks.result_validate(result(spark, rows)).collect()] == [("tie_order", "5")]
    assert {r["rule"] for r in checks.result_validate(result(spark, good_rows()[:99])).collect()} == {"row_count", "rank_missing"}
    assert checks.result_validate(result(spark, good_rows())).count() == 0


def test_a_call_holds_its_own_texts_only():
    """The texts of an Arrow batch become Python objects call by call, and answers leave before the next call."""
    asked = []

    def scorer(texts):
        asked.append(texts)
        return [None if t is None else t.upper() for t in texts]

    batch = pa.RecordBatch.from_pydict({ID: list("abcde"), "t": ["x", None, "y", "z", ""]})
    run = responses._call(scorer, "t", 2)(iter([batch]))
    first = next(run)
    assert asked == [["x", None]] and first.to_pylist() == [{ID: "a", "raw": "X"}, {ID: "b", "raw": None}]
    assert [r["raw"] for b in run for r in b.to_pylist()] == ["Y", "Z", ""] and len(asked) == 3
    with pytest.raises(ValueError):
        list(responses._call(lambda texts: [], "t", 2)(iter([batch])))
