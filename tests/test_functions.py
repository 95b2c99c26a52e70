"""Column functions on hand-made values."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from profilerank.functions import dates, grounding, keywords, numbers, ordinals, responses, text
from profilerank.operators import responses as response_ops


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n int, " + schema).orderBy("n").select(*columns).collect()]


def test_dates(spark):
    texts = ["2024-01-05", "2024-1-5", "2024-02-30", "2024-01-05T10:00", " 2024-01-05", "", None, "20240105"]
    got = values(spark, [(t,) for t in texts], "t string", dates.date_parse_strict(F.col("t")), dates.date_parse_prefix(F.col("t")))
    day = dt.date(2024, 1, 5)
    assert got == [(day, day), (None, None), (None, None), (None, day), (None, None), (None, None), (None, None), (None, None)]


def test_months(spark):
    pairs = [("2020-01-31", "2020-02-29"), ("2020-01-15", "2020-03-15"), ("2020-03-01", "2020-01-01"), ("2019-12-31", "2020-01-01"), (None, "2020-01-01")]
    rows = [tuple(dt.date.fromisoformat(x) if x else None for x in p) for p in pairs]
    got = values(spark, rows, "a date, b date", dates.months_cal(F.col("a"), F.col("b")), dates.months_whole(F.col("a"), F.col("b")))
    assert got == [(1, 0), (2, 2), (-2, 0), (1, 0), (None, None)]


def test_numbers(spark):
    got = values(spark, [(2.5,), (3.5,), (None,), (-4.0,), (99.0,)], "x double",
                 numbers.half_even(F.col("x")), numbers.clamp(F.col("x"), 0, 30), numbers.number_text(F.col("x")), numbers.fmt_value(F.col("x")))
    assert got == [(2.0, 2.5, "2.5", "2.50"), (4.0, 3.5, "3.5", "3.50"), (None, None, "", "unknown"), (-4.0, 0.0, "-4", "-4"), (99.0, 30.0, "99", "99")]


def test_flags(spark):
    got = values(spark, [(x,) for x in [" TRUE", "1", "yes ", "False", "0", "no", "", "maybe", None]], "x string", numbers.flag_parse(F.col("x")))
    assert [g[0] for g in got] == [True, True, True, False, False, False, None, None, None]


@pytest.mark.parametrize("title,level", [
    ("software engineer", 2), ("junior developer", 1), ("senior engineer", 3), ("sr. engineer", 3), ("staff engineer", 4),
    ("engineering manager", 5), ("junior manager", 5), ("", 2), (None, 2), ("internal tools", 2),
])
def test_seniority(spark, title, level):
    assert values(spark, [(title,)], "t string", ordinals.seniority_level(F.col("t"))) == [(level,)]


def test_location(spark):
    rows = [("Pune, MH", "India"), ("New Delhi", "India"), ("Bengaluru", None), ("Jaipur", "India"), ("Berlin", "Germany"), (None, "IN"), (None, None)]
    got = values(spark, rows, "a string, b string", ordinals.location_tier(F.col("a"), F.col("b")))
    assert [g[0] for g in got] == [3, 2, 1, 0, -1, 0, -1]


def test_experience(spark):
    got = values(spark, [(x,) for x in [0.0, 2.5, 5.0, 9.0, 14.0, 19.0, 30.0, None]], "x double", ordinals.experience_fit(F.col("x")))
    assert [g[0] for g in got] == [0.0, 0.5, 1.0, 1.0, 0.5, 0.0, 0.0, 0.0]


def test_grades(spark):
    ranks = [1, 5, 6, 10, 11, 25, 26, 50, 51, 150, 151, 1000, 1001]
    got = values(spark, [(r,) for r in ranks], "r int", ordinals.rank_to_grade(F.col("r")), ordinals.label_gain(ordinals.rank_to_grade(F.col("r"))))
    assert [g[0] for g in got] == [6, 6, 5, 5, 4, 4, 3, 3, 2, 2, 1, 1, 0]
    assert got[0][1] == 63.0 and got[-1][1] == 0.0


LINES = [
    "rag over openai embeddings and sentence-transformers with bge, e5, word2vec, doc2vec and faiss",
    "bi-encoder and crossencoder, dense retrieval, semantic search, vector search, retrieval augmented",
    "ann based fast search; approximate nearest neighbour; ann index; hybrid search; vector database",
    "pinecone weaviate qdrant milvus opensearch elasticsearch", "ndcg mrr mean average precision map@10 precision@5 p@10 recall@50",
    "a/b tests, ab testing, offline to online correlation, offline evaluation, learning-to-rank", "lockra lora qlora peft adapter tuning fine-tuned",
    "lambdamart xgboost for ranking listwise ranking pairwise ranking neural ranker", "kubernetes k8s multi-gpu triton vllm tensorrt",
    "model serving inference optimisation 500 qps latency under slo", "open source github published a paper conference talk tech talk blog post",
    "contributed to and maintainer of", "nlp natural language processing information retrieval search ranking text classification topic models",
    "named entity ner computer vision opencv image classification object detection", "speech recognition asr robotics autonomous driving lidar slam",
    "production deployed shipped to real users at scale millions of queries live system traffic", "postdoc ph.d. research scientist academic lab academia published my paper",
    "machine learning deep learning recommendation system classifier regression model", "langchain openai api gpt-4 chatgpt anthropic llm",
    "code review ci/cd continuous integration unit tests test coverage", "hr tech recruiting talent marketplace two-sided ats job board candidate matching",
    "marketing sales account manager human resources hr generalist finance business analyst", "architect tech lead head of director vp manager engineering manager",
    "senior staff principal lead", "storage ragtime planner dinner embedded bigband that's cats", "dîner élora ragoût naïve ndcgé", "",
]


def test_patterns_match_as_in_python(spark):
    every = sorted({p for family in keywords.FAMILIES.values() for p in family})
    assert len([p for family in keywords.FAMILIES.values() for p in family]) == 145
    found = spark.createDataFrame([(i, line) for i, line in enumerate(LINES)], "n int, t string").withColumn("w", keywords.token_hits("t", every))
    for tokens in (None, "w"):
        got = [tuple(r) for r in found.orderBy("n").select(*[keywords.kw_any("t", [p], tokens).alias(f"p{i}") for i, p in enumerate(every)]).collect()]
        for line, row in zip(LINES, got):
            wanted = tuple(bool(re.search(p, line, re.IGNORECASE)) for p in every)
            assert row == wanted, (line, [p for p, a, b in zip(every, row, wanted) if a != b])
    assert all(any(row[i] for row in got) for i in range(len(every)))


def test_required_literal_is_in_every_match():
    for family in keywords.FAMILIES.values():
        for pattern in family:
            literal = keywords.required_literal(pattern)
            for line in LINES:
                if found := re.search(pattern, line):
                    assert literal in found.group(0)


@pytest.mark.parametrize("pattern,token", [
    (r"\brag\b", "rag"), (r"\bdense retrieval\b", "retrieval"), (r"\bembeddings?\b", None), (r"machine learning", None),
    (r"\bann\b.{0,15}\bsearch\b", "search"), (r"\bmap@\d+", "map"), (r"\bci/cd\b", "ci"), (r"\ba/b test", "a"), (r"\btopic model", "topic"),
    (r"autonomous (vehicle|driving)", None), (r"\be5\b", "e5"),
])
def test_required_token(pattern, token):
    assert keywords.required_token(pattern) == token


def test_hits_count_patterns_not_occurrences(spark):
    got = values(spark, [("rag rag rag",), (None,), ("",)], "t string", keywords.kw_hits("t", [r"\brag\b", r"\bfaiss\b"]))
    assert [g[0] for g in got] == [1, 0, 0]


def test_range_text(spark):
    rows = [((10.0, 20.5),), ((None, 20.0),), ((None, None),), (None,)]
    got = values(spark, rows, "s struct<min:double,max:double>", text.fmt_range(F.col("s")))
    assert [g[0] for g in got] == ["10-20.5 LPA", "?-20 LPA", "unspecified", "unspecified"]


def test_extract_object(spark):
    raws = ['x {"a": 1} y', '<think>{"a": 0}</think>{"a": 1}', '```json\n{"a": {"b": 1}}\n```', "none", None, "} {", '<think> {"a": 2}']
    got = values(spark, [(r,) for r in raws], "r string", responses.json_extract_object(F.col("r")))
    assert [g[0] for g in got] == ['{"a": 1}', '{"a": 1}', '{"a": {"b": 1}}', None, None, None, '{"a": 2}']


GOOD = '"retrieval_score": 30, "evaluation_score": 20, "applied_ml_score": 25, "credibility_score": 15, "bonus_score": 10'


@pytest.mark.parametrize("raw,total", [
    ("{%s}" % GOOD, 100), ("{%s, \"hard_disqualifier\": true}" % GOOD, 20), ("{%s, \"hard_disqualifier\": null}" % GOOD, 100),
    ("{%s, \"hard_disqualifier\": \"false\"}" % GOOD, None), ("{%s} {}" % GOOD, None), ("{%s" % GOOD, None),
    ("{%s}" % GOOD.replace("30", "true"), None), ("{%s}" % GOOD.replace("30", "null"), None), ("{%s}" % GOOD.replace("30", '"30"'), None),
    ("{%s}" % GOOD.replace("30", "2.5"), 72), ("{%s}" % GOOD.replace("30", "3.5"), 74), ("{%s}" % GOOD.replace("30", "-7"), 70),
    ("{%s}" % GOOD.replace("30", "1000"), 100), ("[%s]" % GOOD, None),
])
def test_scores(spark, raw, total):
    df = response_ops.with_score(spark.createDataFrame([("CAND_0000001", raw)], "candidate_id string, raw string"))
    row = df.first()["result"]
    assert (row["total_score"] if row else None) == total


@pytest.mark.parametrize("raw,flag", [
    ('{"is_honeypot": false, "violation_category": "X", "evidence": "e"}', (False, None, None)),
    ('{"is_honeypot": true, "violation_category": "INVALID_EDUCATION_DATES", "evidence": " e "}', (True, "INVALID_EDUCATION_DATES", "e")),
    ('{"is_honeypot": true, "violation_category": "INVALID_EDUCATION_DATES", "evidence": " "}', None),
    ('{"is_honeypot": true, "violation_category": "X", "evidence": "e"}', None), ('{"is_honeypot": 1}', None), ("{}", None), (None, None),
])
def test_verdicts(spark, raw, flag):
    df = response_ops.with_verdict(spark.createDataFrame([("CAND_0000001", raw)], "candidate_id string, raw string"))
    row = df.first()["result"]
    assert (tuple(row)[:3] if row else None) == flag


def test_grounding(spark):
    blob = "6.5 years | senior ml engineer | acme search | pune | knows faiss"
    cases = [
        ("Six years at Acme Search, 6.5 in all.", False, True), ("Has 7 years.", False, False), ("The Big Corp hired them.", False, False),
        ("Works with FAISS and AI.", False, True), ("Works with BERT.", False, False), ("Fine profile.", True, False),
        ("Fine profile, but short.", True, True), ("", False, False), ("x" * 361, False, False), ("x" * 360, False, True),
    ]
    got = values(spark, [(t, blob, c) for t, c, _ in cases], "t string, b string, c boolean", grounding.grounded(F.col("t"), F.col("b"), F.col("c")))
    assert [g[0] for g in got] == [w for *_, w in cases]


def test_text_clean(spark):
    raws = ['"Quoted."', "Sure, here it is", "Here's the note: Good fit", "note: Good", "Noted well", "  plain  "]
    got = values(spark, [(r,) for r in raws], "t string", grounding.text_clean(F.col("t")))
    assert [g[0] for g in got] == ["Quoted.", "here it is", "Good fit", "Good", "Noted well", "plain"]


def test_stable_choice(spark):
    import hashlib

    from profilerank.operators.explain import stable_choice
    rng = random.Random(3)
    ids = [f"CAND_{rng.randrange(10 ** 7):07d}" for _ in range(200)]
    got = values(spark, [(i,) for i in ids], "t string", stable_choice(F.col("t"), ["a", "b", "c"]))
    assert [g[0] for g in got] == ["abc"[int(hashlib.md5(i.encode()).hexdigest(), 16) % 3] for i in ids]
