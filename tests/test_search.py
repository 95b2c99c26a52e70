"""Many queries against many documents, vectors in cells, and overlaps of flat tables, against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from profilerank.operators import evaluate, integrity, relevance
from profilerank.plans import catalog


def _plain_topk(docs, queries, k):
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    words = {i: Counter(split(t)) for i, t in docs}
    lengths = {i: sum(c.values()) for i, c in words.items()}
    mean = sum(lengths.values()) / len(docs)
    frequency = Counter(w for c in words.values() for w in c)
    out = []
    for q, text in queries:
        scores = []
        for i, c in words.items():
            own = [(w, c[w]) for w in set(split(text)) if w in c]
            if own:
                scale = 1.2 * (0.25 + 0.75 * lengths[i] / mean)
                s = sum(math.log(1 + (len(docs) - frequency[w] + 0.5) / (frequency[w] + 0.5)) * f * 2.2 / (f + scale) for w, f in own)
                scores.append((-round(s, 9), i))
        out += [(q, i, round(-s, 6), pos) for pos, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("k", [1, 5, 60])
def test_topk_is_exact(spark, k):
    """Words of very different frequency, one of them in every third document, ties and queries without a hit."""
    rng = random.Random(k)
    vocabulary = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 60)) + ["hot"] * (i % 3 == 0))) for i in range(700)]
    docs += [(1000 + i, "twin words here") for i in range(20)] + [(2000, None), (2001, "")]
    queries = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 12)) + ["hot"])) for i in range(25)]
    queries += [(100, "twin here"), (101, "nothing at all"), (102, None), (103, "W0 w0, hot!")]
    found = relevance.relevance_topk(
        spark.createDataFrame(docs, "doc_id int, text string").repartition(4), spark.createDataFrame(queries, "item_id int, text string"), k).collect()
    assert sorted((r["item_id"], r["doc_id"], round(r["score"], 6), r["pos"]) for r in found) == _plain_topk(docs, queries, k)


def test_topk_scores_few_documents_of_common_words(spark):
    """A word that every document has cannot bring one into the result, so what is scored follows the rare word."""
    docs = spark.createDataFrame([(i, "common " + ("rare " if i < 40 else "") + f"x{i}") for i in range(3000)], "doc_id int, text string")
    queries = spark.createDataFrame([(0, "common rare")], "item_id int, text string")
    index, bounds = relevance.inverted_index(docs, queries.selectExpr("explode(split(text, ' ')) AS word"), "doc_id", "text")
    assert {r["word"]: r["n"] for r in bounds.collect()} == {"common": 3000, "rare": 40} and index.count() == 3040
    assert {r["doc_id"] for r in relevance.relevance_topk(docs, queries, 10).collect()} == set(range(10))


def test_nearest_vectors(spark, monkeypatch):
    monkeypatch.setattr(relevance, "PART_ROWS", 50)  # so that cells are dealt into parts
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16)) * 3
    rows = centres[rng.integers(0, 12, 900)] + rng.normal(size=(900, 16))
    rows[:300] = centres[0] + rng.normal(size=(300, 16)) * 0.2  # a third of all rows in one cell
    data = [(i, [float(x) for x in v]) for i, v in enumerate(rows)] + [(5000, None), (5001, [0.0] * 16)]
    vectors = spark.createDataFrame(data, "vec_id int, embedding array<float>").repartition(4)
    queries = vectors.filter("vec_id % 50 = 0")
    index = relevance.vector_index(vectors, cells=12)
    exact = relevance.nearest(index, queries, 10)
    unit = np.array([v for _, v in data if v is not None], dtype=np.float32).astype(float)
    unit /= np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-12)
    ids = [i for i, v in data if v is not None]
    for q in range(0, 900, 50):
        scores = {i: round(float(s), 6) for i, s in zip(ids, unit @ unit[q]) if i != q}
        own = {r["id"]: r["score"] for r in exact.filter(f"query = {q}").collect()}
        assert len(own) == 10 and all(abs(scores[i] - s) < 2e-6 for i, s in own.items())
        assert min(own.values()) >= sorted(scores.values())[-10] - 2e-6
    got = relevance.recall(relevance.nearest(index, queries, 10, probes=4), exact).first()
    assert got["queries"] == 18 and got["rows"] == 180 and got["recall"] >= 0.9


@pytest.mark.parametrize("bucket", [None, 1, 3600])
def test_interval_pairs(spark, bucket):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), i, (s := rng.randrange(2000)), s + rng.choice([-5, 0, 1, 20, 20, 300])) for i in range(400)]
    rows += [("a", 1000, None, 5), ("a", 1001, 5, None)]
    frame = spark.createDataFrame(rows, "k string, p int, s int, e int").selectExpr("k", "p", "timestamp_seconds(s) AS s", "timestamp_seconds(e) AS e")
    found = integrity.interval_pairs(frame.repartition(4), "k", "s", "e", "p", bucket).collect()
    by = defaultdict(list)
    for k, p, s, e in rows:
        if s is not None and e is not None and s < e:
            by[k].append((s, p, e))
    wanted = [(k, i, j, float(min(e1, e2) - s2)) for k, own in by.items() for s1, i, e1 in own for s2, j, e2 in own if (s1, i) < (s2, j) and s2 < e1]
    assert Counter(map(tuple, found)) == Counter(wanted)


def test_a_part_hands_on_few_rows():
    """Of very many copies of a vector only the k least ids leave the part, and their cosines are equal to the last digit."""
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(400, 7))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    rows[100:] = rows[7]
    ids = rng.permutation(400)
    table = pa.table({"id": ids, "v": [list(v) for v in rows]})
    asked = pa.table({"q": [int(ids[7]), -1], "u": [list(rows[7]), list(rows[0])]})
    found = relevance._nearest_in_part(3)(table, asked).to_pylist()
    own = [r for r in found if r["q"] == ids[7]]
    assert sorted(r["id"] for r in own) == sorted(int(i) for i in ids[100:])[:3] and len({r["score"] for r in own}) == 1
    scores = {int(i): sum(x * y for x, y in zip(v, rows[0])) for i, v in zip(ids, rows)}
    other = sorted(((-r["score"], r["id"]) for r in found if r["q"] == -1))[:3]
    assert len(found) < 20 and other == sorted((-s, i) for i, s in scores.items())[:3]


def test_words_that_no_query_has_do_not_move(spark):
    """The list of words is looked up before words are counted, so a shuffle only sees words of the list."""
    docs = spark.createDataFrame([(i, "seldom " + " ".join(f"x{i}y{j}" for j in range(50))) for i in range(100)], "doc_id int, text string")
    seen = []
    write = relevance.materialize

    def noted(df, name="step", *args, **options):
        if name == "postings":
            seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(df, name, *args, **options)

    relevance.materialize = noted
    try:
        index, _ = relevance.inverted_index(docs, spark.createDataFrame([("seldom",)], "word string"), "doc_id", "text")
    finally:
        relevance.materialize = write
    assert index.count() == 100 and seen[0].index("Aggregate [") < seen[0].index("Join LeftSemi")


def test_topk_reads_texts_once(spark):
    """The number of documents and their mean length come with the counts of words, not from another pass over the texts."""
    seen = spark.sparkContext.accumulator(0)

    def noted(text):
        seen.add(1)
        return text

    docs = spark.createDataFrame([(i, f"some common words x{i % 7}" + " more" * (i % 4)) for i in range(50)], "doc_id int, text string")
    queries = spark.createDataFrame([(0, "common x3 more")], "item_id int, text string")
    found = relevance.relevance_topk(docs.withColumn("text", F.udf(noted)("text")), queries, 5).collect()
    wanted = _plain_topk([tuple(r) for r in docs.collect()], [(0, "common x3 more")], 5)
    assert sorted((r["item_id"], r["doc_id"], round(r["score"], 6), r["pos"]) for r in found) == wanted and seen.value == 50


def test_a_part_of_documents_hands_on_few_rows():
    """Of very many documents of one score only the k least ids leave the part; a term that an id has twice counts twice."""
    held = [(i, 5, 1.0) for i in (9, 3, 7, None, 1)] + [(20, 5, 0.5), (20, 5, 0.75), (21, 8, 0.25), (3, 8, 0.25)]
    rows = pa.table({"id": pa.array([h[0] for h in held], pa.int64()), "term": [h[1] for h in held], "impact": [h[2] for h in held]})
    asked = pa.table({"q": ["both", "none", "five"], "terms": [[5, 8], [6], [5]]})
    found = [tuple(r.values()) for r in relevance._best_in_part(3)(rows, asked).to_pylist()]
    assert found == [("both", 3, 1.25), ("both", 20, 1.25), ("both", None, 1.0), ("both", 1, 1.0), ("both", 7, 1.0), ("five", 20, 1.25), ("five", None, 1.0), ("five", 1, 1.0), ("five", 3, 1.0)]
    assert relevance._best_in_part(3)(rows.slice(0, 0), asked).num_rows == 0 == relevance._best_in_part(3)(rows, asked.slice(0, 0)).num_rows


def test_metrics_of_a_search_search_once(spark, tmp_path, monkeypatch):
    """The lists are stored before they are measured, which reads them more than once."""
    duck, seen, measure = duckdb.connect(), [], evaluate.metric_by_query
    for name, sql in {
        "documents": "SELECT i AS doc_id, 'word' || i % 5 || ' word' || i % 11 || repeat(' more', i::INT % 3) AS text FROM range(90) t(i)",
        "benchmark": "SELECT i AS item_id, 'word' || i || ' more' AS text FROM range(4) t(i)",
        "labels": "SELECT i AS doc_id, (i % 2)::INT AS quality, (i % 7 = 0)::INT AS toxic FROM range(0, 90, 2) t(i)",
    }.items():
        duck.execute(f"COPY ({sql}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    monkeypatch.setattr(evaluate, "metric_by_query", lambda ranked, *a, **b: seen.append(ranked._jdf.queryExecution().optimizedPlan().toString()) or measure(ranked, *a, **b))
    found = catalog.QUERIES["metric_by_query"](spark, str(tmp_path))
    wanted = duck.sql(catalog.SQL["metric_by_query"])
    assert sorted(map(tuple, found.select(*wanted.columns).collect())) == sorted(wanted.fetchall()) and len(seen) == 1 and "Join" not in seen[0]
