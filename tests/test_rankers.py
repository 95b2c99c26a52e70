"""Pairs, early stops, tuning and metrics of many queries on small tables."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from profilerank.operators import evaluate, model, ranking
from profilerank.schema import ID


def ident(i):
    return f"CAND_{i:07d}"


def _rows(n, seed=1, hot=0.5):
    rng = random.Random(seed)
    return [(ident(i), 0 if rng.random() < hot else rng.randrange(1, 12), rng.choice([0, 0, 0, 1, 2, 4]), rng.random(), rng.random()) for i in range(n)]


def _dataset(spark, rows):
    df = spark.createDataFrame(rows, "candidate_id string, q int, relevance_grade int, a double, b double")
    gain = F.pow(F.lit(2.0), "relevance_grade") - 1
    return df.withColumns({"split": F.when(F.crc32(ID) % 4 == 0, "val").otherwise("train"), "label_gain": gain}).repartition(5)


def test_pairs_are_of_one_query_and_of_two_grades(spark):
    rows = _rows(600)
    rows += [(ident(9000 + i), 99, 1, 0.5, 0.5) for i in range(20)]  # one grade only: no pairs
    known = {r[0]: r for r in rows}
    pairs = model.grade_pairs(_dataset(spark, rows), "q", 5, carry="a").collect()
    by_query = {}
    for r in rows:
        by_query.setdefault(r[1], set()).add(r[2])
    wanted = {r[0] for r in rows if len(by_query[r[1]]) > 1}
    assert Counter(p[ID] for p in pairs) == {i: 5 for i in wanted}
    for p in pairs:
        one, other = known[p[ID]], known[p["partner"]]
        assert one[1] == other[1] and one[2] != other[2] and (p["x"], p["y"]) == (one[3], other[3])
        assert p["label"] == float(one[2] > other[2]) and p["weight"] == abs(2 ** one[2] - 2 ** other[2])
    again = model.grade_pairs(_dataset(spark, rows[::-1]), "q", 5, carry="a").collect()
    assert Counter(pairs) == Counter(again)


def test_pairwise_orders_inside_queries(spark, tmp_path):
    """The grade follows the first feature inside a query; between queries the second one, which tells nothing, differs much more."""
    rng = random.Random(4)
    rows = []
    for i in range(800):
        q, a = (0 if i % 3 == 0 else i % 20), rng.random()
        rows.append((ident(i), q, min(6, int(a * 7)) if q % 2 else int(a * 3), a, 100.0 * q + rng.random()))
    ranker = model.train_ranker(_dataset(spark, rows), "pairwise", ["a", "b"], [], query="q")
    scored = model.predict_pool(ranker, _dataset(spark, rows), (ID, "q", "a")).collect()
    low, high = ({r[ID]: r[model.SCORE] for r in scored if c(r)} for c in (lambda r: r["a"] < 0.3, lambda r: r["a"] > 0.8))
    assert max(low.values()) < min(high.values())
    model.save_ranker(ranker, str(tmp_path / "r"))
    loaded = model.predict_pool(model.load_ranker(spark, str(tmp_path / "r")), _dataset(spark, rows)).collect()
    assert {r[ID]: r[model.SCORE] for r in loaded} == {r[ID]: r[model.SCORE] for r in scored}


def test_early_stop_keeps_the_best_round(spark):
    data = _dataset(spark, _rows(500, 3))
    every = model.train_ranker(data, "gbt", ["a", "b"], [], stop="none", maxIter=8, maxDepth=2, stepSize=0.5)
    metrics = {r["rounds"]: r["composite"] for r in model.prefix_metrics(every, data).collect()}
    assert sorted(metrics) == list(range(1, 9))
    valid = data.filter("split = 'val'")
    for rounds in (1, 5, 8):
        short = model.cut_ranker(every, rounds)
        assert short.model.stages[-1].getNumTrees == rounds
        row = evaluate.evaluate(model.predict_pool(short, valid, (ID, "relevance_grade")), model.SCORE, "relevance_grade").first()
        assert row["composite"] == pytest.approx(metrics[rounds])
    kept = model.train_ranker(data, "gbt", ["a", "b"], [], stop="composite", maxIter=8, maxDepth=2, stepSize=0.5)
    assert kept.params["rounds"] == min(r for r in metrics if metrics[r] == max(metrics.values()))
    with pytest.raises(ValueError):
        model.train_ranker(data, "gbt", ["a", "b"], [], stop="never")


def test_tuning_runs_trials_at_once_and_keeps_the_best(spark, monkeypatch):
    import threading

    seen, most, lock = [0], [0], threading.Lock()
    train = model.train_ranker

    def watched(*args, **kwargs):
        with lock:
            seen[0] += 1
            most[0] = max(most[0], seen[0])
        try:
            return train(*args, **kwargs)
        finally:
            with lock:
                seen[0] -= 1

    monkeypatch.setattr(model, "train_ranker", watched)
    data = _dataset(spark, _rows(300, 5))
    options = {"kind": "gbt", "features": ["a", "b"], "categorical": [], "stop": "none"}
    space = {"maxIter": [1, 4], "maxDepth": [1, 3]}
    best, trials = model.tune_ranker(data, trials=4, space=space, parallel=3, **options)
    assert most[0] > 1 and [t["composite"] for t in trials] == sorted((t["composite"] for t in trials), reverse=True)
    assert best.params == trials[0]["params"] and len({t["composite"] for t in trials}) > 1
    assert trials == model.tune_ranker(data, trials=4, space=space, parallel=1, **options)[1]


def _by_query(rows, judged):
    """(q, ndcg_10, ndcg_50, map, p_10) in plain Python; rows and judged: (q, pos, grade) and (q, grade)."""
    out = {}
    for q in {r[0] for r in rows}:
        own = [g for _, _, g in sorted(r for r in rows if r[0] == q)]
        best = sorted((g for k, g in judged if k == q), reverse=True)
        gain = lambda xs, k: sum((2 ** x - 1) / math.log2(n + 2) for n, x in enumerate(xs[:k]))
        relevant = sum(g >= 3 for g in best)
        hits = [sum(g >= 3 for g in own[:n + 1]) / (n + 1) for n in range(len(own)) if own[n] >= 3]
        out[q] = (*(gain(own, k) / gain(best, k) if gain(best, k) else 0.0 for k in (10, 50)), sum(hits) / relevant if relevant else 0.0,
                  sum(g >= 3 for g in own[:10]) / len(own[:10]))
    return out


def test_metrics_of_many_queries(spark):
    rng = random.Random(9)
    rows = [(rng.choice([0, 0, 0, 1, 2, 3, None]), i, rng.choice([0, 0, 1, 2, 3, 6])) for i in range(900)]
    judged = [(q, g) for q, _, g in rows] + [(0, 6), (2, 5), (2, 4), (77, 3)]
    frame = spark.createDataFrame(rows, "q int, pos int, grade int").repartition(7)
    for known in (None, judged):
        table = known and spark.createDataFrame(known, "q int, grade int")
        found = {r["q"]: tuple(r)[1:5] for r in evaluate.metric_by_query(frame, "q", judged=table).collect()}
        wanted = _by_query([(q if q is not None else -1, p, g) for q, p, g in rows], [(q if q is not None else -1, g) for q, g in known or [(q, g) for q, _, g in rows]])
        assert {q if q is not None else -1 for q in found} == set(wanted)
        for q, values in found.items():
            assert values == pytest.approx(wanted[q if q is not None else -1])


def test_segmented_totals(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aaaaaabc") if i % 50 else None, i, rng.choice([None, 1, 2, -3])) for i in range(3000)]
    frame = spark.createDataFrame(rows, "k string, i int, v int").repartition(9)
    found = {r["i"]: (r["total"], r["at"]) for r in ranking.segmented_totals(frame, "k", ["i"], {"total": "v"}, rank="at").collect()}
    sums, counts = Counter(), Counter()
    for k, i, v in rows:
        sums[k] += v or 0
        counts[k] += 1
        assert found[i] == (sums[k], counts[k])
    assert ranking.segmented_totals(frame.limit(0), "k", ["i"], {"total": "v"}).collect() == []
    plan = ranking.segmented_totals(frame, "k", ["i"], {"total": "v"})._jdf.queryExecution().toString()
    assert "Window" not in plan
