"""Ranks, merges and the clean top-k against plain Python."""

import os
import random

import pytest
from pyspark.sql import functions as F

from profilerank.operators import joins, labels, ranking
from profilerank.session import scratch, shared_dir


def scores(spark, rows, schema="candidate_id string, score double"):
    return spark.createDataFrame(rows, schema)


def ident(i):
    return f"CAND_{i:07d}"


def test_global_rank_is_a_permutation_in_order(spark):
    rng = random.Random(1)
    rows = [(ident(i), float(rng.randrange(5))) for i in range(5000)]
    got = ranking.rank_scores(scores(spark, rows).repartition(16)).collect()
    wanted = {cid: n for n, (cid, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1)}
    assert {r["candidate_id"]: r["rank"] for r in got} == wanted


def test_global_rank_of_one_value_for_a_third(spark):
    rows = [(ident(i), 1.0 if i % 3 == 0 else i / 7) for i in range(3000)]
    got = ranking.rank_scores(scores(spark, rows)).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 3001))
    assert [r["candidate_id"] for r in got] == [c for c, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]


def test_global_rank_of_nothing(spark):
    assert ranking.rank_scores(scores(spark, [])).count() == 0


def test_no_single_partition_in_rank(spark):
    ranked = ranking.rank_scores(scores(spark, [(ident(i), 1.0) for i in range(10)]))
    assert "SinglePartition" not in ranked._jdf.queryExecution().executedPlan().toString()


def test_running_totals(spark):
    rows = [(i, i % 4) for i in range(1000)]
    got = ranking.running_totals(spark.createDataFrame(rows, "k int, v int").repartition(7), ["k"], {"upto": "v"}, rank="r").orderBy("k").collect()
    total = 0
    for n, row in enumerate(got, 1):
        total += row["v"]
        assert (row["upto"], row["r"]) == (total, n)


def test_dedup_first(spark):
    rows = [("a", 2, 20.0), ("a", 1, 10.0), ("b", 3, 5.0)] + [("hot", n, float(n)) for n in range(500)]
    got = ranking.dedup_first(spark.createDataFrame(rows, "candidate_id string, pos int, score double"), ["pos"], count="copies").collect()
    assert {tuple(r) for r in got} == {("a", 1, 10.0, 2), ("b", 3, 5.0, 1), ("hot", 0, 0.0, 500)}


def test_demote(spark):
    rows = [("a", 3.0, None), ("b", 5.0, True), ("c", 3.0, False), ("d", 9.0, True)]
    got = ranking.demote_flagged(scores(spark, rows, "candidate_id string, score double, f boolean"), "f").orderBy("rank").collect()
    assert [r["candidate_id"] for r in got] == ["a", "c", "d", "b"]


def test_rerank(spark):
    rows = [("a", 5, 2), ("b", 5, 1), ("c", 7, None), ("d", 5, None)]
    got = ranking.rerank_total(spark.createDataFrame(rows, "candidate_id string, t int, p int"), "t", "p").orderBy("final_rank").collect()
    assert [r["candidate_id"] for r in got] == ["c", "b", "a", "d"]


def sequential(order, flagged, k, batch, max_checks, initial):
    """The walk from the top, batch by batch."""
    clean, moved, cursor = [], [], 0
    while len(clean) < k:
        if cursor >= len(order) or cursor >= max_checks:
            return None
        part = order[cursor:cursor + batch]
        cursor += len(part)
        for cid in part:
            if cid in flagged:
                moved.append(cid)
            elif len(clean) < k:
                clean.append(cid)
    rest = [c for c in order if c not in set(moved)]
    checked = set(order[:cursor])
    out = [(c, False if c in checked else initial.get(c)) for c in rest] + [(c, True) for c in moved]
    return [(c, n, f) for n, (c, f) in enumerate(out, 1)]


@pytest.mark.parametrize("seed", range(8))
def test_gap_fill_equals_the_walk(spark, seed):
    rng = random.Random(seed)
    n, batch, max_checks = rng.randrange(5, 60), rng.randrange(1, 9), rng.randrange(5, 70)
    k, rate = rng.randrange(1, 20), rng.choice([0.0, 0.2, 0.6])
    order = [ident(i) for i in rng.sample(range(1000), n)]
    flagged = {c for c in order if rng.random() < rate}
    initial = {c: rng.choice([True, False, None]) for c in order}
    wanted = sequential(order, flagged, k, batch, max_checks, initial)
    merged = spark.createDataFrame([(c, i, initial[c]) for i, c in enumerate(order, 1)], "candidate_id string, merged_rank bigint, initial_flag boolean")
    verdicts = spark.createDataFrame([(c, c in flagged) for c in order], "candidate_id string, is_honeypot boolean")
    if wanted is None:
        with pytest.raises(ranking.NotEnoughClean):
            ranking.gap_fill_topk(merged, verdicts, k, batch, max_checks)
    else:
        got = ranking.gap_fill_topk(merged, verdicts, k, batch, max_checks).orderBy("final_rank").collect()
        assert [tuple(r) for r in got] == wanted


@pytest.mark.parametrize("known", [3, 6])
def test_gap_fill_refuses_rows_without_a_verdict(spark, known):
    merged = spark.createDataFrame([(ident(i), i, False) for i in range(1, 13)], "candidate_id string, merged_rank bigint, initial_flag boolean")
    verdicts = spark.createDataFrame([(ident(i), False) for i in range(1, 1 + known)], "candidate_id string, is_honeypot boolean")
    with pytest.raises(ranking.Unaudited, match=ident(known + 1)):
        ranking.gap_fill_topk(merged, verdicts, 5, 4 if known == 6 else 5, 12)


def test_repeated_flags_do_not_multiply_rows(spark):
    ranked = spark.createDataFrame([("a", 1), ("b", 2)], "candidate_id string, rank int")
    flags = spark.createDataFrame([("a", False, "x"), ("a", True, "y"), ("a", None, "z")], "candidate_id string, honeypot_flag boolean, reasons string")
    got = sorted(map(tuple, joins.join_flags_left(ranked, flags).select("candidate_id", "honeypot_flag", "reasons", "flag_missing").collect()))
    assert got == [("a", True, "y", False), ("b", False, None, True)]


def test_scratch_leaves_nothing(spark, tmp_path):
    root = f"{shared_dir(spark)}/profilerank/{spark.sparkContext.applicationId}"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    with scratch(spark):
        rows = spark.range(100).select(F.col("id").cast("string").alias("candidate_id"), (F.col("id") % 7).alias("score"))
        ranking.rank_scores(rows).write.parquet(f"{tmp_path}/out")
        assert set(os.listdir(root)) - before
    assert set(os.listdir(root)) == before and spark.read.parquet(f"{tmp_path}/out").count() == 100


def test_split_with_one_grade_of_nearly_all_rows(spark):
    rows = spark.range(4000).select(F.concat(F.lit("c"), "id").alias("candidate_id"), F.when(F.col("id") % 20 == 0, F.col("id") % 3).otherwise(5).cast("int").alias("relevance_grade"))
    got = labels.stratified_split(rows, 0.15, 7)
    counts = {(r["relevance_grade"], r["split"]): r["count"] for r in got.groupBy("relevance_grade", "split").count().collect()}
    assert counts[5, "val"] == 570 and counts[5, "train"] == 3230
    small = labels.stratified_split(rows.limit(1), 0.15, 7).collect()
    assert [r["split"] for r in small] == ["train"]


def test_merge(spark):
    first = spark.createDataFrame([("b", 2), ("a", 1)], "candidate_id string, final_rank int")
    second = spark.createDataFrame([("a", 1, True), ("d", 3, True), ("c", 2, None)], "candidate_id string, rank int, f boolean")
    got = ranking.merge_rankings(first, second, flag="f").orderBy("merged_rank").collect()
    assert [(r["candidate_id"], r["source"], r["initial_flag"], r["merged_rank"]) for r in got] == [
        ("a", 0, None, 1), ("b", 0, None, 2), ("c", 1, None, 3), ("d", 1, True, 4)]


def test_flag_share(spark):
    ranked = spark.createDataFrame([(ident(i), i, i <= 11) for i in range(1, 201)], "candidate_id string, rank int, f boolean")
    assert tuple(ranking.flag_share_topk(ranked, "f").first()) == (100, 11, 11.0)
    with pytest.raises(ValueError):
        ranking.check_flag_share(ranked, "f")
    assert ranking.check_flag_share(ranked, "f", limit=11.0) == 11.0
    assert tuple(ranking.flag_share_topk(ranked.filter("false"), "f").first()) == (0, 0, 0.0)


def test_conservation(spark):
    before = spark.createDataFrame([("a",), ("b",), ("c",)], "candidate_id string")
    assert joins.conservation_check(before, before).first()["conserved"]
    after = spark.createDataFrame([("a",), ("a",), ("d",)], "candidate_id string")
    assert tuple(joins.conservation_check(before, after).first()) == (3, 3, 2, 1, 1, False)


def test_lookups(spark):
    pool = spark.createDataFrame([("a", 1), ("b", 2)], "candidate_id string, v int")
    ids = spark.createDataFrame([("a",), ("a",), ("z",)], "candidate_id string")
    assert [tuple(r) for r in joins.semi_lookup(pool, ids).collect()] == [("a", 1)]
    assert {r[0] for r in joins.missing_ids(ids, pool).collect()} == {"z"}
    left = joins.remaining_passes(pool, spark.createDataFrame([("a",)] * 5 + [("b",)], "candidate_id string"), 3)
    assert {r["candidate_id"]: r["remaining"] for r in left.collect()} == {"a": 0, "b": 2}
