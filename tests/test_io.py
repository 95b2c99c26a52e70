"""Files, streams and whole jobs."""

import datetime
import gzip
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from profilerank.operators import calibrate, checks, integrity, model, ranking, responses, rules
from profilerank.plans import fixture, queries_tables, runs
from profilerank.schema import ID
from profilerank.session import new_path
from profilerank.sources import readers, writers
from profilerank.streaming import score as streams
from tests.conftest import SF_DIR

RECORDS = [
    {"candidate_id": "CAND_0000001", "profile": {"years_of_experience": 3, "headline": "x"}, "activity": {"open_to_work_flag": True}},
    {"candidate_id": "CAND_0000002", "profile": {"years_of_experience": "three", "headline": "y"}, "skills": [{"name": "a", "duration_months": "1"}, {"name": "b", "duration_months": 2}]},
    {"profile": {"headline": "no id"}},
]


@pytest.mark.parametrize("kind", ["jsonl", "gz", "json"])
def test_scan_pool(spark, tmp_path, kind):
    lines = "\n\n".join(json.dumps(r) for r in RECORDS) + "\n"
    if kind == "jsonl":
        path = tmp_path / "pool.jsonl"
        path.write_text(lines)
    elif kind == "gz":
        path = tmp_path / "pool.jsonl.gz"
        path.write_bytes(gzip.compress(lines.encode()))
    else:
        path = tmp_path / "pool.json"
        path.write_text(json.dumps(RECORDS))
    rows = {r[ID]: r for r in readers.scan_pool(spark, str(path), signals_field="activity").collect()}
    assert set(rows) == {"CAND_0000001", "CAND_0000002"}
    assert rows["CAND_0000001"]["signals"]["open_to_work_flag"] and rows["CAND_0000001"]["profile"]["years_of_experience"] == 3.0
    # A value of the wrong type is NULL and the rest of the record stays.
    second = rows["CAND_0000002"]
    assert second["profile"]["years_of_experience"] is None and second["profile"]["headline"] == "y"
    assert [s["duration_months"] for s in second["skills"]] == [None, 2.0]


def test_scan_pool_refuses_broken_lines(spark, tmp_path):
    path = tmp_path / "pool.jsonl"
    path.write_text(json.dumps(RECORDS[0]) + "\n{broken\n")
    with pytest.raises(Exception, match="not JSON"):
        readers.scan_pool(spark, str(path)).count()
    assert readers.scan_pool(spark, str(path), check=False).count() == 1


def test_scores_keep_the_first_file(spark, tmp_path):
    (tmp_path / "scores_0.csv").write_text("candidate_id,score\nCAND_0000001,0.5\nCAND_0000002,0.25,more\n")
    (tmp_path / "scores_1.csv").write_text("candidate_id,score\nCAND_0000003,0.75\nCAND_0000001,0.9\nCAND_0000003,0.1\n")
    scores = readers.scan_scores_glob(spark, str(tmp_path / "scores_*.csv"))
    first = ranking.dedup_first(scores, ["source_pos"], count="copies")
    assert {(r[ID], r["score"], r["copies"]) for r in first.collect()} == {("CAND_0000001", 0.5, 2), ("CAND_0000003", 0.75, 2)}


def test_cache_last_entry_wins(spark, tmp_path):
    entry = lambda v, why: json.dumps({"candidate_id": "CAND_0000001", "rubric_version": v, "brief_rationale": why})
    path = tmp_path / "cache.jsonl"
    path.write_text("\n".join([entry("v2", "old"), "{half", entry("v2", "new"), entry("v1", "stale"), "", '{"rubric_version": "v2"}']))
    fields = "candidate_id string, rubric_version string, brief_rationale string"
    assert [tuple(r) for r in readers.scan_cache_tolerant(spark, str(path), fields, "v2").collect()] == [("CAND_0000001", "v2", "new")]
    assert readers.scan_cache_tolerant(spark, str(path), fields, latest=False).count() == 3


def test_ranked_file(spark, tmp_path):
    df = spark.createDataFrame([(f"CAND_{i:07d}", i, 1 / i, ["a", "b"]) for i in range(1, 50)], "candidate_id string, rank int, score double, reasons array<string>")
    out = str(tmp_path / "ranked")
    writers.sink_ranked(df.orderBy(F.desc("rank")), out, ("score",), single=True)
    (file,) = (tmp_path / "ranked").glob("*.csv")
    lines = file.read_text().splitlines()
    assert lines[:2] == ["candidate_id,rank,score,reasons", "CAND_0000001,1,1.000000,a;b"] and lines[3].split(",")[2] == "0.333333" and len(lines) == 50


def test_result_file_round_trip(spark, tmp_path):
    rows = [(f"CAND_{i:07d}", i, 1.0 - i / 1000, f'says "hi", {i}') for i in range(1, 101)]
    out = str(tmp_path / "result")
    writers.sink_ranked(spark.createDataFrame(rows, "candidate_id string, rank int, score double, reasoning string"), out, ("score",), single=True)
    assert checks.result_validate(checks.read_result(spark, out)).count() == 0


def test_stream_resumes(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    schema = "candidate_id string, v int"

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))

    def run():
        stream = streams.read_stream(spark, str(source), spark.createDataFrame([], schema).schema, pattern="*.parquet")
        streams.stream_score(stream, lambda b: b.withColumn("w", F.col("v") * 2), out, state).awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(out).select(ID, "w").collect())

    add([("a", 1), ("b", 2)])
    assert run() == [("a", 2), ("b", 4)]
    assert run() == [("a", 2), ("b", 4)]
    add([("b", 9), ("c", 3)])
    assert run() == [("a", 2), ("b", 4), ("c", 6)]


@pytest.mark.parametrize("parts", [0, 3])
def test_streams_of_tables_that_are_folders(spark, tmp_path, parts):
    """A table is one file, or a folder of part files (with names of their own)."""
    docs = spark.createDataFrame([(i, f"the number {i} der", 10) for i in range(7)], "doc_id long, text string, n_chars long")
    events = spark.createDataFrame([(i, datetime.datetime(2024, 1, 1 + i % 2), "view", 91.0 * (i % 2)) for i in range(6)],
                                   "event_id long, ts timestamp, event_type string, value double")
    for name, rows in (("documents", docs), ("events", events)):
        place = tmp_path / f"{name}.parquet"
        if parts:
            rows.repartition(parts).write.parquet(str(place))
        else:
            rows.toPandas().to_parquet(place, coerce_timestamps="us")
    found = {r[ID]: (r["english"], r["german"], r["number"]) for r in queries_tables.stream_score(spark, str(tmp_path)).collect()}
    assert found == {f"CAND_{i:07d}": (1, 1, 1) for i in range(7)}
    counts = sorted((r["day"], r["rows"], r["flagged"]) for r in queries_tables.stream_rule_counts(spark, str(tmp_path)).collect())
    assert counts == [("2024-01-01 00:00:00", 3, 0), ("2024-01-02 00:00:00", 3, 3)]


def test_stream_append(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    stream = streams.read_stream(spark, str(tmp_path / "in"), spark.range(1).schema, pattern="*.parquet")
    streams.stream_append(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


@pytest.fixture(scope="module")
def small(spark):
    return fixture.pool(spark, SF_DIR)


@pytest.fixture(scope="module")
def day(small):
    return calibrate.reference_date(small)


def test_relevance_run(spark, small, day):
    ranked = runs.relevance_run(small, "RAG embeddings NDCG", day).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 151))
    flags = [r["honeypot_flag"] for r in ranked]
    assert flags == sorted(flags)
    clean = [(-r["score"], r[ID]) for r in ranked if not r["honeypot_flag"]]
    assert clean == sorted(clean)


def test_audit_run(spark, small, day):
    def scorer(texts):
        return ['{"is_honeypot": true, "violation_category": "OTHER_LOGICAL_IMPOSSIBILITY", "evidence": "x"}' if len(t) % 5 == 0
                else "broken" if len(t) % 7 == 0 else '{"is_honeypot": false}' for t in texts]

    ids = small.select(ID).orderBy(ID)
    first = ranking.global_rank(ids.limit(60), [ID], "final_rank")
    second = ranking.global_rank(ids, [F.desc(ID)]).withColumn("honeypot_flag", F.lit(False))
    audit = runs.audit_run(small, first, second, scorer, day, integrity.Thresholds(), k=30, batch=8, max_checks=120)
    rows = audit.final.orderBy("final_rank").collect()
    assert [r["final_rank"] for r in rows] == list(range(1, 151))
    assert [r["honeypot_flag"] for r in rows[:30]] == [False] * 30
    bad = {r[ID] for r in audit.verdicts.collect() if r["is_honeypot"]}
    tail = [r[ID] for r in rows if r["honeypot_flag"]]
    assert set(tail) <= bad and [r[ID] for r in rows[-len(tail):]] == tail
    assert audit.disagreements.filter(F.col(ID).isin(*bad)).count() == 0
    with pytest.raises(ranking.NotEnoughClean):
        runs.audit_run(small, first, second, lambda ts: [scorer(["x" * 5])[0]] * len(ts), day, integrity.Thresholds(), k=30, batch=8, max_checks=40)


def test_audit_resumes(spark, small, day):
    def scorer(texts):
        return ['{"is_honeypot": false}' for _ in texts]

    def none(texts):
        raise RuntimeError("asked again")

    ids, cache = small.select(ID).orderBy(ID), new_path(spark, "audit-cache")
    first, second = ranking.global_rank(ids.limit(30), [ID], "final_rank"), ranking.global_rank(ids, [F.desc(ID)]).withColumn("honeypot_flag", F.lit(False))
    one = runs.audit_run(small, first, second, scorer, day, integrity.Thresholds(), k=10, batch=5, max_checks=60, cache=cache)
    two = runs.audit_run(small, first, second, none, day, integrity.Thresholds(), k=10, batch=5, max_checks=60, cache=cache)
    assert (one.asked, two.asked) == (10, 0)
    assert sorted(map(tuple, one.final.collect())) == sorted(map(tuple, two.final.collect()))


def test_audit_reads_the_pool_once(spark, small, day):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    # Every second answer flags its row, so several waves are needed.
    def scorer(texts):
        return ['{"is_honeypot": true, "violation_category": "OTHER_LOGICAL_IMPOSSIBILITY", "evidence": "x"}' if len(t) % 2 else '{"is_honeypot": false}'
                for t in texts]

    ids = small.select(ID).orderBy(ID)
    first, second = ranking.global_rank(ids.limit(30), [ID], "final_rank"), ranking.global_rank(ids, [F.desc(ID)]).withColumn("honeypot_flag", F.lit(False))
    counted = small.mapInArrow(count, small.schema)
    audit = runs.audit_run(counted, first, second, scorer, day, integrity.Thresholds(), k=20, batch=5, max_checks=100)
    assert audit.disagreements.count() >= 0 and audit.asked > 20 and read.value == small.count()


def test_scoring_resumes_pass_by_pass(spark):
    asked = spark.sparkContext.accumulator(0)

    def scorer(texts):
        asked.add(len(texts))
        return ['{"retrieval_score": 1, "evaluation_score": 2, "applied_ml_score": 3, "credibility_score": 1, "bonus_score": 0}'] * len(texts)

    rows, cache = spark.createDataFrame([(f"c{i}", f"text {i}") for i in range(9)], f"{ID} string, doc_text string"), new_path(spark, "passes")
    counts = [runs.scoring_run(part, scorer, cache, passes)[1] for part, passes in (
        (rows.limit(0), 2), (rows.limit(2), 1), (rows.limit(5), 3), (rows, 2), (rows, 2), (rows, 1))]
    assert counts == [0, 2, 13, 8, 0, 0] and asked.value == 23
    done = sorted((r[ID], r["pass"]) for r in spark.read.parquet(cache).select(ID, "pass").collect())
    assert done == sorted((f"c{i}", n) for i in range(9) for n in range(3 if i < 5 else 2))


def test_stream_does_not_read_what_it_wrote(spark, tmp_path):
    folder, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    for number in range(3):
        spark.range(number * 5, number * 5 + 10).selectExpr("concat('c', id) AS candidate_id", f"{number} AS n").coalesce(1).write.mode("append").parquet(folder)
        source = streams.read_stream(spark, folder, spark.read.parquet(folder).schema)
        streams.stream_score(source, lambda b: b, out, state).awaitTermination()
        if number == 0:  # an unreadable file in the output of the first batch
            (tmp_path / "out" / "batch=0" / "part-broken.parquet").write_bytes(b"not parquet")
    (tmp_path / "out" / "batch=0" / "part-broken.parquet").write_bytes(b"")
    rows = spark.read.parquet(f"{out}/batch=1", f"{out}/batch=2").collect()
    assert sorted((r[ID], r["n"]) for r in rows) == sorted([(f"c{i}", 1) for i in range(10, 15)] + [(f"c{i}", 2) for i in range(15, 20)])
    assert not (tmp_path / "out-ids").exists()


def test_stream_keeps_the_least_of_the_first_batch(spark, tmp_path):
    """Ids repeat inside a file, between files of one run and between runs; one id holds most rows."""
    folder, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    wanted = {}
    for run in range(2):
        for number in range(2):
            file = 2 * run + number
            rows = [("hot", file, 900 - i) for i in range(400)] + [(f"c{i}", file, i % 7) for i in range(file * 10, file * 10 + 25) for _ in range(2)] + [(None, file, 3)]
            spark.createDataFrame(rows, "candidate_id string, file int, n int").repartition(3).write.parquet(f"{folder}/f{file}")
            for key, f, n in rows:
                best = wanted.get(key)
                if best is None or (best[0] == f and n < best[1]):
                    wanted[key] = (f, n)
        schema = spark.read.parquet(f"{folder}/f0").schema
        # A folder a batch: files of one batch come together.
        for file in range(2 * run, 2 * run + 2):
            source = streams.read_stream(spark, f"{folder}/f[0-{file}]", schema)
            streams.stream_score(source, lambda b: b, out, state, order=["n"]).awaitTermination()
    found = spark.read.parquet(out).collect()
    assert {r[ID]: (r["file"], r["n"]) for r in found} == wanted and len(found) == len(wanted)


def test_stream_keys_cost_no_call_of_their_own(spark, tmp_path):
    """Keys are told apart by Spark's own deduplication; large numbers next to missing ones stay what they are."""
    big = 2**53 + 1
    rows = [(i % 50, None if i % 3 else big + i) for i in range(200)] + [(None, big)]
    spark.createDataFrame(rows, "k long, v long").repartition(3).write.parquet(f"{tmp_path}/in")
    source = streams.read_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
    plan = streams.new_rows(source, "k", ["v"])._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate" in plan and "WithState" not in plan
    streams.stream_score(source.filter("v IS NOT NULL OR k = 1"), lambda b: b, f"{tmp_path}/out", f"{tmp_path}/state", key="k", order=["v"]).awaitTermination()
    found = {r["k"]: r["v"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    wanted = {}
    for k, v in rows:
        if v is not None and k != 1:
            wanted[k] = min(v, wanted.get(k, v))
    assert found == {**wanted, 1: None}


def test_least_of_part_over_many_batches(monkeypatch):
    """What a task holds is cut back to the least row per key as rows come in."""
    monkeypatch.setattr(streams, "_HELD_ROWS", 4)
    rows = [(i % 5 or None, (i * 7) % 31, f"t{i}") for i in range(60)]
    batches = [pa.RecordBatch.from_pydict({"k": [r[0] for r in part], "v": [r[1] for r in part], "t": [r[2] for r in part]},
                                          schema=pa.schema([("k", pa.int64()), ("v", pa.int64()), ("t", pa.string())]))
               for part in ([], *[rows[a:a + 3] for a in range(0, 60, 3)])]
    found = [r for b in streams._least_of_part("k", ["v", "t"])(iter(batches)) for r in b.to_pylist()]
    wanted = {k: min(r[1:] for r in rows if r[0] == k) for k in {r[0] for r in rows}}
    assert {r["k"]: (r["v"], r["t"]) for r in found} == wanted and len(found) == 5


def test_late_rows_are_kept(spark, tmp_path):
    folder, out, late, state = (f"{tmp_path}/{n}" for n in ("in", "out", "late", "state"))
    files = [["2024-01-01 10:00", "2024-01-05 00:00"], ["2024-01-02 09:00", "2024-01-03 09:00", "2024-01-04 09:00", None], ["2024-01-09 00:00", "2024-01-04 10:00"]]
    for number, times in enumerate(files):
        rows = spark.createDataFrame([(t, "r", True) for t in times], "ts string, rule string, flagged boolean").withColumn("ts", F.col("ts").cast("timestamp"))
        rows.coalesce(1).write.mode("append").parquet(folder)
        source = streams.read_stream(spark, folder, spark.read.parquet(folder).schema)
        streams.stream_counts_and_late(source, out, late, state, delay="1 day").awaitTermination()
    counted = {str(r["window_start"])[:10]: r["rows"] for r in streams.read_partial_counts(spark, out).collect()}
    # After the first file the watermark is the 4th: the days before have ended, the 4th itself has not.
    assert counted == {"2024-01-01": 1, "2024-01-05": 1, "2024-01-04": 2, "2024-01-09": 1}
    kept = {(str(r["ts"])[:10] if r["ts"] else None, str(r["watermark"])[:10]) for r in streams.read_late(spark, late).collect()}
    assert kept == {("2024-01-02", "2024-01-04"), ("2024-01-03", "2024-01-04"), (None, "2024-01-04")}


def test_width_of_result_rows(spark, tmp_path):
    good = [f'CAND_{i:07d},{i},{1 - i / 100},"reason, {i}"' for i in range(1, 6)]
    lines = ["candidate_id,rank,score,reasoning", *good[:3], "CAND_0000004,4,0.96", 'CAND_0000005,5,0.95,"a, b",extra']
    (tmp_path / "r.csv").write_text("\n".join(lines) + "\n")
    found = checks.result_validate(checks.read_result(spark, f"{tmp_path}/r.csv"), expected_rows=5).collect()
    assert [(r["rule"], r["item"]) for r in found] == [("column_count", "3"), ("column_count", "4")]


def test_training_and_result_run(spark, small, day):
    ranked = runs.relevance_run(small, "RAG embeddings NDCG", day)
    ranker, dataset, gaps = runs.training_run(small, ranked, day)
    assert {r["metric"] for r in gaps.collect()} == {"composite", "ndcg_10", "ndcg_50", "map", "p_10"}
    flags = rules.rules_flag(small, day)
    result = runs.result_run(small, dataset, ranker, flags, n=10)
    rows = result.withColumn("row_num", F.col("rank"))
    assert checks.result_validate(rows, expected_rows=10).count() == 0
    assert all(r["reasoning"] for r in result.collect())
    explained = model.attribution(ranker, dataset)
    assert model.attribution_error(explained).first()["max_error"] < 1e-6


def test_attribution_needs_a_linear_ranker():
    with pytest.raises(ValueError):
        model.attribution(model.Ranker(None, [], [], "gbt"), None)


def test_population_stats(small):
    stats = calibrate.population_stats(small)
    assert stats["reference_date"] == "2024-02-15" and stats["counts"].first()["n_total"] == 150
    assert stats["thresholds"].count() == 1 and stats["summaries"].count() == 7


def test_paths_are_new(spark):
    assert new_path(spark, "a") != new_path(spark, "a")
    assert responses.Scorer is not None
