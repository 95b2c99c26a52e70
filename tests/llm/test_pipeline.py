"""The whole pipeline against the stages in plain Python, and its intermediate tables."""

import hashlib
import os
import zlib

import duckdb
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from profilerank.llm import language, quality
from profilerank.session import shared_dir
from tests.llm import brute
from tests.llm.test_stage_sizes import _brute_cut

SF = "/root/testdata/sf0.01"


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 260")
    again = docs.where("doc_id in (0, 4, 7)").withColumn("doc_id", F.col("doc_id") + 9000)
    mixed = docs.where("doc_id in (9, 15)").withColumn("doc_id", F.col("doc_id") + 9500).withColumn("text", F.concat(F.lit("Another start. "), "text"))
    odd = spark.createDataFrame([(9900, None, "en", "s", 0), (9901, "", "en", "s", 0)], docs.schema)
    docs.unionByName(again).unionByName(mixed).unionByName(odd).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    found = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    whole = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = quality.learn(whole, spark.read.parquet(f"{SF}/labels.parquet"), ~language.held_out("doc_id", 3, 1))
    rows = sorted((r["doc_id"], r["text"]) for r in whole.select("doc_id", "text").collect())
    scores = model.score([None if t is None else t.encode() for _, t in rows])
    rows = [r for r, s in zip(rows, scores) if s >= 0.5]
    groups = brute.jaccard(rows, 5, 80)
    rows = [r for r, g in zip(rows, groups) if not g["n_shingles"] or g["component_id"] == r[0]]
    left = _brute_cut([(i, t or "") for i, t in rows], 400, 51)
    rows = [(i, t and left[i]) for i, t in rows]
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    rows = [r for r, c in zip(rows, brute.contamination(rows, items)) if not c["contaminated"]]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sorted(found) == [i for i, _ in rows] and 100 < len(rows) < 260
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    # Quality is learned from two thirds of the ids only.
    assert {zlib.crc32(str(i).encode()) % 3 for i in found} == {0, 1, 2}


def test_stages_leave_nothing_behind_but_their_results(spark, tmp_path):
    from profilerank.llm.common import release

    root = f"{shared_dir(spark)}/profilerank/{spark.sparkContext.applicationId}"
    release(spark)
    before = set(os.listdir(root))
    corpus_pipeline.run(spark, "/root/testdata/sf0.001").count()
    release(spark)
    assert {p.split("-")[0] for p in set(os.listdir(root)) - before} == {f"stage_{name}" for name, _ in corpus_pipeline.STAGES}
