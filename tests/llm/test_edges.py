"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for every operator."""

import public_tokenizers
import pytest

import corpus_pipeline
from profilerank.llm import anchors, audio, bpe, common, contamination, html, infill, jaccard, language, quality, repeats, sharding, urls
from profilerank.llm.queries import URL_RULES

#: Names that operators use for their results or on the way.
CLASHES = ("n_tokens", "score", "tx", "c0", "key", "host", "wrapper", "shard", "raw", "label", "_pos", "bucket", "component_id", "stays")
LONG = "word " * 60_000 + "x" * 200_000
ROWS = [(1, None), (2, ""), (3, "The cat. The cat."), (3, "The cat. The cat."), (None, "a b"), (None, None), (4, LONG), (5, LONG),
        (6, " \n\t "), (7, "ñandú 😀 ß"), (8, "THE CAT. the cat."), (9, "a\0b")]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _docs(spark, rows):
    """Documents with columns that clash, placed before and after."""
    names = [*CLASHES[:7], "doc_id", "text", "lang", "source", "n_chars", *CLASHES[7:]]
    kinds = ["int"] * 7 + ["bigint", "string", "string", "string", "bigint"] + ["int"] * (len(CLASHES) - 7)
    full = [(*range(7), i, t, "en" if i else None, "s", len(t or ""), *range(7, len(CLASHES))) for i, t in rows]
    return spark.createDataFrame(full, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))


def _bench(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def _labels(spark):
    return spark.createDataFrame([(3, 1), (8, 0), (None, 1), (7, None), (7, 1)], "doc_id bigint, quality int")


OPERATORS = {
    "bpe": lambda s, d: bpe.round_trip(d, TOKENIZER),
    "language": lambda s, d: language.predict(d, language.learn(d)),
    "sharding": lambda s, d: sharding.interleave(d, 4),
    "urls": lambda s, d: urls.judge_urls(d, URL_RULES, id_col="doc_id", url_col="text"),
    "html": lambda s, d: html.extract_text(d, "doc_id", "source", "text"),
    "repeats": lambda s, d: repeats.repeat_digest(d),
    "quality": lambda s, d: quality.predict(d, quality.learn(d, _labels(s), quality.F.lit(True))),
    "jaccard": lambda s, d: jaccard.similar_groups(d),
    "contamination": lambda s, d: contamination.contamination(d, _bench(s, [(1, "the cat"), (2, None), (None, "the cat")])),
    "audio": lambda s, d: audio.media_digest(d),
    "passages": lambda s, d: anchors.passage_digest(d),
    "infill": lambda s, d: infill.infill_digest(d),
    "repeats_and_passages": lambda s, d: repeats.repeat_digest(d, words=51),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(spark, name):
    found = OPERATORS[name](spark, _docs(spark, ROWS)).collect()
    key = lambda i: (i is None, i or 0)
    assert sorted((r["doc_id"] for r in found), key=key) == sorted((i for i, _ in ROWS), key=key)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, _docs(spark, [])).collect() == []


def test_empty_other_tables(spark):
    docs = _docs(spark, ROWS)
    assert not any(r["contaminated"] for r in contamination.contamination(docs, _bench(spark, [])).collect())
    assert quality.learn(docs, _labels(spark).limit(0), quality.F.lit(True)) is None
    assert {r["score"] for r in quality.predict(docs, None).collect()} == {0.5}
    assert {r["lang_pred"] for r in language.predict(docs, {}).collect()} == {"und"}


def test_results_of_edge_rows(spark):
    docs = _docs(spark, ROWS)
    group = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard.similar_groups(docs).collect()}
    assert group[3, 2] == group[8, 2] == 3 and group[1, 0] == 1 and group[5, 2] == 4
    cut = {r["doc_id"]: r for r in repeats.repeat_digest(docs).collect()}
    assert cut[4]["n_removed"] == cut[4]["n_bytes"] == len(LONG) and cut[4]["n_spans"] == 1 and cut[3]["n_removed"] == 0
    both = {r["doc_id"]: r for r in repeats.repeat_digest(docs, words=51).collect()}
    assert all(both[i][c] == cut[i][c] for i in cut for c in cut[i].__fields__) and both[4]["text"] == both[1]["text"] == "" and both[8]["text"] == "THE CAT. the cat."
    gone = {r["doc_id"]: r for r in anchors.passage_digest(docs).collect()}
    assert gone[4]["n_removed"] == gone[4]["n_words"] == 60_001 and gone[4]["text"] == "" and gone[6]["text"] == " \n\t " and gone[1]["n_words"] == 0
    hit = {r["doc_id"]: r for r in contamination.contamination(docs, _bench(spark, [(1, "the cat")])).collect()}
    assert hit[8]["n_hit"] == 4 and hit[8]["contaminated"] and hit[1]["n_words"] == 0 and not hit[1]["contaminated"]


@pytest.mark.parametrize("stage", range(1, 4))
def test_stages_keep_columns(spark, stage, monkeypatch):
    """The joins and filters of the stages; the first one is tested with its model, the last is round_trip."""
    docs = _docs(spark, ROWS)
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, n: _bench(s, [(1, "the cat")]))
    out = corpus_pipeline.STAGES[stage][1](spark, docs, "")
    assert out.columns == docs.columns
    rows = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    if stage == 1:
        wanted = [(i, t) for i, t in ROWS if i not in (5, 8)]
        wanted.remove((3, ROWS[2][1]))
    elif stage == 2:
        wanted = [(i, "" if t == LONG else t) for i, t in ROWS]
    else:
        wanted = [(i, t) for i, t in ROWS if "cat" not in (t or "")]
    assert rows == sorted(wanted, key=repr)
    assert all(f(spark, _docs(spark, []), "").count() == 0 for _, f in corpus_pipeline.STAGES[stage:stage + 1])


def test_first_and_last_stage(spark, monkeypatch):
    docs = _docs(spark, ROWS)
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, n: _labels(s))
    good, tokens = corpus_pipeline.STAGES[0][1], corpus_pipeline.STAGES[4][1]
    kept = good(spark, docs, "")
    model = quality.learn(docs, _labels(spark), ~language.held_out("doc_id", 3, 1))
    wanted = [t for _, t in ROWS if model is None or model.score([None if t is None else t.encode()])[0] >= 0.5]
    assert kept.columns == docs.columns and sorted((r["text"] for r in kept.collect()), key=repr) == sorted(wanted, key=repr)
    found = [(r["doc_id"], r["n_tokens"] > 0) for r in tokens(spark, docs, "").collect()]
    assert sorted(found, key=repr) == sorted(((i, bool(t)) for i, t in ROWS), key=repr)
    assert good(spark, _docs(spark, []), "").count() == tokens(spark, _docs(spark, []), "").count() == 0


def test_pipeline_of_empty_tables(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)
    # Without labels every document is good, and without a benchmark none is contaminated.
    docs.where("doc_id < 3").write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 3


def test_release_leaves_the_tables_of_others(spark):
    own = common.stored(spark.range(3).toDF("a"), "own")
    with common.owned("a stage"):
        made = common.stored(spark.range(4).toDF("a"), "made")
    assert common.release(spark, "a stage") == 1 and own.count() == 3
    with pytest.raises(Exception, match="FILE_NOT_EXIST|FileNotFound|does not exist"):
        made.count()
