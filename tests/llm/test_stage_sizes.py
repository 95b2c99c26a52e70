"""The stages' own sizes: near copies by five words and 0.8, repeated passages of over 50 words."""

import re
from collections import Counter

import corpus_pipeline
from profilerank.llm.common import stored
from tests.llm import brute

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA).repartition(3)


def _words(name, n):
    return [f"{name}{i}" for i in range(n)]


def test_near_copies_between_the_thresholds(spark):
    def changed(words, *places):
        return " ".join("other" + w if i in places else w for i, w in enumerate(words))

    a, b = _words("a", 100), _words("b", 100)
    # Two of 100 words that stand apart: 0.81 of the 5-word and 0.88 of the 3-word shingles. Three: below 0.8.
    rows = [(1, " ".join(a)), (2, changed(a, 30, 60)), (3, " ".join(b)), (4, changed(b, 20, 50, 80))]
    left = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, _docs(spark, rows), "").collect())
    assert left == [g["doc_id"] for g in brute.jaccard(rows, 5, 80) if g["component_id"] == g["doc_id"]] == [1, 3, 4]
    assert len({g["component_id"] for g in brute.jaccard(rows)}) == 4


def _brute_cut(rows, size, n):
    """Every text without bytes of repeated strings and without words of repeated passages, found one by one."""
    data = [t.encode() for _, t in rows]
    words = [[(m.start(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", d)] for d in data]
    runs = [[tuple(w for _, w in own[i:i + n]) for i in range(len(own) - n + 1)] for own in words]
    strings = Counter(d[i:i + size] for d in data for i in range(len(d) - size + 1))
    passages = Counter(r for own in runs for r in own)
    out = {}
    for (doc, _), d, own, its in zip(rows, data, words, runs):
        gone = {j for i in range(len(d) - size + 1) if strings[d[i:i + size]] > 1 for j in range(i, i + size)}
        for w in {j for i, r in enumerate(its) if passages[r] > 1 for j in range(i, i + n)}:
            gone.update(range(own[w][0], own[w + 1][0] if w + 1 < len(own) else len(d)))
        out[doc] = bytes(b for i, b in enumerate(d) if i not in gone).decode("utf-8", "ignore")
    return out


def test_passages_of_over_50_words(spark):
    passages = {n: [f"{n % 10}{w}" for w in _words("é", n)] for n in (50, 51, 55, 60)}
    rows = []
    for n, own in passages.items():
        rows.append((n, " ".join(_words(f"head{n}x", 20) + own + _words(f"tail{n}x", 20))))
        rows.append((n + 100, " \n ".join(_words(f"other{n}x", 7) + own)))  # other white space, and the end of the text
    long = _words("long", 30)  # 30 words of 20 bytes and more: 400 bytes
    rows += [(1, " ".join(w * 4 for w in long) + " x"), (2, "y " + " ".join(w * 4 for w in long)), (3, "a " * 30 + "b " * 80 + "c"), (4, "one")]
    found = {r["doc_id"]: r for r in corpus_pipeline.repeat_stage(spark, _docs(spark, rows), "").collect()}
    assert {i: r["text"] for i, r in found.items()} == _brute_cut(rows, 400, 51)
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())
    assert found[151]["text"].split() == _words("other51x", 7) and found[150]["text"] == dict(rows)[150] and found[1]["text"] == " x"


def test_both_stages_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 260")
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    rows = [r for r, g in zip(rows, brute.jaccard(rows, 5, 80)) if not g["n_shingles"] or g["component_id"] == r[0]]
    kept = stored(corpus_pipeline.near_duplicate_stage(spark, docs, ""), "kept", keep=True)
    left = corpus_pipeline.repeat_stage(spark, kept, "")
    assert {r["doc_id"]: r["text"] for r in left.collect()} == _brute_cut(rows, 400, 51)
