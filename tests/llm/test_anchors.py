"""Removed words against a count of all passages in plain Python."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import pytest

from profilerank.llm import anchors


def _plain_python(docs, size):
    split = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in docs]
    seen = Counter(tuple(w[i:i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for (doc, _), words in zip(docs, split):
        gone = {j for i in range(len(words) - size + 1) if seen[tuple(words[i:i + size])] > 1 for j in range(i, i + size)}
        kept = b" ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((doc, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def _docs():
    rng = random.Random(7)
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet' WHERE doc_id < 250").fetchall()
    letters = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    p = letters(300).split()
    docs += [(5000, None), (5001, ""), (5002, "a " * 34), (5003, "a " * 35), (5004, " a" * 36), (5005, "a\n" * 400), (5006, "x y z " * 100), (5003, "a " * 35),
             (5007, "x y z " * 11), (None, "b " * 40), (None, "b " * 40), (None, None),
             (6000, " ".join(p)), (6001, letters(17) + " \t" + " ".join(p[40:200]) + " \r\n " + letters(23)),
             (6002, letters(5) + " " + " ".join(p[100:134]) + " c"), (6003, letters(5) + " " + " ".join(p[100:135]) + " c")]
    text = docs[0][1].split(" ")
    for i in range(60):
        k = rng.randrange(len(text))
        docs.append((8000 + i, " ".join(text[rng.randrange(40):k] + [f"q{rng.randrange(5)}"] + text[k + rng.randrange(3):])))
    for i in range(40):  # passages just above and below the size, at any distance from the blocks
        at, n = rng.randrange(200), rng.choice((33, 34, 35, 36, 37, 50))
        docs.append((9000 + i, " ".join([f"u{i}_{j}" for j in range(rng.randrange(30))] + p[at:at + n] + [f"v{i}"])))
    docs += [(9100 + i, " ".join(["ab" * 128 + "c" * k for k in range(40)] + [f"w{i}"])) for i in range(2)]
    return docs


# The Thue-Morse word and its mirror: sums with powers of a base as factors do not tell them apart.
def _regular():
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    return [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, " ".join(word[:1024])), (4, " ".join(word[1024:2048]))]


@pytest.mark.parametrize("size,block,stretch,piece", [(35, 9, 3, 1 << 22), (35, 18, 1, 50), (35, 12, 1, 50), (8, 3, 1, 1 << 22)])
def test_digest(spark, monkeypatch, size, block, stretch, piece):
    monkeypatch.setattr(anchors, "BATCH_BYTES", piece)
    monkeypatch.setattr(anchors, "HELD_TEXTS", 1 << 19 if piece > 50 else 3)
    docs = _docs()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    found = anchors.passage_digest(frame, words=size, block=block, stretch=stretch).collect()
    assert sorted(repr(tuple(r)[:4]) for r in found) == sorted(map(repr, _plain_python(docs, size)))
    assert all(hashlib.sha256(b" ".join(r["text"].encode().split())).hexdigest() == r["kept_sha256"] for r in found)
    texts = {doc: text or "" for doc, text in docs if doc != 5003 and doc is not None}
    assert all(r["text"] == texts[r["doc_id"]] for r in found if r["doc_id"] in texts and not r["n_removed"])


def test_regular_texts(spark):
    docs = _regular()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = anchors.passage_digest(frame, words=600, block=100).collect()
    assert sorted(repr(tuple(r)[:4]) for r in found) == sorted(map(repr, _plain_python(docs, 600)))


def test_hot_copies_and_a_common_passage(spark):
    """A third of all rows is one text, and another third shares a passage inside texts of their own."""
    common = " ".join(f"c{i}" for i in range(40))
    docs = [(i, " ".join(f"same{j}" for j in range(80))) for i in range(300)]
    docs += [(1000 + i, f"l{i} m{i} {common} r{i} s{i}") for i in range(300)]
    docs += [(2000 + i, " ".join(f"own{i}_{j}" for j in range(60))) for i in range(300)]
    found = {r["doc_id"]: r for r in anchors.passage_digest(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)).collect()}
    assert {r["n_removed"] for i, r in found.items() if i < 1000} == {80}
    assert all(r["n_removed"] == 40 and r["text"] == f"l{i - 1000} m{i - 1000} r{i - 1000} s{i - 1000}" for i, r in found.items() if 1000 <= i < 2000)
    assert {r["n_removed"] for i, r in found.items() if i >= 2000} == {0}


def test_all_columns_stay(spark):
    rows = [(1, "k", "w " * 35, 0.5), (2, None, None, 1.5), (3, "r1", "one two", None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, raw string, text string, lo double")
    assert sorted(map(tuple, anchors.remove_passages(frame).collect())) == rows
    assert anchors.remove_passages(frame.limit(0)).collect() == []
    with pytest.raises(ValueError):
        anchors.remove_passages(frame, words=34)
