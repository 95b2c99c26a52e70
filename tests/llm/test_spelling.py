"""Words, signatures and forms against plain Python."""

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings, strategies as st

from profilerank.llm import spelling


def _distance_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _plain_python(docs):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def _forms(counts):
    forms, rows = {}, []
    for w, n in counts.items():
        near = sorted((-m, v) for v, m in counts.items() if _distance_one(w, v))
        forms[w] = (near[0][1], -near[0][0], len(near)) if near and -near[0][0] >= 5 * n else (None, None, len(near))
    for w, n in counts.items():
        root = w
        while forms[root][0]:
            root = forms[root][0]
        rows.append((w, forms[w][0], root, n, forms[w][2], forms[w][1]))
    return sorted(map(repr, rows))


@given(st.text("abcé", min_size=6, max_size=12), st.integers(0, 12), st.sampled_from("abcdé"), st.sampled_from(["insert", "delete", "replace"]))
@settings(max_examples=400, deadline=None)
def test_signatures_meet(word, at, letter, edit):
    at = min(at, len(word) - 1)
    other = word[:at] + ("" if edit == "delete" else letter) + word[at + (edit != "insert"):]
    if edit == "insert":
        other = word[:at] + letter + word[at:]
    assert set(spelling.signatures(word)) & set(spelling.signatures(other))


def test_vocabulary(spark):
    rng = random.Random(5)
    counts = {}
    for _ in range(60):
        base = "".join(rng.choice("aeinrstélo") for _ in range(rng.randrange(6, 12)))
        for _ in range(12):
            word = list(base)
            for _ in range(rng.randrange(0, 3)):
                at = rng.randrange(len(word))
                word[at:at + rng.randrange(2)] = rng.choice(("", "a", "é", "s"))
            if len(word) >= 6:
                counts["".join(word)] = rng.choice((5, 6, 25, 30, 125, 125, 700, 4000))
    counts |= {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "aaaaaaaaa": 625, "bbbbbb": 9, "bbbbbc": 45, "bbbbbd": 45}
    counts |= {f"head{a}{b}tail": 7 for a in "abcdefghijklm" for b in "nopqrstuvwxyz"}
    found = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(4)).collect()
    assert sorted(repr(tuple(r)) for r in found) == _forms(counts)
    by = {r["word"]: r for r in found}
    assert by["aaaaaa"]["root"] == "aaaaaaaaa" and by["bbbbbb"]["form"] == "bbbbbc" and by["heada" "ntail"]["n_near"] == 24


@pytest.mark.parametrize("block", [1 << 22, 500])
def test_documents(spark, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK_CHARS", block)
    monkeypatch.setattr(spelling, "HELD_WORDS", 1 << 18 if block > 500 else 50)
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet' WHERE doc_id < 400").fetchall()
    docs += [(5000, None), (5001, ""), (None, "Straße ÀÉÎÕ×÷ÿ " * 9), (None, None), (5002, "ABCDEF abcdef ÀBCDEF " * 6), (5002, "ABCDEF abcdef ÀBCDEF " * 6),
             (5003, "Ωmega ǅungla x" * 7), (5004, "y" * 300_000 + " " + "zzzzzz " * 2000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    found = spelling.spelling_forms(frame).collect()
    assert sorted(repr(tuple(r)) for r in found) == _forms(_plain_python(docs))
    assert spelling.spelling_forms(frame.limit(0)).collect() == []
