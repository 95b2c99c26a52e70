"""Boundary sets against sorted lists, and cut texts against the contract in plain Python."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from profilerank.llm import infill

OFFSETS = {
    "run": np.arange(200_000),
    "array": np.arange(0, 300_000, 97),
    "bitmap": np.arange(0, 3 << 16, 2),
    "mixed": np.concatenate([np.arange(0, 70_000), np.arange(70_001, 140_000, 2), np.arange(200_000, 400_000, 501)]),
    "one": np.array([65_536]),
}


@pytest.mark.parametrize("name", OFFSETS)
def test_select_and_rank(name):
    offsets = OFFSETS[name]
    found = infill.BoundarySet(offsets)
    assert len(found) == len(offsets)
    for k in {0, len(offsets) - 1, *np.random.default_rng(1).integers(0, len(offsets), 300).tolist()}:
        assert found.select(k) == offsets[k] and found.rank(int(offsets[k])) == k + 1
    for value in np.random.default_rng(2).integers(0, 450_000, 300).tolist():
        assert found.rank(value) == int(np.searchsorted(offsets, value, side="right"))
    with pytest.raises(IndexError):
        found.select(len(offsets))


def test_containers_by_size():
    kinds = lambda name: {type(c).__name__ for c in infill.BoundarySet(OFFSETS[name]).containers}
    assert kinds("run") == {"RunContainer"} and kinds("array") == {"ArrayContainer"} and kinds("bitmap") == {"BitmapContainer"}
    assert kinds("mixed") == {"RunContainer", "ArrayContainer", "BitmapContainer"}


@given(st.text(max_size=200), st.tuples(*[st.integers(0, 2**32 - 1)] * 4))
@settings(max_examples=300, deadline=None)
def test_round_trip(text, numbers):
    data = text.encode("utf-8", "replace")
    n, form, a, m, output = infill.transform(data, numbers)
    assert infill.restore(output, form) == data and n == len(data.decode())


def _plain_python(doc, text):
    text, h = text or "", hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    form, a, b, output = "plain", None, None, text
    if text and not any(s in text for s in ("<P>", "<S>", "<M>")) and h3 % 100 < 90:
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        form = "spm" if h4 % 100 < 20 else "psm"
        output = f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}" if form == "spm" else f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return doc, n, form, a, None if a is None else b - a, digest(output), digest(text)


def test_against_plain_python(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    long = "aé😀" * 40_000 + "x" * 70_000 + "ñx" * 50_000
    docs += [(90_000 + i, long[i:]) for i in range(12)]
    docs += [(5000, None), (5001, ""), (5002, "has <P> inside"), (5003, "<S>"), (5004, "<M"), (5005, "<P<S<M<"), (5006, "x"), (None, "no id"), (5006, "x")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    found = sorted(map(repr, map(tuple, infill.infill_digest(frame).collect())))
    assert found == sorted(repr(_plain_python(*d)) for d in docs)
    texts = {r["doc_id"]: r for r in infill.fill_in_middle(frame).collect()}
    assert infill.restore(texts[90_003]["output"].encode(), texts[90_003]["form"]).decode() == long[3:]
    assert {r["form"] for r in texts.values()} == {"plain", "psm", "spm"}
