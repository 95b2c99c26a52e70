"""Operators against the contracts in plain Python, on texts with near copies, hot groups and adversarial repetition."""

import random

import duckdb
import numpy as np
import pytest

from profilerank.llm import contamination, jaccard, repeats
from profilerank.llm.phrases import Prints
from tests.llm import brute


def _texts(where: str) -> list[tuple]:
    return duckdb.sql(f"SELECT doc_id, text FROM '/root/testdata/sf0.01/documents.parquet' WHERE {where} ORDER BY doc_id").fetchall()


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)


def _same(found, wanted):
    assert sorted(map(repr, map(tuple, found))) == sorted(repr(tuple(r.values())) for r in wanted)


@pytest.mark.parametrize("block", [1 << 20, 700])
def test_repeats(spark, monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK", block)
    rng = random.Random(3)
    docs = _texts("doc_id < 150")
    letters = lambda n: "".join(rng.choice("ab") for _ in range(n))
    p = letters(900)
    docs += [(5000, None), (5001, ""), (5002, "a" * 399), (5003, "a" * 400), (5004, "a" * 401), (5005, "a" * 3000), (5006, "xyz" * 500),
             (5007, "xyz" * 133), (5003, "a" * 400), (6000, p), (6001, letters(50) + p[100:700] + letters(70)),
             (6002, letters(10) + p[300:699] + letters(30)), (6003, letters(10) + p[300:700] + letters(30)), (None, p[:450]), (None, p[:450]),
             (7000, "é" * 500 + "x"), (7001, "ê" * 3 + "é" * 401)]
    text = docs[0][1]
    for i in range(40):
        k = rng.randrange(len(text))
        docs.append((8000 + i, text[:k] + "Q" + text[k + 3:]))
    _same(repeats.repeat_digest(_frame(spark, docs)).collect(), brute.repeats(docs))


def _thue_morse(one: str, two: str, doublings: int) -> tuple[str, str]:
    """Two texts whose polynomials modulo 2**64 agree from 1,024 letters on."""
    for _ in range(doublings):
        one, two = one + two, two + one
    return one, two


def test_repeats_that_collide_in_one_fingerprint(spark):
    one, two = _thue_morse("a", "b", 10)
    three, four = _thue_morse("x", "q", 11)
    rng = random.Random(5)
    noise = ["".join(rng.choice("klmnop ") for _ in range(1500)) for _ in range(3)]
    docs = [(1, one), (2, two), (3, three), (4, noise[0] + four), (5, noise[0][:1300] + noise[1]), (6, noise[2] + one), (7, "z" * 1100), (8, two[:1023])]
    numbers = Prints((one + two).encode()).of(np.array([0, 1024]), np.array([1024, 2048]))
    assert numbers[0] == numbers[1]
    found = repeats.repeat_digest(_frame(spark, docs), size=1024).collect()
    _same(found, brute.repeats(docs, 1024))
    removed = {r["doc_id"]: r["n_removed"] for r in found}
    assert removed[1] == 1024 and removed[2] == 0 and removed[5] == 1300


def test_long_words_that_collide(spark):
    one, two = _thue_morse("a", "b", 10)
    docs = [(1, one), (2, two), (3, one), (4, f"{one} w x y z"), (5, f"{two} w x y z")]
    _same(jaccard.similar_groups(_frame(spark, docs)).collect(), brute.jaccard(docs))


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_one_shingle_in_a_third_of_all_documents(spark, percent):
    """A common line in many small groups, of all sizes about the edges of the bands, is not a link."""
    rng = random.Random(percent)
    docs = [(i, " ".join(rng.choice("abcdefgh") + rng.choice("rstu") for _ in range(rng.randrange(5, 40)))) for i in range(200)]
    for i in range(100):
        words = [f"w{i // 4}v{j}" for j in range(rng.randrange(3, 12) if i % 4 == 0 else len(words) - 3 + rng.randrange(3))]
        docs.append((1000 + i, " ".join(["all", "rights", "reserved", *words])))
    _same(jaccard.similar_groups(_frame(spark, docs), percent=percent).collect(), brute.jaccard(docs, 3, percent))


def test_counts_are_never_below_the_truth():
    """Counts of two tasks, handed on in stretches and added up, keep a common shingle behind rare ones."""
    rng = np.random.default_rng(1)
    rare, common = rng.integers(0, 1 << 63, 50_000, dtype=np.uint64), rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    total = jaccard.Counts()
    for _ in range(2):
        task = jaccard.Counts()
        task.add(rare)
        for _ in range(300):
            task.add(common)
        for place, seen in zip(*task.stretches()):
            total.merge(place, seen)
    scale = total.logarithms()
    assert (jaccard.commonness(common, scale) >= round(np.log2(601) * 1024)).all()
    assert (jaccard.commonness(rare, scale) >= round(np.log2(3) * 1024)).all()
    assert (jaccard.commonness(rare, scale) == round(np.log2(3) * 1024)).mean() > 0.99


def test_jaccard(spark):
    rng = random.Random(3)
    docs = _texts("doc_id < 300")
    docs += [(5000, None), (5001, ""), (5002, " \n "), (5003, "One"), (5004, "one"), (5005, "one two"), (5006, "ONE\ttwo"), (5007, "two one"),
             (5003, "One"), (None, "one"), (None, "zz zz"), (None, "a b c d"), (9000, "é É a"), (9001, "É é a")]
    for base, size, edits, new in ((docs[0], None, (1, 1, 2, 3, 5, 8), 40), (docs[4], 60, (1, 1, 2, 2, 3), 4)):
        words = base[1].split()[:size]
        for i in range(120):
            own = list(words)
            for _ in range(rng.choice(edits)):
                own[rng.randrange(len(own))] = f"x{rng.randrange(new)}"
            docs.append((8000 - len(docs), " ".join(own[:len(own) - rng.choice((0, 0, 2, 5))])))
    _same(jaccard.similar_groups(_frame(spark, docs)).collect(), brute.jaccard(docs))


def test_contamination(spark):
    docs = _texts("doc_id < 300")
    items = duckdb.sql("SELECT item_id, text FROM '/root/testdata/sf0.01/benchmark.parquet'").fetchall()
    items += [(100, "the"), (101, "of the"), (102, None), (103, "!!! "), (104, items[0][1]), (105, "and in the"), (106, "de la que de")]
    docs += [(5000, None), (5001, ""), (5002, "The"), (5003, items[3][1] * 3), (5003, items[3][1] * 3), (None, items[4][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    _same(contamination.contamination(_frame(spark, docs), bench).collect(), brute.contamination(docs, items))
