"""Spelling variants: words that differ by one inserted, deleted or replaced letter, and the form each is a variant of.

By PartEnum signatures. A word's letters, the first, second, ... of a kind told apart, are a binary vector; one edit
changes at most two of its places, so words one edit apart have Hamming distance at most two. The places are dealt to
``PARTS`` parts by a fixed rule. Two vectors at distance two differ in at most two parts, so they agree in all others: the
signatures of a word are its letters in every choice of ``PARTS`` - 2 parts, and an equi-join on signatures misses no pair.
An edit leaves the first or the last three letters as they are (words have at least ``LEAST_LETTERS`` = 6), so every
signature is joined once with the head and once with the tail beside it: anagrams alone do not meet. What meets is
verified by length and edit distance; a pair that met several times is one.

What is joined is the vocabulary, not the text: tasks add up words before anything moves. A signature with very many
words is one key with many rows on both sides of a sort-merge join, which adaptive execution splits; its rows are streamed,
not collected. Forms are followed by pointer doubling: a form has at least ``RATIO`` times the occurrences of its variant,
so chains are as long as a logarithm of the corpus.

Null texts have no words, null ids count as the empty string, empty texts and tables give no words. Equal counts go by the
smaller word in code-point order. Repeated rows count as often as they stand there. Other columns are not read, whatever
their names. Texts are read whole, and a task holds a bounded number of words at a time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from .common import fields, flat_map_texts, stored, with_row

# Letters, the share of runs that lose a letter, and when a word counts.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
SLIP = 199
LEAST_LETTERS, LEAST_COUNT, RATIO = 6, 5, 5
#: Parts of the letter vector; two of them may differ.
PARTS = 8
HEAD = 3
#: Distinct words a task adds up before it hands them on, and letters it reads at a time.
HELD_WORDS, BLOCK_CHARS = 300_000, 1 << 22
_LOWER = {i: i + 32 for i in range(65, 91)}


def _runs(text: str):
    """Lists of lower-cased letter runs of a text, block by block."""
    text = text.translate(_LOWER)
    if len(text) <= BLOCK_CHARS:
        yield RUN.findall(text)
        return
    held = []
    for match in RUN.finditer(text):
        held.append(match.group())
        if len(held) >= HELD_WORDS:
            yield held
            held = []
    yield held


def slipped(doc: str, run: str, slip: int = SLIP) -> str:
    """The run, without one letter if the hash of id and run says so."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % slip:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LETTERS, slip: int = SLIP) -> DataFrame:
    """(word, n) of all words with at least so many letters."""
    source = with_row(docs, [id_col, text_col]).select(F.coalesce(F.col("c0").cast("string"), F.lit("")).alias("c0"), F.col("c1").cast("string").alias("c1"))

    def setup():
        held: Counter = Counter()

        def flush():
            yield list(held.keys()), list(held.values())
            held.clear()

        def work(part):
            for doc, text in zip(part.column(0).to_pylist(), part.column(1)):
                for runs in _runs(text.as_py() or ""):
                    # A run is treated alike wherever it stands in a text, so each distinct one is hashed once.
                    for run, n in Counter(runs).items():
                        if len(run) >= least:
                            word = slipped(doc, run, slip)
                            if len(word) >= least:
                                held[word] += n
                    if len(held) >= HELD_WORDS:
                        yield from flush()

        work.finish = flush
        return work

    return flat_map_texts(source, setup, fields("word string, n bigint")).groupBy("word").agg(F.sum("n").alias("n"))


def signatures(word: str, parts: int = PARTS) -> list[str]:
    """The letters of the word in every choice of all parts but two, in a fixed order."""
    seen: Counter = Counter()
    placed: list[list[str]] = [[] for _ in range(parts)]
    for letter in word:
        nth = seen[letter]
        seen[letter] += 1
        placed[(ord(letter) + 3 * nth) % parts].append(letter)
    own = ["".join(sorted(p)) for p in placed]
    return [f"{a}.{b}:" + ",".join(own[i] for i in range(parts) if i not in (a, b)) for a, b in combinations(range(parts), 2)]


def _signed(words: DataFrame) -> DataFrame:
    """(word, sig): a row per signature and end of the word, the signature as 64 bits."""
    def setup():
        def work(part):
            own, keys = [], []
            for word in part.column(0).to_pylist():
                found = signatures(word)
                own += [word] * len(found)
                keys += found
            if own:
                yield own, keys

        return work

    rows = flat_map_texts(words.select("word"), setup, fields("word string, key string"))
    head, tail = F.substring("word", 1, HEAD), F.substring("word", -HEAD, HEAD)
    ends = F.array(F.xxhash64("key", F.lit("head"), head), F.xxhash64("key", F.lit("tail"), tail))
    return rows.select("word", F.explode(ends).alias("sig"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), a before b in code-point order: all pairs of words exactly one edit apart, each once.

    Words with fewer than ``2 * HEAD`` letters are not looked at.
    """
    signed = stored(_signed(words.where(F.char_length("word") >= 2 * HEAD)), "signatures")
    left, right = signed.withColumnRenamed("word", "a"), signed.withColumnRenamed("word", "b")
    apart = F.abs(F.char_length("a") - F.char_length("b"))
    met = left.join(right, "sig").where((F.col("a") < F.col("b")) & (apart <= 1))
    return met.where(F.levenshtein("a", "b", 1) == 1).select("a", "b").distinct()


def _roots(chained: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: every round the form's form takes the place of the form, until none has one."""
    at = stored(chained.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")), "roots")
        at = moved.select("word", "root")
        if not moved.where("went").limit(1).count():
            return at


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n)."""
    vocabulary = stored(words, "vocabulary")
    pairs = stored(near_pairs(vocabulary), "near_words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counted = both.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    far: Column = -F.col("best.minus") >= ratio * F.col("n")
    joined = stored(vocabulary.join(best, "word", "left").select(
        "word", F.when(far, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(far, -F.col("best.minus")).alias("form_n")), "forms")
    roots = _roots(joined.where(F.col("form").isNotNull()))
    return joined.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_count: int = LEAST_COUNT) -> DataFrame:
    """``variants`` of the words of whole texts that occur at least so often."""
    return variants(word_counts(docs, id_col, text_col).where(F.col("n") >= least_count))
