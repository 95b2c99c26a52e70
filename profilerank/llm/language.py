"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent n-grams (1 to 3 characters, words padded with a blank) of a language. A
document gets the language whose profile is nearest to its own by out-of-place distance: the sum, over the document's
n-grams, of the difference of the two ranks, or the profile length where the language lacks the n-gram.

An n-gram is a number, 21 bits per character, so that counting and ranking are vectorised. Learning counts n-grams per
language in all training rows: each task adds up the words it meets, then their n-grams, and one aggregate adds the
tasks. Profiles, languages times their length, are all that reaches the driver.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import fields, flat_map_texts, map_texts, with_row

PROFILE = 400
#: Most languages whose profiles are sent to the executors.
MAX_LANGUAGES = 2_000
#: Distinct words that a learning task holds before it turns them into n-grams.
HELD_WORDS = 200_000

_WORD = regex.compile(r"\p{L}+")
_BLANK = ord(" ")


def grams(text: str) -> np.ndarray:
    """The n-grams of a text of words that are set apart by single blanks, as numbers."""
    codes = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    letter = codes != _BLANK
    two = codes[:-1] << 21 | codes[1:]
    if len(codes) > 2:
        three = two[:-1] << 21 | codes[2:]
        three = three[letter[1:-1]]  # a blank in the middle joins two words
    else:
        three = two[:0]
    return np.concatenate([codes[letter], two[letter[:-1] | letter[1:]], three])


def ranked(numbers: np.ndarray, size: int) -> np.ndarray:
    """The most frequent numbers, first the most frequent; ties by number."""
    numbers = np.sort(numbers)
    starts = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
    counts = np.diff(np.concatenate([starts, [len(numbers)]]))
    return numbers[starts][np.argsort(-counts, kind="stable")[:size]]


def words_of(text: bytes | None) -> list[str]:
    return _WORD.findall((text or b"").decode("utf-8", "replace").lower())


def gram_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, gram, n): how often each n-gram occurs per language, in all rows with a language and a text; repeated rows count again."""
    source = with_row(docs, [text_col, lang_col]).where("c0 is not null and c1 is not null")
    source = source.select("c0", F.col("c1").cast("string").alias("c1"))

    def setup():
        held: dict[str, Counter] = defaultdict(Counter)

        def flush():
            for lang, words in held.items():
                total: Counter = Counter()
                numbers, times = [], []
                for word, n in words.items():
                    own = grams(word)
                    numbers.append(own)
                    times.append(np.full(len(own), n))
                if numbers:
                    value, place = np.unique(np.concatenate(numbers), return_inverse=True)
                    n = np.bincount(place, weights=np.concatenate(times)).astype(np.int64)
                    yield [lang] * len(value), value, n
            held.clear()

        def work(part):
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                held[lang].update(_WORD.findall(text.lower()))
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from flush()

        work.finish = flush
        return work

    counted = flat_map_texts(source, setup, fields("lang string, gram bigint, n bigint"))
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE) -> dict[str, np.ndarray]:
    """The profile of every language: its ``size`` most frequent n-grams, ties by number."""
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = gram_counts(docs, lang_col, text_col).withColumn("r", F.row_number().over(order)).where(F.col("r") <= size)
    lists = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("r", "gram"))).alias("g")).limit(MAX_LANGUAGES + 1).collect()
    if len(lists) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: their profiles are too many to be sent to the executors")
    return {row["lang"]: np.array([g["gram"] for g in row["g"]], dtype=np.int64) for row in sorted(lists)}


def place_table(profiles: dict[str, np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of any profile in order, and for each language their ranks (``size`` where it lacks one)."""
    known = np.unique(np.concatenate([*profiles.values(), np.zeros(0, dtype=np.int64)]))
    places = np.full((len(profiles), len(known) + 1), size, dtype=np.int64)
    for i, profile in enumerate(profiles.values()):
        places[i, np.searchsorted(known, profile)] = np.arange(len(profile))
    return known, places


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = PROFILE, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every whole text.

    Repeated rows and ids are rows of their own. The score is one minus the distance over the largest possible distance. Null texts, texts without a letter, and all
    texts if there is no profile, are ``und`` with score 0. Ties go to the first language by name.
    """
    names = sorted(profiles)
    shared = docs.sparkSession.sparkContext.broadcast((names, *place_table({n: profiles[n] for n in names}, size)))

    def setup():
        languages, known, places = shared.value

        def work(texts):
            labels, scores = [], []
            for text in texts:
                words = words_of(text)
                if not words or not languages:
                    labels.append("und")
                    scores.append(0.0)
                    continue
                own = ranked(grams(" ".join(words)), size)
                at = np.searchsorted(known, own)
                at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != own)] = len(known)
                found = places[:, at]
                distance = np.where(found == size, size, np.abs(found - np.arange(len(own)))).sum(axis=1)
                best = int(distance.argmin())
                labels.append(languages[best])
                scores.append(float(1 - distance[best] / (size * len(own))))
            return labels, scores

        return work

    return map_texts(docs, id_col, text_col, setup, fields("lang_pred string, score double"))


def held_out(id_col: str | Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))
