"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares of byte classes, lengths and repetition, in fixed steps, of the line
and of both neighbours; a transition matrix ties the labels of adjacent lines. The lines of a labelled document take
its label for training. A document's raw value is the mean of its lines' forward-backward marginals, weighted by their
lengths, and a logistic curve fitted on the same rows makes it a probability.

Training takes at most ``rows_per_class`` labelled documents of each class, those with the smallest hash of the id; the
class proportions are counted over all labelled rows. The rest of the work is one pass over the documents.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import fields, map_texts, with_row

ROWS_PER_CLASS = 3_000
STEPS = 80
RIDGE = 1e-4

# Byte classes: 0 other, 1 small letter, 2 capital, 3 digit, 4 white space, 5 beyond ASCII, 6 sentence mark, 7 "!", 8 "|".
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[ord("a"):ord("z") + 1], _CLASS[ord("A"):ord("Z") + 1], _CLASS[ord("0"):ord("9") + 1], _CLASS[128:] = 1, 2, 3, 5
_CLASS[[9, 10, 11, 12, 13, 32]] = 4
_CLASS[[ord(c) for c in ".,;:?'\"-()"]] = 6
_CLASS[ord("!")], _CLASS[ord("|")] = 7, 8

_SHARES = np.array([0.0, 0.02, 0.06, 0.15, 0.3, 0.6])
_SIZES = np.array([0.0, 10, 30, 60, 120, 240, 500])
_WORD_SIZES = np.array([0.0, 2.5, 4, 5, 6, 8, 12])
BINS, FEATURES = 9, 12


def line_features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(steps of each line and feature, length of each line, number of lines of each text). A text has a line at least."""
    whole = b"\n".join([t or b"" for t in texts]) + b"\n"
    data = np.frombuffer(whole, dtype=np.uint8)
    kind = _CLASS[data]
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = ends - starts
    count = [np.add.reduceat(kind == c, starts, dtype=np.int64) for c in range(9)]
    count[4] = count[4] - 1  # the line's own end
    word_start = np.empty(len(data), dtype=bool)
    word_start[0] = kind[0] != 4
    np.logical_and(kind[1:] != 4, kind[:-1] == 4, out=word_start[1:])
    words = np.add.reduceat(word_start, starts, dtype=np.int64)
    lines_of = np.array([1 + (t or b"").count(b"\n") for t in texts], dtype=np.int64)
    repeated = np.zeros(len(ends), dtype=np.int64)
    lines = whole[:-1].split(b"\n")
    same = np.zeros(len(ends), dtype=np.int64)  # words equal to the word before
    for i, line in enumerate(lines):
        row = line.split()
        same[i] = sum(map(eq, row, row[1:]))
    at = 0
    for n in lines_of.tolist():
        if n > 1:
            seen = set()
            for i in range(at, at + n):
                if lines[i] in seen:
                    repeated[i] = 1
                seen.add(lines[i])
        at += n
    full, letters = np.maximum(size, 1), np.maximum(count[1] + count[2] + count[5], 1)
    last = kind[np.maximum(ends - 1, 0)]
    shares = [count[0] / full, count[2] / letters, count[3] / full, count[4] / full, count[6] / full, count[7] / full, count[8] / full,
              same / np.maximum(words, 1)]
    columns = [np.searchsorted(_SHARES, s, side="left") for s in shares]
    columns += [np.searchsorted(_SIZES, size, side="left"), np.searchsorted(_WORD_SIZES, size / np.maximum(words, 1), side="left"),
                repeated, np.where(size > 0, np.select([last == 6, last == 7, last == 0, last == 8], [1, 2, 3, 4], 5), 0)]
    return np.stack(columns, axis=1).astype(np.int16), size, lines_of


def with_neighbours(steps: np.ndarray, lines_of: np.ndarray) -> np.ndarray:
    """One index per line and feature into the weights: own steps, the previous line's, the next line's.

    The line before the first and after the last has a step of its own.
    """
    lines, own = steps.shape
    first = np.zeros(lines, dtype=bool)
    starts = np.concatenate([[0], np.cumsum(lines_of)[:-1]])
    first[starts] = True
    last = np.zeros(lines, dtype=bool)
    last[np.cumsum(lines_of) - 1] = True
    outside = BINS - 1
    before = np.vstack([steps[:1], steps[:-1]])
    after = np.vstack([steps[1:], steps[-1:]])
    before[first], after[last] = outside, outside
    base = np.arange(own) * BINS
    return np.hstack([steps + base, before + base + own * BINS, after + base + 2 * own * BINS]).astype(np.int32)


N_WEIGHTS = 3 * FEATURES * BINS + 1


def groups_of(lines_of: np.ndarray, cells: int = 200_000) -> list[np.ndarray]:
    """Texts of similar numbers of lines, so that padding to the longest stays below ``cells`` (or one text alone)."""
    order = np.argsort(lines_of, kind="stable")
    out, start = [], 0
    for i in range(1, len(order) + 1):
        if i == len(order) or (i + 1 - start) * lines_of[order[i]] > cells or lines_of[order[i]] > 2 * lines_of[order[start]] + 4:
            out.append(order[start:i])
            start = i
    return out


def marginals(unary: np.ndarray, lines_of: np.ndarray, moves: np.ndarray, groups: list[np.ndarray], pairs: bool = False):
    """P(bad) of every line by forward-backward, and, if asked for, the expected number of moves between labels.

    ``unary`` is each line's log odds of bad, ``moves`` the 2 x 2 log weights of moves.
    """
    out, step = np.empty(len(unary)), np.exp(moves)
    expected = np.zeros((2, 2))
    starts = np.concatenate([[0], np.cumsum(lines_of)[:-1]])
    for group in groups:
        sizes, longest = lines_of[group], int(lines_of[group].max())
        place = starts[group][:, None] + np.minimum(np.arange(longest), sizes[:, None] - 1)
        real = np.arange(longest) < sizes[:, None]
        odds = 1 / (1 + np.exp(-np.clip(unary[place], -50, 50)))
        local = np.stack([1 - odds, odds], axis=2) + 1e-30
        forward, backward = np.empty_like(local), np.ones_like(local)
        now = local[:, 0] / local[:, 0].sum(axis=1, keepdims=True)
        forward[:, 0] = now
        for t in range(1, longest):
            now = (now @ step) * local[:, t]
            now = now / now.sum(axis=1, keepdims=True)
            forward[:, t] = now
        for t in range(longest - 2, -1, -1):
            now = (backward[:, t + 1] * local[:, t + 1]) @ step.T
            now = now / now.sum(axis=1, keepdims=True)
            # Beyond a text's last line nothing is known.
            backward[:, t] = np.where(real[:, t + 1, None], now, 1.0)
        joint = forward * backward
        bad = joint[:, :, 1] / joint.sum(axis=2)
        out[place[real]] = bad[real]
        if pairs and longest > 1:
            ahead = backward[:, 1:] * local[:, 1:]
            both = forward[:, :-1, :, None] * step * ahead[:, :, None, :]
            both /= both.sum(axis=(2, 3), keepdims=True)
            expected += both[real[:, 1:]].sum(axis=0)
    return (out, expected) if pairs else out


@dataclass
class QualityModel:
    weights: np.ndarray
    moves: np.ndarray
    slope: float
    offset: float

    def raw(self, texts: list[bytes | None]) -> np.ndarray:
        """The length-weighted mean of P(good) over the lines of each text."""
        steps, size, lines_of = line_features(texts)
        unary = self.weights[with_neighbours(steps, lines_of)].sum(axis=1) + self.weights[-1]
        bad = marginals(unary, lines_of, self.moves, groups_of(lines_of))
        starts = np.concatenate([[0], np.cumsum(lines_of)[:-1]])
        weight = size + 1.0
        return 1 - np.add.reduceat(bad * weight, starts) / np.add.reduceat(weight, starts)

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        return _curve(self.raw(texts), self.slope, self.offset)


def _log_odds(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return np.log(share / (1 - share))


def _curve(share: np.ndarray, slope: float, offset: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * _log_odds(share) + offset, -50, 50)))


def fit(steps: np.ndarray, size: np.ndarray, lines_of: np.ndarray, good: np.ndarray, weight: np.ndarray,
        rounds: int = STEPS) -> QualityModel:
    """The chain's weights by gradient ascent on its likelihood, then the logistic curve.

    ``good`` is each text's label, ``weight`` what a text counts: the class proportions of all labelled rows.
    """
    index = with_neighbours(steps, lines_of)
    groups = groups_of(lines_of)
    label = np.repeat(1 - good, lines_of).astype(float)
    each = np.repeat(1.0 / lines_of, lines_of)  # a text counts once, however many lines it has
    starts = np.concatenate([[0], np.cumsum(lines_of)[:-1]])
    balance = np.repeat(np.where(good == 1, 0.5 / max(good.sum(), 1), 0.5 / max((1 - good).sum(), 1)), lines_of) * each
    stay = [np.maximum(lines_of - 1, 0)[good == 1 - c].sum() for c in (0, 1)]
    seen = np.array([[stay[0], 0.0], [0.0, stay[1]]])
    weights, moves = np.zeros(N_WEIGHTS), np.zeros((2, 2))
    flat = index.ravel()
    speed, mean, square = 0.15, np.zeros(N_WEIGHTS + 4), np.zeros(N_WEIGHTS + 4)
    for i in range(1, rounds + 1):
        unary = weights[index].sum(axis=1) + weights[-1]
        bad, expected = marginals(unary, lines_of, moves, groups, pairs=True)
        rest = (label - bad) * balance
        gradient = np.bincount(flat, weights=np.repeat(rest, index.shape[1]), minlength=N_WEIGHTS) - RIDGE * weights
        gradient[-1] = rest.sum()
        change = (seen - expected) / max(1, (lines_of - 1).sum()) - RIDGE * 10 * moves
        gradient = np.concatenate([gradient, change.ravel()])
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient ** 2
        step = speed * (mean / (1 - 0.9 ** i)) / (np.sqrt(square / (1 - 0.99 ** i)) + 1e-8)
        weights, moves = weights + step[:-4], moves + step[-4:].reshape(2, 2)
    unary = weights[index].sum(axis=1) + weights[-1]
    bad = marginals(unary, lines_of, moves, groups)
    part = size + 1.0
    share = 1 - np.add.reduceat(bad * part, starts) / np.add.reduceat(part, starts)
    slope, offset = 1.0, 0.0
    x, y = _log_odds(share), good.astype(float)
    for _ in range(50):  # Newton's method on two numbers
        p = _curve(share, slope, offset)
        w = weight * p * (1 - p) + 1e-9
        g = np.array([(weight * (y - p) * x).sum() - 1e-3 * (slope - 1), (weight * (y - p)).sum() - 1e-3 * offset])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        change = np.clip(np.linalg.solve(h, g), -1, 1)
        slope, offset = slope + change[0], offset + change[1]
    return QualityModel(weights, moves, float(max(slope, 0.05)), float(offset))


def learn(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text",
          quality_col: str = "quality", rows_per_class: int = ROWS_PER_CLASS) -> QualityModel | None:
    """A model from the labelled documents for which ``allowed`` (a condition on the labels) holds.

    Null labels and labels other than 0 and 1 are left out; of contradicting labels of one id the lower holds; a repeated
    document counts as often as it is there. None if there is no labelled document of both classes.
    """
    known = (labels.where(allowed).where(F.col(quality_col).isin(0, 1)).groupBy(F.col(id_col).alias("k"))
             .agg(F.min(quality_col).cast("int").alias("y")).where("k is not null"))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if set(totals) != {0, 1}:
        return None
    order = F.md5(F.col("k").cast("string"))
    chosen = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(order, "k").limit(rows_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * rows_per_class ids, a bounded table.
    sample = with_row(docs, [id_col, text_col]).join(F.broadcast(chosen), F.col("c0") == F.col("k")).select("y", "c1")

    def setup():
        def work(texts):
            steps, size, lines_of = line_features(texts)
            ends = np.cumsum(lines_of)
            return ([steps[e - n:e].tobytes() for e, n in zip(ends, lines_of)], [size[e - n:e].tolist() for e, n in zip(ends, lines_of)])

        return work

    rows = map_texts(sample, "y", "c1", setup, fields("steps binary, size array<bigint>")).collect()
    if {r["y"] for r in rows} != {0, 1}:
        return None
    rows.sort(key=lambda r: (r["y"], bytes(r["steps"])))
    lines_of = np.array([len(r["size"]) for r in rows])
    steps = np.frombuffer(b"".join(bytes(r["steps"]) for r in rows), dtype=np.int16).reshape(-1, FEATURES)
    size = np.concatenate([r["size"] for r in rows])
    good = np.array([r["y"] for r in rows])
    met = np.bincount(good, minlength=2)
    weight = np.array([totals[0] / met[0], totals[1] / met[1]])[good]
    return fit(steps, size, lines_of, good, weight * len(good) / weight.sum())


def predict(docs: DataFrame, model: QualityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every whole text; null texts count as empty, repeated rows and ids are rows of their own.
    Without a model every score is 0.5."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def setup():
        known = shared.value

        def work(texts):
            scores = np.full(len(texts), 0.5) if known is None else known.score(texts)
            return scores, (scores >= 0.5).astype(np.int32)

        return work

    return map_texts(docs, id_col, text_col, setup, fields("score double, predicted int"))


def keep_good(docs: DataFrame, model: QualityModel | None, text_col: str = "text") -> DataFrame:
    """The documents, with all their columns, that the model predicts to be good: one pass, no shuffle. Repeated rows all
    stay or all go; without a model all stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(text: pd.Series) -> pd.Series:
        if shared.value is None:
            return pd.Series(np.ones(len(text), dtype=bool))
        out = [shared.value.score([t if t is None else bytes(t) for t in text.iloc[i:i + 128]]) >= 0.5 for i in range(0, len(text), 128)]
        return pd.Series(np.concatenate(out) if out else np.zeros(0, dtype=bool))

    return docs.where(good(F.col(f"`{text_col}`").cast("binary")))
