"""Relevance of documents to one query text or to many, and of vectors to query vectors.

The default scorer is BM25 over word tokens; a vector variant takes stored embeddings. An own
model plugs in through ``responses.pointwise_apply``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialize

K1, B = 1.2, 0.75
# Letters and digits of any script make words.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
_WORD_GAP = re.compile(r"[\W_]+")


def query_terms(query: str) -> list[str]:
    """Distinct words of the query, in order."""
    return list(dict.fromkeys(t for t in _WORD_GAP.split(query.lower()) if t))


def term_counts(docs: DataFrame, terms: list[str], id_col: str, text_col: str) -> DataFrame:
    """(id, length, tf): number of words, and how often each term occurs, in the order of the terms.

    The words that are no terms are dropped first. The rest are set apart by two blanks, so that
    " term " occurs once per word; counting is then a byte search for each term in a short text,
    without a row per word and without a shuffle.
    """
    found = docs.select(id_col, F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), TOKEN_SPLIT).alias("_all"))
    kept = found.select(
        id_col, (F.size("_all") - F.when(F.get("_all", 0) == "", 1).otherwise(0)
                 - F.when((F.size("_all") > 1) & (F.element_at("_all", -1) == ""), 1).otherwise(0)).alias("length"),
        F.concat(F.lit(" "), F.array_join(F.filter("_all", lambda t: t.isin(*terms)), "  "), F.lit(" ")).alias("_terms"))

    def count(term: str) -> Column:
        left = F.length(F.replace(F.col("_terms"), F.lit(f" {term} "), F.lit("")))
        return F.floor((F.length("_terms") - left) / (len(term) + 2)).cast("int")

    return kept.select(id_col, "length", F.array(*[count(t) for t in terms]).cast("array<int>").alias("tf"))


def relevance_score(docs: DataFrame, query: str, id_col: str = "candidate_id", text_col: str = "doc_text") -> DataFrame:
    """(id, score): BM25 of every document. Documents without a query word score 0.

    No document is shuffled. One pass over the texts stores a few counts per document; the
    collection statistics, one row, and the scores are read from those.
    """
    terms = query_terms(query)
    counted = materialize(term_counts(docs, terms, id_col, text_col), "terms")
    seen = [F.count_if(F.get("tf", i) > 0) for i in range(len(terms))]
    total, mean, *frequency = counted.agg(F.count("*"), F.avg("length"), *seen).first()
    scale = K1 * (1 - B + B * F.col("length") / F.lit(mean or 1.0))
    score = F.lit(0.0)
    for i, n in enumerate(frequency):
        weight = math.log(1 + (total - n + 0.5) / (n + 0.5))
        score = score + F.lit(weight) * F.get("tf", i) * (K1 + 1) / (F.get("tf", i) + scale)
    return counted.select(id_col, score.alias("score"))


def _words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), TOKEN_SPLIT), "")


#: The word that every document has once, in the counts only.
_EVERY = ""


def inverted_index(docs: DataFrame, words: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """((word, term, id, impact), (word, term, n, bound)): what each of the words adds to the BM25 score of each document that has it.

    ``words`` (word) says which words are looked for; no other word moves, unless the list is too long to be sent to all tasks. ``n`` is the number of documents with the word, ``bound`` the greatest
    impact, ``term`` a number of its own. Words are counted per document before they move. Texts are read once: an empty word that
    is counted with the others stands for the document itself, so that the number of documents and their mean length come from the counts.
    """
    split = docs.select(F.col(id_col).alias("id"), _words(text_col).alias("w"))
    spark = docs.sparkSession
    looked_for = materialize(words.select("word").unionByName(spark.range(1).select(F.lit(_EVERY).alias("word"))), "words")  # once stored, its size is known
    every = split.select("id", F.size("w").alias("length"), F.explode(F.concat(F.array(F.lit(_EVERY)), "w")).alias("word")).join(looked_for, "word", "left_semi")
    counted = materialize(every.groupBy("id", "length", "word").agg(F.count("*").alias("tf")).select("word", "id", "length", "tf"), "postings")
    total, mean = counted.filter(F.col("word") == _EVERY).agg(F.coalesce(F.sum("tf"), F.lit(0)), F.try_divide(F.sum(F.col("tf") * F.col("length")), F.sum("tf"))).first()
    postings = counted.filter(F.col("word") != _EVERY)
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(mean or 1.0)))
    found = postings.groupBy("word").agg(F.count("*").alias("n"), F.max(part).alias("part"))
    weight = F.log(1 + (F.lit(total) - F.col("n") + 0.5) / (F.col("n") + 0.5))
    known = found.select("word", F.monotonically_increasing_id().alias("term"), "n", weight.alias("weight"), (weight * F.col("part")).alias("bound"))
    bounds = materialize(known, "word_bounds")
    index = postings.join(bounds.select("word", "term", "weight"), "word").select("word", "term", "id", (F.col("weight") * part).alias("impact"))
    return index, bounds


def _best(scored: DataFrame, k: int) -> DataFrame:
    """(q, id, score, pos): the k best per query. Tasks keep k rows per query before anything moves."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    return scored.withColumn("pos", F.row_number().over(order)).filter(F.col("pos") <= k)


#: Rows of the index that one part of the documents is made for.
PART_POSTINGS = 500_000
#: Query texts or vectors that a part meets at once.
ASK_ROWS = 20_000
#: Scores that differ by less may change places by the order of their sums or by rounding to nine digits.
_NEAR = 1e-8


def _first_of_equals(score: np.ndarray, k: int) -> np.ndarray:
    """Of falling scores: the first k of every run of equal ones."""
    return np.arange(len(score)) - np.searchsorted(-score, -score) < k


def _best_in_part(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of the index rows of one part of the documents and the queries' terms: whatever may be among the k best of a query, with its score.

    The rows of a term stand together, and a query adds up those of its terms. Of equal scores the k least ids are kept,
    however many documents there are.
    """
    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids = rows["id"].unique()
        ids = ids.take(pc.array_sort_indices(ids, null_placement="at_start"))
        place, term, impact = pc.index_in(rows["id"], value_set=ids).to_numpy(), rows["term"].to_numpy(), rows["impact"].to_numpy()
        order = np.lexsort((place, term))
        place, term, impact = place[order], term[order], impact[order]
        own = np.flatnonzero(np.diff(term, prepend=-1) | np.diff(place, prepend=-1))  # an id may come with several texts
        place, term, impact = place[own], term[own], np.add.reduceat(impact, own) if len(own) else impact
        terms = pc.list_flatten(asked["terms"]).to_numpy()
        starts, ends = np.searchsorted(term, terms), np.searchsorted(term, terms, side="right")
        upto, found = np.cumsum(pc.list_value_length(asked["terms"]).to_numpy()), []
        for at, (low, high) in enumerate(zip([0, *upto[:-1]], upto) if len(ids) else ()):
            score = np.zeros(len(ids))
            for x, y in zip(starts[low:high], ends[low:high]):
                score[place[x:y]] += impact[x:y]
            hit = np.flatnonzero(score)
            score = score[hit]
            if len(hit) > k:
                near = score >= np.partition(score, -k)[-k] - _NEAR
                hit, score = hit[near], score[near]
            order = np.argsort(-score, kind="stable")  # equal ones stay in the order of their ids
            hit, score = hit[order], score[order]
            kept = _first_of_equals(score, k)
            found.append((np.full(kept.sum(), at), hit[kept], score[kept]))
        at, places, scores = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, t) for i, t in enumerate((int, int, float)))
        return pa.table({"q": asked["q"].take(pa.array(at)), "id": ids.take(pa.array(places)), "score": scores})

    return run


def relevance_topk(
    docs: DataFrame, queries: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id", query_text: str = "text",
) -> DataFrame:
    """(query id, document id, score, pos): the k best documents by BM25 for every query, however many there are.

    Documents without a word of a query are not in its list; equal scores (to nine digits) go by document id.

    The rows of an inverted index are dealt into parts by document, about ``PART_POSTINGS`` each, and every part meets all queries,
    ``ASK_ROWS`` at a time. A part adds up whole scores and hands on the best of each query, so that no row per query and
    document moves. The search is exact: all documents with a word of a query are scored.
    """
    asked = queries.select(F.col(query_id).alias("q"), F.explode(F.array_distinct(_words(query_text))).alias("word")).filter("q IS NOT NULL").distinct()
    index, bounds = inverted_index(docs, asked.select("word").distinct(), id_col, text_col)
    terms = materialize(asked.join(bounds, "word").groupBy("q").agg(F.sort_array(F.collect_list("term")).alias("terms")), "query_terms")
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, -(-(bounds.agg(F.sum("n")).first()[0] or 0) // PART_POSTINGS))
    blocks = max(1, -(-terms.count() // ASK_ROWS))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = index.select(F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), each(blocks).alias("block"), "id", "term", "impact")
    wanted = terms.select(each(parts).alias("part"), F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int").alias("block"), "q", "terms")
    result = T.StructType([terms.schema["q"], index.schema["id"], T.StructField("score", T.DoubleType())])
    group = ["part", "block"]
    met = rows.groupBy(group).cogroup(wanted.groupBy(group)).applyInArrow(_best_in_part(k), result)
    return _best(met.select("q", "id", F.round("score", 9).alias("score")), k).select(F.col("q").alias(query_id), F.col("id").alias(id_col), "score", "pos")


def cosine_score(vectors: DataFrame, query: list[float], id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, score): cosine of every vector and the query vector."""
    norm = math.sqrt(sum(x * x for x in query))
    target = F.array(*[F.lit(float(x)) for x in query])
    dot = F.aggregate(F.zip_with(vector_col, target, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, x: s + x)
    own = F.sqrt(F.aggregate(F.transform(vector_col, lambda a: a.cast("double") * a.cast("double")), F.lit(0.0), lambda s, x: s + x))
    return vectors.select(id_col, F.coalesce(F.try_divide(dot, own * norm), F.lit(0.0)).alias("score"))


@dataclass
class VectorIndex:
    """All rows as unit vectors with their cell, the cells' centres, and the rows per cell and part."""

    rows: DataFrame
    centres: list[list[float]]
    sizes: DataFrame


#: Rows that centres are fitted on, at most, and rows that one part of a cell is made for.
SAMPLE_ROWS, PART_ROWS = 20_000, 50_000


def _unit(vector_col: str) -> Column:
    values = F.transform(vector_col, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(values, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(values, lambda x: F.coalesce(F.try_divide(x, norm), F.lit(0.0)))


def vector_index(vectors: DataFrame, cells: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 42) -> VectorIndex:
    """A coarse index: centres fitted on at most ``SAMPLE_ROWS`` rows (by a hash of the id), and every row in the nearest cell.

    Rows without a vector are left out. A cell that holds very many rows is dealt into parts of about ``PART_ROWS``.
    """
    unit = materialize(vectors.filter(F.col(vector_col).isNotNull()).select(F.col(id_col).alias("id"), _unit(vector_col).alias("v")), "unit_vectors")
    sample = unit.orderBy(F.xxhash64(F.lit(seed), "id")).limit(SAMPLE_ROWS).select(array_to_vector("v").alias("features"))
    model: KMeansModel = KMeans(k=cells, seed=seed, maxIter=10).fit(sample)
    placed = model.transform(unit.withColumn("features", array_to_vector("v"))).select("id", "v", F.col("prediction").alias("cell"))
    placed = materialize(placed, "vector_cells")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))
    rows = placed.join(F.broadcast(sizes), "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))  # at most one row a cell
    return VectorIndex(rows.drop("parts"), [c.tolist() for c in model.clusterCenters()], sizes)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = pc.list_flatten(column).to_numpy()
    return values.reshape(len(column), len(values) // max(len(column), 1))


def _nearest_in_part(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Of one part of a cell and the query vectors that ask for it: whatever may be among the k best of a query, with its cosine.

    Matrix products say which rows come into question; their cosines are then summed up in the order of the elements, so that
    equal vectors have equal ones. Of equal cosines the k least ids are kept, however many rows there are.
    """
    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        ids, names, found = rows["id"].to_numpy(), asked["q"].to_numpy(), []
        vectors, targets = _matrix(rows["v"]), _matrix(asked["u"])
        for start in range(0, len(names) if len(ids) else 0, 64):
            for at, products in enumerate((vectors @ targets[start:start + 64].T).T, start):
                others = np.flatnonzero(ids != names[at])
                if len(others) > k:
                    products = products[others]
                    least = np.partition(products, -k)[-k] - _NEAR
                    others = others[~(products < least)]
                score = np.zeros(len(others))
                for x, y in zip(vectors[others].T, targets[at]):
                    score += x * y
                order = np.argsort(-score, kind="stable")  # equal ones stay in the order of their ids
                others, score = others[order], score[order]
                kept = _first_of_equals(score, k)
                found.append((np.full(kept.sum(), at), others[kept], score[kept]))
        at, places, scores = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, t) for i, t in enumerate((int, int, float)))
        return pa.table({"q": asked["q"].take(pa.array(at)), "id": rows["id"].take(pa.array(places)), "score": scores})

    return run


def nearest(index: VectorIndex, queries: DataFrame, k: int, probes: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query, id, score, pos): the k rows with the greatest cosine per query vector, equal ones by id; not the query's own row.

    Only the ``probes`` cells whose centres are nearest are looked at; without ``probes`` all of them, and the result is exact.
    """
    centres = F.array(*[F.array(*[F.lit(x) for x in c]) for c in index.centres])

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    asked = queries.filter(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("q"), _unit(vector_col).alias("u"))
    blocks = max(1, -(-asked.count() // ASK_ROWS))
    ranked = F.array_sort(F.transform(centres, lambda c, i: F.struct((-dot(c, F.col("u"))).alias("minus"), i.cast("int").alias("cell"))))
    cells = F.slice(ranked, 1, probes) if probes else ranked
    wanted = asked.withColumn("block", F.pmod(F.xxhash64("q"), F.lit(blocks))).select("q", "u", "block", F.explode(F.transform(cells, lambda c: c["cell"])).alias("cell"))
    wanted = wanted.join(F.broadcast(index.sizes), "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = index.rows.filter("id IS NOT NULL").withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    result = T.StructType([asked.schema["q"], rows.schema["id"], T.StructField("score", T.DoubleType())])
    group = ["cell", "part", "block"]
    met = rows.groupBy(group).cogroup(wanted.groupBy(group)).applyInArrow(_nearest_in_part(k), result)
    return _best(met.select("q", "id", F.round("score", 9).alias("score")), k).withColumnRenamed("q", "query")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(queries, rows, found, recall): the share of the exact result that another one has."""
    both = exact.select("query", "id").join(found.select("query", "id", F.lit(1).alias("_hit")), ["query", "id"], "left")
    return both.agg(F.count_distinct("query").alias("queries"), F.count("*").alias("rows"), F.count("_hit").alias("found")).withColumn(
        "recall", F.coalesce(F.try_divide(F.col("found").cast("double"), F.col("rows")), F.lit(1.0)))
