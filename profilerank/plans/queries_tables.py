"""Registered queries over the flat tables: sources, joins, ranks, labels, answers, metrics, results, streams."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import grounding as G
from ..functions import numbers as N
from ..functions import ordinals as O
from ..functions import responses as R
from ..operators import checks, evaluate, explain, integrity, joins, labels, model, ranking, relevance, responses, rules
from ..schema import ID
from ..session import materialize, new_path, spread
from ..sources import readers, writers
from ..streaming import score as streams
from .fixture import pool, table
from .queries_pool import PROSE_FAMILIES, reference
from .registry import register
from .sql import DOC_ID, any_hit, fold, hits, over_pool, strip


def _id(column: Column | str) -> Column:
    key = F.col(column) if isinstance(column, str) else column
    return F.concat(F.lit("CAND_"), F.lpad(key.cast("string"), 7, "0"))


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return table(spark, sf, "documents").select(_id("doc_id").alias(ID), "doc_id", *columns)


# A score with many ties, so that the tie-break counts.
_TIED = "(n_chars % 100) / 10.0::DOUBLE"
_SCORED = f"scored AS (SELECT {DOC_ID} AS candidate_id, doc_id, {_TIED} AS score FROM documents)"
_FLAGGED = "flagged AS (SELECT doc_id, toxic = 1 AS toxic FROM labels)"


def tied_scores(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf, ((F.col("n_chars") % 100) / F.lit(10.0)).alias("score"))


def toxic_flags(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(_id("doc_id").alias(ID), (F.col("toxic") == 1).alias("honeypot_flag"))


# --- sources and sinks ---

def _pool_json(spark: SparkSession, sf: str) -> str:
    path = new_path(spark, "pool-json")
    pool(spark, sf).write.json(path)
    return path


_POOL_SQL = over_pool("""SELECT candidate_id, len(career_history)::INT AS roles, len(skills)::INT AS skills, profile.years_of_experience AS years,
  coalesce(list_sum(list_transform(career_history, lambda x: x.duration_months)), 0)::DOUBLE AS months, len(profile.summary)::INT AS summary_length,
  signals.last_active_date AS last_active, len(signals.scores)::INT AS assessments FROM pool""")


def _pool_columns(read: DataFrame) -> DataFrame:
    return read.select(
        ID, F.greatest(F.size("career_history"), F.lit(0)).alias("roles"), F.greatest(F.size("skills"), F.lit(0)).alias("skills"),
        F.col("profile.years_of_experience").alias("years"),
        F.coalesce(F.aggregate(F.filter(F.transform("career_history", lambda h: h["duration_months"]), lambda d: d.isNotNull()),
                               F.lit(0.0), lambda a, d: a + d), F.lit(0.0)).alias("months"),
        F.length("profile.summary").alias("summary_length"), F.col("signals.last_active_date").alias("last_active"),
        F.greatest(F.size("signals.skill_assessment_scores"), F.lit(0)).alias("assessments"))


@register("scan_pool", _POOL_SQL)
def scan_pool(spark: SparkSession, sf: str) -> DataFrame:
    """The pool through JSON lines and back."""
    return _pool_columns(readers.scan_pool(spark, _pool_json(spark, sf)))


def _as_array(batches):
    """The objects of a task as the lines of one JSON array."""
    yield pa.RecordBatch.from_pydict({"value": ["["]})
    first = True
    for batch in batches:
        lines = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_pydict({"value": [("" if first and not i else ",") + line for i, line in enumerate(lines)]})
        first = first and not lines
    yield pa.RecordBatch.from_pydict({"value": ["]"]})


@register("scan_pool_array", _POOL_SQL)
def scan_pool_array(spark: SparkSession, sf: str) -> DataFrame:
    """The pool through files that are JSON arrays, and back."""
    path = new_path(spark, "pool-arrays")
    pool(spark, sf).select(F.to_json(F.struct("*")).alias("value")).mapInArrow(_as_array, "value string").write.text(path)
    return _pool_columns(readers.scan_pool(spark, path, array=True))


def _score_parts(spark: SparkSession, sf: str) -> str:
    """Score files of three shards with a repeated id and rows of a wrong width; returns their pattern."""
    base = new_path(spark, "scores")
    scores = documents(spark, sf, (F.col("n_chars") / 7).alias("score"))
    line = F.concat_ws(",", ID, F.format_string("%.6f", "score"), F.when(F.col("doc_id") % 50 == 7, "extra"))
    for shard in range(3):
        rows = scores.filter(F.col("doc_id") % 3 == shard).select(ID, F.format_string("%.6f", "score").alias("score"))
        rows.write.option("header", True).csv(f"{base}/scores_{shard}.csv")
    scores.select(F.concat(F.lit("x"), line, F.lit(",3rd")).alias("value")).write.text(f"{base}/scores_bad.csv")
    return f"{base}/scores_*.csv"


@register("scan_scores_glob", f"SELECT {DOC_ID} AS candidate_id, printf('%.6f', n_chars / 7::DOUBLE)::DOUBLE AS score FROM documents")
def scan_scores_glob(spark: SparkSession, sf: str) -> DataFrame:
    return readers.scan_scores_glob(spark, _score_parts(spark, sf)).select(ID, "score")


_CACHE = "candidate_id string, rubric_version string, turn bigint, brief_rationale string"


@register("scan_cache_tolerant", """SELECT 'CAND_' || lpad(conv_id::VARCHAR, 7, '0') AS candidate_id, 'v0' AS rubric_version,
  max(turn) AS turn, max_by(text, turn) AS brief_rationale FROM conversations WHERE turn % 2 = 0 GROUP BY conv_id""")
def scan_cache_tolerant(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "cache")
    entries = table(spark, sf, "conversations").select(
        _id("conv_id").alias(ID), F.concat(F.lit("v"), F.col("turn") % 2).alias("rubric_version"), "turn", F.col("text").alias("brief_rationale"))
    writers.sink_append(entries.filter("turn < 2"), path)
    writers.sink_append(entries.filter("turn >= 2"), path)
    entries.select(F.concat(F.lit("{broken "), "brief_rationale").alias("value")).write.mode("append").text(path)
    return readers.scan_cache_tolerant(spark, path, _CACHE, "v0", order="turn")


@register("col_alias_resolve", f"SELECT {DOC_ID} AS candidate_id, quality AS relevance_grade, toxic AS honeypot_flag FROM labels")
def col_alias_resolve(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "labels").select(_id("doc_id").alias(ID), F.col("quality").alias("grade"), F.col("toxic").alias("flagged"))
    named = readers.col_alias_resolve(raw, readers.GRADE_ALIASES, "relevance_grade")
    return readers.col_alias_resolve(named, readers.FLAG_ALIASES, "honeypot_flag")


_RANKED = f"WITH {_SCORED}, ranked AS (SELECT *, row_number() OVER (ORDER BY score DESC, candidate_id) AS rank FROM scored)"


@register("sink_ranked", _RANKED + " SELECT candidate_id, rank, printf('%.6f', score) AS score FROM ranked")
def sink_ranked(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "ranked")
    writers.sink_ranked(ranking.rank_scores(tied_scores(spark, sf)).select(ID, "rank", "score"), path, ("score",))
    return spark.read.schema(f"{ID} string, rank bigint, score string").option("header", True).csv(path)


@register("sink_append", f"SELECT {DOC_ID} AS candidate_id, 'run' || (doc_id % 2) AS run, n_chars FROM documents")
def sink_append(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "append")
    rows = documents(spark, sf, "n_chars").withColumn("run", F.concat(F.lit("run"), F.col("doc_id") % 2)).drop("doc_id")
    for run in ("run0", "run1"):
        writers.sink_append(rows.filter(F.col("run") == run), path, "run", "parquet")
    return spark.read.parquet(path).withColumn("run", F.col("run").cast("string"))


@register("sink_preview", _RANKED + " SELECT candidate_id, score FROM ranked WHERE rank <= 25")
def sink_preview(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "preview")
    writers.sink_preview(tied_scores(spark, sf).select(ID, "score"), path, 25)
    return spark.read.schema(f"{ID} string, score double").option("header", True).csv(f"{path}.top25")


# --- scalar values ---

_MESSY = "CASE doc_id % 9 WHEN 0 THEN ' True ' WHEN 1 THEN '0' WHEN 2 THEN 'YES' WHEN 3 THEN 'no' WHEN 4 THEN '' WHEN 5 THEN NULL WHEN 6 THEN '12.5' WHEN 7 THEN 'abc' ELSE '1' END"


def _messy(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf, F.expr(_MESSY).alias("raw"))


@register("flag_parse", f"""SELECT {DOC_ID} AS candidate_id, CASE WHEN lower(trim(raw)) IN ('true', '1', 'yes') THEN true
  WHEN lower(trim(raw)) IN ('false', '0', 'no') THEN false END AS flag FROM (SELECT doc_id, {_MESSY} AS raw FROM documents)""")
def flag_parse(spark: SparkSession, sf: str) -> DataFrame:
    return _messy(spark, sf).select(ID, N.flag_parse(F.col("raw")).alias("flag"))


@register("num_coerce", f"""SELECT {DOC_ID} AS candidate_id, TRY_CAST(raw AS DOUBLE) AS value, NULL::DOUBLE AS absent,
  floor(coalesce(TRY_CAST(raw AS DOUBLE), -1)) AS code FROM (SELECT doc_id, {_MESSY} AS raw FROM documents)""")
def num_coerce(spark: SparkSession, sf: str) -> DataFrame:
    raw = _messy(spark, sf).select(ID, F.col("raw").alias("value"), F.col("raw").alias("code"))
    return model.coerce_features(raw, ["value", "absent", "code"], ["code"])


@register("null_clean", f"""SELECT {DOC_ID} AS candidate_id, CASE WHEN doc_id % 4 = 0 OR doc_id % 4 = 1 THEN 0 ELSE n_chars END::DOUBLE AS value FROM documents""")
def null_clean(spark: SparkSession, sf: str) -> DataFrame:
    dirty = F.when(F.col("doc_id") % 4 == 0, F.lit(float("nan"))).when(F.col("doc_id") % 4 != 1, F.col("n_chars").cast("double"))
    return documents(spark, sf, dirty.alias("value")).select(ID, N.null_clean(F.col("value")).alias("value"))


@register("fmt_value", f"SELECT {DOC_ID} AS candidate_id, CASE WHEN n_chars % 4 = 0 THEN (n_chars // 4)::VARCHAR ELSE printf('%.2f', n_chars / 4.0::DOUBLE) END AS text FROM documents")
def fmt_value(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf, (F.col("n_chars") / 4).alias("value")).select(ID, N.fmt_value(F.col("value")).alias("text"))


@register("stable_choice", f"""SELECT candidate_id, ['Less convincing: ', 'On the other side: ', 'To be weighed: '][
  (list_sum(list_transform(string_split(md5(candidate_id), ''), lambda c: instr('0123456789abcdef', c) - 1)) % 3 + 1)::INT] AS choice
  FROM (SELECT {DOC_ID} AS candidate_id FROM documents)""")
def stable_choice(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(ID, explain.stable_choice(F.col(ID), explain.LEAD_INS).alias("choice"))


# --- joins ---

@register("join_flags_left", f"WITH {_SCORED}, {_FLAGGED} SELECT candidate_id, score, coalesce(toxic, false) AS honeypot_flag, f.doc_id IS NULL AS flag_missing FROM scored s LEFT JOIN flagged f ON s.doc_id = f.doc_id")
def join_flags_left(spark: SparkSession, sf: str) -> DataFrame:
    return joins.join_flags_left(tied_scores(spark, sf), toxic_flags(spark, sf)).select(ID, "score", "honeypot_flag", "flag_missing")


@register("join_flags_left_repeated", f"""WITH {_SCORED}, f AS (SELECT doc_id, bool_or(toxic = 1) AS t FROM (SELECT doc_id, toxic FROM labels UNION ALL SELECT doc_id, 0 FROM labels UNION ALL SELECT doc_id, 1 FROM labels WHERE doc_id % 9 = 0) GROUP BY doc_id)
  SELECT candidate_id, score, coalesce(t, false) AS honeypot_flag, f.doc_id IS NULL AS flag_missing FROM scored s LEFT JOIN f ON s.doc_id = f.doc_id""")
def join_flags_left_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Every id has two or three flags."""
    flags = table(spark, sf, "labels").select(_id("doc_id").alias(ID), "doc_id", (F.col("toxic") == 1).alias("honeypot_flag"))
    again = flags.withColumn("honeypot_flag", F.lit(False)).unionByName(flags.filter("doc_id % 9 = 0").withColumn("honeypot_flag", F.lit(True)))
    return joins.join_flags_left(tied_scores(spark, sf), flags.unionByName(again).drop("doc_id")).select(ID, "score", "honeypot_flag", "flag_missing")


@register("semi_lookup", f"SELECT {DOC_ID} AS candidate_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)")
def semi_lookup(spark: SparkSession, sf: str) -> DataFrame:
    wanted = table(spark, sf, "labels").filter("quality = 0").select(_id("doc_id").alias(ID))
    return joins.semi_lookup(documents(spark, sf, "text"), wanted).drop("doc_id")


@register("semi_lookup_missing", "SELECT 'CAND_' || lpad(c_custkey::VARCHAR, 7, '0') AS candidate_id FROM customer WHERE c_custkey NOT IN (SELECT doc_id FROM documents)")
def semi_lookup_missing(spark: SparkSession, sf: str) -> DataFrame:
    return joins.missing_ids(table(spark, sf, "customer").select(_id("c_custkey").alias(ID)), documents(spark, sf))


@register("anti_done", f"SELECT {DOC_ID} AS candidate_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_done(spark: SparkSession, sf: str) -> DataFrame:
    return joins.anti_done(documents(spark, sf, "n_chars"), table(spark, sf, "labels").select(_id("doc_id").alias(ID))).drop("doc_id")


@register("anti_done_passes", f"""SELECT {DOC_ID} AS candidate_id, greatest(0, 4 - coalesce(n, 0))::INT AS remaining
  FROM documents LEFT JOIN (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id) ON conv_id = doc_id""")
def anti_done_passes(spark: SparkSession, sf: str) -> DataFrame:
    done = table(spark, sf, "conversations").select(_id("conv_id").alias(ID))
    return joins.remaining_passes(documents(spark, sf), done, 4).select(ID, F.col("remaining").cast("int").alias("remaining"))


@register("join_features_labels", f"SELECT {DOC_ID} AS candidate_id, n_chars, quality FROM documents JOIN labels USING (doc_id)")
def join_features_labels(spark: SparkSession, sf: str) -> DataFrame:
    grades = table(spark, sf, "labels").select(_id("doc_id").alias(ID), "quality")
    return joins.join_features_labels(documents(spark, sf, "n_chars"), grades).drop("doc_id")


@register("join_unmatched_labels", "SELECT count(*) AS unmatched FROM customer WHERE c_custkey NOT IN (SELECT doc_id FROM documents)")
def join_unmatched_labels(spark: SparkSession, sf: str) -> DataFrame:
    return joins.unmatched_labels(documents(spark, sf), table(spark, sf, "customer").select(_id("c_custkey").alias(ID)))


@register("join_pool_labels", f"SELECT {DOC_ID} AS candidate_id, n_chars, coalesce(quality, 0) AS relevance_grade FROM documents LEFT JOIN labels USING (doc_id)")
def join_pool_labels(spark: SparkSession, sf: str) -> DataFrame:
    grades = table(spark, sf, "labels").select(_id("doc_id").alias(ID), F.col("quality").alias("relevance_grade"))
    return joins.join_pool_labels(documents(spark, sf, "n_chars"), grades).drop("doc_id")


# --- ranks ---

@register("global_rank", _RANKED + " SELECT candidate_id, score, rank FROM ranked")
def global_rank(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.rank_scores(tied_scores(spark, sf)).select(ID, "score", "rank")


@register("global_rank_lines", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  row_number() OVER (ORDER BY l_quantity DESC, l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount, l_tax, l_shipdate) AS rank FROM lineitem""")
def global_rank_lines(spark: SparkSession, sf: str) -> DataFrame:
    keys = [F.desc("l_quantity"), F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_tax", "l_shipdate"]
    return ranking.global_rank(table(spark, sf, "lineitem"), keys, keep=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])


@register("dedup_first", """SELECT 'CAND_' || lpad(l_orderkey::VARCHAR, 7, '0') AS candidate_id, min({'a': l_shipdate, 'b': l_partkey, 'c': l_suppkey, 'd': l_linenumber}).b AS l_partkey,
  count(*) AS copies FROM lineitem GROUP BY l_orderkey""")
def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(_id("l_orderkey").alias(ID), "l_shipdate", "l_partkey", "l_suppkey", "l_linenumber")
    return ranking.dedup_first(lines, ["l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"], count="copies").select(ID, "l_partkey", "copies")


@register("demote_flagged", f"""WITH {_SCORED}, {_FLAGGED}, marked AS (SELECT s.*, coalesce(toxic, false) AS honeypot_flag FROM scored s LEFT JOIN flagged f ON s.doc_id = f.doc_id)
  SELECT candidate_id, score, honeypot_flag, row_number() OVER (ORDER BY honeypot_flag, score DESC, candidate_id) AS rank FROM marked""")
def demote_flagged(spark: SparkSession, sf: str) -> DataFrame:
    marked = joins.join_flags_left(tied_scores(spark, sf), toxic_flags(spark, sf))
    return ranking.demote_flagged(marked, "honeypot_flag").select(ID, "score", "honeypot_flag", "rank")


_TOTALS = _RANKED + ", totals AS (SELECT candidate_id, doc_id % 21 AS total_score, rank FROM ranked)"


@register("rerank_total", _TOTALS + " SELECT candidate_id, total_score, row_number() OVER (ORDER BY total_score DESC, rank) AS final_rank FROM totals")
def rerank_total(spark: SparkSession, sf: str) -> DataFrame:
    ranked = ranking.rank_scores(tied_scores(spark, sf)).withColumn("total_score", F.col("doc_id") % 21)
    return ranking.rerank_total(ranked, "total_score", "rank").select(ID, "total_score", "final_rank")


@register("topn_prefix", _RANKED + " SELECT candidate_id, rank FROM ranked WHERE rank <= 30")
def topn_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """Only the 30 best rows are ranked; the others are neither sorted nor stored."""
    return ranking.rank_scores(ranking.top_n(tied_scores(spark, sf), 30)).select(ID, "rank")


# The first ranking holds the labelled documents, the second one all; toxic ones are flagged there.
_MERGED = f"""WITH {_SCORED}, first_r AS (SELECT {DOC_ID} AS candidate_id, row_number() OVER (ORDER BY quality DESC, doc_id) AS final_rank FROM labels),
second_r AS (SELECT s.candidate_id, row_number() OVER (ORDER BY score DESC, s.candidate_id) AS rank, n.doc_id % 5 = 0 AS flag FROM scored s JOIN documents n USING (doc_id)),
united AS (SELECT candidate_id, 0 AS source, final_rank AS r, NULL::BOOLEAN AS initial_flag FROM first_r
  UNION ALL SELECT candidate_id, 1, rank, flag FROM second_r WHERE candidate_id NOT IN (SELECT candidate_id FROM first_r)),
merged AS (SELECT candidate_id, source, row_number() OVER (ORDER BY source, r) AS merged_rank, initial_flag FROM united)"""


def _rankings(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    first = ranking.global_rank(table(spark, sf, "labels").select(_id("doc_id").alias(ID), "doc_id", "quality"), [F.desc("quality"), "doc_id"], "final_rank")
    second = ranking.rank_scores(tied_scores(spark, sf)).withColumn("flag", F.col("doc_id") % 5 == 0)
    return first, second


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    first, second = _rankings(spark, sf)
    return ranking.merge_rankings(first, second, flag="flag")


@register("merge_rankings", _MERGED + " SELECT * FROM merged")
def merge_rankings(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf)


@register("anti_tail", _MERGED + " SELECT candidate_id, r AS rank FROM united WHERE source = 1")
def anti_tail(spark: SparkSession, sf: str) -> DataFrame:
    first, second = _rankings(spark, sf)
    return ranking.anti_tail(second, first).select(ID, "rank")


@register("gap_fill_topk", _MERGED + """, judged AS (SELECT m.*, n_chars % 4 = 0 AS hp FROM merged m JOIN documents d ON 'CAND_' || lpad(d.doc_id::VARCHAR, 7, '0') = m.candidate_id),
clean AS (SELECT merged_rank, row_number() OVER (ORDER BY merged_rank) AS n FROM judged WHERE NOT hp),
cursor_at AS (SELECT least(ceil(merged_rank / 10.0) * 10, (SELECT count(*) FROM merged)) AS c FROM clean WHERE n = 60)
SELECT candidate_id, row_number() OVER (ORDER BY hp AND merged_rank <= c, merged_rank) AS final_rank,
  CASE WHEN merged_rank <= c THEN hp ELSE initial_flag END AS honeypot_flag FROM judged, cursor_at""")
def gap_fill_topk(spark: SparkSession, sf: str) -> DataFrame:
    verdicts = documents(spark, sf, (F.col("n_chars") % 4 == 0).alias("is_honeypot"))
    return ranking.gap_fill_topk(_merged(spark, sf), verdicts, k=60, batch=10, max_checks=500)


@register("flag_share_topk", f"""WITH {_SCORED}, {_FLAGGED}, r AS (SELECT s.*, toxic, row_number() OVER (ORDER BY score DESC, candidate_id) AS rank FROM scored s LEFT JOIN flagged f ON s.doc_id = f.doc_id)
  SELECT count(*) AS top_rows, count(*) FILTER (WHERE toxic) AS flagged, 100.0::DOUBLE * count(*) FILTER (WHERE toxic) / count(*) AS flagged_percent FROM r WHERE rank <= 100""")
def flag_share_topk(spark: SparkSession, sf: str) -> DataFrame:
    best = ranking.top_n(tied_scores(spark, sf), 100)
    return ranking.flag_share(best.join(toxic_flags(spark, sf), ID, "left"), "honeypot_flag")


# --- set operations ---

@register("union_parts", f"WITH {_SCORED} SELECT candidate_id, score FROM scored")
def union_parts(spark: SparkSession, sf: str) -> DataFrame:
    scores = tied_scores(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    english = F.col("lang") == "en"
    return joins.union_parts([scores.filter(english), scores.filter(~english)]).select(ID, "score")


@register("union_clean_flagged", f"WITH {_SCORED}, {_FLAGGED} SELECT candidate_id, score, CASE WHEN toxic THEN 1 ELSE 0 END AS group_order FROM scored s JOIN flagged f ON s.doc_id = f.doc_id")
def union_clean_flagged(spark: SparkSession, sf: str) -> DataFrame:
    marked = tied_scores(spark, sf).join(toxic_flags(spark, sf), ID)
    return joins.union_clean_flagged(marked.filter("NOT honeypot_flag"), marked.filter("honeypot_flag")).select(ID, "score", "group_order")


@register("minus_ids", "SELECT 'CAND_' || lpad(c_custkey::VARCHAR, 7, '0') AS candidate_id FROM (SELECT c_custkey FROM customer EXCEPT SELECT user_id FROM events)")
def minus_ids(spark: SparkSession, sf: str) -> DataFrame:
    return joins.minus_ids(table(spark, sf, "customer").select(_id("c_custkey").alias(ID)), table(spark, sf, "events").select(_id("user_id").alias(ID)))


@register("conservation_check", """WITH b AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), a AS (SELECT c_custkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1),
j AS (SELECT coalesce(b.n, 0) AS b, coalesce(a.n, 0) AS a FROM b FULL JOIN a USING (k))
SELECT sum(b)::BIGINT AS rows_in, sum(a)::BIGINT AS rows_out, count(*) FILTER (WHERE b > 0 AND a = 0) AS lost, count(*) FILTER (WHERE b = 0 AND a > 0) AS added,
  count(*) FILTER (WHERE b > 0 AND a > 0 AND a <> b) AS changed, count(*) FILTER (WHERE a <> b) = 0 AS conserved FROM j""")
def conservation_check(spark: SparkSession, sf: str) -> DataFrame:
    before = table(spark, sf, "orders").select(_id("o_custkey").alias(ID))
    return joins.conservation_check(before, table(spark, sf, "customer").filter("c_acctbal > 0").select(_id("c_custkey").alias(ID)))


# --- grades ---

_GRADE = "CASE WHEN {r} <= 5 THEN 6 WHEN {r} <= 10 THEN 5 WHEN {r} <= 25 THEN 4 WHEN {r} <= 50 THEN 3 WHEN {r} <= 150 THEN 2 WHEN {r} <= 1000 THEN 1 ELSE 0 END"
# Orders by price give ranks beyond the last limit; customers with low balance are flagged.
_PRICED = """priced AS (SELECT 'CAND_' || lpad(o_orderkey::VARCHAR, 7, '0') AS candidate_id, o_custkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS llm_rank FROM orders)"""
_LABELLED = f"""WITH {_PRICED}, graded AS (SELECT candidate_id, llm_rank, {_GRADE.format(r='llm_rank')} AS g, o_custkey % 11 = 0 AS flagged FROM priced),
labelled AS (SELECT candidate_id, llm_rank, CASE WHEN flagged THEN 0 ELSE g END AS relevance_grade, flagged::INT AS honeypot_override_applied FROM graded)"""


def _priced(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(_id("o_orderkey").alias(ID), "o_orderkey", "o_custkey", "o_totalprice")
    return ranking.global_rank(rows, [F.desc("o_totalprice"), "o_orderkey"], "llm_rank")


def _labelled(spark: SparkSession, sf: str, priced: DataFrame | None = None) -> DataFrame:
    priced = priced or _priced(spark, sf)
    return labels.grade_labels(priced.select(ID, "llm_rank"), priced.filter("o_custkey % 11 = 0").select(ID))


@register("rank_to_grade", f"WITH {_PRICED} SELECT candidate_id, llm_rank, {_GRADE.format(r='llm_rank')} AS grade FROM priced")
def rank_to_grade(spark: SparkSession, sf: str) -> DataFrame:
    return _priced(spark, sf).select(ID, "llm_rank", O.rank_to_grade(F.col("llm_rank")).alias("grade"))


@register("grade_override", _LABELLED + " SELECT * FROM labelled")
def grade_override(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf)


@register("rank_cap", f"""SELECT candidate_id, TRY_CAST(raw AS BIGINT) AS llm_rank FROM (SELECT {DOC_ID} AS candidate_id, CASE WHEN doc_id % 7 = 0 THEN 'n/a' ELSE n_chars::VARCHAR END AS raw FROM documents)
  WHERE TRY_CAST(raw AS BIGINT) <= 2000""")
def rank_cap(spark: SparkSession, sf: str) -> DataFrame:
    raw = documents(spark, sf, F.when(F.col("doc_id") % 7 == 0, "n/a").otherwise(F.col("n_chars").cast("string")).alias("rank"))
    return labels.rank_cap(raw, max_rank=2000)


@register("label_gain", _LABELLED + " SELECT candidate_id, (2 ** relevance_grade - 1)::DOUBLE AS gain FROM labelled")
def label_gain(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf).select(ID, O.label_gain(F.col("relevance_grade")).alias("gain"))


@register("pseudo_label_union", f"""WITH l AS (SELECT {DOC_ID} AS candidate_id, row_number() OVER (ORDER BY quality DESC, doc_id) AS llm_rank, doc_id FROM labels)
SELECT candidate_id, llm_rank, {_GRADE.format(r='llm_rank')} AS relevance_grade, 0 AS honeypot_override_applied FROM l
UNION ALL SELECT {DOC_ID}, NULL, CASE WHEN doc_id % 10 = 0 THEN 0 ELSE 1 END, (doc_id % 10 = 0)::INT FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def pseudo_label_union(spark: SparkSession, sf: str) -> DataFrame:
    ranks = ranking.global_rank(table(spark, sf, "labels").select(_id("doc_id").alias(ID), "doc_id", "quality"), [F.desc("quality"), "doc_id"], "llm_rank")
    known = labels.grade_labels(ranks.select(ID, "llm_rank"))
    ids = documents(spark, sf)
    return labels.pseudo_label_union(known, ids, ids.filter("doc_id % 10 = 0"), grade=1)


_SPLIT = _LABELLED + """, placed AS (SELECT *, row_number() OVER (PARTITION BY relevance_grade ORDER BY md5('42:' || candidate_id), candidate_id) AS p, count(*) OVER (PARTITION BY relevance_grade) AS n FROM labelled),
split AS (SELECT *, CASE WHEN p <= (CASE WHEN n > 1 THEN greatest(1, round_even(n * 0.15::DOUBLE, 0)) ELSE 0 END) THEN 'val' ELSE 'train' END AS split FROM placed)"""


@register("stratified_split", _SPLIT + " SELECT candidate_id, relevance_grade, split FROM split")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return labels.stratified_split(_labelled(spark, sf)).select(ID, "relevance_grade", "split")


@register("grade_histogram", _SPLIT + """ SELECT s.split, g.grade::INT AS grade, count(l.candidate_id) AS n, round(100.0::DOUBLE * count(l.candidate_id) / any_value(s.total), 1) AS percent
  FROM (SELECT split, count(*) AS total FROM split GROUP BY split) s CROSS JOIN (SELECT unnest(range(7)) AS grade) g LEFT JOIN split l ON l.split = s.split AND l.relevance_grade = g.grade GROUP BY s.split, g.grade""")
def grade_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return labels.grade_histogram(labels.stratified_split(_labelled(spark, sf)), by=("split",))


@register("dataset_assemble", _SPLIT + """ SELECT candidate_id, o_totalprice, relevance_grade, split, (2 ** relevance_grade - 1)::DOUBLE AS label_gain
  FROM split JOIN (SELECT 'CAND_' || lpad(o_orderkey::VARCHAR, 7, '0') AS candidate_id, o_totalprice FROM orders) USING (candidate_id)""")
def dataset_assemble(spark: SparkSession, sf: str) -> DataFrame:
    priced = _priced(spark, sf)
    built = labels.dataset_assemble(priced.select(ID, "o_totalprice"), _labelled(spark, sf, priced))
    return built.select(ID, "o_totalprice", "relevance_grade", "split", "label_gain")


@register("dataset_metadata", _SPLIT + """ SELECT count(*) AS labeled_set_size, count(*) FILTER (WHERE split = 'train') AS train_group_size, count(*) FILTER (WHERE split = 'val') AS val_group_size,
  (SELECT string_agg(c::VARCHAR, ',' ORDER BY g) FROM (SELECT g, count(candidate_id) AS c FROM (SELECT unnest(range(7)) AS g) LEFT JOIN split ON relevance_grade = g AND split = 'train' GROUP BY g)) AS train_grades,
  (SELECT string_agg(c::VARCHAR, ',' ORDER BY g) FROM (SELECT g, count(candidate_id) AS c FROM (SELECT unnest(range(7)) AS g) LEFT JOIN split ON relevance_grade = g AND split = 'val' GROUP BY g)) AS val_grades FROM split""")
def dataset_metadata(spark: SparkSession, sf: str) -> DataFrame:
    priced = _priced(spark, sf)
    built = labels.dataset_assemble(priced.select(ID, "o_totalprice"), _labelled(spark, sf, priced))
    row = labels.dataset_metadata(built, built, ["o_totalprice"], [])
    return row.select("labeled_set_size", "train_group_size", "val_group_size",
                      F.array_join(F.col("train_grade_histogram").cast("array<string>"), ",").alias("train_grades"),
                      F.array_join(F.col("val_grade_histogram").cast("array<string>"), ",").alias("val_grades"))


# --- answers of a scorer ---

_VERDICT_RAW = """CASE doc_id % 8
  WHEN 0 THEN '{"is_honeypot": true, "violation_category": "CAREER_SPAN_EXCEEDS_EXPERIENCE", "evidence": " gap of 8 years ", "brief_rationale": " from ' || source || ' "}'
  WHEN 1 THEN '```json {"is_honeypot": false, "evidence": "x", "brief_rationale": "ok ' || source || '"} ```'
  WHEN 2 THEN '<think>maybe {"is_honeypot": true}</think> So: {"is_honeypot": false}'
  WHEN 3 THEN '{"is_honeypot": tru'
  WHEN 4 THEN '{"is_honeypot": "yes", "brief_rationale": "' || source || '"}'
  WHEN 5 THEN '{"is_honeypot": true, "violation_category": "INVALID_EDUCATION_DATES", "evidence": "  "}'
  WHEN 6 THEN '{"is_honeypot": true, "violation_category": "' || source || '", "evidence": "x"}'
  ELSE '{"is_honeypot": false} and {more}' END"""
_SCORE_RAW = """CASE doc_id % 7
  WHEN 0 THEN '{"retrieval_score": ' || (doc_id % 40 - 3) || '.5, "evaluation_score": ' || (doc_id % 25) || ', "applied_ml_score": 2.5, "credibility_score": 3.5, "bonus_score": 40}'
  WHEN 1 THEN '{"retrieval_score": 30, "evaluation_score": 19, "applied_ml_score": ' || (doc_id % 26) || ', "credibility_score": 3, "bonus_score": 1, "hard_disqualifier": true, "disqualifier_reason": " ' || source || ' "}'
  WHEN 2 THEN '{"retrieval_score": "30", "evaluation_score": 19, "applied_ml_score": 2, "credibility_score": 3, "bonus_score": 1}'
  WHEN 3 THEN '{"retrieval_score": null, "evaluation_score": 19, "applied_ml_score": 2, "credibility_score": 3, "bonus_score": 1}'
  WHEN 4 THEN '{"retrieval_score": 1, "evaluation_score": 1, "applied_ml_score": 2, "credibility_score": 3, "bonus_score": 1, "hard_disqualifier": "false"}'
  WHEN 5 THEN 'no object here' ELSE '<think>hm</think>```json{"retrieval_score": 12, "evaluation_score": ' || (doc_id % 25) || ', "applied_ml_score": 2, "credibility_score": 3, "bonus_score": 1, "hard_disqualifier": false, "brief_rationale": " fine "}```' END"""


def _extract_sql(raw: str) -> str:
    after = f"CASE WHEN contains({raw}, '<think>') AND contains({raw}, '</think>') THEN substr({raw}, instr({raw}, '</think>') + 8) ELSE {raw} END"
    return f"nullif(regexp_extract(replace(replace({after}, '```json', ''), '```', ''), '(?s)\\{{.*\\}}'), '')"


def _answers_sql(raw: str) -> str:
    return f"answers AS (SELECT candidate_id, doc_id, raw, CASE WHEN json_valid(obj) THEN obj::JSON END AS j FROM (SELECT *, {_extract_sql('raw')} AS obj FROM (SELECT {DOC_ID} AS candidate_id, doc_id, {raw} AS raw FROM documents)))"


def _raw(spark: SparkSession, sf: str, expression: str) -> DataFrame:
    return documents(spark, sf, F.expr(expression).alias("raw"))


@register("json_extract_object", f"SELECT candidate_id, {_extract_sql('raw')} AS obj FROM (SELECT {DOC_ID} AS candidate_id, {_VERDICT_RAW} AS raw FROM documents)")
def json_extract_object(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf, _VERDICT_RAW).select(ID, R.json_extract_object(F.col("raw")).alias("obj"))


_VERDICTS = f"""WITH {_answers_sql(_VERDICT_RAW)}, parsed AS (SELECT *, json_type(j, '$.is_honeypot') AS t, j->>'$.is_honeypot' = 'true' AS hp, j->>'$.violation_category' AS cat,
  {strip("j->>'$.evidence'")} AS ev, {strip("coalesce(j->>'$.brief_rationale', '')")} AS why FROM answers),
verdicts AS (SELECT candidate_id, raw, hp AS is_honeypot, CASE WHEN hp THEN cat END AS violation_category, CASE WHEN hp THEN ev END AS evidence, why AS brief_rationale
  FROM parsed WHERE t = 'BOOLEAN' AND (NOT hp OR (cat IN ({', '.join(f"'{c}'" for c in R.CATEGORIES)}) AND coalesce(ev, '') <> '')))"""


@register("verdict_validate", _VERDICTS + " SELECT candidate_id, is_honeypot, violation_category, evidence, brief_rationale FROM verdicts")
def verdict_validate(spark: SparkSession, sf: str) -> DataFrame:
    # Stored before the filter, which would otherwise parse every answer a second time.
    checked = materialize(responses.with_verdict(_raw(spark, sf, _VERDICT_RAW)).select(ID, "result"), "verdicts")
    return checked.filter("result IS NOT NULL").select(ID, "result.*")


def _sub(name: str, top: int) -> str:
    return f"greatest(0, least({top}, round_even((j->>'$.{name}')::DOUBLE, 0)))::INT AS {name}"


_SCORES = f"""WITH {_answers_sql(_SCORE_RAW)}, usable AS (SELECT * FROM answers WHERE {' AND '.join(f"json_type(j, '$.{n}') IN ('DOUBLE', 'UBIGINT', 'BIGINT')" for n in R.SUBSCORES)}
  AND coalesce(json_type(j, '$.hard_disqualifier'), 'BOOLEAN') IN ('BOOLEAN', 'NULL')),
subs AS (SELECT candidate_id, {', '.join(_sub(n, t) for n, t in R.SUBSCORES.items())}, coalesce(j->>'$.hard_disqualifier' = 'true', false) AS hard_disqualifier,
  {strip("nullif(j->>'$.disqualifier_reason', '')")} AS disqualifier_reason, {strip("coalesce(j->>'$.brief_rationale', '')")} AS brief_rationale FROM usable),
scores AS (SELECT *, least({' + '.join(R.SUBSCORES)}, CASE WHEN hard_disqualifier THEN 20 ELSE 100 END) AS total_score FROM subs)"""


@register("score_validate", _SCORES + " SELECT * FROM scores")
def score_validate(spark: SparkSession, sf: str) -> DataFrame:
    checked = materialize(responses.with_score(_raw(spark, sf, _SCORE_RAW)).select(ID, "result"), "scores")
    return checked.filter("result IS NOT NULL").select(ID, "result.*")


_NOTE = "'no usable answer in 3 attempts'"
_LEFT = "s.candidate_id IS NULL AS fallback, CASE WHEN s.candidate_id IS NULL THEN a.raw END AS fallback_answer"


@register("fallback_row", _SCORES + f""" SELECT a.candidate_id, {', '.join(f'coalesce({n}, 0) AS {n}' for n in R.SUBSCORES)}, coalesce(hard_disqualifier, false) AS hard_disqualifier, disqualifier_reason,
  CASE WHEN s.candidate_id IS NULL THEN {_NOTE} ELSE brief_rationale END AS brief_rationale, coalesce(total_score, 0) AS total_score, {_LEFT} FROM answers a LEFT JOIN scores s ON a.candidate_id = s.candidate_id""")
def fallback_row(spark: SparkSession, sf: str) -> DataFrame:
    return responses.fallback_row(responses.with_score(_raw(spark, sf, _SCORE_RAW)))


@register("fallback_verdict", _VERDICTS + f""" SELECT a.candidate_id, coalesce(is_honeypot, false) AS is_honeypot, violation_category, evidence,
  CASE WHEN s.candidate_id IS NULL THEN {_NOTE} ELSE brief_rationale END AS brief_rationale, {_LEFT} FROM answers a LEFT JOIN verdicts s ON a.candidate_id = s.candidate_id""")
def fallback_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return responses.fallback_row(responses.with_verdict(_raw(spark, sf, _VERDICT_RAW)), verdict=True)


def length_scores(texts: list[str]) -> list[str]:
    """A stand-in for a model: subscores by text length."""
    return ['{"retrieval_score": %d, "evaluation_score": %d, "applied_ml_score": %d, "credibility_score": 1, "bonus_score": 0, "hard_disqualifier": %s}'
            % (n % 31, n % 21, n % 26, "true" if n % 6 == 0 else "false") for n in map(len, texts)]


def no_scorer(texts: list[str]) -> list[str]:
    raise RuntimeError("nothing is left to ask for")


@register("scoring_run", f"""WITH s AS (SELECT {DOC_ID} AS candidate_id, doc_id, len(text) AS n FROM documents), t AS (SELECT *, n % 31 + n % 21 + n % 26 + 1 AS total FROM s),
c AS (SELECT candidate_id, doc_id, (CASE WHEN n % 6 = 0 THEN least(total, 20) ELSE total END)::INT AS total_score FROM t)
SELECT candidate_id, total_score, row_number() OVER (ORDER BY total_score DESC, doc_id) AS final_rank,
  (SELECT count(*) FROM documents WHERE doc_id % 3 = 0) AS asked_first, (SELECT count(*) FROM documents WHERE doc_id % 3 = 0) + 2 * (SELECT count(*) FROM documents WHERE doc_id % 3 <> 0) AS asked_second, 0::BIGINT AS asked_third FROM c""")
def scoring_run(spark: SparkSession, sf: str) -> DataFrame:
    """Two passes over all documents, resumed: a third of them had one pass before, and a last run asks for nothing."""
    from . import runs

    texts, cache = documents(spark, sf, F.col("text").alias("doc_text")), new_path(spark, "scores-cache")
    _, once = runs.scoring_run(texts.filter("doc_id % 3 = 0"), length_scores, cache, 1)
    _, rest = runs.scoring_run(texts, length_scores, cache, 2)
    final, none = runs.scoring_run(texts, no_scorer, cache, 2, "doc_id")
    return final.select(ID, "total_score", "final_rank", *[F.lit(n).cast("bigint").alias(c) for c, n in (
        ("asked_first", once), ("asked_second", rest), ("asked_third", none))])


def length_scorer(texts: list[str]) -> list[str]:
    """A stand-in for a model: verdicts by text length, some of them unusable."""
    def answer(n: int) -> str:
        if n % 10 == 3:
            return "cannot say"
        if n % 5 == 0:
            return '{"is_honeypot": true, "violation_category": "OTHER_LOGICAL_IMPOSSIBILITY", "evidence": "length %d"}' % n
        return '{"is_honeypot": false, "brief_rationale": "length %d"}' % n

    return [answer(len(t)) for t in texts]


@register("pointwise_apply", f"""SELECT {DOC_ID} AS candidate_id, CASE WHEN len(text) % 10 = 3 THEN NULL ELSE len(text) % 5 = 0 END AS is_honeypot,
  CASE WHEN len(text) % 10 <> 3 AND len(text) % 5 = 0 THEN 'length ' || len(text) END AS evidence, CASE WHEN len(text) % 10 = 3 THEN 1 ELSE 0 END AS attempt FROM documents""")
def pointwise_apply(spark: SparkSession, sf: str) -> DataFrame:
    rows = documents(spark, sf, F.col("text").alias("doc_text"))
    answers = responses.pointwise_apply(rows, length_scorer, responses.with_verdict, max_retries=1)
    return answers.select(ID, F.col("result.is_honeypot").alias("is_honeypot"), F.col("result.evidence").alias("evidence"), "attempt")


# Lines of an order as passes over one record.
_PASS_SQL = f"""WITH passes AS (SELECT 'CAND_' || lpad(l_orderkey::VARCHAR, 7, '0') AS candidate_id, l_linenumber * 100000000 + l_partkey * 1000 + l_suppkey AS pass, l_partkey % 31 AS retrieval_score, l_suppkey % 21 AS evaluation_score,
  l_partkey % 26 AS applied_ml_score, l_linenumber % 16 AS credibility_score, l_suppkey % 11 AS bonus_score, l_partkey % 29 = 0 AS hard_disqualifier,
  CASE WHEN l_suppkey % 2 = 0 THEN 'part ' || l_partkey END AS disqualifier_reason, 'supplier ' || l_suppkey AS brief_rationale FROM lineitem),
averaged AS (SELECT candidate_id, {', '.join(f'round_even(avg({n}), 0)::INT AS {n}' for n in R.SUBSCORES)}, bool_or(hard_disqualifier) AS hard_disqualifier,
  min({{'p': pass, 'r': disqualifier_reason}}) FILTER (WHERE hard_disqualifier AND disqualifier_reason IS NOT NULL).r AS disqualifier_reason,
  min({{'p': pass, 'r': brief_rationale}}).r AS brief_rationale FROM passes GROUP BY candidate_id),
scored AS (SELECT *, CASE WHEN hard_disqualifier THEN least(20, {' + '.join(R.SUBSCORES)}) ELSE {' + '.join(R.SUBSCORES)} END::INT AS total_score FROM averaged)"""


def _passes(spark: SparkSession, sf: str) -> DataFrame:
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        _id("l_orderkey").alias(ID), (line * 100000000 + part * 1000 + supp).alias("pass"), (part % 31).alias("retrieval_score"),
        (supp % 21).alias("evaluation_score"), (part % 26).alias("applied_ml_score"), (line % 16).alias("credibility_score"),
        (supp % 11).alias("bonus_score"), (part % 29 == 0).alias("hard_disqualifier"),
        F.when(supp % 2 == 0, F.concat(F.lit("part "), part)).alias("disqualifier_reason"), F.concat(F.lit("supplier "), supp).alias("brief_rationale"))


@register("avg_passes", _PASS_SQL + " SELECT * FROM scored")
def avg_passes(spark: SparkSession, sf: str) -> DataFrame:
    return responses.avg_passes(_passes(spark, sf))


@register("score_bands", _PASS_SQL + """ SELECT b.band, count(s.candidate_id) AS rows FROM (SELECT unnest(['80-100', '60-79', '40-59', '20-39', '0-19']) AS band) b
  LEFT JOIN (SELECT candidate_id, CASE WHEN total_score >= 80 THEN '80-100' WHEN total_score >= 60 THEN '60-79' WHEN total_score >= 40 THEN '40-59' WHEN total_score >= 20 THEN '20-39' ELSE '0-19' END AS band FROM scored) s USING (band) GROUP BY b.band""")
def score_bands(spark: SparkSession, sf: str) -> DataFrame:
    return responses.score_bands(responses.avg_passes(_passes(spark, sf)))


@register("score_range", _PASS_SQL + " SELECT min(total_score) AS least, max(total_score) AS greatest, round(avg(total_score), 6) AS mean, count(*) FILTER (WHERE hard_disqualifier) AS disqualified FROM scored")
def score_range(spark: SparkSession, sf: str) -> DataFrame:
    return responses.score_range(responses.avg_passes(_passes(spark, sf)))





@register("category_breakdown", "SELECT 'category ' || (n_chars % 6) AS category, count(*) AS flagged FROM documents WHERE doc_id % 3 = 0 GROUP BY 1")
def category_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    verdicts = documents(spark, sf, (F.col("doc_id") % 3 == 0).alias("is_honeypot"), F.concat(F.lit("category "), F.col("n_chars") % 6).alias("violation_category"))
    return responses.category_breakdown(verdicts)


@register("category_flag_rate", "SELECT count(*) AS checked, count(*) FILTER (WHERE doc_id % 3 = 0) AS flagged, count(*) FILTER (WHERE doc_id % 3 = 0) / count(*)::DOUBLE AS rate, true AS alarm FROM documents")
def category_flag_rate(spark: SparkSession, sf: str) -> DataFrame:
    return responses.flag_rate(documents(spark, sf, (F.col("doc_id") % 3 == 0).alias("is_honeypot")))


# --- grounding ---

# The answer of an assistant is checked against what the user said before.
_TURNS = """turns AS (SELECT a.conv_id, a.turn, a.text AS said, lower(u.text) AS blob, length(u.text) % 2 = 0 AS concerns
  FROM conversations a JOIN conversations u ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE a.role = 'assistant')"""


def _turns(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    before = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.lower("text").alias("blob"), (F.length("text") % 2 == 0).alias("concerns"))
    return turns.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("said")).join(before, ["conv_id", "turn"])


def _all_in(pattern: str, text: str, keep: str = "true") -> str:
    found = f"list_filter(regexp_extract_all({text}, '{pattern}'), lambda x: {keep})"
    return f"len(list_filter({found}, lambda x: NOT contains(blob, lower(x)))) = 0"


_SENTENCES = "string_split(regexp_replace(said, '([.!?]\\s)', '\\1' || chr(1), 'g'), chr(1))"
_FLAT = f"array_to_string(list_transform({_SENTENCES}, lambda x: lower(substr(x, 1, 1)) || substr(x, 2)), '')"


@register("ground_numbers", f"WITH {_TURNS} SELECT conv_id, turn, {_all_in(G.NUMBER, fold('said'))} AS grounded FROM turns")
def ground_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return _turns(spark, sf).select("conv_id", "turn", G.ground_numbers(F.col("said"), F.col("blob")).alias("grounded"))


@register("ground_entities", f"""WITH {_TURNS}, flat AS (SELECT *, {fold(_FLAT)} AS t FROM turns) SELECT conv_id, turn, {_all_in(G.PHRASE, 't')}
  AND {_all_in(G.ACRONYM, 't', "x NOT IN (" + ', '.join(f"'{a}'" for a in G.ALLOWED_ACRONYMS) + ")")} AS grounded FROM flat""")
def ground_entities(spark: SparkSession, sf: str) -> DataFrame:
    return _turns(spark, sf).select("conv_id", "turn", G.ground_entities(F.col("said"), F.col("blob")).alias("grounded"))


@register("ground_tone", f"WITH {_TURNS} SELECT conv_id, turn, length(said) BETWEEN 1 AND 360 AND (NOT concerns OR " + "(" + " OR ".join(
    f"contains(lower(said), '{w}')" for w in G.CONTRAST) + ")) AS grounded FROM turns")
def ground_tone(spark: SparkSession, sf: str) -> DataFrame:
    return _turns(spark, sf).select("conv_id", "turn", G.ground_tone(F.col("said"), F.col("concerns")).alias("grounded"))


_WRAPPED = """CASE turn % 5 WHEN 0 THEN ' "' || text || '" ' WHEN 1 THEN 'Sure, ' || text WHEN 2 THEN 'Here''s the note: ' || text WHEN 3 THEN 'NOTE: ' || text ELSE text END"""


@register("text_clean", f"""SELECT conv_id, turn, {strip("regexp_replace(" + strip("regexp_replace(" + strip(_WRAPPED) + ", '^[" + chr(34) + "'']|[" + chr(34) + "'']$', '', 'g')") + ", '" + G.LEAD_IN.replace(chr(39), chr(39) * 2) + "', '')")} AS cleaned FROM conversations""")
def text_clean(spark: SparkSession, sf: str) -> DataFrame:
    wrapped = table(spark, sf, "conversations").select("conv_id", "turn", F.expr(_WRAPPED.replace("Here''s", "Here\\'s")).alias("t"))
    return wrapped.select("conv_id", "turn", G.text_clean(F.col("t")).alias("cleaned"))


# --- relevance ---

_TERMS = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


@register("relevance_score", f"""WITH q AS (SELECT DISTINCT unnest({_TERMS.format('text')}) AS term FROM benchmark WHERE item_id = 0),
tok AS (SELECT doc_id, {_TERMS.format('text')} AS ts FROM documents), dl AS (SELECT doc_id, len(ts) AS n FROM tok),
tf AS (SELECT doc_id, term, count(*) AS f FROM (SELECT doc_id, unnest(ts) AS term FROM tok) JOIN q USING (term) GROUP BY ALL),
df AS (SELECT term, count(*) AS d FROM tf GROUP BY term), st AS (SELECT count(*) AS n_docs, avg(n) AS mean FROM dl),
parts AS (SELECT doc_id, sum(ln(1 + (n_docs - d + 0.5::DOUBLE) / (d + 0.5::DOUBLE)) * f * 2.2::DOUBLE / (f + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / mean))) AS s
  FROM tf JOIN df USING (term) JOIN dl USING (doc_id) CROSS JOIN st GROUP BY doc_id)
SELECT doc_id, round(coalesce(s, 0), 6) AS score FROM documents LEFT JOIN parts USING (doc_id)""")
def relevance_score(spark: SparkSession, sf: str) -> DataFrame:
    query = table(spark, sf, "benchmark").filter("item_id = 0").select("text").first()[0]
    scored = relevance.relevance_score(spread(table(spark, sf, "documents").select("doc_id", "text")), query, "doc_id", "text")
    return scored.select("doc_id", F.round("score", 6).alias("score"))


_TOPK = f"""WITH q AS (SELECT DISTINCT item_id, unnest({_TERMS.format('text')}) AS term FROM benchmark),
tok AS (SELECT doc_id, {_TERMS.format('text')} AS ts FROM documents), dl AS (SELECT doc_id, len(ts) AS n FROM tok),
tf AS (SELECT doc_id, term, count(*) AS f FROM (SELECT doc_id, unnest(ts) AS term FROM tok) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
df AS (SELECT term, count(*) AS d FROM tf GROUP BY term), st AS (SELECT count(*) AS n_docs, avg(n) AS mean FROM dl),
parts AS (SELECT item_id, doc_id, round(sum(ln(1 + (n_docs - d + 0.5::DOUBLE) / (d + 0.5::DOUBLE)) * f * 2.2::DOUBLE / (f + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / mean))), 9) AS s
  FROM tf JOIN df USING (term) JOIN dl USING (doc_id) JOIN q USING (term) CROSS JOIN st GROUP BY item_id, doc_id),
best AS (SELECT item_id, doc_id, s, row_number() OVER (PARTITION BY item_id ORDER BY s DESC, doc_id) AS pos FROM parts QUALIFY pos <= 50)"""


def _topk(spark: SparkSession, sf: str) -> DataFrame:
    return relevance.relevance_topk(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"), 50)


@register("relevance_topk", _TOPK + " SELECT item_id, doc_id, round(s, 6) AS score, pos FROM best")
def relevance_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The 50 best documents for every benchmark text."""
    return _topk(spark, sf).select("item_id", "doc_id", F.round("score", 6).alias("score"), "pos")


#: Cells that are looked at, of 64. The given vectors lie evenly in all directions, the worst case for cells: a quarter of them
#: holds 0.64 of the nearest rows, half of them 0.85.
_PROBES = 46

_COSINE = """WITH u AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
v AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS e FROM u),
scored AS (SELECT q.vec_id AS query, v.vec_id AS id, round(list_sum(list_transform(range(1, len(v.e) + 1), lambda i: v.e[i] * q.e[i])), 9) AS s FROM v, v q WHERE q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id)"""


def _nearest(spark: SparkSession, sf: str, probes: int | None) -> tuple[relevance.VectorIndex, DataFrame]:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return (index := relevance.vector_index(vectors)), relevance.nearest(index, vectors.filter("vec_id % 50 = 0"), 20, probes)


@register("relevance_cosine", _COSINE + " SELECT query, id, round(s, 6) AS score, row_number() OVER (PARTITION BY query ORDER BY s DESC, id) AS pos FROM scored QUALIFY pos <= 20")
def relevance_cosine(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 nearest vectors for every vector whose id 50 divides, by all cells of the index."""
    return _nearest(spark, sf, None)[1].select("query", "id", F.round("score", 6).alias("score"), "pos")


@register("relevance_cosine_index", "SELECT count(*) AS queries, count(*) * least(20, (SELECT count(*) - 1 FROM embeddings)) AS rows, true AS recalled FROM embeddings WHERE vec_id % 50 = 0")
def relevance_cosine_index(spark: SparkSession, sf: str) -> DataFrame:
    """The same by the nearest cells only: at least nine tenths of it are found."""
    index, found = _nearest(spark, sf, _PROBES)
    exact = relevance.nearest(index, table(spark, sf, "embeddings").filter("vec_id % 50 = 0"), 20)
    return relevance.recall(found, exact).select("queries", "rows", (F.col("recall") >= 0.9).alias("recalled"))


# --- metrics ---

# Documents by the tied score; the grade comes from the label and the length.
_GRADED = f"""WITH {_SCORED}, graded AS (SELECT s.candidate_id, score, (CASE WHEN l.doc_id IS NULL THEN 0 ELSE quality * 3 + toxic + s.doc_id % 3 END)::INT AS grade FROM scored s LEFT JOIN labels l ON s.doc_id = l.doc_id),
placed AS (SELECT candidate_id, grade, (grade >= 3)::INT AS rel, row_number() OVER (ORDER BY score DESC, candidate_id) AS pos, row_number() OVER (ORDER BY grade DESC, candidate_id) AS ideal FROM graded),
cum AS (SELECT *, sum(rel) OVER (ORDER BY pos) AS cum_rel FROM placed)"""


def _dcg_sql(position: str, k: int | None) -> str:
    kept = f" FILTER (WHERE {position} <= {k})" if k else ""
    return f"sum((2 ** least(grade, 6) - 1) / log2({position} + 1)){kept}"


def _ndcg_sql(k: int | None) -> str:
    return f"coalesce({_dcg_sql('pos', k)} / nullif({_dcg_sql('ideal', k)}, 0), 0)"


_MAP_SQL = "coalesce(sum(rel * cum_rel / pos::DOUBLE) / nullif(sum(rel), 0), 0)::DOUBLE"


def _p_sql(k: int) -> str:
    return f"avg(rel) FILTER (WHERE pos <= {k})"


def _graded(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    grade = F.when(F.col("quality").isNull(), 0).otherwise(F.col("quality") * 3 + F.col("toxic") + F.col("doc_id") % 3)
    return tied_scores(spark, sf).join(known, "doc_id", "left").select(ID, "score", grade.cast("int").alias("grade"))


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.ranked_grades(_graded(spark, sf), "score", "grade")


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@register("metric_ndcg", _GRADED + f" SELECT round({_ndcg_sql(10)}, 9) AS ndcg_10, round({_ndcg_sql(50)}, 9) AS ndcg_50, round({_ndcg_sql(None)}, 9) AS ndcg_all FROM cum")
def metric_ndcg(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluate.metric_ndcg(evaluate.ranked_only(_graded(spark, sf), "score", "grade"), [10, 50, None]))


@register("metric_map", _GRADED + f" SELECT round({_MAP_SQL}, 9) AS map FROM cum")
def metric_map(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluate.metric_map(_ranked(spark, sf)))


@register("metric_precision", _GRADED + f" SELECT {_p_sql(5)} AS p_5, {_p_sql(10)} AS p_10 FROM cum")
def metric_precision(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.metric_precision(evaluate.ranked_only(_graded(spark, sf), "score", "grade"), [5, 10])


_COMPOSITE = f"""parts AS (SELECT {_ndcg_sql(10)} AS ndcg_10, {_ndcg_sql(50)} AS ndcg_50, {_MAP_SQL} AS map, {_p_sql(10)} AS p_10 FROM cum)"""
_WEIGHED = "0.5::DOUBLE * ndcg_10 + 0.3::DOUBLE * ndcg_50 + 0.15::DOUBLE * map + 0.05::DOUBLE * p_10"


@register("metric_composite", _GRADED + f", {_COMPOSITE} SELECT round(ndcg_10, 9) AS ndcg_10, round(ndcg_50, 9) AS ndcg_50, round(map, 9) AS map, p_10, round({_WEIGHED}, 9) AS composite FROM parts")
def metric_composite(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(evaluate.metric_composite(_ranked(spark, sf)))


@register("metric_pseudo", _GRADED + f" SELECT round({_ndcg_sql(10)}, 9) AS ndcg_10, round({_ndcg_sql(50)}, 9) AS ndcg_50, round({_ndcg_sql(None)}, 9) AS ndcg_all, round({_MAP_SQL}, 9) AS map, {_p_sql(10)} AS p_10, {_p_sql(5)} AS p_5 FROM cum")
def metric_pseudo(spark: SparkSession, sf: str) -> DataFrame:
    graded = _graded(spark, sf)
    known = graded.filter("grade > 0").select(ID, F.col("grade").alias("relevance_grade"))
    return _rounded(evaluate.metric_pseudo(graded.select(ID, F.col("score").alias("predicted_score")), known))


@register("cum_precision", _GRADED + " SELECT candidate_id, pos, rel, cum_rel::BIGINT AS cum_rel, cum_rel / pos::DOUBLE AS precision FROM cum")
def cum_precision(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.cum_precision(_ranked(spark, sf)).select(ID, "pos", "rel", "cum_rel", "precision")


def _half_sql(part: int) -> str:
    """The metrics of the documents with an even or an odd number."""
    half = _GRADED.replace("placed AS (", f"half AS (SELECT * FROM graded WHERE substr(candidate_id, 6)::INT % 2 = {part}), placed AS (")
    return half.replace("AS ideal FROM graded", "AS ideal FROM half")


_HALVES = ", ".join(f"m{p} AS ({_half_sql(p)}, {_COMPOSITE} SELECT *, {_WEIGHED} AS composite FROM parts)" for p in (0, 1))


@register("overfit_gap", f"""WITH {_HALVES}, long AS (SELECT unnest(['composite', 'ndcg_10', 'ndcg_50', 'map', 'p_10']) AS metric,
  unnest([m0.composite, m0.ndcg_10, m0.ndcg_50, m0.map, m0.p_10]) AS train, unnest([m1.composite, m1.ndcg_10, m1.ndcg_50, m1.map, m1.p_10]) AS valid FROM m0, m1)
SELECT metric, round(train, 9) AS train, round(valid, 9) AS valid, round(train - valid, 9) AS gap, metric = 'composite' AND train - valid > 0.15 AS alarm FROM long""")
def overfit_gap(spark: SparkSession, sf: str) -> DataFrame:
    graded = _graded(spark, sf).withColumn("half", F.substring(ID, 6, 7).cast("int") % 2)
    train, valid = (evaluate.evaluate(graded.filter(F.col("half") == h), "score", "grade") for h in (0, 1))
    return _rounded(evaluate.overfit_gap(train, valid))


# --- result checks ---

def _result(spark: SparkSession, sf: str, damage: bool) -> DataFrame:
    """All documents as a result table, with damaged ids, ranks and scores or without."""
    ranked = ranking.rank_scores(tied_scores(spark, sf))
    d = F.col("doc_id") if damage else F.lit(1)
    bad_id = F.when(d % 97 == 0, "").when(d % 89 == 0, F.concat(F.lit("X"), F.col("doc_id"))).when(d % 83 == 0, "CAND_0000001").otherwise(F.col(ID))
    bad_rank = F.when(d % 79 == 0, F.concat(F.col("rank").cast("string"), F.lit(".0"))).when(d % 73 == 0, "5").otherwise(F.col("rank").cast("string"))
    bad_score = F.when(d % 71 == 0, "high").otherwise(F.col("score").cast("string"))
    return ranked.select(F.col("rank").alias("row_num"), bad_id.alias(ID), bad_rank.alias("rank"), bad_score.alias("score"),
                         F.concat(F.lit("Reason "), F.col("doc_id") % 50).alias("reasoning"))


_RESULT = f"""{_RANKED}, result AS (SELECT rank AS row_num, CASE WHEN doc_id % 97 = 0 THEN '' WHEN doc_id % 89 = 0 THEN 'X' || doc_id WHEN doc_id % 83 = 0 THEN 'CAND_0000001' ELSE candidate_id END AS candidate_id,
  CASE WHEN doc_id % 79 = 0 THEN NULL WHEN doc_id % 73 = 0 THEN 5 ELSE rank END AS r, CASE WHEN doc_id % 71 <> 0 THEN score END AS score, 'Reason ' || (doc_id % 50) AS reasoning FROM ranked),
pairs AS (SELECT r, score, candidate_id, lead(score) OVER w AS s2, lead(candidate_id) OVER w AS c2 FROM result WHERE r IS NOT NULL AND score IS NOT NULL AND candidate_id <> '' WINDOW w AS (ORDER BY r, row_num))"""


@register("result_validate", _RESULT + """ SELECT 'row_count' AS rule, count(*)::VARCHAR AS item FROM result HAVING count(*) <> 100
UNION ALL SELECT 'id_missing', row_num::VARCHAR FROM result WHERE candidate_id = ''
UNION ALL SELECT 'id_pattern', candidate_id FROM result WHERE candidate_id <> '' AND NOT regexp_full_match(candidate_id, 'CAND_[0-9]{7}')
UNION ALL SELECT 'id_duplicate', candidate_id FROM result WHERE regexp_full_match(candidate_id, 'CAND_[0-9]{7}') GROUP BY candidate_id HAVING count(*) > 1
UNION ALL SELECT 'rank_not_integer', row_num::VARCHAR FROM result WHERE r IS NULL
UNION ALL SELECT 'rank_out_of_range', r::VARCHAR FROM result WHERE r NOT BETWEEN 1 AND 100
UNION ALL SELECT 'rank_duplicate', r::VARCHAR FROM result WHERE r BETWEEN 1 AND 100 GROUP BY r HAVING count(*) > 1
UNION ALL SELECT 'score_not_float', row_num::VARCHAR FROM result WHERE score IS NULL
UNION ALL SELECT 'rank_missing', x::VARCHAR FROM (SELECT unnest(range(1, 101)) AS x) WHERE x NOT IN (SELECT r FROM result WHERE r IS NOT NULL)
UNION ALL SELECT 'score_increases', r::VARCHAR FROM pairs WHERE score < s2
UNION ALL SELECT 'tie_order', r::VARCHAR FROM pairs WHERE score = s2 AND candidate_id > c2""")
def result_validate(spark: SparkSession, sf: str) -> DataFrame:
    return checks.result_validate(_result(spark, sf, damage=True))


@register("result_validate_correct", "SELECT 'none' AS rule, 'none' AS item WHERE false")
def result_validate_correct(spark: SparkSession, sf: str) -> DataFrame:
    """A whole correct table: no violation."""
    result = _result(spark, sf, damage=False)
    return checks.result_validate(result, expected_rows=result.count())


@register("reason_unique", _RESULT + """ SELECT count(*) AS reasons, 0::BIGINT AS empty, count(DISTINCT reasoning) AS distinct_reasons, count(*) - count(DISTINCT reasoning) AS duplicates FROM result""")
def reason_unique(spark: SparkSession, sf: str) -> DataFrame:
    return checks.reason_unique(_result(spark, sf, damage=True))


# --- explanation ---

# Contributions of five features per document, made from its numbers.
_DRIVER_FEATURES = ["experience_band_fit", "notice_period_days", "retrieval_embeddings_narrative_hits", "has_python_skill", "saved_by_recruiters_30d"]
_CONTRIBUTIONS = "[(doc_id % 11 - 5) / 4.0::DOUBLE, (doc_id % 7 - 3) / 4.0::DOUBLE, (n_chars % 13 - 6) / 4.0::DOUBLE, (n_chars % 5 - 2) / 4.0::DOUBLE, (doc_id % 3 - 1) / 4.0::DOUBLE]"


def _explained(spark: SparkSession, sf: str) -> DataFrame:
    d, n = F.col("doc_id"), F.col("n_chars")
    parts = F.array(*[x / F.lit(4.0) for x in (d % 11 - 5, d % 7 - 3, n % 13 - 6, n % 5 - 2, d % 3 - 1)])
    return documents(spark, sf, parts.alias("contributions"), (d % 11 / F.lit(10.0)).alias("experience_band_fit"),
                     ((n % 5) * 15.0).alias("notice_period_days"), (n % 4 * 1.0).alias("retrieval_embeddings_narrative_hits"),
                     (d % 2 * 1.0).alias("has_python_skill"), (n % 9 / F.lit(2.0)).alias("saved_by_recruiters_30d"),
                     (d % 10 == 0).alias("honeypot_flag"))


_DRIVERS = f"""WITH x AS (SELECT {DOC_ID} AS candidate_id, doc_id, n_chars, {_CONTRIBUTIONS} AS cs FROM documents),
e AS (SELECT candidate_id, doc_id, n_chars, unnest(cs) AS c, generate_subscripts(cs, 1) AS i, list_max(list_transform(cs, lambda v: abs(v))) * 0.1::DOUBLE AS lim FROM x),
f AS (SELECT *, ['{"', '".join(_DRIVER_FEATURES)}'][i] AS feature FROM e)"""


@register("top_drivers", _DRIVERS + """, p AS (SELECT candidate_id, string_agg(feature, ';' ORDER BY abs(c) DESC, i) AS names FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY abs(c) DESC, i) AS r FROM f WHERE c > lim) WHERE r <= 3 GROUP BY 1),
n AS (SELECT candidate_id, string_agg(feature, ';' ORDER BY abs(c) DESC, i) AS names FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY abs(c) DESC, i) AS r FROM f WHERE -c > lim) WHERE r <= 3 GROUP BY 1)
SELECT x.candidate_id, coalesce(p.names, '') AS positive, coalesce(n.names, '') AS negative FROM x LEFT JOIN p USING (candidate_id) LEFT JOIN n USING (candidate_id)""")
def top_drivers(spark: SparkSession, sf: str) -> DataFrame:
    found = explain.top_drivers(_explained(spark, sf), _DRIVER_FEATURES, n=3)
    return found.select(ID, *[F.array_join(F.transform(s, lambda p: p["feature"]), ";").alias(s) for s in ("positive", "negative")])


_FV = "CASE WHEN {v} = floor({v}) THEN ({v})::BIGINT::VARCHAR ELSE printf('%.2f', {v}) END"
_SIDE_WORD = "CASE WHEN c >= 0 THEN ', in favour' ELSE ', against' END"
_CLAUSES = _DRIVERS + f""", vals AS (SELECT *, doc_id % 11 / 10.0::DOUBLE AS fit, n_chars % 5 * 15 AS notice, n_chars % 4 AS hits, doc_id % 2 AS py, n_chars % 9 / 2.0::DOUBLE AS saved FROM f),
clauses AS (SELECT candidate_id, doc_id, c, i, lim, CASE i
  WHEN 1 THEN 'experience band fit: ' || {_FV.format(v='fit')} || {_SIDE_WORD}
  WHEN 2 THEN CASE WHEN notice > 30 THEN 'is bound for ' || notice || ' more days' ELSE 'is free in ' || notice || ' days' END
  WHEN 3 THEN CASE WHEN hits > 0 THEN 'career text touches on retrieval embeddings ' || hits || ' times' ELSE 'retrieval embeddings narrative hits: 0' || {_SIDE_WORD} END
  WHEN 4 THEN CASE WHEN py = 0 THEN 'lists no Python' ELSE 'lists Python' END
  ELSE 'saved by recruiters 30d: ' || {_FV.format(v='saved')} || {_SIDE_WORD} END AS clause FROM vals),
pos AS (SELECT candidate_id, list(clause ORDER BY abs(c) DESC, i) AS ps FROM clauses WHERE c > lim GROUP BY 1),
neg AS (SELECT candidate_id, list(clause ORDER BY abs(c) DESC, i) AS ns FROM clauses WHERE -c > lim GROUP BY 1),
lists AS (SELECT candidate_id, doc_id % 10 = 0 AS flagged, coalesce(ps, []) AS ps, coalesce(ns, []) AS ns,
  ['Less convincing: ', 'On the other side: ', 'To be weighed: '][(list_sum(list_transform(string_split(md5(candidate_id), ''), lambda h: instr('0123456789abcdef', h) - 1)) % 3 + 1)::INT] AS lead_in
  FROM x LEFT JOIN pos USING (candidate_id) LEFT JOIN neg USING (candidate_id))"""


def _version_sql(p: int, n: int) -> str:
    bad, said = f"ns[1:{n}]", f"array_to_string(ps[1:{p}], '; ')"
    return f"""CASE WHEN len(ps) > 0 THEN upper(substr({said}, 1, 1)) || substr({said}, 2) || '.' || CASE WHEN len({bad}) > 0 THEN ' ' || lead_in || array_to_string({bad}, '; ') || '.' ELSE '' END
      WHEN len(ns) > 0 THEN 'Little speaks for this record: ' || array_to_string(ns[1:{max(n, 1)}], '; ') || '.' ELSE 'Nothing about this record stands out.' END
      || CASE WHEN flagged THEN ' Caution: the record contradicts itself.' ELSE '' END"""


_REASONS = _CLAUSES + f""", v AS (SELECT candidate_id, [{', '.join(_version_sql(*v) for v in ((3, 1), (2, 1), (1, 1), (1, 0)))}] AS t FROM lists)
SELECT candidate_id, coalesce(list_filter(t, lambda x: length(x) <= {{limit}})[1], t[4]) AS reasoning FROM v"""


@register("reason_text", _REASONS.format(limit=320))
def reason_text(spark: SparkSession, sf: str) -> DataFrame:
    return explain.reason_text(_explained(spark, sf), None, _DRIVER_FEATURES)


@register("reason_text_short", _REASONS.format(limit=90))
def reason_text_short(spark: SparkSession, sf: str) -> DataFrame:
    """Ninety characters, so that clauses have to go."""
    return explain.reason_text(_explained(spark, sf), None, _DRIVER_FEATURES, max_chars=90)


@register("reason_payload", _CLAUSES + """, p AS (SELECT candidate_id, ps[1:3] AS strengths, CASE WHEN flagged THEN ['the record contradicts itself'] ELSE [] END || ns[1:2] AS concerns, flagged FROM lists)
SELECT candidate_id, array_to_string(strengths, '; ') AS strengths, array_to_string(concerns, '; ') AS concerns, flagged, len(concerns) > 0 AS has_concerns FROM p""")
def reason_payload(spark: SparkSession, sf: str) -> DataFrame:
    built = explain.reason_payload(_explained(spark, sf), None, _DRIVER_FEATURES)
    read = F.from_json("payload", "strengths array<string>, concerns array<string>, is_honeypot_flagged boolean")
    return built.select(ID, read.alias("p"), "has_concerns").select(
        ID, F.array_join("p.strengths", "; ").alias("strengths"), F.array_join("p.concerns", "; ").alias("concerns"),
        F.col("p.is_honeypot_flagged").alias("flagged"), "has_concerns")


# --- models ---

# A linear model without a penalty on one feature is the regression line, and one boosting round of depth 1 on a yes-no
# feature is the mean gain of either side, so SQL can predict what the rankers must.
_LINE, _SIDE = ["words"], ["is_long"]
_MODEL_ROWS = f"""rows AS (SELECT {DOC_ID} AS candidate_id, doc_id, len(string_split(text, ' '))::DOUBLE AS words, (n_chars > 1500)::INT::DOUBLE AS is_long FROM documents),
labelled AS (SELECT r.*, greatest(quality * 4 + r.doc_id % 3 - toxic, 0) AS relevance_grade FROM rows r JOIN labels l ON r.doc_id = l.doc_id),
placed_l AS (SELECT *, row_number() OVER (PARTITION BY relevance_grade ORDER BY md5('42:' || candidate_id), candidate_id) AS p, count(*) OVER (PARTITION BY relevance_grade) AS n FROM labelled),
dataset AS (SELECT *, (2 ** relevance_grade - 1)::DOUBLE AS gain, CASE WHEN p <= (CASE WHEN n > 1 THEN greatest(1, round_even(n * 0.15::DOUBLE, 0)) ELSE 0 END) THEN 'val' ELSE 'train' END AS split FROM placed_l),
line AS (SELECT regr_slope(gain, words) AS b, regr_intercept(gain, words) AS a, avg(words) AS mx, avg(gain) AS my FROM dataset WHERE split = 'train'),
sides AS (SELECT is_long, avg(gain) AS m FROM dataset WHERE split = 'train' GROUP BY is_long)"""


def _text_features(spark: SparkSession, sf: str) -> DataFrame:
    """The features of every document, for training and for scoring."""
    return documents(spark, sf, F.size(F.split("text", " ", -1)).cast("double").alias("words"), (F.col("n_chars") > 1500).cast("int").alias("is_long"))


def _model_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """The labelled documents with grades from their quality and id."""
    grades = table(spark, sf, "labels").select(
        _id("doc_id").alias(ID), (F.col("quality") * 4 + (F.col("doc_id") % 3) - F.col("toxic")).cast("int").alias("g")).select(
        ID, F.greatest("g", F.lit(0)).alias("relevance_grade"))
    return materialize(labels.dataset_assemble(_text_features(spark, sf).drop("doc_id"), grades), "dataset")


def _line_ranker(dataset: DataFrame) -> model.Ranker:
    return model.train_ranker(dataset, "linear", _LINE, [], regParam=0.0)


_SPLIT_METRICS = f"""scored_l AS (SELECT split, candidate_id, relevance_grade::INT AS grade, (relevance_grade >= 3)::INT AS rel, b * words AS s FROM dataset, line),
placed AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY s DESC, candidate_id) AS pos, row_number() OVER (PARTITION BY split ORDER BY grade DESC, candidate_id) AS ideal FROM scored_l),
cum AS (SELECT *, sum(rel) OVER (PARTITION BY split ORDER BY pos) AS cum_rel FROM placed),
parts AS (SELECT split, {_ndcg_sql(10)} AS ndcg_10, {_ndcg_sql(50)} AS ndcg_50, {_MAP_SQL} AS map, {_p_sql(10)} AS p_10 FROM cum GROUP BY split),
whole AS (SELECT *, {_WEIGHED} AS composite FROM parts),
long AS (UNPIVOT whole ON composite, ndcg_10, ndcg_50, map, p_10 INTO NAME metric VALUE v)"""


@register("train_ranker", f"""WITH {_MODEL_ROWS}, {_SPLIT_METRICS} SELECT t.metric, round(t.v, 9) AS train, round(w.v, 9) AS valid, round(t.v - w.v, 9) AS gap,
  t.metric = 'composite' AND t.v - w.v > 0.15 AS alarm FROM long t JOIN long w ON t.metric = w.metric AND t.split = 'train' AND w.split = 'val'""")
def train_ranker(spark: SparkSession, sf: str) -> DataFrame:
    dataset = _model_dataset(spark, sf)
    ranker = _line_ranker(dataset)
    return _rounded(evaluate.overfit_gap(model.evaluate_ranker(ranker, dataset, "train"), model.evaluate_ranker(ranker, dataset, "val")))


@register("train_ranker_boosted", f"WITH {_MODEL_ROWS} SELECT candidate_id, round(m, 6) AS predicted_score FROM rows JOIN sides USING (is_long)")
def train_ranker_boosted(spark: SparkSession, sf: str) -> DataFrame:
    ranker = model.train_ranker(_model_dataset(spark, sf), "gbt", _SIDE, [], maxIter=1, maxDepth=1)
    return model.predict_pool(ranker, _text_features(spark, sf)).select(ID, F.round(model.SCORE, 6).alias(model.SCORE))


@register("tune_ranker", f"WITH {_MODEL_ROWS}, {_SPLIT_METRICS} SELECT unnest([0, 1, 2])::INT AS trial, round(composite, 9) AS composite FROM whole WHERE split = 'val'")
def tune_ranker(spark: SparkSession, sf: str) -> DataFrame:
    """A penalty changes the slope of the line, not the order it gives; every trial has the same composite."""
    _, trials = model.tune_ranker(_model_dataset(spark, sf), trials=3, kind="linear", features=_LINE, categorical=[], space={"regParam": [0.0, 0.01, 0.1]})
    return _rounded(spark.createDataFrame([(t["trial"], t["composite"]) for t in trials], "trial int, composite double"))


_PREDICTED = f"""WITH {_MODEL_ROWS} SELECT candidate_id, round(a + b * words, 6) AS predicted_score, row_number() OVER (ORDER BY b * words DESC, candidate_id) AS predicted_rank FROM rows, line"""


@register("predict_pool", _PREDICTED)
def predict_pool(spark: SparkSession, sf: str) -> DataFrame:
    """Every document scored by a linear ranker that was trained on the labelled ones."""
    ranker = _line_ranker(_model_dataset(spark, sf))
    ranked = ranking.rank_scores(model.predict_pool(ranker, _text_features(spark, sf)), model.SCORE, "predicted_rank")
    return ranked.select(ID, F.round(model.SCORE, 6).alias(model.SCORE), "predicted_rank")


@register("ranker_saved_and_loaded", _PREDICTED)
def ranker_saved_and_loaded(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "ranker")
    model.save_ranker(_line_ranker(_model_dataset(spark, sf)), path)
    ranked = ranking.rank_scores(model.predict_pool(model.load_ranker(spark, path), _text_features(spark, sf)), model.SCORE, "predicted_rank")
    return ranked.select(ID, F.round(model.SCORE, 6).alias(model.SCORE), "predicted_rank")


@register("attribution", f"""WITH {_MODEL_ROWS} SELECT candidate_id, words, round(b * (words - mx), 6) AS words_part, round(my, 6) AS bias, round(a + b * words, 6) AS predicted_score FROM dataset, line""")
def attribution(spark: SparkSession, sf: str) -> DataFrame:
    dataset = _model_dataset(spark, sf)
    explained = model.attribution(_line_ranker(dataset), dataset)
    return explained.select(ID, "words", F.round(F.get("contributions", 0), 6).alias("words_part"), F.round("bias", 6).alias("bias"),
                            F.round(model.SCORE, 6).alias(model.SCORE))


@register("metric_by_query", _TOPK + f""", placed AS (SELECT item_id, pos, coalesce(quality * 3 + toxic + doc_id % 3, 0)::INT AS grade FROM best LEFT JOIN labels USING (doc_id)),
cum AS (SELECT *, (grade >= 3)::INT AS rel, sum((grade >= 3)::INT) OVER (PARTITION BY item_id ORDER BY pos) AS cum_rel, row_number() OVER (PARTITION BY item_id ORDER BY grade DESC, pos) AS ideal FROM placed),
per_query AS (SELECT item_id, {_ndcg_sql(10)} AS ndcg_10, {_ndcg_sql(50)} AS ndcg_50, {_MAP_SQL} AS map, {_p_sql(10)} AS p_10 FROM cum GROUP BY item_id)
SELECT item_id, round(ndcg_10, 9) AS ndcg_10, round(ndcg_50, 9) AS ndcg_50, round(map, 9) AS map, round(p_10, 9) AS p_10, round({_WEIGHED}, 9) AS composite FROM per_query""")
def metric_by_query(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "labels").select("doc_id", (F.col("quality") * 3 + F.col("toxic") + F.col("doc_id") % 3).alias("grade"))
    graded = _topk(spark, sf).join(known, "doc_id", "left").withColumn("grade", F.coalesce("grade", F.lit(0)))
    return _rounded(evaluate.metric_by_query(materialize(graded, "graded"), "item_id"))  # read more than once


# --- overlaps of a flat table ---

_SPANS = "spans AS (SELECT CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS record, event_id, ts AS s, ts + to_seconds((value * 30)::INT) AS e FROM events)"


@register("interval_pairs", f"WITH {_SPANS} SELECT a.record, a.event_id AS i, b.event_id AS j, (epoch_us(least(a.e, b.e)) - epoch_us(b.s)) / 1000000 AS overlap_seconds FROM spans a JOIN spans b ON a.record = b.record AND (b.s > a.s OR (b.s = a.s AND b.event_id > a.event_id)) AND b.s < a.e AND b.s < b.e")
def interval_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping spans of a record, one of which holds a third of all rows."""
    record = F.when(F.col("event_id") % 3 == 0, -1).otherwise(F.col("user_id"))
    end = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.bround(F.col("value") * 30, 0).cast("bigint") * 1_000_000)
    spans = table(spark, sf, "events").select(record.alias("record"), "event_id", F.col("ts").cast("timestamp").alias("s"), end.alias("e"))
    return integrity.interval_pairs(spans, "record", "s", "e", "event_id")


# --- streams ---

_STREAM_HITS = {n: PROSE_FAMILIES[n] for n in ("english", "german", "number")}


@register("stream_score", f"SELECT {DOC_ID} AS candidate_id, {', '.join(f'{hits('t', p)} AS {n}' for n, p in _STREAM_HITS.items())} FROM (SELECT doc_id, {fold('lower(text)')} AS t FROM documents)")
def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    """Documents scored as a stream; the second run over the same files adds nothing."""
    from ..functions.keywords import kw_hits

    def scored(batch: DataFrame) -> DataFrame:
        return batch.select(_id("doc_id").alias(ID), "doc_id", F.lower("text").alias("t")).select(
            ID, "doc_id", *[kw_hits("t", p).alias(n) for n, p in _STREAM_HITS.items()])

    out, checkpoint = new_path(spark, "stream-out"), new_path(spark, "stream-state")
    schema = table(spark, sf, "documents").schema
    for _ in range(2):
        source = streams.read_table_stream(spark, f"{sf.rstrip('/')}/documents.parquet", schema)
        streams.stream_score(source, scored, out, checkpoint, key="doc_id").awaitTermination()
    return spark.read.parquet(out).select(ID, *_STREAM_HITS)


@register("stream_score_repeated", f"""SELECT {DOC_ID} AS candidate_id, doc_id % 3 AS first_file, n_chars FROM documents""")
def stream_score_repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Three sets of files, one run and batch each; the second and third repeat ids of earlier ones, and each repeats ids within itself."""
    docs, folder = documents(spark, sf, "n_chars"), new_path(spark, "stream-in")
    out, checkpoint = new_path(spark, "stream-out"), new_path(spark, "stream-state")
    for number in range(3):
        part = docs.filter(F.col("doc_id") % 3 <= number).withColumn("n_chars", F.when(F.col("doc_id") % 3 == number, F.col("n_chars")).otherwise(-1))
        part = part.withColumn("copy", F.lit(0)).unionByName(part.withColumn("n_chars", F.lit(-2).cast("bigint")).withColumn("copy", F.lit(1)))
        part.withColumn("number", F.lit(number)).write.mode("append").parquet(folder)
        schema = spark.read.parquet(folder).schema
        source = streams.read_stream(spark, folder, schema, files_per_batch=2**31 - 1)
        streams.stream_score(source, lambda batch: batch.select(ID, "n_chars", "number"), out, checkpoint, order=["copy"]).awaitTermination()
    return spark.read.parquet(out).select(ID, F.col("number").cast("bigint").alias("first_file"), "n_chars")


@register("stream_rule_counts", "SELECT (date_trunc('day', ts))::VARCHAR AS day, event_type AS rule, count(*) AS rows, count(*) FILTER (WHERE value > 90) AS flagged FROM events GROUP BY ALL")
def stream_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Daily counts per event type as a stream."""
    schema = table(spark, sf, "events").schema
    source = streams.read_table_stream(spark, f"{sf.rstrip('/')}/events.parquet", schema)
    rows = source.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("rule"), (F.col("value") > 90).alias("flagged"))
    out = new_path(spark, "counts-out")
    streams.stream_rule_counts(rows, out, new_path(spark, "counts-state"), delay="60 days").awaitTermination()
    counted = streams.read_rule_counts(spark, out)
    return counted.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("day"), "rule", "rows", "flagged")


# The events in four files by number, so that each file holds all days; a row is late if the file before it was a delay ahead.
_LATE = """timed AS (SELECT event_id, ts, event_type AS rule, value > 90 AS flagged, (event_id // 64) % 4 AS batch FROM events),
tops AS (SELECT batch, max(ts) AS top FROM timed GROUP BY batch),
marks AS (SELECT t.batch, max(b.top) - INTERVAL 9 DAY AS mark FROM tops t JOIN tops b ON b.batch < t.batch GROUP BY t.batch),
judged AS (SELECT timed.*, mark IS NOT NULL AND date_trunc('day', ts) + INTERVAL 1 DAY <= mark AS late FROM timed LEFT JOIN marks USING (batch))"""


@register("stream_rule_counts_late", f"WITH {_LATE} SELECT date_trunc('day', ts)::VARCHAR AS day, rule, count(*) FILTER (WHERE NOT late) AS rows, count(*) FILTER (WHERE NOT late AND flagged) AS flagged, count(*) FILTER (WHERE late) AS late_rows FROM judged GROUP BY ALL")
def stream_rule_counts_late(spark: SparkSession, sf: str) -> DataFrame:
    """Daily counts from four files that arrive one by one, the second run after a restart, and the rows that came too late."""
    events = table(spark, sf, "events").select("ts", F.col("event_type").alias("rule"), (F.col("value") > 90).alias("flagged"), (F.floor(F.col("event_id") / 64) % 4).alias("file"))
    folder, out, late, checkpoint = (new_path(spark, f"late-{n}") for n in ("in", "out", "rows", "state"))
    for number in range(4):
        events.filter(F.col("file") == number).drop("file").coalesce(1).write.mode("append").parquet(folder)
        if number:  # the first run reads two files in two batches
            schema = spark.read.parquet(folder).schema
            source = streams.read_stream(spark, folder, schema, files_per_batch=1)
            streams.stream_counts_and_late(source, out, late, checkpoint, delay="9 days").awaitTermination()
    counted = streams.read_partial_counts(spark, out)
    left = streams.read_late(spark, late).groupBy(F.date_trunc("day", "ts").alias("window_start"), "rule").agg(F.count("*").alias("late_rows"))
    both = counted.join(left, ["window_start", "rule"], "full").na.fill(0, ["rows", "flagged", "late_rows"])
    return both.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("day"), "rule", "rows", "flagged", "late_rows")


# --- flagship ---

_FLAGSHIP_SCORE = " + ".join(hits("t", p) for p in PROSE_FAMILIES.values())


@register("flagship", f"""WITH s AS (SELECT {DOC_ID} AS candidate_id, doc_id, {_FLAGSHIP_SCORE} AS score FROM (SELECT doc_id, {fold('lower(text)')} AS t FROM documents))
SELECT candidate_id, score::INT AS score, coalesce(toxic = 1, false) AS honeypot_flag, row_number() OVER (ORDER BY coalesce(toxic = 1, false), score DESC, candidate_id) AS rank
FROM s LEFT JOIN labels l ON s.doc_id = l.doc_id QUALIFY rank <= 100""")
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by keyword hits, flagged ones last, top 100."""
    from ..functions.keywords import kw_hits

    texts = spread(documents(spark, sf, "text")).withColumn("t", F.lower("text"))
    every = [p for patterns in PROSE_FAMILIES.values() for p in patterns]
    scored = joins.join_flags_left(texts.select(ID, kw_hits("t", every).alias("score")), toxic_flags(spark, sf)).drop("flag_missing")
    best = scored.orderBy("honeypot_flag", F.desc("score"), ID).limit(100)
    return ranking.demote_flagged(best, "honeypot_flag").select(ID, "score", "honeypot_flag", "rank")
