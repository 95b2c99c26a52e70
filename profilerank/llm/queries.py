"""The registered queries of this package, with production parameters over whole tables, and their SQL where it exists."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import anchors, audio, bpe, contamination, html, infill, jaccard, language, quality, repeats, sharding, spelling, urls
from .common import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def add(query):
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return add


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


# Only A-Z in lower case; null is empty.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@_register("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path())


@_register("op2_language")
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = language.learn(docs.where(~language.held_out("doc_id", 4, 2)))
    found = language.predict(docs, profiles)
    return found.select("doc_id", language.held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


SHARDS, SHARD_SEED = 24, "shards"


def _crc_entry(value: int) -> int:
    for _ in range(8):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


# CRC-32 byte by byte over a table that follows from the polynomial.
_CRC_TABLE = f"crc_table AS (SELECT {[_crc_entry(i) for i in range(256)]}::BIGINT[] AS tab)"

SQL_SHARDING = f"""
WITH {_CRC_TABLE},
hexed AS (SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS h FROM documents),
raw AS (
  SELECT doc_id, source, list_transform(range(0, len(h) // 2),
    lambda i: (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1) AS bs FROM hexed),
keyed AS (
  SELECT doc_id, source, len(bs) + 8 AS size,
         xor(list_reduce([4294967295::BIGINT] || bs, lambda a, x: xor(tab[(xor(a, x) & 255) + 1], a >> 8)), 4294967295) AS text_crc32,
         ('0x' || substr(md5('{SHARD_SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM raw, crc_table),
parts AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY h, doc_id, text_crc32, size) - 1 + 0.5::DOUBLE)
            / count(*) OVER (PARTITION BY source) AS part FROM keyed),
placed AS (
  SELECT *, row_number() OVER (ORDER BY part, source NULLS FIRST, h, doc_id, text_crc32, size) - 1 AS pos, count(*) OVER () AS total FROM parts),
cut AS (SELECT *, (pos * {SHARDS}) // total AS s FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, s::INTEGER AS shard, (pos - (s * total + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot,
       NULL::INTEGER AS grown_shard
FROM cut"""


@_register("op3_sharding", SQL_SHARDING)
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents"), SHARDS, SHARD_SEED)


# The rules of the registered query (verdict, host, path).
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

SQL_URLS = """
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
judged AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/%' THEN 'org/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/de/%' THEN 'com/de/' END AS rule FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged"""


@_register("op4_urls", SQL_URLS)
def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


@_register("op10_audio")
def op10_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.media_digest(table(spark, sf_dir, "documents"))


@_register("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.learn(docs, table(spark, sf_dir, "labels"), ~language.held_out("doc_id", 3, 1))
    return quality.predict(docs, model).select("doc_id", language.held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


_BENCH_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SQL_CONTAMINATION = f"""
WITH items AS (SELECT item_id, {_BENCH_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
cut AS (SELECT item_id, ws, least(13, len(ws)) AS n FROM items WHERE len(ws) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM cut)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_BENCH_WORDS} AS ws FROM documents),
grams AS (
  SELECT r, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n)),
hits AS (SELECT r, i, n, item_id FROM grams JOIN windows USING (n, g)),
words AS (SELECT r, count(DISTINCT w) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS w FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)"""


@_register("op9_contamination", SQL_CONTAMINATION)
def op9_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_register("op6_repeats")
def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, by strings of 400 bytes, and the text that is left without passages of over 50 words as well."""
    return repeats.repeat_digest(table(spark, sf_dir, "documents"), words=51)


SQL_JACCARD = f"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh FROM split),
sizes AS (SELECT r, doc_id, len(sh) AS n FROM sets),
tokens AS (SELECT r, unnest(sh) AS t FROM sets),
shared AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM tokens a JOIN tokens b ON a.t = b.t AND a.r < b.r GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.r = x JOIN sizes q ON q.r = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT r, r AS o FROM sizes UNION SELECT reach.r, b.y FROM reach JOIN both_ways b ON reach.o = b.x)
SELECT s.doc_id, s.n AS n_shingles, m.component_id
FROM sizes s JOIN (SELECT reach.r, min(t.doc_id) AS component_id FROM reach JOIN sizes t ON t.r = reach.o GROUP BY 1) m USING (r)"""


@_register("op8_jaccard", SQL_JACCARD)
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents"))


@_register("op5_html")
def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(table(spark, sf_dir, "pages"))


SQL_PASSAGES = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*') AS parts FROM documents),
starts AS (SELECT r, i, sha256(array_to_string(ws[i:i + 34], ' ')) AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM docs)),
again AS (SELECT g FROM starts GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM starts JOIN again USING (g)),
words AS (SELECT r, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS w, unnest(parts) AS part FROM docs),
kept AS (
  SELECT r, string_agg(w, ' ' ORDER BY i) AS joined, string_agg(part, '' ORDER BY i) AS rest FROM words ANTI JOIN gone USING (r, i) GROUP BY r),
counted AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(joined, '')) AS kept_sha256,
       regexp_extract(text, '^[\\x20\\x09-\\x0D]*') || coalesce(rest, '') AS text
FROM docs LEFT JOIN kept USING (r) LEFT JOIN counted USING (r)"""


@_register("op11_passages", SQL_PASSAGES)
def op11_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.passage_digest(table(spark, sf_dir, "documents"))


SQL_SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
counted AS (SELECT run, count(*) AS c, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
raw AS (
  SELECT run, c, list_transform(range(0, len(h) // 2),
    lambda i: (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 1) AS bs FROM counted),
hashed AS (
  SELECT run, c, xor(list_reduce([4294967295::BIGINT] || bs, lambda a, x: xor(tab[(xor(a, x) & 255) + 1], a >> 8)), 4294967295) AS crc FROM raw, crc_table),
made AS (
  SELECT CASE WHEN crc % 199 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, c FROM hashed),
vocabulary AS (SELECT word, sum(c)::BIGINT AS n FROM made WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
cuts AS (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
near AS (
  SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, v.word FROM cuts a JOIN vocabulary v ON v.word = a.rest
  UNION SELECT v.word, a.word FROM cuts a JOIN vocabulary v ON v.word = a.rest),
best AS (SELECT near.word, count(*) AS n_near, min({{'m': -v.n, 'w': other}}) AS b FROM near JOIN vocabulary v ON v.word = other GROUP BY near.word),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= 5 * v.n THEN b.w END AS form, CASE WHEN -b.m >= 5 * v.n THEN -b.m END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS at FROM forms UNION ALL SELECT chain.word, f.form FROM chain JOIN forms f ON f.word = chain.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, chain.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain ON chain.word = f.word JOIN forms last ON last.word = chain.at AND last.form IS NULL"""


@_register("op12_spelling", SQL_SPELLING)
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(table(spark, sf_dir, "documents"))


SQL_INFILL = """
WITH hexed AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, t, length(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM hexed),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts"""


@_register("op13_infill", SQL_INFILL)
def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_digest(table(spark, sf_dir, "documents"))
