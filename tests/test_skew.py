"""The same results when one key, source or text holds a third of all rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR, TABLES
from tests.test_queries import _rows

HOT = {
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS o_custkey) FROM t",
    "lineitem": "SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey) FROM t",
    "events": "SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id, CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS event_type) FROM t",
    "documents": """SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN (SELECT text FROM t ORDER BY n_chars DESC, doc_id LIMIT 1) ELSE text END AS text,
        CASE WHEN doc_id % 3 = 0 THEN 50 ELSE n_chars END AS n_chars, CASE WHEN doc_id % 3 = 0 THEN 'src0' ELSE source END AS source) FROM t""",
    "conversations": """SELECT * EXCLUDE (n) REPLACE (CASE WHEN n % 3 = 0 THEN 1 ELSE conv_id END AS conv_id, CASE WHEN n % 3 = 0 THEN 1000 + n ELSE turn END AS turn)
        FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS n FROM t)""",
}
NAMES = [
    "doc_compact", "feat_all", "rules_flag", "rule_histogram", "check_any", "summary_dist", "summary_dist_prices", "dedup_first", "avg_passes",
    "scan_cache_tolerant", "anti_done_passes", "conservation_check", "stratified_split", "global_rank", "global_rank_lines", "demote_flagged",
    "gap_fill_topk", "reason_unique", "relevance_score", "score_bands", "minus_ids", "metric_composite", "ground_numbers", "stream_rule_counts", "verdict_disagree",
]


@pytest.fixture(scope="module")
def hot(tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE OR REPLACE VIEW t AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
        connection.execute(f"COPY ({HOT.get(name, 'SELECT * FROM t')}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    yield connection, str(folder)
    connection.close()


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_with_hot_keys(spark, hot, name):
    connection, folder = hot
    found = entry.queries()[name](spark, folder)
    wanted = connection.sql(entry.oracle_sql()[name])
    rows = _rows(found.columns, found.collect())
    assert rows and rows == _rows(wanted.columns, wanted.fetchall())
