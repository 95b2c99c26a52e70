"""How the nested pool is put together from tables of its own."""

import datetime

import pytest

from profilerank.operators import calibrate
from profilerank.plans import fixture


@pytest.fixture
def tables(spark, tmp_path):
    day = datetime.datetime(1995, 1, 1)
    rows = {
        "customer": ([(k, "BUILDING", 100.0 * k) for k in range(6)], "c_custkey long, c_mktsegment string, c_acctbal double"),
        # order 1 comes twice, one order has no key
        "orders": ([(o, day + datetime.timedelta(days=o)) for o in [*range(60), 1, None] if o is not None] + [(None, day)],
                   "o_orderkey long, o_orderdate timestamp"),
        "lineitem": ([(o, n, 3 * o + n, o + n, float(n + 1)) for o in (0, 1, 2, 45) for n in range(8)] + [(None, 1, 1, 1, 1.0)],
                     "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double"),
        "events": ([(0, day, "view", 1.5), (0, day, "click", 2.5), (None, day, "view", 9.0)], "user_id long, ts timestamp, event_type string, value double"),
        "documents": ([(1, "first"), (1, "second"), (2, None), (None, "lost")], "doc_id long, text string"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_rows(spark, tables):
    found = sorted(fixture.build_pool(spark, tables).collect(), key=lambda r: (r["candidate_id"], r["profile"]["summary"]))
    ids = [r["candidate_id"][-1] for r in found]
    assert ids == ["0", "1", "1", "2", "3", "4", "5"]  # a document that comes twice gives two rows, as before
    assert [r["profile"]["summary"] for r in found if r["candidate_id"][-1] == "1"] == ["first", "second"]
    by = {r["candidate_id"][-1]: r for r in found}
    assert [len(by[k]["career_history"] or []) for k in "012345"] == [1, 8, 12, 20, 1, 7]
    assert [len(by[k]["skills"] or []) for k in "012345"] == [4, 8, 0, 0, 0, 4]
    # Lines 0 and 4 of order 0 are one skill: least part 0, greatest supplier 4 and quantity 5, two lines.
    first = by["0"]["skills"][0]
    assert (first["name"], first["proficiency"], first["duration_months"], first["endorsements"]) == ("Python", "beginner", 80.0, 6.0)
    assert by["0"]["signals"]["skill_assessment_scores"] == {"RAG evaluation": 1.5, "NDCG": 2.5}


def test_every_table_moves_once(spark, tables):
    """Orders, lines and texts are dealt to their record once, and no join deals them again."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fixture.build_pool(spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange ") == 5  # customer, orders, lineitem, events, documents


def test_records_are_made_where_rows_have_moved(spark, tables):
    """Orders and lines are dealt by their record but do not carry it, and no join or group deals them again."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fixture.build_pool(spark, tables)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 5 and sum("orderkey" in line for line in dealt) == 2


def test_lists_are_made_without_lambdas(spark, tables):
    """Roles and skills are sorted and unpacked by expressions that need no call per comparison."""
    plan = fixture.build_pool(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in plan and "array_sort(" not in plan and "transform(x" not in plan


def test_reference_date_of_any_string(spark):
    """Only strings that start with a digit are parsed; the latest valid date wins wherever it stands."""
    schema = "a string, b array<string>, c array<struct<d: string, n: long>>, m map<string, string>, e array<struct<f: array<string>>>"
    empty = (None, None, None, None, None)
    rows = [
        ("2024-02-30", ["", "x2030-01-01", None, " 2031-01-01"], [None, ("2001-05-06 and more", 1)], {"2032-01-01": "9"}, [(["2002-01-01", ":"],), (None,), None]),
        empty, ("no date", [], [], {}, []),
    ]
    frame = spark.createDataFrame(rows, schema)
    plan = calibrate.ref_date_any_string(frame)._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" in plan
    assert str(calibrate.ref_date_any_string(frame).first()[0]) == "2002-01-01"
    later = spark.createDataFrame([("2003-03-03T10:00", None, [("2004-04-04x", 2)], {"k": "2005-05-05"}, None)], schema)
    assert str(calibrate.ref_date_any_string(frame.union(later)).first()[0]) == "2005-05-05"
    assert calibrate.ref_date_any_string(spark.createDataFrame([empty], schema)).first()[0] is None
