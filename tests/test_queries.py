"""Every registered query against its SQL twin, on whole tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def _plain(value):
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return value
    return float(value) + 0.0


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    wanted = duck.sql(SQL[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    assert _rows(found.columns, found.collect()) == _rows(wanted.columns, wanted.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 100
    assert sorted(r["rank"] for r in rows) == list(range(1, 101))
