import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from profilerank.schema import POOL  # noqa: E402
from profilerank.session import get_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session("local[8]", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.fixture
def records(spark):
    """A function that turns nested dicts into a pool."""
    def build(*rows: dict):
        filled = [{"candidate_id": f"CAND_{i:07d}", **row} for i, row in enumerate(rows)]
        return spark.createDataFrame([_shape(r, POOL) for r in filled], POOL)

    return build


def _shape(value, dtype):
    """Missing fields as None, numbers in the type of the schema."""
    kind = dtype.typeName()
    if value is None:
        return None
    if kind == "struct":
        return tuple(_shape(value.get(f.name), f.dataType) for f in dtype.fields)
    if kind == "array":
        return [_shape(v, dtype.elementType) for v in value]
    if kind == "map":
        return {k: float(v) for k, v in value.items()}
    return float(value) if kind == "double" else value
