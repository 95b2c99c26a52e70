"""What the operators of this package share: passes over whole texts, stored tables, exact positions.

Python code runs in Arrow batches inside tasks; partitioning, shuffles and state are Spark's. The package is
pickled by value, so that executors need no copy of it.

What all operators do: an empty table gives an empty table with the result's columns; columns they do not name are
ignored, or handed on where whole documents are returned, whatever their names; texts are taken whole.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__package__])

#: Rows that one call of a text function gets: bounds what a task holds besides the Arrow batch.
SLICE_ROWS = 128
#: Rows of an Arrow batch: whole texts may be long, and the session's usual 10,000 of them do not fit a small executor.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

# Application, path and owner of each stored table that may still be there, and the owner of those stored now.
_STORED: list[tuple[str, str, str | None]] = []
_OWNER: list[str | None] = [None]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read again; ``release`` deletes it unless it is to be kept."""
    out = materialize(df, name)
    if not keep:
        for path in out.inputFiles()[:1]:
            _STORED.append((df.sparkSession.sparkContext.applicationId, path.rpartition("/")[0], _OWNER[-1]))
    return out


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop_stored(df: DataFrame) -> None:
    """Deletes a stored table that no later step reads."""
    for path in {p.rpartition("/")[0] for p in df.inputFiles()[:1]}:
        for entry in [e for e in _STORED if e[1] == path]:
            _delete(df.sparkSession, path)
            _STORED.remove(entry)


@contextmanager
def owned(owner: str) -> Iterator[None]:
    """Tables that are stored inside belong to this owner."""
    _OWNER.append(owner)
    try:
        yield
    finally:
        _OWNER.pop()


def release(spark: SparkSession, owner: str | None = None) -> int:
    """Deletes the stored tables of an owner whose results have been written, or those of all. Returns their number.

    With an owner, tables that others have stored stay: a result that was not read yet may need them.
    """
    app, gone = spark.sparkContext.applicationId, 0
    for entry in [e for e in _STORED if owner in (None, e[2])]:
        if entry[0] == app:
            _delete(spark, entry[1])
            gone += 1
        _STORED.remove(entry)
    return gone


def with_row(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns renamed to c0, c1, ...: names of the input cannot clash with names made on the way.

    Also lowers the session's rows per Arrow batch to ``BATCH_ROWS``, if they are more.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    return df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])


def map_texts(docs: DataFrame, id_col: str, text_col: str, setup: Callable[[], Callable], fields: T.StructType,
              keep: int = 1) -> DataFrame:
    """One output row per document: the id and what the text function returns.

    ``setup`` runs once per task and returns a function from a list of texts (UTF-8 bytes, None for null) to one
    list or array per field. Only the two columns are read.
    """
    source = with_row(docs, [id_col, text_col]).withColumn("c1", F.col("c1").cast("binary"))
    schema = T.StructType([T.StructField(id_col, source.schema["c0"].dataType), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, names, kinds = setup(), schema.names, None
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                made = work(part.column(1).to_pylist())
                if kinds is None:
                    kinds = [arrow_type(f.dataType) for f in fields]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[m if isinstance(m, pa.Array) else pa.array(m, k) for m, k in zip(made, kinds)]], names)

    return source.mapInArrow(run, schema)


def flat_map_texts(source: DataFrame, setup: Callable[[], Callable], schema: T.StructType) -> DataFrame:
    """Any number of output rows per slice: the function gets a record batch and yields lists of columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, kinds = setup(), [arrow_type(f.dataType) for f in schema]
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                for made in work(batch.slice(start, SLICE_ROWS)):
                    yield pa.RecordBatch.from_arrays(
                        [m if isinstance(m, pa.Array) else pa.array(m, k) for m, k in zip(made, kinds)], schema.names)
        finish = getattr(work, "finish", None)
        for made in finish() if finish else ():
            yield pa.RecordBatch.from_arrays([pa.array(m, k) for m, k in zip(made, kinds)], schema.names)

    return source.mapInArrow(run, schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    """Arrow's type for the types that operators return."""
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, arrow_type(f.dataType)) for f in kind])
    return {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.StringType: pa.string(),
            T.BooleanType: pa.bool_(), T.BinaryType: pa.binary()}[type(kind)]


def fields(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def positions(df: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, int]:
    """The stored rows with ``_pos``, 0 to N-1 in the order of the keys, and N.

    Range partitions, a sort inside each, and one offset per partition: the driver sees one row per partition. The
    number of partitions is ``spark.sql.shuffle.partitions``, merged by adaptive execution.
    """
    spark = df.sparkSession
    ordered = stored(df.orderBy(*keys).withColumn("_m", F.monotonically_increasing_id()), name)
    placed = ordered.withColumn("_part", F.shiftright("_m", 33))
    offsets, total = [], 0
    for row in placed.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect():
        offsets.append((row["_part"], total))
        total += row["n"]
    starts = F.broadcast(spark.createDataFrame(offsets, "_part bigint, _start bigint"))
    inside = F.col("_m") - F.shiftleft("_part", 33)
    return placed.join(starts, "_part").withColumn("_pos", F.col("_start") + inside).drop("_m", "_part", "_start"), total
