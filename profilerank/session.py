"""Where intermediate tables live, and how a plan is cut.

An intermediate result that is read twice is written as a parquet table below the shared
folder of the session (``spark.checkpoint.dir``). Unlike a cache it survives the loss of
executors, and unlike a row checkpoint the second reader still prunes columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# (application, path) of every intermediate table that may still be there.
_LIVE: list[tuple[str, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables and stream checkpoints: ``spark.checkpoint.dir``.

    Without that setting it is a folder below the warehouse, which executors reach as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/") if configured else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_intermediate"


def new_path(spark: SparkSession, name: str, keep: bool = False) -> str:
    """A path below the shared folder that nothing else uses; a surrounding ``scratch`` deletes it unless it is kept."""
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/profilerank/{app}/{name}-{uuid.uuid4().hex}"
    if not keep:
        _LIVE.append((app, path))
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """The folder, if it is not there; a reader with a schema then finds an empty table."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, what steps inside have stored. The result of a run must be written inside."""
    before = len(_LIVE)
    try:
        yield
    finally:
        app = spark.sparkContext.applicationId
        for owner, path in _LIVE[before:]:
            if owner == app:
                delete_path(spark, path)
        del _LIVE[before:]


def materialize(df: DataFrame, name: str = "step", keep: bool = False, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once and return the written table. Long texts take much less room as ``zstd``."""
    spark = df.sparkSession
    path = new_path(spark, name, keep)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(*inputs: DataFrame, target_bytes: int = 256 << 20) -> int:
    """Number of partitions for work on the inputs: one per 256 MB of files, at least one per core.

    Row-local text work is bound by processors, so a small table should not end up in one task.
    """
    size = sum(int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) for df in inputs)
    return max(inputs[0].sparkSession.sparkContext.defaultParallelism, -(-size // target_bytes))


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan over at least as many partitions as there are cores.

    Only a small table changes: its one file would otherwise be the work of one task.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def get_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for."""
    builder = SparkSession.builder.appName("profilerank")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # The feature table has 128 columns; the default of 100 would end code generation.
        "spark.sql.codegen.maxFields": "400",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
