"""Session and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "tidemark") -> SparkSession:
    """Session for tests and the bench. On a cluster the job brings its own session."""
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below the shared folder of the session.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    master, whose driver and executors share one disk, may go without it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside give their shuffle files back at once, not when the driver next collects its garbage.

    For results that are written or collected once: the same DataFrame object, run again, would make its shuffles anew.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


#: Folders written by ``settled`` in this process.
_SETTLED: list[str] = []


def settled(df: DataFrame) -> DataFrame:
    """The frame written once to the shared folder and read back.

    For a result of costly joins that a plan uses several times: it is computed
    once, survives the loss of executors, and its size is known to the planner.
    Its shuffles are dropped. The folder stays until ``clear_settled`` or the owner of the shared folder
    removes it.
    """
    path = shared_dir(df.sparkSession)
    _SETTLED.append(path)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_settled(spark: SparkSession) -> None:
    """Delete what ``settled`` has written, once all results that may read it are written or collected."""
    while _SETTLED:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SETTLED.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_rows(spark: SparkSession, rows: list[tuple], columns: dict[str, pa.DataType]) -> DataFrame:
    """A handful of driver rows as a local relation. A list of tuples would start Python workers."""
    values = list(zip(*rows)) if rows else [()] * len(columns)
    arrays = [pa.array(v, type=t) for v, t in zip(values, columns.values())]
    return spark.createDataFrame(pa.table(arrays, names=list(columns)))
