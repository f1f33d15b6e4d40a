"""Session settings and the shared folder for tables cut out of a plan."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def prepare(spark: SparkSession) -> SparkSession:
    """Set the SQL options the results or the skew handling depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Fact rows of one hot name are split over several tasks when they meet their dimension.
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # A lookup of few names asks the statistics and Bloom filters of the stored files for each of them.
    spark.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", "64")
    # Folders of many pages are listed by so many tasks and not by one for each folder: each sends a result to the driver.
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "64")
    return spark


def work_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder.

    A local one is made only where the session names none and runs on one machine, as in tests.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="nameharbor-")
        context.setCheckpointDir(shared)
    return shared


_listeners: list[list[str]] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    path = f"{work_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for made in _listeners:
        made.append(path)
    return path


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The folders that are handed out within the block, for a caller that knows when nobody reads them any more."""
    made: list[str] = []
    _listeners.append(made)
    try:
        yield made
    finally:
        _listeners[:] = [m for m in _listeners if m is not made]


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def drop_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def small_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few rows of the driver as a frame of one partition that needs no Python worker."""
    table = pa.Table.from_pylist([dict(zip(schema.names, row, strict=True)) for row in rows], to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def written(rows: DataFrame, label: str, *folders: str, path: str | None = None) -> DataFrame:
    """Write rows once to the shared folder and go on from the written table.

    Cuts the lineage, pins values that a recomputation could change (range
    bounds are sampled) and keeps column pruning for the readers. ``folders``
    are columns whose values get a folder each, for readers of one of them.
    """
    spark = rows.sparkSession
    path = f"{path}/{label}" if path else fresh_path(spark, label)
    rows.write.partitionBy(*folders).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def workspace(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder for :func:`written` tables that nobody needs once the block is left."""
    path = fresh_path(spark, label)
    try:
        yield path
    finally:
        drop_folder(spark, path)
