"""Query warehouse: any table of query names and Unix seconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import from_unix_s
from ..operators.positions import with_positions


def in_window(queries: DataFrame, start: str, end: str, time: str = "unixtime") -> DataFrame:
    """Rows from ``start`` (a date) up to, not including, ``end``."""
    lower, upper = (F.unix_seconds(F.to_timestamp(F.lit(d), "yyyy-MM-dd")) for d in (start, end))
    return queries.where((F.col(time) >= lower) & (F.col(time) < upper))


def first_last(queries: DataFrame, name: str = "qname", time: str = "unixtime") -> DataFrame:
    """``qname, min_unixtime, max_unixtime``: one row per query name."""
    return queries.groupBy(F.col(name).alias("qname")).agg(
        F.min(time).alias("min_unixtime"), F.max(time).alias("max_unixtime")
    )


def from_sql(spark: SparkSession, query: str) -> DataFrame:
    """Rows of a query that returns name, first and last time, in that order."""
    return spark.sql(query).toDF("qname", "min_unixtime", "max_unixtime")


def as_sightings(rows: DataFrame) -> DataFrame:
    return rows.select(
        "qname", from_unix_s(F.col("min_unixtime")).alias("first_seen"),
        from_unix_s(F.col("max_unixtime")).alias("last_seen"),
    )


def page(rows: DataFrame, limit: int, offset: int, name: str = "qname") -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in name order.

    Positions come from range partitions, so a deep page costs no more than
    the first and no task holds all rows before it.
    """
    placed = with_positions(rows, [name])
    return placed.where((F.col("position") >= offset) & (F.col("position") < offset + limit)).drop("position")


class NamePages:
    """Rows in name order, laid out once in pages of ``size``, of which any can be read by itself.

    A page has a folder of its own, so reading one opens its files only,
    however many come before it.
    """

    def __init__(self, rows: DataFrame, path: str, size: int, name: str = "qname"):
        self.spark, self.path, self.size, self.columns = rows.sparkSession, path, size, rows.columns
        placed = with_positions(rows, [name]).withColumn("page", F.expr(f"position div {size}"))
        placed.write.mode("overwrite").partitionBy("page").parquet(path)
        self.schema = placed.schema

    def page(self, limit: int, offset: int) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` in name order; ``limit`` may span several pages or part of one."""
        position, page = F.col("position"), F.col("page")
        first, last = offset // self.size, (offset + limit - 1) // self.size
        found = self.spark.read.schema(self.schema).parquet(self.path).where((page >= first) & (page <= last))
        return found.where((position >= offset) & (position < offset + limit)).select(*self.columns)
