"""Entries of CT logs in pages, with an index of what each page holds that is searched before any page is opened."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists

#: entries of a page
PAGE = 1_000_000

_FOLDERS = T.StructType([T.StructField("landing", T.StringType()), T.StructField("log_url", T.StringType()), T.StructField("first", T.LongType())])
_INDEX = T.StructType([
    T.StructField("log_url", T.StringType()), T.StructField("first", T.LongType()),
    T.StructField("least_index", T.LongType()), T.StructField("greatest_index", T.LongType()),
    T.StructField("least_ts", T.TimestampType()), T.StructField("greatest_ts", T.TimestampType()),
    T.StructField("n", T.LongType()), T.StructField("landing", T.StringType()),
])


class Pages:
    """Landed entries of any number of logs, in ``entries`` and ``index`` under one folder.

    A page has the entries of one log from ``first`` (a multiple of ``size``)
    on, and lies in a folder of its own; its row in the index has the least and
    greatest index and time in it. Times need not rise with the index. A
    search opens the pages that can hold the answer and no others.
    Conditions have one term for each log asked about, so their size goes with
    the number of logs, not of entries or pages.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, size: int = PAGE):
        self.spark, self.path, self.size = spark, path.rstrip("/"), size
        self.schema = T.StructType([f for f in schema.fields if f.name not in _FOLDERS.names])

    def land(self, landing: str, entries: DataFrame) -> None:
        """Lay out entries (``log_url``, ``index``, ``ts`` and more). A repeated landing replaces what it has left before.

        Entries without a log or an index belong to no page and are left out.
        """
        known = entries.where("log_url is not null and index is not null")
        paged = known.withColumn("first", F.expr(f"floor(index / {self.size}) * {self.size}").cast("bigint"))
        folder = f"{self.path}/entries/landing={landing}"
        paged.repartition("log_url", "first").write.mode("overwrite").partitionBy("log_url", "first").parquet(folder)
        fields = [f for f in _FOLDERS.fields if f.name != "landing"]
        laid = self.spark.read.schema(T.StructType([*self.schema.fields, *fields])).parquet(folder)
        index = laid.groupBy("log_url", "first").agg(
            F.min("index").alias("least_index"), F.max("index").alias("greatest_index"),
            F.min("ts").alias("least_ts"), F.max("ts").alias("greatest_ts"), F.count("*").alias("n"),
        )
        index.write.mode("overwrite").parquet(f"{self.path}/index/landing={landing}")

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/{part}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{part}")

    def index(self) -> DataFrame:
        """One row for each page: ``log_url, first, least_index, greatest_index, least_ts, greatest_ts, n``."""
        return self._read("index", _INDEX).drop("landing")

    def entries(self, kept: Column | None = None) -> DataFrame:
        """Entries; ``kept`` is a condition on ``log_url`` and ``first``, and prunes the folders that are read."""
        rows = self._read("entries", T.StructType([*self.schema.fields, *_FOLDERS.fields]))
        rows = rows if kept is None else rows.where(kept)
        return rows.select("log_url", *self.schema.names)

    def heads(self) -> DataFrame:
        """``log_url, tree_size`` as far as entries have landed; no page is opened."""
        return self.index().groupBy("log_url").agg((F.max("greatest_index") + 1).alias("tree_size"))

    def in_ranges(self, ranges: Iterable[tuple[str, int, int]]) -> DataFrame:
        """The entries with ``start <= index < end`` of each (log, start, end)."""
        asked = [(log, start, end) for log, start, end in ranges if start < end]
        if not asked:
            return self.entries(F.lit(False))
        page = F.col("first")
        folders = [(F.col("log_url") == log) & (page > start - self.size) & (page < end) for log, start, end in asked]
        exact = [(F.col("log_url") == log) & (F.col("index") >= start) & (F.col("index") < end) for log, start, end in asked]
        return self.entries(reduce(or_, folders)).where(reduce(or_, exact))

    def _page_of(self, hit: Column, pick: Column) -> list[tuple[str, int]]:
        found = self.index().where(hit).groupBy("log_url").agg(pick.alias("first")).collect()  # one row per log
        return [(r.log_url, r.first) for r in found]

    def _search(self, pages: list[tuple[str, int]], found: Column) -> DataFrame:
        kept = reduce(or_, [(F.col("log_url") == log) & (F.col("first") == first) for log, first in pages], F.lit(False))
        return self.entries(kept).groupBy("log_url").agg(found.alias("found"))

    def first_after(self, time: Column) -> DataFrame:
        """``log_url, found``: the first index with a later time, null where there is none; one page of each log is opened.

        No entry of an earlier page is later than that page's greatest time.
        """
        pages = self._page_of(F.col("greatest_ts") > time, F.min("first"))
        return self._search(pages, F.min(F.when(F.col("ts") > time, F.col("index"))))

    def last_before(self, time: Column) -> DataFrame:
        """``log_url, found``: the last index with an earlier time, null where there is none; one page of each log is opened."""
        pages = self._page_of(F.col("least_ts") < time, F.max("first"))
        return self._search(pages, F.max(F.when(F.col("ts") < time, F.col("index"))))

    def indexes_by_time(self, **times: Column) -> DataFrame:
        """``log_url`` and for each time the first index after it, the tree size where there is none."""
        out = self.heads()
        for name, time in times.items():
            out = out.join(self.first_after(time).withColumnRenamed("found", f"_{name}"), "log_url", "left")
        return out.select("log_url", *[F.coalesce(f"_{name}", "tree_size").alias(name) for name in times])

    def since(self, time: Column) -> DataFrame:
        """Entries from the first index after a time to the end of each log."""
        starts = self.indexes_by_time(start=time).join(self.heads(), "log_url").collect()  # one row per log
        return self.in_ranges((r.log_url, r.start, r.tree_size) for r in starts)
