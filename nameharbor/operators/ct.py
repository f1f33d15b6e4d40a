"""CT logs: resume positions, indexes by time and the ranges left to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def resume_indexes(entries: DataFrame, logs: DataFrame) -> DataFrame:
    """``log_url, resume_index`` for every log: one past the highest stored index, else 0."""
    stored = entries.groupBy("log_url").agg((F.max("index") + 1).alias("resume_index"))
    known = logs.select("log_url").distinct()
    return known.join(stored, "log_url", "left").select(
        "log_url", F.coalesce("resume_index", F.lit(0)).alias("resume_index")
    )


def tree_heads(entries: DataFrame) -> DataFrame:
    """``log_url, tree_size`` as far as entries have landed."""
    return entries.groupBy("log_url").agg((F.max("index") + 1).alias("tree_size"))


def indexes_by_time(entries: DataFrame, heads: DataFrame, **times: Column) -> DataFrame:
    """First index after each time, per log; the tree size when there is none.

    ``times`` maps output columns to instants, all found in one pass.
    """
    found = entries.groupBy("log_url").agg(
        *[F.min(F.when(F.col("ts") > t, F.col("index"))).alias(name) for name, t in times.items()]
    )
    return heads.join(found, "log_url", "left").select(
        "log_url", *[F.coalesce(name, "tree_size").alias(name) for name in times]
    )


def log_positions(entries: DataFrame, stored: Column, **times: Column) -> DataFrame:
    """``log_url, resume_index, tree_size`` and the first index after each time, in one pass.

    ``stored`` tells which entries are stored; the indexes are as in the functions above.
    """
    found = entries.groupBy("log_url").agg(
        (F.max("index") + 1).alias("tree_size"), (F.max(F.when(stored, F.col("index"))) + 1).alias("resume_index"),
        *[F.min(F.when(F.col("ts") > t, F.col("index"))).alias(name) for name, t in times.items()],
    )
    first = [F.coalesce(name, "tree_size").alias(name) for name in times]
    return found.select("log_url", "tree_size", F.coalesce("resume_index", F.lit(0)).alias("resume_index"), *first)


def position_ranges(positions: DataFrame) -> DataFrame:
    """``log_url, start_index, end_index`` of :func:`log_positions` with ``from_index`` and ``to_index``."""
    return positions.select(
        "log_url", F.greatest("resume_index", "from_index").alias("start_index"),
        F.least("tree_size", "to_index").alias("end_index"),
    ).where("start_index < end_index")


def index_ranges(
    resume: DataFrame, heads: DataFrame, by_time: DataFrame | None = None
) -> DataFrame:
    """``log_url, start_index, end_index`` left to read; logs with nothing left are dropped.

    ``by_time`` has the columns ``from_index`` and ``to_index`` of the wanted window.
    """
    ranges = heads.join(resume, "log_url", "left").withColumn("resume_index", F.coalesce("resume_index", F.lit(0)))
    if by_time is None:
        ranges = ranges.select("log_url", F.col("resume_index").alias("start_index"), F.col("tree_size").alias("end_index"))
    else:
        ranges = ranges.join(by_time, "log_url").select(
            "log_url", F.greatest("resume_index", "from_index").alias("start_index"),
            F.least("tree_size", "to_index").alias("end_index"),
        )
    return ranges.where("start_index < end_index")


def entries_in_ranges(entries: DataFrame, ranges: DataFrame) -> DataFrame:
    """Entries of each log within its range. One range row per log."""
    joined = entries.join(ranges, "log_url")
    return joined.where("index >= start_index and index < end_index").drop("start_index", "end_index")


def scan_from_time(entries: DataFrame, heads: DataFrame, since: Column) -> DataFrame:
    """Entries from the first index after a time to the end of the log."""
    start = indexes_by_time(entries, heads, start_index=since)
    return entries.join(start, "log_url").where("index >= start_index").drop("start_index")
