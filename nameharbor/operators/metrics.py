"""Counters per interval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LEVELS
from ..session import small_rows
from .dimensions import ANON

INTERVAL = "1 hour"


def interval_counts(rows: DataFrame, ts: str, *keys: str, interval: str = INTERVAL) -> DataFrame:
    """``interval_start, *keys, n``: rows per tumbling interval and key, for batch and stream."""
    return (
        rows.groupBy(F.window(ts, interval).alias("w"), *keys).agg(F.count("*").alias("n"))
        .select(F.col("w.start").alias("interval_start"), *keys, "n")
    )


def store_hits(hits: DataFrame, ts: str, interval: str = INTERVAL) -> DataFrame:
    """Sum of the inserted or matched rows ``n`` per interval, status and type."""
    return (
        hits.groupBy(F.window(ts, interval).alias("w"), "status", "type").agg(F.sum("n").alias("n"))
        .select(F.col("w.start").alias("interval_start"), "status", "type", "n")
    )


#: stored table -> type in the counts of a batch; name tables are counted by :func:`name_points`
COUNTED = {
    "certificates": "cert", "logs": "log", "zonefile_entries": "zone-entry",
    "passive_entries": "passive-entry", "entrada_entries": "entrada-entry",
}


POINT = T.StructType([*(T.StructField(tag, T.StringType()) for tag in ("name", "status", "type", "key")), T.StructField("n", T.LongType())])


def name_points(spark: SparkSession, counts: dict[tuple[str, str, bool], int]) -> DataFrame:
    """Names a batch has stored (``db-insert``) and has found stored (``db-hit``), by type; none for a count of 0.

    ``counts`` are by twin, level and whether the names were new.
    """
    return small_rows(spark, [
        ("store-hits", "db-insert" if new else "db-hit", level.replace("_", "-") + ("-anon" if twin == ANON else ""), None, n)
        for (twin, level, new), n in sorted(counts.items()) if n
    ], POINT)


def table_points(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Rows a batch has stored in tables of :data:`COUNTED`; none for a count of 0."""
    return small_rows(spark, [
        ("store-hits", "db-insert", kind, None, counts[table]) for table, kind in COUNTED.items() if counts.get(table)
    ], POINT)


def key_points(rows: DataFrame, name: str, key: str) -> DataFrame:
    """Rows of a batch by log or TLD."""
    none = F.lit(None).cast("string")
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    return counts.select(F.lit(name).alias("name"), none.alias("status"), none.alias("type"), F.col(key).alias("key"), "n")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, n`` for each table; an empty one counts 0."""
    counts = [
        rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, rows in tables.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


def name_hits(sightings: DataFrame, ts: str, interval: str = INTERVAL) -> DataFrame:
    """Names of each level stored (``db-insert``) or met again (``db-hit``) per interval: ``ts, status, type, n``.

    A name counts once per interval. Copies merge before the shuffle, and a
    name's intervals stay rows of their own.
    """
    start = F.window(ts, interval)["start"]
    names = F.explode(F.array(*[
        F.struct(F.lit(level.replace("_", "-")).alias("type"), F.col(level).alias("name")) for level in LEVELS
    ]))
    rows = sightings.select(start.alias("start"), *LEVELS).select("start", names.alias("n")).select("start", "n.*")
    seen = rows.groupBy("type", "name", F.col("start").alias(ts)).count()
    firsts = rows.groupBy("type", "name").agg(F.min("start").alias("first"))
    each = seen.join(firsts, ["type", "name"])
    status = F.when(F.col(ts) == F.col("first"), "db-insert").otherwise("db-hit")
    return each.select(ts, status.alias("status"), "type", F.lit(1).alias("n"))
