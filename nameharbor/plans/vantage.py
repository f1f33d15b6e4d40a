"""Comparing the vantage points: who saw a registrable domain, and who saw it first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SOURCES = ("zone", "ct", "passive", "entrada")


def overlap(sightings: DataFrame) -> DataFrame:
    """``sources, n_apexes``: domains per combination of sources."""
    per_apex = sightings.groupBy("apex").agg(F.array_sort(F.collect_set("source")).alias("seen"))
    return per_apex.groupBy(F.array_join("seen", "+").alias("sources")).agg(F.count("*").alias("n_apexes"))


def first_seen(sightings: DataFrame) -> DataFrame:
    """First sighting of each domain per source, the source that led, and by how much.

    One aggregation; copies and later sightings fall away before the shuffle.
    ``lead_ms`` is null for a domain seen by one source only.
    """
    firsts = sightings.groupBy("apex").agg(
        *[F.min(F.when(F.col("source") == s, F.col("ts"))).alias(f"first_{s}") for s in SOURCES]
    )
    pairs = F.array(*[
        F.when(F.col(f"first_{s}").isNotNull(), F.struct(F.col(f"first_{s}").alias("ts"), F.lit(s).alias("source")))
        for s in SOURCES
    ])
    ordered = firsts.withColumn("_order", F.array_sort(F.array_compact(pairs)))
    lead = F.unix_millis(F.get("_order", F.lit(1))["ts"]) - F.unix_millis(F.get("_order", F.lit(0))["ts"])
    return ordered.select(
        "apex", *[f"first_{s}" for s in SOURCES], F.get("_order", F.lit(0))["source"].alias("leading_source"),
        lead.alias("lead_ms"),
    )
