"""Positions in a total order, and numbering, without one task holding a group.

A plain window without a partition, or with a hot one, sorts its rows in a
single task. Here rows are laid out in range partitions once; a count per
partition carries the numbering from one partition to the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def _laid_out(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range partitions in ``order`` with their number, pinned: bounds come from a sample."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    return written(ranged, "ranged")


def with_positions(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``position``, counted from 0 in ``order``, which must be unique."""
    laid = _laid_out(rows, order)
    counts = laid.groupBy("_part").agg(F.count("*").alias("_rows"))
    # one row per range partition, so the window and the broadcast are of fixed size
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        laid.join(F.broadcast(starts), "_part")
        .withColumn("position", F.col("_start") + local - 1)
        .drop("_part", "_start")
    )


def running_count(
    rows: DataFrame, key: str, order: Sequence[str], name: str, flag: Column | None = None
) -> DataFrame:
    """Add ``name``: flagged rows of the same ``key`` up to and including this one.

    ``order`` must be unique within a key. A key that fills many range
    partitions is counted in each of them; only the carry crosses over.
    """
    flagged = (F.lit(True) if flag is None else flag).cast("bigint")
    laid = _laid_out(rows.withColumn("_flag", flagged), [key, *order])
    within = Window.partitionBy("_part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    counts = laid.groupBy(key, "_part").agg(F.sum("_flag").alias("_sum"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = counts.select(
        F.col(key).alias("_key"), F.col("_part").alias("_to"), F.sum("_sum").over(earlier).alias("_carry")
    ).where("_carry is not null")
    # a partition continues at most one key of the partition before it: no more rows than partitions
    return (
        laid.join(F.broadcast(carry), (F.col("_part") == F.col("_to")) & F.col(key).eqNullSafe(F.col("_key")), "left")
        .withColumn(name, F.sum("_flag").over(within) + F.coalesce("_carry", F.lit(0)))
        .drop("_part", "_flag", "_key", "_to", "_carry")
    )
