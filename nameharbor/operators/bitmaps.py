"""Exact distinct counts that grow by batch: dense ids as bitmaps, a few KB for each 32,768 of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bitmaps(rows: DataFrame, column: str) -> DataFrame:
    """``bucket, bitmap`` of the ids in a column; null ones are left out. Copies of a hot id merge before the shuffle."""
    ids = rows.where(F.col(column).isNotNull())
    return ids.groupBy(F.bitmap_bucket_number(column).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("bitmap"))


def merged_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """One bitmap for each bucket, out of those of any number of batches."""
    return bitmaps.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_ids(bitmaps: DataFrame, name: str) -> DataFrame:
    """One row: how many different ids the bitmaps hold. No id is looked at again."""
    return merged_bitmaps(bitmaps).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).alias(name))
