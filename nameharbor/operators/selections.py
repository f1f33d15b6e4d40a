"""Selecting logs and TLDs to work on, and skipping finished ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def filter_logs(
    logs: DataFrame, all_logs: bool, included: Sequence[str] = (), excluded: Sequence[str] = ()
) -> DataFrame:
    """All logs but the excluded ones, or the included ones only."""
    return logs.where(~F.col("url").isin(*excluded)) if all_logs else logs.where(F.col("url").isin(*included))


def select_tlds(available: DataFrame, included: DataFrame, excluded: DataFrame) -> DataFrame:
    """Available and included TLDs without the excluded ones."""
    wanted = available.select("tld").unionByName(included.select("tld")).distinct()
    return wanted.join(excluded.select("tld").distinct(), "tld", "left_anti")


def without_finished(rows: DataFrame, finished: DataFrame) -> DataFrame:
    """Rows of the TLDs that are not on the finished list."""
    return rows.join(finished.select("tld").distinct(), "tld", "left_anti")


def read_finished(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("tld")).where("tld <> ''")


def mark_finished(tlds: DataFrame, path: str) -> None:
    """Add TLDs to the finished list, after their events are written."""
    tlds.select("tld").distinct().write.mode("append").text(path)


def reset_finished(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], "tld string").write.mode("overwrite").text(path)
