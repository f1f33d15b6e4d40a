"""Passive-DNS logs: JSON lines whose query field is a string or an array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import once
from ..functions.times import PASSIVE_SHIFT, shifted


def string_or_array(doc: Column, path: str) -> Column:
    """A JSON value that is one string or an array of strings, as an array."""
    many = F.try_variant_get(doc, path, "array<string>")
    one = F.array_compact(F.array(F.try_variant_get(doc, path, "string")))
    return F.coalesce(many, one)


def parse_log_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row per query: ``query, ts``. Unreadable lines and lines without a query give none."""
    kept = [c for c in lines.columns if c != value]
    doc = lines.select(*kept, once(F.try_parse_json(value)).alias("_doc"))
    ts = F.try_to_timestamp(F.try_variant_get("_doc", "$.result.timestamp", "string"))
    queries = string_or_array(F.col("_doc"), '$.result["query{}"]')
    # a line that is no JSON has a null document, hence no queries
    return doc.select(*kept, ts.alias("ts"), F.explode(queries).alias("query"))


def unreadable_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    return lines.where(F.try_parse_json(value).isNull()).select(
        F.lit("passive").alias("source"), F.lit("unreadable line").alias("reason"),
        F.col(value).alias("payload"), F.lit(None).cast("bigint").alias("stage_id"),
    )


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the ``.json`` files directly in ``path``."""
    return spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "false").text(path)


def read_passive(spark: SparkSession, path: str, shift: str = PASSIVE_SHIFT) -> tuple[DataFrame, DataFrame]:
    """Queries of a folder with their time moved by ``shift``, and its unreadable lines as rejects."""
    lines = read_log_lines(spark, path)
    return parse_log_lines(lines).withColumn("ts", shifted(F.col("ts"), shift)), unreadable_lines(lines)
