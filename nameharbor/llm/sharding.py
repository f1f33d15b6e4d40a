"""Sharding: contiguous shards of equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nameharbor.session import written


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of each document.

    The order is that of (MD5 of the text, doc_id), so that equal texts lie side by side. It is laid
    out in range partitions once; only the partitions' totals are put together, and a document's
    place in bytes is its partition's offset plus the running sum within. A document goes to the
    shard in which its middle byte lies. A null text has size 1 and the checksum of the empty one; a
    null id comes first among equal texts; equal rows are told apart by nothing but their slots.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("key"))
    laid = written(rows.repartitionByRange("key", "doc_id").withColumn("part", F.spark_partition_id()), "shards")
    # one row for each partition, then for each partition and shard: a window over these is small
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = laid.groupBy("part").agg(F.sum("size").alias("bytes"))
    parts = parts.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("offset"),
                         F.sum("bytes").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("part").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = laid.withColumn("at", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(parts, "part")
    # the middle is at + size / 2; twice that keeps to whole numbers
    middle = (F.col("offset") + F.col("at")) * 2 + F.col("size")
    shard = F.least(F.floor(middle * shards / (F.col("total") * 2)), F.lit(shards - 1)).cast("int")
    placed = placed.withColumn("shard", shard)
    counts = placed.groupBy("part", "shard").agg(F.count("*").alias("n"))
    counts = counts.select("part", "shard", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    within = F.row_number().over(Window.partitionBy("part", "shard").orderBy("key", "doc_id"))
    return placed.withColumn("within", within).join(counts, ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("ahead") + F.col("within") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _crc_table() -> list[int]:
    """What a byte does to a checksum with the reversed polynomial 0xEDB88320."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return table


OP6_SQL = f"""
WITH steps AS (SELECT {_crc_table()}::BIGINT[] AS step),
sized AS (SELECT doc_id, text, strlen(coalesce(text, '')) + 1 AS size, md5(coalesce(text, '')) AS key, hex(encode(coalesce(text, ''))) AS bytes
          FROM documents),
placed AS (SELECT *, sum(size) OVER (ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total FROM sized),
cut AS (SELECT *, least(15, floor(((before * 2 + size) * 16) / (total * 2)))::INT AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(bytes) // 2), lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32,
  'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY key, doc_id) - 1 AS slot, NULL::INT AS grown_shard
FROM cut, steps
"""
