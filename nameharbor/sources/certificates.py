"""CT logs: log lists, landed entry pages, leaves and certificate names."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import from_unix_ms
from ..schemas import ENTRY_PAGE, LOG_LIST
from .der import dns_names, names_of_certificates  # noqa: F401 -- the names of one certificate are read here too


def read_log_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Logs and operators of a log-list document."""
    document = spark.read.schema(LOG_LIST).option("multiLine", "true").json(path)
    return (
        document.select(F.explode("logs").alias("log")).select("log.*"),
        document.select(F.explode("operators").alias("operator")).select("operator.*"),
    )


def log_operators(logs: DataFrame, operators: DataFrame) -> DataFrame:
    """One row per log and operator name."""
    pairs = logs.select("url", "description", F.explode("operated_by").alias("id"))
    return pairs.join(operators, "id").select("url", "description", F.col("name").alias("operator"))


def read_entry_pages(
    spark: SparkSession, path: str, log_url: str | None = None, overlapping: bool = False
) -> DataFrame:
    """``log_url, index, leaf_input`` of pages landed as ``entry_<first>_<last>.json``.

    The index of an entry is the first index in the file name plus its place.
    ``log_url`` may also be a partition folder of ``path``. Pages that were
    fetched with overlap are merged on request.
    """
    # a schema of its own: add() would change the shared one
    schema = ENTRY_PAGE if log_url is not None else T.StructType([*ENTRY_PAGE.fields, T.StructField("log_url", T.StringType())])
    pages = spark.read.schema(schema).option("multiLine", "true").json(path)
    first = F.regexp_extract(F.col("_metadata.file_name"), r"entry_(\d+)_\d+\.json", 1)
    url = F.lit(log_url) if log_url is not None else F.col("log_url")
    entries = pages.select(
        url.alias("log_url"), first.try_cast("bigint").alias("first"), F.posexplode("entries").alias("place", "entry")
    ).select("log_url", (F.col("first") + F.col("place")).alias("index"), F.col("entry.leaf_input").alias("leaf_input"))
    return entries.dropDuplicates(["log_url", "index"]) if overlapping else entries


def _number(data: Column, start: Column | int, size: int) -> Column:
    """Big-endian unsigned number out of binary data, ``start`` counted from 1."""
    piece = F.substring(data, F.lit(start) if isinstance(start, int) else start, F.lit(size))
    return F.conv(F.hex(piece), 16, 10).try_cast("bigint")


_CERTIFICATE, _PRECERTIFICATE = 0, 1


def decode_leaves(entries: DataFrame) -> DataFrame:
    """Add ``timestamp, entry_type, is_precert, raw`` from the base64 leaf.

    A leaf is: version, leaf type, eight bytes of milliseconds, two bytes of
    entry type, for a precertificate 32 bytes of key hash, three bytes of
    length and the certificate. ``raw`` is null where the leaf is not of that form.
    """
    leaf = entries.withColumn("_leaf", F.try_to_binary("leaf_input", F.lit("base64")))
    leaf = leaf.withColumns({
        "timestamp": from_unix_ms(_number(F.col("_leaf"), 3, 8)),
        "entry_type": _number(F.col("_leaf"), 11, 2),
    })
    kind = F.col("entry_type")
    start = F.when(kind == _CERTIFICATE, F.lit(13)).when(kind == _PRECERTIFICATE, F.lit(45))
    leaf = leaf.withColumn("_start", start).withColumn("_size", _number(F.col("_leaf"), F.col("_start"), 3))
    whole = F.octet_length("_leaf") >= F.col("_start") + 2 + F.col("_size")
    raw = F.when(whole, F.substring(F.col("_leaf"), F.col("_start") + 3, F.col("_size").cast("int")))
    return leaf.select(
        *[c for c in entries.columns if c != "leaf_input"], "timestamp", "entry_type",
        (kind == _PRECERTIFICATE).alias("is_precert"), raw.alias("raw"), "leaf_input",
    )


def split_leaves(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries with a certificate and an index, and the others as rejects."""
    kind = F.col("entry_type")
    unsupported = kind.isNotNull() & ~kind.isin(_CERTIFICATE, _PRECERTIFICATE)
    reason = (
        F.when(unsupported, "unsupported entry type").when(F.col("raw").isNull(), "bad leaf").otherwise("no index")
    )
    lost = F.col("raw").isNull() | F.col("index").isNull()
    bad = decoded.where(lost).select(
        F.lit("ct").alias("source"), reason.alias("reason"), F.col("leaf_input").alias("payload"),
        F.lit(None).cast("bigint").alias("stage_id"),
    )
    return decoded.where(~lost).drop("leaf_input"), bad


@F.arrow_udf(T.ArrayType(T.StringType()))
def _dns_names(raw: pa.Array) -> pa.Array:
    return names_of_certificates(raw)


def with_dns_names(entries: DataFrame) -> DataFrame:
    """Add ``dns_names``; only the certificate bytes cross to Python, in Arrow batches."""
    return entries.withColumn("dns_names", _dns_names("raw"))
