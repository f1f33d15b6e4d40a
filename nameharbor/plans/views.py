"""Name observations laid over the given tables: the inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The given Parquet tables of one folder, and the observation views on them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def landing(self, name: str) -> str:
        """The table as a file-stream path: a pattern may name one file or a folder of files."""
        return f"{self.folder}/{name}.{{parquet}}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def events(self) -> DataFrame:
        return self.table("events")

    def obs(self) -> DataFrame:
        return observations(self.events())

    def snap(self, *more: str) -> DataFrame:
        return snapshots(self.events(), *more)

    def host(self) -> DataFrame:
        return hosts(self.table("pages"))

    def cert(self) -> DataFrame:
        return certificate_entries(self.table("documents"))

    def runs(self) -> DataFrame:
        return run_starts(self.table("orders"))


def pick(number: Column, *values: str | Column) -> Column:
    """The value whose place is the number modulo the count of values."""
    place = F.pmod(number, F.lit(len(values)))
    out = F.when(place == 0, values[0])
    for i, value in enumerate(values[1:], 1):
        out = out.when(place == i, value)
    return out


def observations(events: DataFrame) -> DataFrame:
    """One query sighting per event: the sighting and its name parts."""
    suffix = pick(F.col("event_id"), "co.uk", "com", "org")
    tld = pick(F.col("event_id"), "uk", "com", "org")
    apex = F.concat_ws(".", "event_type", suffix)
    return events.select(
        "event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type",
        F.concat(F.lit("h"), F.col("user_id").cast("string"), F.lit("."), apex).alias("fqdn"),
        apex.alias("apex"), suffix.alias("public_suffix"), tld.alias("tld"),
    )


def snapshots(events: DataFrame, *more: str) -> DataFrame:
    """Domains of three zones per day; copies are left in for the readers to merge."""
    tld = pick(F.col("event_id"), "com", "net", "org")
    return events.select(
        tld.alias("tld"), F.col("ts").cast("date").alias("snapshot_date"),
        F.concat(F.lit("d"), F.col("user_id").cast("string"), F.lit("."), tld).alias("domain"),
        *more,
    )


def hosts(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.regexp_extract("url", r"^[a-z]+://([^/]+)/", 1).alias("host"))


def certificate_entries(documents: DataFrame) -> DataFrame:
    """One log entry per document, the text as certificate bytes; copies are one certificate."""
    doc = F.col("doc_id")
    site = F.concat(F.lit("s"), F.pmod(doc, F.lit(50)).cast("string"), F.lit("."), F.col("lang"), F.lit(".com"))
    return documents.select(
        F.col("text").cast("binary").alias("raw"), doc.alias("index"), F.col("source").alias("log_url"),
        F.concat(F.lit("log "), F.col("source")).alias("description"),
        (F.pmod(doc, F.lit(2)) == 0).alias("is_precert"),
        F.timestamp_seconds(F.lit(1704067200) + doc * 60).alias("ts"),
        F.array(site, F.concat(F.lit("www."), site)).alias("dns_names"),
    )


def run_starts(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").alias("measurement_id"), F.col("o_orderdate").cast("timestamp").alias("start_time"),
        F.col("o_orderkey").alias("seq"),
    )
