"""Sightings as fact rows: foreign keys by name.

Names of a fact table may be hot while a dimension has one row per name, so
the joins here are plain equi joins: adaptive execution broadcasts a small
dimension and splits the partition of a hot name otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .snapshots import event_columns


def _keyed(rows: DataFrame, dimension: DataFrame, on: str, key: str, how: str = "inner") -> DataFrame:
    return rows.join(dimension.select(on, F.col("id").alias(key)), on, how)


def zone_facts(events: DataFrame, apexes: DataFrame) -> DataFrame:
    """Zone events ``apex, event_type, ts, stage_id`` as rows of ``zonefile_entries``."""
    keyed = _keyed(events, apexes, "apex", "apex_id")
    return keyed.withColumns(event_columns(F.col("event_type"), F.col("ts"))).select(
        "registered", "expired", "apex_id", "stage_id"
    )


def passive_facts(sightings: DataFrame, fqdns: DataFrame) -> DataFrame:
    """Every sighting ``fqdn, ts, stage_id`` as a row of ``passive_entries``."""
    return _keyed(sightings, fqdns, "fqdn", "fqdn_id").select(
        "fqdn_id", F.col("ts").alias("timestamp"), "stage_id"
    )


def warehouse_facts(sightings: DataFrame, fqdns_anon: DataFrame) -> DataFrame:
    """Rows ``fqdn_anon, first_seen, last_seen, stage_id`` keyed to the pseudonym."""
    pseudonyms = fqdns_anon.select(F.col("fqdn").alias("fqdn_anon"), "id")
    return _keyed(sightings, pseudonyms, "fqdn_anon", "fqdn_id").select(
        "fqdn_id", "first_seen", "last_seen", "stage_id"
    )


def fingerprinted(entries: DataFrame) -> DataFrame:
    return entries.withColumn("sha256_fingerprint", F.sha2("raw", 256))


def distinct_certificates(entries: DataFrame) -> DataFrame:
    """One row per certificate; copies merge before the shuffle."""
    return entries.dropDuplicates(["sha256_fingerprint"])


def certificate_names(entries: DataFrame) -> DataFrame:
    """One row per DNS name of an entry."""
    return entries.withColumn("dns_name", F.explode("dns_names")).drop("dns_names")


def bridge(names: DataFrame, certificates: DataFrame, fqdns: DataFrame) -> DataFrame:
    """Distinct ``certificate_id, fqdn_id`` of ``sha256_fingerprint, fqdn`` pairs."""
    pairs = names.select("sha256_fingerprint", "fqdn").distinct()
    keyed = _keyed(pairs, certificates, "sha256_fingerprint", "certificate_id")
    return _keyed(keyed, fqdns, "fqdn", "fqdn_id").select("fqdn_id", "certificate_id")


def log_facts(entries: DataFrame, certificates: DataFrame, logs: DataFrame) -> DataFrame:
    """Every log entry, also of a certificate that was stored before, as a row of ``log_entries``."""
    keyed = _keyed(entries.drop("raw"), certificates, "sha256_fingerprint", "certificate_id")
    urls = logs.select(F.col("url").alias("log_url"), "id")
    return keyed.join(urls.withColumnRenamed("id", "log_id"), "log_url").select(
        "index", F.col("ts").alias("timestamp"), "is_precert", "certificate_id", "log_id", "stage_id"
    )
