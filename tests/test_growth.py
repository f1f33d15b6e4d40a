"""Figures that must not grow with the input: bytes of one task, tasks of a listing, passes over a batch."""

import glob
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from nameharbor.functions.suffixes import suffix_rules
from nameharbor.plans import store as stores
from nameharbor.plans.ingest import Batch, ingest
from nameharbor.plans.store import Store
from nameharbor.session import prepare
from nameharbor.sources.pages import Pages

AT = datetime(2024, 1, 1)
ENTRY = "muid string, raw binary, index bigint, ts timestamp, is_precert boolean, log_url string, description string, dns_names array<string>"


def current(spark):
    return spark.createDataFrame([("run", 1)], "muid string, stage_id bigint")


def certificates(spark, numbers):
    return spark.createDataFrame([("run", b"%04d" % i * 100, i, AT, False, "log/", "a log", [f"n{i}.com"]) for i in numbers], ENTRY)


def test_large_certificates_are_written_by_several_tasks(spark, tmp_path, rows, monkeypatch):
    """A bucket is cut by its bytes, and its certificates are found again."""
    monkeypatch.setattr(stores, "FILE_BYTES", 10_000, raising=False)
    store = Store(spark, str(tmp_path / "store"))
    ingest(store, Batch("one", ct=certificates(spark, [*range(200), *range(20)])), current(spark), suffix_rules(spark))  # 88,000 bytes, 9 files
    files = glob.glob(f"{store.path}/certificates/batch_id=one/bucket=-/*.parquet")
    assert 5 <= len(files) <= 9
    assert max(spark.read.parquet(f).count() for f in files) < 60
    assert rows(store.read("certificates"), "id") == [(i,) for i in sorted(range(1, 201), key=lambda i: repr((i,)))]
    ingest(store, Batch("two", ct=certificates(spark, range(190, 230))), current(spark), suffix_rules(spark))
    stored = store.read("certificates")
    assert stored.count() == 230 == stored.select("sha256_fingerprint").distinct().count() == stored.select("id").distinct().count()
    assert store.read("log_entries").count() == 220 + 40


def test_a_listing_of_many_pages_has_few_tasks(spark, tmp_path):
    entries = spark.range(300).select(
        F.lit("log").alias("log_url"), F.col("id").alias("index"), F.timestamp_seconds(F.col("id")).alias("ts"))
    pages = Pages(prepare(spark), str(tmp_path / "pages"), entries.schema, size=2)
    pages.land("one", entries)
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        assert pages.entries().count() == 300
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # 150 folders
    assert stages and max(s.numTasks for s in stages if s is not None) <= 64


def test_names_of_a_batch_are_split_once(spark, tmp_path):
    """Names and facts read the accepted rows as written; only what is turned away looks at the batch again."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(name):
        seen.add(1)
        return name

    names = [f"h{i % 50}.com" for i in range(100)]
    batch = spark.createDataFrame([("run", n, AT + timedelta(minutes=i)) for i, n in enumerate(names)], "muid string, query string, ts timestamp")
    store = Store(spark, str(tmp_path / "store"))
    ingest(store, Batch("one", passive=batch.withColumn("query", counted("query"))), current(spark), suffix_rules(spark))
    assert store.read("passive_entries").count() == 100 and store.read("fqdns").count() == 50
    assert seen.value <= 400  # 600 before
