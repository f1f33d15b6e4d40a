"""Lookups that read only the buckets and files that can hold the names of a batch."""

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from nameharbor.functions.suffixes import suffix_rules
from nameharbor.operators import dimensions as dim
from nameharbor.plans.ingest import Batch, ingest
from nameharbor.plans.store import Store
from nameharbor.schemas import LEVELS, LEVEL_TABLE

AT = datetime(2024, 1, 1)


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), bucket_rows=20)


def passive(spark, store, batch, names):
    rows = spark.createDataFrame([("run", n, AT) for n in names], "muid string, query string, ts timestamp")
    current = spark.createDataFrame([("run", 7)], "muid string, stage_id bigint")
    ingest(store, Batch(batch, passive=rows), current, suffix_rules(spark))


def scans(node):
    """The file scans of an executed plan."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return scans(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return scans(node.plan())
    if kind == "FileSourceScanExec":
        return [node]
    children = node.children()
    return [scan for i in range(children.size()) for scan in scans(children.apply(i))]


def scanned(rows):
    """Files that the scans of a frame open."""
    fresh = rows.select("*")  # metrics are those of the first run of a plan
    fresh.collect()
    return sum(scan.metrics().apply("numFiles").value() for scan in scans(fresh._jdf.queryExecution().executedPlan()))


def hash_start(name, digits=dim.BUCKET_DIGITS):
    import hashlib

    return hashlib.md5(name.encode()).hexdigest()[:digits]


def buckets_of(path):
    return {m[1] for root, _, files in os.walk(path) if any(f.endswith(".parquet") for f in files) for m in [re.search(r"bucket=([^/]+)", root)] if m}


def test_a_batch_is_parted_by_its_size(spark, store):
    passive(spark, store, "many", [f"n{i}.com" for i in range(400)])
    path = f"{store.path}/names/batch_id=many/twin=plain"
    assert buckets_of(f"{path}/level=tld") == {"-"}
    assert buckets_of(f"{path}/level=fqdn") == {hash_start(f"n{i}.com", 2) for i in range(400)}  # 400 > 20 * 16
    passive(spark, store, "few", ["n1.com", "x.com"])
    assert buckets_of(f"{store.path}/names/batch_id=few") == {"-"}
    assert store.read("fqdns").count() == 401 and sorted(r.id for r in store.read("fqdns").collect()) == list(range(1, 402))


def test_a_small_batch_reads_the_buckets_it_touches(spark, store):
    names = [f"n{i}.com" for i in range(400)]
    passive(spark, store, "many", names)
    wanted = spark.createDataFrame([("plain", "fqdn", n) for n in ("n3.com", "n77.com", "n300.com", "new.com")], "twin string, level string, name string")
    asked = dim.wanted_names(wanted)
    touched = {hash_start(n, 2) for n in ("n3.com", "n77.com", "n300.com", "new.com")}
    assert asked["plain", "fqdn"] == dim.Wanted(4, frozenset(hash_start(n) for n in ("n3.com", "n77.com", "n300.com", "new.com")), asked["plain", "fqdn"].names)
    stored = store.names([], asked)
    assert {r["name"] for r in stored.collect()} == {"n3.com", "n77.com", "n300.com"}
    assert 0 < scanned(stored) <= len(touched)
    # the names reach the files' statistics and Bloom filters
    text = stored._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*In\(name", text)
    every = store.read("fqdns")
    assert scanned(every) == len(buckets_of(f"{store.path}/names/batch_id=many/twin=plain/level=fqdn"))


def test_files_have_bloom_filters(spark, store):
    import pyarrow.parquet as pq

    passive(spark, store, "one", [f"n{i}.com" for i in range(10)])
    (path,) = [os.path.join(root, f) for root, _, files in os.walk(f"{store.path}/names/batch_id=one/twin=plain/level=fqdn") for f in files if f.endswith(".parquet")]
    group = pq.ParquetFile(path).metadata.row_group(0)
    (name,) = [group.column(i) for i in range(group.num_columns) if group.column(i).path_in_schema == "name"]
    assert os.path.getsize(path) < 20_000  # sized by the number of names
    rows = spark.read.parquet(path)
    assert [r.name for r in rows.select("name").collect()] == sorted(r.name for r in rows.select("name").collect())
    assert name.is_stats_set


@pytest.mark.parametrize("each", [1, 7, 1 << 20])
def test_any_bucket_size_gives_the_same_rows(spark, tmp_path, each):
    store = Store(spark, str(tmp_path / "store"), bucket_rows=each)
    batches = [[f"{i % 30}.n{i % 9}.co.uk" for i in range(40)], [f"{i % 35}.n{i % 11}.co.uk" for i in range(60)], ["0.n0.co.uk", "www.x.org"]]
    for number, names in enumerate(batches):
        passive(spark, store, str(number), names)
    expected = {n for names in batches for n in names}
    for level, of in zip(LEVELS, (1, 2, 3, 99), strict=True):
        found = store.read(LEVEL_TABLE[level]).collect()
        assert len({r[level] for r in found}) == len(found) and sorted(r.id for r in found) == list(range(1, len(found) + 1))
        assert {r[level] for r in found} == ({".".join(n.split(".")[-of:]) for n in expected} if of == 99 else
                                             {n.split(".")[-1] for n in expected} if level == "tld" else {r[level] for r in found})
    fqdns, apexes = store.read("fqdns"), store.read("apexes").select(F.col("id").alias("apex_id"), "apex")
    assert all(r.fqdn.endswith(r.apex) for r in fqdns.join(apexes, "apex_id").collect())
    assert fqdns.join(apexes, "apex_id").count() == len(expected)


def test_wanted_of_nothing_and_of_many(spark):
    empty = spark.createDataFrame([], "fqdn string")
    assert dim.wanted_in(empty, "fqdn") == dim.Wanted()
    many = spark.range(20_000).select(F.col("id").cast("string").alias("fqdn"))
    asked = dim.wanted_in(many, "fqdn")
    assert asked.n == 20_000 and asked.names is None and len(asked.prefixes) > 4000
    assert [dim.bucket_of(F.lit("a"), n, 10)._jc.toString() for n in (0, 10)] == ["'-'"] * 2


def test_empty_batches(spark, store):
    passive(spark, store, "none", [])
    passive(spark, store, "addresses", ["1.2.3.4"])
    assert [store.read(t).count() for t in ("fqdns", "tlds", "passive_entries", "rejects")] == [0, 0, 0, 1]
    passive(spark, store, "one", ["a.com"])
    passive(spark, store, "again", [])
    assert [store.read(t).count() for t in ("fqdns", "tlds", "passive_entries")] == [1, 1, 1]
    assert store.highest()["fqdns"] == 1
