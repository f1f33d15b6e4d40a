from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from nameharbor.functions.pseudonyms import Anonymizer
from nameharbor.functions.suffixes import suffix_rules
from nameharbor.operators.snapshots import zone_diff_events
from nameharbor.plans.store import Store
from nameharbor.schemas import LEVELS, RECORDS
from nameharbor.streaming import jobs
from test_sources import certificate


@pytest.fixture
def land(spark, tmp_path):
    """Land one file per call, in order of arrival."""
    import os
    import time

    count = [0]

    def write(rows, schema, folder="in"):
        count[0] += 1
        part = str(tmp_path / f"part{count[0]}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(part)
        os.makedirs(tmp_path / folder, exist_ok=True)
        name = next(n for n in os.listdir(part) if n.endswith(".parquet"))
        target = tmp_path / folder / f"{count[0]:03d}.parquet"
        os.rename(f"{part}/{name}", target)
        at = time.time() - 1000 + count[0]
        os.utime(target, (at, at))
        return str(tmp_path / folder)

    return write


@pytest.fixture
def current(spark):
    return spark.createDataFrame([("run", 1)], "muid string, stage_id bigint")


def test_one_micro_batch_per_file(spark, land, current, tmp_path, rows):
    ms = 1_700_000_000_123
    for names in (["a.com", "www.a.com"], ["a.com", "b.org"], ["b.org", "1.2.3.4"]):
        path = land([("run", n, "A", ms) for n in names], RECORDS["passive"])
    step = jobs.ingest_step(str(tmp_path / "store"), "passive", current, suffix_rules(spark))
    stream = jobs.read_landed(spark, path, RECORDS["passive"], files_per_trigger=1)
    jobs.run(stream, "passive", str(tmp_path / "check"), step)
    store = Store(spark, str(tmp_path / "store"))
    assert store._marks('commits').count() == 3
    assert [store.read(t).count() for t in ("fqdns", "apexes", "passive_entries", "rejects")] == [3, 2, 5, 1]
    assert rows(store.read("passive_entries"), F.unix_millis("timestamp"))[0] == (ms,)
    # nothing new: nothing happens; another file: one more batch
    jobs.run(jobs.read_landed(spark, path, RECORDS["passive"]), "passive", str(tmp_path / "check"), step)
    assert store._marks('commits').count() == 3
    land([("run", "c.com", "A", ms)], RECORDS["passive"])
    jobs.run(jobs.read_landed(spark, path, RECORDS["passive"]), "passive", str(tmp_path / "check"), step)
    assert store.read("passive_entries").count() == 6


def test_four_streams_into_one_store(spark, land, current, tmp_path):
    name, ms = "www.example.co.uk", 1_700_000_000_000
    log = ("a log", "key", "log/", 86400, [0], None)
    records = {
        "zone": ("run", name, "REGISTRATION", ms), "ct": ("run", certificate([name]), 3, ms, False, log),
        "passive": ("run", name, "A", ms), "entrada": ("run", name, ms, ms + 1),
    }
    for source, record in records.items():
        path = land([record], RECORDS[source], source)
        step = jobs.ingest_step(str(tmp_path / "store"), source, current, suffix_rules(spark), Anonymizer.sha256("1", "2", "3", "4"))
        jobs.run(jobs.read_landed(spark, path, RECORDS[source]), source, str(tmp_path / f"check-{source}"), step)
    store = Store(spark, str(tmp_path / "store"))
    tables = ("tlds", "public_suffixes", "apexes", "fqdns", "tlds_anon", "public_suffixes_anon", "apexes_anon", "fqdns_anon",
              "certificates", "certificate_to_fqdns", "log_entries", "passive_entries", "zonefile_entries", "entrada_entries")
    assert [store.read(t).count() for t in tables] == [1] * len(tables)
    for level in LEVELS:
        assert store.anon_view(level).where(f"plain_{level}_id is not null").count() == 1
    assert store.read("zonefile_entries").where("registered is not null").count() == 1


SNAPSHOT = "tld string, snapshot_date date, domain string"


def test_streaming_differ_is_the_batch_differ(spark, land, tmp_path):
    days = [date(2024, 1, d) for d in (1, 2, 3, 5, 6)]
    held = {"com": ["ab", "abc", "bc", "ab", "d"], "net": ["x", "x", "", "xy", "y"]}
    everything = []
    for i, day in enumerate(days):
        rows = [(tld, day, f"{n}.{tld}") for tld, sets in held.items() for n in sets[i]]
        everything += rows
        path = land(rows + rows[:1], SNAPSHOT)
    jobs.run(jobs.read_landed(spark, path, spark.createDataFrame([], SNAPSHOT).schema, files_per_trigger=1), "diff", str(tmp_path / "check"), jobs.zone_diff_step(str(tmp_path / "store")))
    store = Store(spark, str(tmp_path / "store"))
    assert store._marks('commits').count() == 5
    batch = zone_diff_events(spark.createDataFrame(everything, SNAPSHOT))
    columns = ["tld", "domain", "event_type", "snapshot_date"]
    found = store.read("zone_events").select(*columns)
    assert found.count() == batch.count()
    assert found.exceptAll(batch.select(*columns)).count() == 0


def test_names_are_known_across_batches(spark, land, tmp_path, rows):
    for names in (["a", "b", "a"], ["b", "c"], ["a"]):
        path = land([(n,) for n in names], "fqdn string")
    stream = jobs.read_landed(spark, path, spark.createDataFrame([], "fqdn string").schema, files_per_trigger=1)
    jobs.run(stream, "names", str(tmp_path / "check"), jobs.known_names_step(str(tmp_path / "store")))
    assert rows(Store(spark, str(tmp_path / "store")).read("known_names")) == [("a",), ("b",), ("c",)]


def test_counters_over_batches_and_late_rows(spark, land, tmp_path, rows):
    at = datetime(2024, 1, 1)
    schema = "ts timestamp, tld string"
    land([(at + timedelta(minutes=m), "com") for m in (1, 2, 70)], schema)
    land([(at + timedelta(minutes=m), "com") for m in (71, 59, 300)], schema)  # 59 is within the allowed delay
    land([(at + timedelta(minutes=301), "com")], schema)
    path = land([(at + timedelta(minutes=m), "com") for m in (302, 3)], schema)  # 3 is too late by now
    stream = jobs.read_landed(spark, path, spark.createDataFrame([], schema).schema, files_per_trigger=1)
    jobs.stream_interval_counts(stream, ["tld"], str(tmp_path / "check"), str(tmp_path / "out"))
    found = jobs.latest_counts(spark, str(tmp_path / "out"), ["tld"])
    assert rows(found, F.hour("interval_start"), "n") == [(0, 3), (1, 2), (5, 3)]
