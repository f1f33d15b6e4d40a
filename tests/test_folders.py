"""Jobs from files to the store, with runs that the store keeps."""

import gzip
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from nameharbor.functions.suffixes import suffix_rules
from nameharbor.operators import runs
from nameharbor.plans import folders
from nameharbor.plans.runs import current_stage_ids, record_events, stored_stages
from nameharbor.plans.store import Store
from nameharbor.schemas import RECORDS
from nameharbor.streaming import jobs
from test_sources import certificate, leaf


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path / "store"))
    record_events(made, "run", runs.run_event(spark, runs.START, "run", "text", "host", datetime(2024, 1, 1)))
    return made


def test_snapshots(spark, rows, store, tmp_path):
    """A broken file stops its own TLD only; a finished TLD is skipped."""
    held = {"com": ["$ORIGIN com.\na ns x.\n", "$ORIGIN com.\na ns x.\nb ns x.\n"], "net": ["a.net. in ns x.\n", "broken\n"]}
    for tld, texts in held.items():
        for day, text in enumerate(texts, 1):
            with gzip.open(tmp_path / f"{tld}.2021-02-0{day}.gz", "wt") as out:
                out.write(text)
    for batch in ("z1", "z2"):
        folders.store_snapshots(store, batch, "run", f"{tmp_path}/*.gz", suffix_rules(spark))
    assert rows(store.read("apexes"), "apex") == [("a.com",), ("b.com",)]
    assert store.read("zonefile_entries").count() == 2
    assert rows(store.read("zonefile_entries"), F.dayofmonth("registered"), "expired", "stage_id") == [(2, None, 1), (None, None, 1)]
    assert rows(store.read("finished_tlds")) == [("com",)]
    assert rows(store.read("rejects").distinct(), "reason", "payload") == [("unreadable record", "broken")]


def test_zone_rounds(spark, rows, store, tmp_path):
    """Each round has a stage of its own; a repeated round changes nothing."""
    for day, text in enumerate(["a.com. in ns x.\n", "a.com. in ns x.\nb.com. in ns x.\nbroken\n"], 1):
        with gzip.open(tmp_path / f"com.2021-02-0{day}.gz", "wt") as out:
            out.write(text)
    for number in (0, 1, 1):
        day, at = f"2021-02-0{number + 1}", datetime(2024, 1, 1, number + 1)
        folders.store_zone_round(store, number, "run", f"{tmp_path}/*.gz", suffix_rules(spark), at, day, day, ended=at.replace(minute=30))
    stages = stored_stages(store)
    assert rows(stages, "stage", F.hour("start_time"), F.hour("stop_time"), F.minute("stop_time")) == [(1, 0, 1, 30), (2, 2, 2, 30)]
    found = store.read("zonefile_entries").join(stages.select(F.col("id").alias("stage_id"), "stage"), "stage_id")
    assert rows(found.groupBy("stage").count()) == [(1, 1), (2, 2)]
    assert rows(store.read("rejects"), "payload") == [("broken",)]
    zones = store.read("metrics").where("name = 'zone-entries'")
    assert rows(zones, "key", "n") == [("com", 1), ("com", 2)]


def test_pages(spark, rows, store, tmp_path):
    import json

    pages = tmp_path / "pages" / "log_url=log"
    pages.mkdir(parents=True)
    logs = spark.createDataFrame([("log", "a log"), ("other", "no page")], "url string, description string")

    def land(first, *leaves):
        (pages / f"entry_{first}_{first + len(leaves)}.json").write_text(json.dumps({"entries": [{"leaf_input": x, "extra_data": ""} for x in leaves]}))
        folders.store_entry_pages(store, f"c{first}", "run", str(tmp_path / "pages"), suffix_rules(spark), logs)

    land(0, leaf(1000, 0, certificate(["a.com"])), leaf(2000, 0, b"garbage"), leaf(3000, 7, b"x"))
    assert rows(store.read("log_entries"), "index", "stage_id") == [(0, 1)]
    assert rows(store.read("rejects"), "reason") == [("unreadable certificate",), ("unsupported entry type",)]
    land(3, leaf(4000, 0, certificate(["b.com"])))
    assert rows(store.read("log_entries"), "id", "index") == [(1, 0), (2, 3)]
    assert rows(store.read("fqdns"), "fqdn") == [("a.com",), ("b.com",)]


def test_a_run_that_starts_after_the_stream(spark, rows, store, tmp_path):
    """The stages are asked for in every micro-batch."""
    path = str(tmp_path / "in")
    for muid, name in (("run", "a.com"), ("late", "b.com")):
        record = [(muid, name, "A", 1_700_000_000_000)]
        spark.createDataFrame(record, RECORDS["passive"]).coalesce(1).write.mode("append").parquet(path)
    stream = jobs.read_landed(spark, path, RECORDS["passive"], files_per_trigger=1)
    ingest = jobs.ingest_step(store.path, "passive", current_stage_ids, suffix_rules(spark))

    def start_late(_, batch):
        if batch.endswith("1"):
            record_events(store, "late", runs.run_event(spark, runs.START, "late", ts=datetime(2024, 1, 2)))

    jobs.run(stream, "passive", str(tmp_path / "check"), start_late, ingest)
    assert rows(store.read("passive_entries"), "id", "stage_id") in ([(1, 1), (2, 2)], [(1, 2), (2, 1)])
    assert store.read("rejects").count() == 0
