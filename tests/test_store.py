import shutil
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from nameharbor.functions.pseudonyms import Anonymizer
from nameharbor.functions.suffixes import suffix_rules
from nameharbor.plans.ingest import Batch, ingest
from nameharbor.plans.store import Store, StoreBusy
from nameharbor.schemas import LEVELS, LEVEL_TABLE, TABLES

SALTS = Anonymizer.sha256("1", "2", "3", "4")
AT = datetime(2024, 1, 1)


@pytest.fixture
def make(spark, tmp_path):
    current = spark.createDataFrame([("run", 7)], "muid string, stage_id bigint")
    rules = suffix_rules(spark)

    class Maker:
        store = Store(spark, str(tmp_path / "store"))

        def zone(self, *names, event="FIRST_SEEN"):
            return spark.createDataFrame([("run", n, event, AT) for n in names], "muid string, domain string, event_type string, ts timestamp")

        def passive(self, *names):
            return spark.createDataFrame([("run", n, AT) for n in names], "muid string, query string, ts timestamp")

        def entrada(self, *names):
            return spark.createDataFrame([("run", n, AT, AT + timedelta(1)) for n in names], "muid string, qname string, first_seen timestamp, last_seen timestamp")

        def ct(self, *sans, log="log/"):
            rows = [("run", str(sorted(s)).lower().encode(), i, AT, False, log, "a log", s) for i, s in enumerate(sans)]
            return spark.createDataFrame(rows, "muid string, raw binary, index bigint, ts timestamp, is_precert boolean, log_url string, description string, dns_names array<string>")

        def ingest(self, batch, **sources):
            ingest(self.store, Batch(batch, **sources), current, rules, SALTS)

        def counts(self, *tables):
            hidden = self.store.open_batches()
            return [self.store.read(t, hidden).count() for t in tables]

    return Maker()


def anon(level):
    return f"{LEVEL_TABLE[level]}_anon"


def check_keys(store):
    """Invariants: names and ids unique, ids dense, no dangling key."""
    for level in LEVELS:
        for table in (LEVEL_TABLE[level], anon(level)):
            found = store.read(table, []).collect()
            assert len({r[level] for r in found}) == len(found)
            assert sorted(r.id for r in found) == list(range(1, len(found) + 1))
            for parent in LEVELS[: LEVELS.index(level)]:
                of = LEVEL_TABLE[parent] if table == LEVEL_TABLE[level] else anon(parent)
                known = {r.id for r in store.read(of, []).collect()}
                assert {r[f"{parent}_id"] for r in found} <= known
    fqdns = {r.id for r in store.read("fqdns", []).collect()}
    certs = {r.id for r in store.read("certificates", []).collect()}
    assert {r.fqdn_id for r in store.read("certificate_to_fqdns", []).collect()} <= fqdns
    assert {r.certificate_id for r in store.read("log_entries", []).collect()} <= certs
    assert {r.fqdn_id for r in store.read("passive_entries", []).collect()} <= fqdns


def test_passive_zone_and_rejects(make):
    """Copies stay sightings, a hot name is one dimension row, bad rows are turned away with a reason."""
    make.ingest(
        "p", passive=make.passive("a.com", "a.com", "www.a.com", "b.org.", "B.ORG", "1.2.3.4", *["hot.org"] * 500),
        zone=make.zone(*["example.org"] * 6).unionByName(make.zone("::1").withColumn("muid", F.lit("gone"))),
    )
    assert make.counts("tlds", "apexes", "fqdns", "passive_entries", "zonefile_entries") == [2, 4, 5, 505, 6]
    assert make.store.read("passive_entries").select("stage_id").distinct().first().stage_id == 7
    assert make.store.read("zonefile_entries").where("registered is null and expired is null").count() == 6
    found = {(r.source, r.reason, r.payload) for r in make.store.read("rejects").collect()}
    assert found == {("passive", "name is an IP address", "1.2.3.4"), ("zone", "no active stage", "::1")}
    check_keys(make.store)


def test_certificates(make):
    sans = [["www.a.com", "www.b.org"], ["www.b.org", "www.c.com", "test.c.com"]]
    make.ingest("c1", ct=make.ct(*sans))
    make.ingest("c2", ct=make.ct(*[[n.upper() for n in s] for s in sans], ["1.2.3.4"], log="other/"))
    assert make.counts("fqdns", "apexes", "certificates", "log_entries", "certificate_to_fqdns", "logs") == [4, 3, 3, 5, 5, 2]
    check_keys(make.store)


def test_pseudonyms_of_stored_names_are_linked(make):
    make.ingest("z", zone=make.zone("example.co.uk"))
    make.ingest("e", entrada=make.entrada("www.example.co.uk", "test.example.co.uk", "other.co.uk", "other.co.uk"))
    assert make.counts(*[LEVEL_TABLE[x] for x in LEVELS], *[anon(x) for x in LEVELS], "entrada_entries") == [1, 1, 1, 1, 1, 1, 2, 3, 4]
    linked = {x: make.store.anon_view(x).where(f"plain_{x}_id is not null").count() for x in LEVELS}
    assert linked == {"tld": 1, "public_suffix": 1, "apex": 1, "fqdn": 0}
    row = make.store.anon_view("apex").where("plain_apex_id is not null").first()
    assert row.apex == make.store.read("apexes").select(SALTS.of("apex", F.col("apex"))).first()[0]


NAMES = [f"{i}.{d}" for i in (0, 1) for d in ("example.co.uk", "google.co.uk", "google.com")]


@pytest.mark.parametrize("order", [("entrada", "passive"), ("both",)])
def test_links_in_any_order(make, order):
    for step in order:
        kinds = ("entrada", "passive") if step == "both" else (step,)
        make.ingest(step, **{k: getattr(make, k)(*NAMES) for k in kinds})
    for level, expected in zip(LEVELS, (2, 2, 3, 6), strict=True):
        view = make.store.anon_view(level)
        assert view.count() == expected == view.where(f"plain_{level}_id is not null").count()
    check_keys(make.store)


def test_the_offset_of_the_warehouse_grows_by_batch(make):
    from nameharbor.plans.ingest import warehouse_offset

    for batch, names, expected in (("one", ("a.com", "a.com", "b.com"), 2), ("two", ("b.com", "c.com"), 3)):
        make.ingest(batch, entrada=make.entrada(*names))
        full = make.store.read("entrada_entries").select("fqdn_id").distinct().count()
        assert warehouse_offset(make.store).first().resume_offset == expected == full


def test_all_sources_at_once(make):
    name = "www.example.co.uk"
    make.ingest("all", zone=make.zone(name), ct=make.ct([name]), passive=make.passive(name), entrada=make.entrada(name))
    tables = [t for x in LEVELS for t in (LEVEL_TABLE[x], anon(x), f"{anon(x)}_links")]
    tables += ["certificates", "certificate_to_fqdns", "log_entries", "passive_entries", "zonefile_entries", "entrada_entries"]
    assert make.counts(*tables) == [1] * len(tables)
    check_keys(make.store)


def snapshot_of(store):
    hidden = store.open_batches()
    tables = ("apexes", "fqdns", "fqdns_anon", "fqdns_anon_links", "passive_entries", "entrada_entries")
    return {t: sorted(map(repr, store.read(t, hidden).collect())) for t in tables}


def test_repeated_and_unfinished_batches(make):
    one = {"passive": make.passive("a.com", "b.com")}
    two = {"passive": make.passive("b.com", "c.com"), "entrada": make.entrada("a.com")}
    make.ingest("one", **one)
    before = snapshot_of(make.store)
    make.ingest("two", **two)
    after = snapshot_of(make.store)
    for batch, sources in (("two", two), ("one", one)):
        make.ingest(batch, **sources)  # nothing happens
    assert snapshot_of(make.store) == after
    # as if the job had died before its marker: readers see the state of batch one
    shutil.rmtree(f"{make.store.path}/commits")
    make.store.commit("one")
    assert snapshot_of(make.store) == before
    make.ingest("two", **two)
    assert snapshot_of(make.store) == after


def test_empty_tables(make):
    assert make.counts("fqdns", "log_entries") == [0, 0]
    make.store.create()
    assert make.counts(*TABLES) == [0] * len(TABLES)
    assert make.store.next_id("fqdns") == 1
    make.ingest("one", passive=make.passive(*[f"n{i}.com" for i in range(10)]))
    assert make.store.next_id("apexes") == 11


FACTS = ("passive_entries", "entrada_entries", "zonefile_entries", "log_entries", "certificate_to_fqdns")


def test_fact_ids_are_unique_over_batches_and_repeat(make):
    hot = ["hot.org"] * 300
    two = dict(passive=make.passive("a.com", *hot), zone=make.zone(*hot), entrada=make.entrada("e.com"), ct=make.ct(["a.com"]))
    for batch in ("one", "two"):
        make.ingest(batch, **two)
    for table in FACTS:
        ids = sorted(r.id for r in make.store.read(table).collect())
        assert ids == list(range(1, len(ids) + 1))
    assert make.counts("passive_entries") == [602]
    found = snapshot_of(make.store)
    # as if batch two had died before its mark; it runs again and gives the same
    highest = make.store.highest([])
    shutil.rmtree(f"{make.store.path}/commits")
    make.store.commit("one")
    assert make.store.highest()["passive_entries"] == 301
    make.ingest("two", **two)
    assert snapshot_of(make.store) == found and make.store.highest() == highest


def test_metrics_of_each_batch(make, rows):
    for batch in ("one", "two"):
        make.ingest(batch, ct=make.ct(["a.com"], ["a.com"], ["b.com"]), zone=make.zone("a.com"), passive=make.passive("a.com", "b.com"))
    points = make.store.read("metrics")
    hits = points.where("name = 'store-hits'").groupBy("status", "type").agg(F.sum("n").alias("n"))
    stored = {(r.status, r.type): r.n for r in hits.collect()}
    assert stored == {
        **{("db-insert", k): n for k, n in {"tld": 1, "public-suffix": 1, "apex": 2, "fqdn": 2, "cert": 2, "log": 1, "zone-entry": 2, "passive-entry": 4}.items()},
        **{("db-hit", k): n for k, n in {"tld": 1, "public-suffix": 1, "apex": 2, "fqdn": 2}.items()}}
    assert rows(points.where("key is not null"), "name", "key", "n") == [("log-entries", "log/", 3)] * 2 + [("zone-entries", "com", 1)] * 2
    assert points.where("ts is null").count() == 0


@pytest.mark.parametrize("delay", [0, 0.5, 2])
def test_two_writers_at_once(make, delay):
    """The second is refused, or comes after the first; names and ids stay unique."""
    make.ingest("seed", passive=make.passive("seed.com"))
    refused = []

    def write(batch, names, wait):
        threading.Event().wait(wait)
        try:
            make.ingest(batch, passive=make.passive(*names))
        except StoreBusy:
            refused.append(batch)

    threads = [threading.Thread(target=write, args=a) for a in (("a", ["a.com", "x.org"], 0), ("b", ["a.com", "y.net"], delay))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert len(refused) < 2
    for batch in refused:
        make.ingest(batch, passive=make.passive("a.com", "x.org" if batch == "a" else "y.net"))
    assert make.counts("fqdns", "passive_entries") == [4, 5]
    check_keys(make.store)


def test_claim_of_another_process(make):
    """A claim file left by a dead batch keeps others out; the same batch takes it over."""
    make.store.claim("dead")
    from nameharbor.plans import store as stores
    stores._held.clear()
    with pytest.raises(StoreBusy):
        make.ingest("other", passive=make.passive("a.com"))
    make.ingest("dead", passive=make.passive("a.com"))
    make.ingest("other", passive=make.passive("b.com"))
    assert make.counts("fqdns") == [2]


def test_runs_in_the_store(spark, make, rows):
    from nameharbor.operators import runs
    from nameharbor.plans.runs import current_stage_ids, record_events, stored_measurements, stored_stages

    def event(batch, kind, muid, minute):
        record_events(make.store, batch, runs.run_event(spark, kind, muid, "text", "host", AT + timedelta(minutes=minute)))

    event("r1", runs.START, "one", 0)
    event("r2", runs.START, "two", 1)
    event("r3", runs.STAGE_STOP, "one", 2)
    event("r4", runs.STAGE_START, "one", 3)
    assert rows(current_stage_ids(make.store)) == [("one", 3), ("two", 2)]
    event("r5", runs.STOP, "one", 4)
    event("r5", runs.STOP, "one", 4)  # a repeated batch
    assert rows(stored_measurements(make.store), "id", "muid", F.minute("start_time"), F.minute("end_time")) == [(1, "one", 0, 4), (2, "two", 1, None)]
    assert rows(stored_stages(make.store), "id", "muid", "stage", F.minute("start_time"), F.minute("stop_time")) == [
        (1, "one", 1, 0, 2), (2, "two", 1, 1, None), (3, "one", 2, 3, 4)]
