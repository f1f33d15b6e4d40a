"""CT pages with an index, and the tail that reads them in bounded micro-batches."""

import itertools
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from nameharbor.functions.suffixes import suffix_rules
from nameharbor.operators.snapshots import zone_diff_events
from nameharbor.plans.store import Store
from nameharbor.sources.pages import Pages
from nameharbor.streaming import jobs
from nameharbor.streaming.tail import LogRangeReader, tail_logs
from test_lookups import scanned

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
ENTRY = "log_url string, index bigint, ts timestamp, raw binary, is_precert boolean, description string, dns_names array<string>"


def at(minutes):
    return F.timestamp_seconds(F.lit(int((START + timedelta(minutes=minutes)).timestamp())))


def entry(log, index, minute):
    name = f"n{index}.com"
    return (log, index, START + timedelta(minutes=minute), name.encode(), False, "a log", [name])


#: the times of ``odd/`` go back and forth; ``even/`` has gaps in its indexes
ROWS = [entry("https://odd/", i, [5, 3, 40, 8, 2][i % 5] + i) for i in range(100)] + [entry("even/", i, i) for i in range(0, 200, 3)]


@pytest.fixture
def pages(spark, tmp_path):
    made = Pages(spark, str(tmp_path / "pages"), spark.createDataFrame([], ENTRY).schema, size=10)
    made.land("one", spark.createDataFrame(ROWS + [(None, 1, None, None, None, None, None), ("even/", None, None, None, None, None, None)], ENTRY))
    return made


def test_index(pages, rows):
    index = pages.index()
    assert index.count() == 10 + 20 and index.agg(F.sum("n")).first()[0] == len(ROWS)
    assert rows(index.where("log_url = 'even/' and first = 20"), "least_index", "greatest_index", "n") == [(21, 27, 3)]
    assert rows(pages.heads()) == [("even/", 199), ("https://odd/", 100)]


@pytest.mark.parametrize("minute", [-1, 0, 17, 44, 45, 101, 137, 500])
def test_searches_open_one_page_of_each_log(pages, minute):
    for log in ("https://odd/", "even/"):
        mine = [r for r in ROWS if r[0] == log]
        moment = START + timedelta(minutes=minute)
        after = min((r[1] for r in mine if r[2] > moment), default=None)
        before = max((r[1] for r in mine if r[2] < moment), default=None)
        for search, expected in ((pages.first_after, after), (pages.last_before, before)):
            found = {r.log_url: r.found for r in search(at(minute)).collect()}
            assert found.get(log) == expected
            assert scanned(search(at(minute))) == len(found)


@pytest.mark.parametrize(("start", "end", "files"), [(0, 5, 1), (15, 16, 1), (15, 41, 4), (95, 500, 1), (7, 7, 0), (300, 400, 0)])
def test_ranges_open_their_pages_only(pages, start, end, files):
    found = pages.in_ranges([("https://odd/", start, end)])
    assert sorted(r["index"] for r in found.collect()) == [i for i in range(100) if start <= i < end]
    assert scanned(found) == files
    both = pages.in_ranges([("https://odd/", start, end), ("even/", 30, 40)])
    assert scanned(both) == files + 1 and both.where("log_url = 'even/'").count() == 4


def test_from_a_time_on(pages, rows):
    for minute in (17, 90):
        late = {(r[0], r[1]) for log in ("https://odd/", "even/") for mine in [[r for r in ROWS if r[0] == log]]
                for first in [min((r[1] for r in mine if r[2] > START + timedelta(minutes=minute)), default=10**9)] for r in mine if r[1] >= first}
        assert set(rows(pages.since(at(minute)), "log_url", "index")) == late
    found = {r.log_url: (r.a, r.b) for r in pages.indexes_by_time(a=at(17), b=at(10_000)).collect()}
    assert found == {"https://odd/": (2, 100), "even/": (18, 199)}


def test_a_repeated_landing_replaces_and_another_adds(spark, pages):
    pages.land("one", spark.createDataFrame(ROWS, ENTRY))
    assert pages.entries().count() == len(ROWS) and pages.index().count() == 30
    pages.land("two", spark.createDataFrame([entry("https://odd/", 100 + i, 200 + i) for i in range(7)], ENTRY))
    assert pages.heads().where("log_url like '%odd%'").first().tree_size == 107
    assert scanned(pages.in_ranges([("https://odd/", 99, 102)])) == 2


def test_nothing_landed(spark, tmp_path):
    none = Pages(spark, str(tmp_path / "none"), spark.createDataFrame([], ENTRY).schema)
    assert none.heads().count() == none.entries().count() == none.since(at(0)).count() == none.in_ranges([("a", 0, 9)]).count() == 0
    none.land("empty", spark.createDataFrame([], ENTRY))
    assert none.heads().count() == 0 and none.indexes_by_time(a=at(0)).count() == 0


def drained(heads, resume, entries, size):
    import json

    reader = LogRangeReader({"heads": json.dumps(heads), "resume": json.dumps(resume), "entries": str(entries), "range": str(size)})
    offset, out = reader.initialOffset(), []
    while (end := reader.latestOffset()) != offset:
        out.append([(p.log_url, p.start, p.end) for p in reader.partitions(offset, end)])
        offset = end
    return out, offset


@pytest.mark.parametrize(("entries", "size"), [(1, 10), (2, 1), (7, 3), (50, 20), (10**9, 10**9)])
def test_ranges_are_bounded_and_cover_every_index_once(entries, size):
    heads, resume = {"a": 10, "b": 33, "c": 0, "d": 5}, {"a": 4, "d": 5, "gone": 3}
    batches, offset = drained(heads, resume, entries, size)
    assert offset == {"a": 10, "b": 33, "c": 0, "d": 5}
    for batch in batches:
        assert 0 < sum(end - start for _, start, end in batch) <= entries and all(0 < end - start <= size for _, start, end in batch)
    seen = sorted((log, i) for batch in batches for log, start, end in batch for i in range(start, end))
    assert seen == [("a", i) for i in range(4, 10)] + [("b", i) for i in range(33)]


def test_a_reader_goes_on_from_what_was_planned():
    """A restarted stream runs its unfinished micro-batch first; the next one begins after it."""
    import json

    reader = LogRangeReader({"heads": json.dumps({"a": 30, "new": 2}), "resume": json.dumps({"a": 5}), "entries": "10", "range": "100"})
    assert [(p.start, p.end) for p in reader.partitions({"a": 5}, {"a": 15})] == [(5, 15)]
    assert reader.latestOffset() == {"a": 23, "new": 2}


@pytest.fixture
def current(spark):
    return spark.createDataFrame([("run", 1)], "muid string, stage_id bigint")


def in_run(rows):
    return rows.withColumn("muid", F.lit("run"))


def test_tail_resumes_at_the_stored_index(spark, tmp_path, pages, current):
    store, check = Store(spark, str(tmp_path / "store")), str(tmp_path / "check")
    rules = suffix_rules(spark)
    tail_logs(store, pages, check, current, rules, in_run, entries=120, size=25)
    assert store.read("log_entries").count() == len(ROWS)
    batches = store._marks("commits").count()
    assert batches == 3  # 299 indexes
    tail_logs(store, pages, check, current, rules, in_run, entries=120)  # nothing new
    assert store._marks("commits").count() == batches
    pages.land("two", spark.createDataFrame([entry("https://odd/", 100 + i, 200 + i) for i in range(30)] + [entry("third/", i, i) for i in range(3)], ENTRY))
    tail_logs(store, pages, check, current, rules, in_run, entries=20)
    assert store._marks("commits").count() == batches + 2
    logs = store.read("logs").withColumnRenamed("id", "log_id")
    stored = store.read("log_entries").join(logs, "log_id")
    assert {(r.url, r.n) for r in stored.groupBy("url").agg(F.countDistinct("index").alias("n")).collect()} == {("https://odd/", 130), ("even/", 67), ("third/", 3)}
    assert stored.count() == 200


def test_an_unfinished_micro_batch_runs_again(spark, tmp_path, pages, current):
    store, check, rules = Store(spark, str(tmp_path / "store")), str(tmp_path / "check"), suffix_rules(spark)
    calls = []

    def fails_once(rows):
        calls.append(1)
        if len(calls) == 2:
            raise ValueError("lost")
        return in_run(rows)

    with pytest.raises(Exception, match="lost"):
        tail_logs(store, pages, check, current, rules, fails_once, entries=120)
    assert 0 < store.read("log_entries").count() < len(ROWS)
    tail_logs(store, pages, check, current, rules, fails_once, entries=120)
    stored = store.read("log_entries")
    assert stored.count() == len(ROWS) == stored.select("log_id", "index").distinct().count()


SNAPSHOT = "tld string, snapshot_date date, domain string"
DAYS = [date(2024, 1, d) for d in (1, 2, 3, 5)]
HELD = {"com": ["ab", "abc", "bd", "ad"], "net": ["x", "xy", "y", "xz"]}


def snapshot(tld, i):
    return [(tld, DAYS[i], f"{n}.{tld}") for n in HELD[tld][i]]


def arrive(spark, store, batches):
    step = jobs.zone_diff_step(store.path)
    for number, rows in enumerate(batches):
        step(spark.createDataFrame(rows, SNAPSHOT), f"b{number}")
    return sorted(tuple(r) for r in jobs.zone_events(store).collect())


def batch_events(spark, rows):
    return sorted(tuple(r) for r in zone_diff_events(spark.createDataFrame(rows, SNAPSHOT)).collect())


def test_snapshots_in_any_order(spark, tmp_path):
    """A zone for each order of four snapshots: every order gives what the batch differ gives."""
    store = Store(spark, str(tmp_path / "store"))
    orders = list(itertools.permutations(range(4)))
    arrivals = [
        [(f"{held}{''.join(map(str, order))}", DAYS[order[k]], f"{n}.x") for held in HELD for order in orders for n in HELD[held][order[k]]]
        for k in range(4)
    ]
    found = arrive(spark, store, arrivals)
    assert found == batch_events(spark, [r for rows in arrivals for r in rows])
    assert {e[0] for e in found} == {f"{held}{''.join(map(str, o))}" for held in HELD for o in orders}


def test_late_events_are_retracted(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    arrive(spark, store, [snapshot("com", 0), snapshot("com", 2), snapshot("com", 1)])
    changed = store.read("zone_events").where("n < 0")
    # c has come and gone in between; that a is gone on the third and d there holds as before
    assert changed.count() == 0
    jobs.zone_diff_step(store.path)(spark.createDataFrame([("com", date(2023, 12, 31), "b.com")], SNAPSHOT), "earlier")
    changed = store.read("zone_events").where("n < 0")
    assert {(r.domain, r.event_type, r.snapshot_date.day) for r in changed.collect()} == {("a.com", "FIRST_SEEN", 1), ("b.com", "FIRST_SEEN", 1)}
    assert ("com", "a.com", "REGISTRATION", DAYS[0]) in {tuple(r) for r in jobs.zone_events(store).collect()}


def test_a_snapshot_that_comes_again_replaces(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    other = [("com", DAYS[1], "q.com"), ("com", DAYS[1], "a.com"), ("com", DAYS[1], "a.com")]
    found = arrive(spark, store, [snapshot("com", 0), snapshot("com", 1), snapshot("com", 2), snapshot("com", 1), other])
    assert found == batch_events(spark, snapshot("com", 0) + other + snapshot("com", 2))
