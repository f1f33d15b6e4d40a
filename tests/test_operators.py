import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from nameharbor.operators import bitmaps, ct, facts, metrics, runs, selections, snapshots
from nameharbor.operators import dimensions as dim
from nameharbor.operators.positions import running_count, with_positions
from nameharbor.plans import vantage


def snaps(spark, *pairs):
    return spark.createDataFrame(list(pairs), "tld string, day string, domain string").select(
        "tld", F.to_date("day").alias("snapshot_date"), "domain"
    )


def plain(events):
    return sorted((r.tld, r.domain, r.event_type, str(r.snapshot_date)) for r in events.collect())


def diff_by_hand(pairs, calendar):
    held = {}
    for tld, day, domain in pairs:
        held.setdefault((tld, day), set()).add(domain)
    out = []
    for tld in {t for t, _ in calendar}:
        before = None
        for day in sorted(d for t, d in calendar if t == tld):
            now = held.get((tld, day), set())
            if before is None:
                out += [(tld, d, "FIRST_SEEN", day) for d in now]
            else:
                out += [(tld, d, "REGISTRATION", day) for d in now - before]
                out += [(tld, d, "EXPIRATION", day) for d in before - now]
            before = now
    return sorted(out)


def test_differ_against_set_differences(spark):
    rng = random.Random(3)
    days = [f"2024-01-{d:02d}" for d in (1, 2, 4, 9, 10, 11, 20)]
    pairs = [(t, d, f"n{n}.{t}") for t in ("com", "net") for d in days for n in range(30) if rng.random() < 0.5]
    pairs += pairs[:50]  # copies within a snapshot
    calendar = {(t, d) for t, d, _ in pairs}
    found = snapshots.zone_diff_events(snaps(spark, *pairs))
    assert plain(found) == diff_by_hand(pairs, calendar)


def test_differ_sees_an_empty_snapshot(spark):
    pairs = [("com", "2024-01-01", "a.com"), ("com", "2024-01-03", "a.com")]
    files = snaps(spark, *[("com", f"2024-01-0{d}", None) for d in (1, 2, 3, 4)])
    calendar = {("com", f"2024-01-0{d}") for d in (1, 2, 3, 4)}
    found = plain(snapshots.zone_diff_events(snaps(spark, *pairs), files))
    assert found == diff_by_hand(pairs, calendar)
    assert [e[2] for e in found] == ["EXPIRATION", "EXPIRATION", "FIRST_SEEN", "REGISTRATION"]


def test_three_rounds_of_a_zone(spark, rows):
    rounds = [
        ["first.org", "second.co.uk", "third.net", "fourth.net"], ["first.org", "third.net", "fourth.net"],
        ["first.org", "second.co.uk", "fourth.net"],
    ]
    pairs = [("test", f"2024-01-0{i}", d) for i, names in enumerate(rounds, 1) for d in names]
    events = snapshots.zone_diff_events(snaps(spark, *pairs))
    changes = [e[1:] for e in plain(events.where("event_type <> 'FIRST_SEEN'"))]
    assert changes == [
        ("second.co.uk", "EXPIRATION", "2024-01-02"), ("second.co.uk", "REGISTRATION", "2024-01-03"),
        ("third.net", "EXPIRATION", "2024-01-03"),
    ]
    lives = snapshots.lifetimes(events)
    assert rows(lives.where("domain = 'second.co.uk'"), F.col("start_date").cast("string"), F.col("end_date").cast("string"), "known_start") == [
        ("2024-01-01", "2024-01-02", False), ("2024-01-03", None, True)]


def test_events_rebuild_the_last_snapshot(spark, rows):
    """Invariant: first snapshot plus registrations minus expirations is the last snapshot."""
    rng = random.Random(5)
    pairs = [("com", f"2024-01-{d:02d}", f"n{n}.com") for d in range(1, 12) for n in range(40) if rng.random() < 0.6]
    lives = snapshots.lifetimes(snapshots.zone_diff_events(snaps(spark, *pairs)))
    last = sorted({(d,) for _, day, d in pairs if day == "2024-01-11"}, key=repr)
    assert rows(lives.where("end_date is null"), "domain") == last


def test_differ_moves_rows_once(spark):
    events = snapshots.zone_diff_events(snaps(spark, ("com", "2024-01-01", "a.com")))
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_collect_set" in plan  # copies merge before the shuffle


def test_compare_sets(spark, rows):
    a, b = (spark.createDataFrame([(v,) for v in vs], "v int") for vs in ([1, 2, 2, 1], [1, 3]))
    assert rows(snapshots.compare_sets(a, b, "v")) == [(2, "only_a"), (3, "only_b")]


def test_snapshot_counts(spark, rows):
    frame = snaps(spark, ("com", "2024-01-01", "a"), ("com", "2024-01-01", "a"), ("com", "2024-01-01", "b"), ("com", "2024-01-02", "a"))
    assert rows(snapshots.snapshot_counts(frame)) == [("com", 2, 3, 2)]


def test_event_columns(spark, rows):
    frame = spark.createDataFrame([("FIRST_SEEN",), ("REGISTRATION",), ("EXPIRATION",)], "event_type string")
    out = frame.select("event_type", *[c.isNotNull().alias(n) for n, c in snapshots.event_columns(F.col("event_type"), F.current_timestamp()).items()])
    assert rows(out) == [("EXPIRATION", False, True), ("FIRST_SEEN", False, False), ("REGISTRATION", True, False)]


def test_adaptive_execution_picks_the_join_by_size(spark):
    entries = spark.range(1000).selectExpr("concat('log', id % 3) AS log_url", "id AS index")
    ranges = spark.range(3).selectExpr("concat('log', id) AS log_url", "id * 2 AS start_index", "10L AS end_index")
    found = ct.entries_in_ranges(entries, ranges)
    assert found.count() == sum(1 for i in range(10) if i >= (i % 3) * 2)
    found.collect()
    assert "BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()


def test_hot_name_is_split_when_it_meets_its_dimension(spark):
    """Two thirds of all sightings are of one name: its partition is read by several tasks."""
    sightings = spark.range(60_000).select(
        F.when(F.col("id") % 3 < 2, "hot.com").otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("fqdn"),
        F.timestamp_seconds("id").alias("ts"), F.lit(1).alias("stage_id"), "id",
    )
    fqdns = dim.with_ids(sightings.select("fqdn").distinct(), "fqdn")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    keep = {key: spark.conf.get(key, None) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        found = facts.passive_facts(sightings, fqdns)
        hot = found.groupBy("fqdn_id").count().agg(F.max("count")).first()[0]
        shown = facts.passive_facts(sightings, fqdns)
        shown.collect()
        plan = shown._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in keep.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert hot == 40_000
    assert "skew=true" in plan


# --- numbering ---


def test_positions(spark, rows):
    frame = spark.range(2000).select(F.sha1(F.col("id").cast("string")).alias("name"))
    names = sorted(r.name for r in frame.collect())
    assert rows(with_positions(frame, ["name"])) == [(n, i) for i, n in sorted(enumerate(names), key=lambda p: repr((p[1], p[0])))]


def test_running_count_of_a_hot_key(spark):
    """One key holds most rows: it fills several range partitions and is still counted through."""
    frame = spark.range(5000).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("key"),
        F.hash("id").alias("t"), "id", (F.col("id") % 3 == 0).alias("flag"),
    )
    for flag in (None, F.col("flag")):
        found = running_count(frame, "key", ["t", "id"], "n", flag).collect()
        groups = {}
        for row in found:
            groups.setdefault(row.key, []).append(row)
        assert sum(map(len, groups.values())) == 5000
        for members in groups.values():
            seen = 0
            for row in sorted(members, key=lambda r: (r.t, r.id)):
                seen += row.flag if flag is not None else 1
                assert row.n == seen
    # no partition of the laid-out rows holds the hot key alone
    laid = running_count(frame, "key", ["t", "id"], "n")
    parts = {r.p for r in laid.where("key = 'hot'").select(F.spark_partition_id().alias("p")).collect()}
    assert len(parts) > 1


def test_null_keys_are_counted(spark, rows):
    frame = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "key string, t int")
    assert rows(running_count(frame, "key", ["t"], "n"), "key", "t", "n") == [("a", 3, 1), (None, 1, 1), (None, 2, 2)]


def test_ids_are_dense_and_repeatable(spark):
    frame = spark.range(3000).select(F.col("id").cast("string").alias("name"))
    first = {r.name: r.id for r in dim.with_ids(frame, "name", first=11).collect()}
    assert sorted(first.values()) == list(range(11, 3011))
    again = {r.name: r.id for r in dim.with_ids(frame.repartition(7), "name", first=11).collect()}
    assert first == again


def test_next_id(spark):
    empty = spark.createDataFrame([], "id bigint")
    assert dim.next_id(empty).first().next_id == 1
    assert dim.next_id(spark.createDataFrame([(4,), (10,)], "id bigint")).first().next_id == 11


def test_batch_names(spark, rows):
    frame = spark.createDataFrame(
        [("uk", "co.uk", "a.co.uk", False), ("uk", "co.uk", "b.co.uk", True), ("uk", "co.uk", "a.co.uk", True)],
        "tld string, public_suffix string, apex string, anonymous boolean",
    )
    assert rows(dim.batch_names(frame, "apex")) == [("a.co.uk", "uk", "co.uk", True, True), ("b.co.uk", "uk", "co.uk", False, True)]
    assert rows(dim.batch_names(frame, "tld")) == [("uk", True, True)]


# --- CT, lists, runs, metrics ---


def test_ranges(spark, rows):
    heads = spark.createDataFrame([("a", 10), ("b", 10), ("c", 5), ("new", 3)], "log_url string, tree_size bigint")
    resume = spark.createDataFrame([("a", 4), ("b", 0), ("c", 5)], "log_url string, resume_index bigint")
    assert rows(ct.index_ranges(resume, heads)) == [("a", 4, 10), ("b", 0, 10), ("new", 0, 3)]
    window = spark.createDataFrame([("a", 2, 7), ("b", 3, 99), ("c", 0, 5), ("new", 3, 3)], "log_url string, from_index bigint, to_index bigint")
    assert rows(ct.index_ranges(resume, heads, window)) == [("a", 4, 7), ("b", 3, 10)]


def test_resume_of_an_unknown_log_is_zero(spark, rows):
    stored = spark.createDataFrame([("a", 3), ("a", 9), ("a", 5)], "log_url string, index bigint")
    logs = spark.createDataFrame([("a",), ("b",)], "log_url string")
    assert rows(ct.resume_indexes(stored, logs)) == [("a", 10), ("b", 0)]


def test_tld_selection(spark, rows):
    one = lambda *v: spark.createDataFrame([(x,) for x in v], "tld string")
    assert rows(selections.select_tlds(one("com", "net", "net"), one("org", "com"), one("net", "x"))) == [("com",), ("org",)]


def test_runs(spark, rows):
    at = datetime(2024, 1, 1)
    steps = [(runs.START, "one"), (runs.START, "two"), (runs.STAGE_STOP, "one"), (runs.STAGE_START, "one"), (runs.STOP, "two")]
    log = None
    for i, (event, muid) in enumerate(steps):
        row = runs.run_event(spark, event, muid, "text" if event == runs.START else None, "host", at + timedelta(minutes=i))
        log = row if log is None else log.unionByName(row)
    assert rows(runs.measurements(log), "muid", "description", F.col("end_time").isNotNull()) == [("one", "text", False), ("two", "text", True)]
    assert rows(runs.stages(log), "muid", "stage", F.col("stop_time").isNotNull()) == [("one", 1, True), ("one", 2, False), ("two", 1, True)]
    assert rows(runs.current_stages(runs.stages(log))) == [("one", 2), ("two", 1)]
    made = runs.run_event(spark, runs.START).first().muid
    assert len(made) == 32 and "-" not in made


def test_rows_without_a_run_are_turned_away(spark, rows):
    current = spark.createDataFrame([("one", 5)], "muid string, stage_id bigint")
    frame = spark.createDataFrame([("one", "a"), ("gone", "b"), ("", "c"), (None, "d")], "muid string, name string")
    good, bad = runs.with_stage(frame, current, "zone", "name")
    assert rows(good) == [("a", 5)]
    assert rows(bad, "payload", "reason") == [("b", "no active stage"), ("c", "missing run id"), ("d", "missing run id")]


def test_metrics(spark, rows):
    frame = spark.createDataFrame([("2024-01-01 00:10:00", "com"), ("2024-01-01 00:50:00", "com"), ("2024-01-01 01:00:00", "com")], "ts string, tld string").withColumn("ts", F.to_timestamp("ts"))
    counted = metrics.interval_counts(frame, "ts", "tld")
    assert rows(counted, F.hour("interval_start"), "n") == [(0, 2), (1, 1)]
    hits = spark.createDataFrame([("2024-01-01 00:10:00", "db-insert", "tld", 3), ("2024-01-01 00:20:00", "db-insert", "tld", 4)], "ts string, status string, type string, n bigint").withColumn("ts", F.to_timestamp("ts"))
    assert rows(metrics.store_hits(hits, "ts"), "status", "type", "n") == [("db-insert", "tld", 7)]
    assert rows(metrics.table_counts({"a": frame, "b": frame.where("false")})) == [("a", 3), ("b", 0)]


def test_certificates_with_copies(spark, rows):
    entries = facts.fingerprinted(spark.createDataFrame(
        [(b"x", 1, ["www.a.com", "www.b.org"]), (b"x", 2, ["www.a.com", "www.b.org"]), (b"y", 3, ["www.b.org", "www.b.org"])],
        "raw binary, index bigint, dns_names array<string>",
    ))
    assert facts.distinct_certificates(entries).count() == 2
    names = facts.certificate_names(entries).withColumnRenamed("dns_name", "fqdn")
    certs = dim.with_ids(entries.select("sha256_fingerprint").distinct(), "sha256_fingerprint")
    fqdns = dim.with_ids(names.select("fqdn").distinct(), "fqdn")
    assert facts.bridge(names, certs, fqdns).count() == 3


def test_vantage_points(spark, rows):
    frame = spark.createDataFrame(
        [("zone", "a.com", 5), ("ct", "a.com", 2), ("ct", "a.com", 9), ("passive", "b.com", 1), ("zone", "c.com", 3), ("ct", "c.com", 3)],
        "source string, apex string, s bigint",
    ).withColumn("ts", F.timestamp_seconds("s"))
    assert rows(vantage.overlap(frame)) == [("ct+zone", 2), ("passive", 1)]
    assert rows(vantage.first_seen(frame), "apex", "leading_source", "lead_ms") == [("a.com", "ct", 3000), ("b.com", "passive", None), ("c.com", "ct", 0)]


def test_distinct_ids_by_batch(spark, rows):
    """Bitmaps of three batches, with copies, nulls and ids far apart, against the full count."""
    batches = [[1, 2, 2, 32768, None], [2, 32769, 70_000], [5, 10**12, 1, None]]
    frames = [spark.createDataFrame([(i,) for i in batch], "id bigint") for batch in batches]
    held = [bitmaps.id_bitmaps(frame, "id") for frame in frames]
    for n in (1, 2, 3):
        union = held[0]
        for more in held[1:n]:
            union = union.unionByName(more)
        assert rows(bitmaps.distinct_ids(union, "n")) == [(len({i for batch in batches[:n] for i in batch} - {None}),)]
    assert rows(bitmaps.distinct_ids(bitmaps.id_bitmaps(frames[0].where("false"), "id"), "n")) == [(0,)]
