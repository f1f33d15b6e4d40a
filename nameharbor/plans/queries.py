"""Registered queries: every operator over the given tables.

Times leave as Unix milliseconds and dates as text, so that any engine's
answer can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, times
from ..functions.pseudonyms import Anonymizer, with_pseudonyms
from ..functions.suffixes import SuffixRules, suffix_rules, with_domain_parts
from ..operators import bitmaps, ct, facts, metrics, runs, selections, snapshots
from ..operators import dimensions as dim
from ..schemas import LEVEL_TABLE, LEVELS
from ..session import fresh_path, prepare, written
from ..sources import passive, warehouse, zones
from ..sources.pages import Pages
from ..streaming import jobs
from ..streaming.tail import tail_logs
from . import vantage
from .folders import store_round
from .ingest import Batch, accept, ingest
from .runs import record_events, stored_stages
from .store import Store
from .views import Tables, certificate_entries, observations, pick
from .views import snapshots as snapshot_rows

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}

SALTS = Anonymizer.sha256("1", "2", "3", "4")
#: names sighted before this day play the stored tables, later ones the batch
CUT = "2024-01-15"


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(function):
        return lambda spark, folder: function(Tables(prepare(spark), folder))

    return {name: bound(function) for name, function in QUERIES.items()}


def ms(ts: Column | str) -> Column:
    return F.unix_millis(F.col(ts) if isinstance(ts, str) else ts)


def day(date: Column | str) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def instant(text: str) -> Column:
    return F.to_timestamp(F.lit(text), "yyyy-MM-dd")


def date(text: str) -> Column:
    return F.to_date(F.lit(text), "yyyy-MM-dd")


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def or_zero(column: str) -> Column:
    return F.coalesce(column, F.lit(0)).alias(column)


# --- names ---


def spelled(t: Tables) -> DataFrame:
    """Names of both views as sources may spell them: ``origin, id, name``."""
    f = F.col("fqdn")
    name = pick(
        F.col("event_id"), F.concat(f, F.lit(".")), F.concat(F.lit("."), F.upper(f)), F.concat(f, F.lit("\t")),
        F.concat(F.lit(".."), f, F.lit("..")), F.concat(F.upper(f), F.lit("\n")), f,
    )
    obs = t.obs().select(F.lit("events").alias("origin"), F.col("event_id").alias("id"), name.alias("name"))
    hosts = t.host().select(
        F.lit("pages").alias("origin"), F.col("page_id").alias("id"),
        F.concat(F.upper("host"), F.lit(".")).alias("name"),
    )
    return obs.unionByName(hosts)


@query
def normalize_fqdn(t: Tables) -> DataFrame:
    return spelled(t).select("origin", "id", names.normalize_name(F.col("name")).alias("fqdn"))


@query
def domain_parts(t: Tables) -> DataFrame:
    return with_domain_parts(spelled(t), "name", suffix_rules(t.spark)).select("origin", "id", *LEVELS)


def with_addresses(obs: DataFrame) -> DataFrame:
    """Sightings with ``name``: by name, by IPv4 (some octets too large) and by IPv6 address."""
    user = F.col("user_id")
    v4 = F.format_string("10.%d.%d.1", F.pmod(user, F.lit(300)), F.pmod("event_id", F.lit(256)))
    v6 = F.format_string("2001:db8::%d", F.pmod(user, F.lit(10000)))
    return obs.withColumn("name", pick(F.col("event_id"), F.col("fqdn"), v4, v6, F.concat(F.lit("1.2.3."), "fqdn")))


@query
def ip_reject(t: Tables) -> DataFrame:
    return with_addresses(t.obs()).select("event_id", "name", names.is_ip(F.col("name")).alias("is_ip"))


@query
def url_regex_extract(t: Tables) -> DataFrame:
    tld = names.tld_of(F.col("host"))
    link = pick(F.col("page_id"), F.concat(F.lit("https://zones.example/czds/downloads/"), tld, F.lit(".zone")), F.col("url"))
    found = names.zone_of_download_url(link)
    return t.host().select("page_id", F.coalesce(found, F.lit("none")).alias("tld"))


@query
def anonymize_levels(t: Tables) -> DataFrame:
    return with_pseudonyms(t.obs(), SALTS).select("event_id", *[f"{level}_anon" for level in LEVELS])


@query
def anonymize_identity(t: Tables) -> DataFrame:
    return with_pseudonyms(t.obs(), Anonymizer()).select("event_id", *[f"{level}_anon" for level in LEVELS])


# --- times ---


@query
def unix_ms_to_ts(t: Tables) -> DataFrame:
    given = t.events().select("event_id", times.to_unix_ms(F.col("ts")).alias("given_ms"))
    return given.select(
        "event_id", F.date_format(times.from_unix_ms(F.col("given_ms")), "yyyy-MM-dd HH:mm:ss.SSS").alias("ts")
    )


@query
def ts_to_unix_ms(t: Tables) -> DataFrame:
    return t.events().select("event_id", times.to_unix_ms(F.col("ts")).alias("unix_ms"))


@query
def passive_shift(t: Tables) -> DataFrame:
    return t.obs().select("event_id", ms(times.shifted(F.col("ts"))).alias("shifted_ms"))


# --- sources ---


def log_lines(obs: DataFrame) -> DataFrame:
    """Passive log lines: one query, a list of two, no query, or no JSON at all."""
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")

    def line(queries: str) -> Column:
        return F.format_string('{"preview":false,"result":{"timestamp":"%s"' + queries + "}}", stamp, "fqdn", "apex")

    one, many = line(',"query{}":"%2$s","query_type{}":"A"'), line(',"query{}":["%2$s","%3$s"],"query_type{}":["A","AAAA"]')
    return obs.select("event_id", names.once(pick(F.col("event_id"), one, many, line(""), one, many, F.lit('{"result":{'))).alias("value"))


@query
def passive_scan(t: Tables) -> DataFrame:
    return passive.parse_log_lines(log_lines(t.obs())).select("event_id", "query", ms("ts").alias("ts_ms"))


def zone_lines(t: Tables) -> DataFrame:
    """Resource records of the zones, with types the reader wants and some it does not."""
    owner = F.when(F.pmod("event_id", F.lit(50)) == 0, F.col("tld")).otherwise(F.col("domain"))
    kind = pick(F.col("user_id"), F.lit("NS"), F.lit("A"), F.lit("AAAA"), F.lit("TXT"))
    value = F.format_string("%s.   3600  in  %s  dns.%s.", F.upper(owner), F.lower(kind), "tld")
    return t.snap("event_id", "user_id").select("tld", "snapshot_date", names.once(value).alias("value"))


@query
def zone_rr_domains(t: Tables) -> DataFrame:
    records, _ = zones.split_rejects(zones.absolute_records(zone_lines(t)))
    return zones.zone_domains(records).select("tld", day("snapshot_date").alias("snapshot_date"), "domain")


# --- snapshots ---


def by_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("snapshot_date", day("snapshot_date"))


@query
def snapshot_date_filter(t: Tables) -> DataFrame:
    return by_day(t.snap().where(F.col("snapshot_date").between(date("2024-01-10"), date("2024-01-15"))).distinct())


@query
def snapshot_distinct(t: Tables) -> DataFrame:
    return by_day(t.snap().distinct())


@query
def snapshot_counts(t: Tables) -> DataFrame:
    return snapshots.snapshot_counts(t.snap())


@query
def zone_diff_events(t: Tables) -> DataFrame:
    return by_day(snapshots.zone_diff_events(t.snap()))


@query
def zone_diff_counts(t: Tables) -> DataFrame:
    return by_day(snapshots.event_counts(snapshots.zone_diff_events(t.snap())))


@query
def snapshot_compare(t: Tables) -> DataFrame:
    sides = [t.snap().where(F.col("snapshot_date") == date(d)) for d in ("2024-01-10", "2024-01-20")]
    return snapshots.compare_sets(*sides, key="domain")


def zone_sightings(t: Tables) -> DataFrame:
    """Differ events as sightings: ``tld, domain, event_type, ts``."""
    events = snapshots.zone_diff_events(t.snap())
    return events.select("tld", "domain", "event_type", F.col("snapshot_date").cast("timestamp").alias("ts"))


@query
def zone_event_columns(t: Tables) -> DataFrame:
    columns = snapshots.event_columns(F.col("event_type"), F.col("ts"))
    return zone_sightings(t).select(
        "tld", "domain", "event_type", *[F.coalesce(day(c), F.lit("none")).alias(n) for n, c in columns.items()]
    )


@query
def zone_fact(t: Tables) -> DataFrame:
    # diffed and split once, for the names and for the facts
    split = written(with_domain_parts(zone_sightings(t), "domain", suffix_rules(t.spark)), "zone-events")
    apexes = dim.with_ids(split.select("apex").distinct(), "apex")
    rows = facts.zone_facts(split.withColumn("stage_id", F.lit(1)), apexes)
    return rows.select(
        "apex_id", *[F.coalesce(day(c), F.lit("none")).alias(c) for c in ("registered", "expired")]
    )


@query
def domain_lifetime(t: Tables) -> DataFrame:
    lives = snapshots.lifetimes(snapshots.zone_diff_events(t.snap()))
    return lives.select(
        "tld", "domain", day("start_date").alias("start_date"),
        F.coalesce(day("end_date"), F.lit("none")).alias("end_date"), "known_start",
    )


@query
def tld_selection(t: Tables) -> DataFrame:
    available, included = t.snap().select("tld"), t.obs().select("tld")
    excluded = t.host().select(names.tld_of(F.col("host")).alias("tld")).where("tld = 'net'")
    return selections.select_tlds(available, included, excluded)


@query
def resume_anti(t: Tables) -> DataFrame:
    finished = t.host().select(names.tld_of(F.col("host")).alias("tld")).where("tld <> 'com'")
    return selections.without_finished(by_day(t.snap()).distinct(), finished)


# --- dimensions ---


def level_batch(t: Tables, level: str) -> DataFrame:
    rows = t.obs().withColumn("anonymous", F.col("event_type") == "error")
    return dim.batch_names(rows, level).select(level, "create_plain", "create_anon")


@query
def batch_distinct_fqdn(t: Tables) -> DataFrame:
    return level_batch(t, "fqdn")


@query
def batch_distinct_apex(t: Tables) -> DataFrame:
    return level_batch(t, "apex")


@query
def batch_distinct_suffix(t: Tables) -> DataFrame:
    return level_batch(t, "public_suffix")


@query
def batch_distinct_tld(t: Tables) -> DataFrame:
    return level_batch(t, "tld")


def stored_and_batch(t: Tables, name: str, pseudonyms: bool = False) -> tuple[DataFrame, DataFrame]:
    """Dimension of the names before the cut, and the distinct names after it."""
    obs = with_pseudonyms(t.obs(), SALTS) if pseudonyms else t.obs()
    early = F.col("ts") < instant(CUT)
    stored = dim.with_ids(obs.where(early).select(name).distinct(), name)
    return stored, obs.where(~early).select(name).distinct()


def looked_up(t: Tables, name: str, pseudonyms: bool = False) -> DataFrame:
    stored, batch = stored_and_batch(t, name, pseudonyms)
    return dim.lookup(batch, stored, name, "found_id").select(name, or_zero("found_id"))


@query
def dim_lookup_fqdn(t: Tables) -> DataFrame:
    return looked_up(t, "fqdn")


@query
def dim_lookup_apex(t: Tables) -> DataFrame:
    return looked_up(t, "apex")


@query
def dim_lookup_suffix(t: Tables) -> DataFrame:
    return looked_up(t, "public_suffix")


@query
def dim_lookup_tld(t: Tables) -> DataFrame:
    return looked_up(t, "tld")


@query
def dim_lookup_anon(t: Tables) -> DataFrame:
    return looked_up(t, "fqdn_anon", pseudonyms=True)


def added(t: Tables, name: str, pseudonyms: bool = False) -> DataFrame:
    stored, batch = stored_and_batch(t, name, pseudonyms)
    first = dim.next_id(stored).first().next_id  # one number
    return dim.with_ids(dim.new_rows(batch, stored, name), name, first)


@query
def dim_new_rows(t: Tables) -> DataFrame:
    return added(t, "fqdn")


@query
def dim_new_rows_anon(t: Tables) -> DataFrame:
    return added(t, "fqdn_anon", pseudonyms=True)


def hierarchy(rows: DataFrame) -> dict[str, DataFrame]:
    """Every level with ids and the ids of its parents."""
    tables: dict[str, DataFrame] = {}
    for level in LEVELS:
        parents = LEVELS[: LEVELS.index(level)]
        distinct = rows.groupBy(level).agg(*[F.min(p).alias(p) for p in parents]) if parents else rows.select(level).distinct()
        tables[level] = dim.with_parent_ids(dim.with_ids(distinct, level), level, tables)
    return tables


def distinct_names(t: Tables) -> DataFrame:
    """Distinct names of the sightings, far fewer than these; every level reads them."""
    return written(t.obs().select(*LEVELS).distinct(), "names")


@query
def dim_hierarchy(t: Tables) -> DataFrame:
    return hierarchy(distinct_names(t))["fqdn"].select("id", "fqdn", "tld_id", "public_suffix_id", "apex_id")


@query
def next_ids(t: Tables) -> DataFrame:
    named = distinct_names(t)
    return union([
        dim.next_id(dim.with_ids(named.select(level).distinct(), level)).select(
            F.lit(LEVEL_TABLE[level]).alias("table_name"), "next_id"
        )
        for level in LEVELS
    ])


@query
def dim_first_n(t: Tables) -> DataFrame:
    fqdns = dim.with_ids(t.obs().select("fqdn").distinct(), "fqdn")
    return fqdns.orderBy("id").limit(100).select("id", "fqdn")


@query
def anon_links(t: Tables) -> DataFrame:
    hidden = F.pmod("event_id", F.lit(4)) == 0
    obs = t.obs()
    plain = dim.with_ids(obs.where(~hidden).select("fqdn").distinct(), "fqdn")
    pseudonyms = obs.where(hidden).select(SALTS.of("fqdn", F.col("fqdn")).alias("fqdn")).distinct()
    linked = dim.plain_links(pseudonyms, plain, "fqdn", SALTS.of("fqdn", F.col("fqdn")))
    return linked.select("fqdn", or_zero("plain_fqdn_id"))


# --- facts ---


@query
def passive_fact(t: Tables) -> DataFrame:
    obs = t.obs()
    fqdns = dim.with_ids(obs.select("fqdn").distinct(), "fqdn")
    rows = facts.passive_facts(obs.withColumn("stage_id", F.lit(1)), fqdns)
    return rows.select("fqdn_id", ms("timestamp").alias("ts_ms"))


def queries_of(obs: DataFrame) -> DataFrame:
    """Sightings as the rows of a query warehouse: ``qname, unixtime``."""
    return obs.select(F.col("fqdn").alias("qname"), F.unix_seconds("ts").alias("unixtime"))


def warehouse_rows(t: Tables) -> DataFrame:
    return warehouse.first_last(queries_of(t.obs()))


@query
def qname_first_last(t: Tables) -> DataFrame:
    return warehouse_rows(t)


@query
def entrada_window(t: Tables) -> DataFrame:
    return warehouse.first_last(warehouse.in_window(queries_of(t.obs()), "2024-01-10", "2024-01-20"))


@query
def entrada_page(t: Tables) -> DataFrame:
    laid = warehouse.NamePages(warehouse_rows(t), fresh_path(t.spark, "name-pages"), size=500)
    return laid.page(limit=500, offset=200)


@query
def entrada_fact(t: Tables) -> DataFrame:
    rows = warehouse.as_sightings(warehouse_rows(t)).withColumn("fqdn_anon", SALTS.of("fqdn", F.col("qname")))
    pseudonyms = dim.with_ids(rows.select(F.col("fqdn_anon").alias("fqdn")).distinct(), "fqdn")
    fact = facts.warehouse_facts(rows.withColumn("stage_id", F.lit(1)), pseudonyms)
    return fact.select("fqdn_id", ms("first_seen").alias("first_ms"), ms("last_seen").alias("last_ms"))


@query
def entrada_offset(t: Tables) -> DataFrame:
    """Different names over two batches, from the bitmaps of each."""
    fqdns = written(dim.with_ids(t.obs().select("fqdn").distinct(), "fqdn"), "fqdn-ids")
    batches = [facts.passive_facts(half.withColumn("stage_id", F.lit(1)), fqdns) for half in halves(t)]
    return bitmaps.distinct_ids(union([bitmaps.id_bitmaps(rows, "fqdn_id") for rows in batches]), "resume_offset")


# --- certificates and logs ---


def fingerprints(t: Tables) -> DataFrame:
    return facts.fingerprinted(t.cert())


@query
def cert_dedup(t: Tables) -> DataFrame:
    kept = facts.distinct_certificates(fingerprints(t))
    return kept.select("sha256_fingerprint", F.octet_length("raw").cast("bigint").alias("n_bytes"))


@query
def cert_names(t: Tables) -> DataFrame:
    return facts.certificate_names(t.cert().select("index", "dns_names"))


def certificate_ids(rows: DataFrame) -> DataFrame:
    return dim.with_ids(rows.select("sha256_fingerprint").distinct(), "sha256_fingerprint")


@query
def cert_to_fqdn(t: Tables) -> DataFrame:
    rows = written(fingerprints(t).select("sha256_fingerprint", "dns_names"), "fingerprints")
    pairs = with_domain_parts(facts.certificate_names(rows), "dns_name", suffix_rules(t.spark))
    fqdns = dim.with_ids(pairs.select("fqdn").distinct(), "fqdn")
    return facts.bridge(pairs, certificate_ids(rows), fqdns)


def log_ids(rows: DataFrame) -> DataFrame:
    urls = rows.groupBy(F.col("log_url").alias("url")).agg(F.min("description").alias("description"))
    return dim.with_ids(urls, "url")


@query
def log_dim(t: Tables) -> DataFrame:
    return log_ids(t.cert()).select("id", "url", "description")


@query
def log_entry_fact(t: Tables) -> DataFrame:
    # fingerprints are computed once; the certificate bytes are read no further
    rows = written(fingerprints(t).drop("raw", "dns_names").withColumn("stage_id", F.lit(1)), "fingerprints")
    fact = facts.log_facts(rows, certificate_ids(rows), log_ids(rows))
    return fact.select("index", ms("timestamp").alias("ts_ms"), "is_precert", "certificate_id", "log_id")


def log_entries(t: Tables) -> DataFrame:
    return t.cert().select("log_url", "index", "ts")


def stored_until() -> Column:
    return F.to_timestamp(F.lit("2024-01-01 03:00:00"))


def is_stored() -> Column:
    return F.col("ts") < stored_until()


def stored_entries(t: Tables) -> DataFrame:
    return log_entries(t).where(is_stored())


@query
def ct_resume_index(t: Tables) -> DataFrame:
    return ct.resume_indexes(stored_entries(t), log_entries(t))


def window_times() -> dict[str, Column]:
    bounds = {"from_index": "2024-01-01 01:00:00", "to_index": "2024-01-01 06:00:00"}
    return {name: F.to_timestamp(F.lit(text)) for name, text in bounds.items()}


def landed_log_entries(t: Tables) -> Pages:
    """The entries of the logs in pages, without the certificates."""
    entries = log_entries(t)
    pages = Pages(t.spark, fresh_path(t.spark, "pages"), entries.schema, size=2_000)
    pages.land("all", entries)
    return pages


@query
def ct_index_by_date(t: Tables) -> DataFrame:
    return landed_log_entries(t).indexes_by_time(**window_times())


@query
def ct_index_range(t: Tables) -> DataFrame:
    """Entries of a window of time that come after the last stored one, out of the pages that can hold them."""
    pages = landed_log_entries(t)
    stored = pages.last_before(stored_until()).withColumn("resume_index", F.col("found") + 1)
    positions = pages.heads().join(stored, "log_url", "left").join(pages.indexes_by_time(**window_times()), "log_url")
    ranges = ct.position_ranges(positions.withColumn("resume_index", F.coalesce("resume_index", F.lit(0))))
    found = [(r.log_url, r.start_index, r.end_index) for r in ranges.collect()]  # one row per log
    return pages.in_ranges(found).select("log_url", "index")


@query
def ct_scan_from_time(t: Tables) -> DataFrame:
    return landed_log_entries(t).since(F.to_timestamp(F.lit("2024-01-01 02:00:00"))).select("log_url", "index")


@query
def log_list_filter(t: Tables) -> DataFrame:
    logs = t.cert().select(F.col("log_url").alias("url")).distinct()
    chosen = ("src1", "src2", "src3")
    both = {"all": selections.filter_logs(logs, True, excluded=chosen), "some": selections.filter_logs(logs, False, included=chosen)}
    return union([rows.select(F.lit(mode).alias("mode"), "url") for mode, rows in both.items()])


# --- runs ---


@query
def stage_numbers(t: Tables) -> DataFrame:
    numbered = runs.numbered_starts(t.runs(), "measurement_id", ["start_time", "seq"])
    return numbered.select("measurement_id", "seq", "stage")


@query
def stage_intervals(t: Tables) -> DataFrame:
    rows = runs.stage_intervals(t.runs(), "measurement_id", "start_time", ["start_time", "seq"])
    return rows.select(
        "measurement_id", "stage", ms("start_time").alias("start_ms"), F.coalesce(ms("stop_time"), F.lit(0)).alias("stop_ms")
    )


@query
def stage_lookup(t: Tables) -> DataFrame:
    """Customers as rows of a run, orders as its stages: rows of a run without a stage are turned away."""
    current = t.runs().groupBy(F.col("measurement_id").alias("muid")).agg(F.count("*").alias("stage_id"))
    rows = t.table("customer").select(F.col("c_custkey").alias("muid"), F.col("c_custkey").alias("customer"))
    staged, turned_away = runs.with_stage(rows, current, "customer", "customer")
    return staged.select(F.col("customer").cast("string").alias("customer"), "stage_id").unionByName(
        turned_away.select(F.col("payload").alias("customer"), F.lit(0).cast("bigint").alias("stage_id"))
    )


# --- ingest ---

RUN = "0123456789abcdef0123456789abcdef"


def current_stage(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(RUN).alias("muid"), F.lit(1).cast("bigint").alias("stage_id"))


def in_run(rows: DataFrame) -> DataFrame:
    return rows.withColumn("muid", F.lit(RUN))


@query
def ingest_rejects(t: Tables) -> DataFrame:
    rows = with_addresses(t.obs()).select(
        F.col("name").alias("query"), "ts",
        pick(F.col("event_id"), *[F.lit(m) for m in (None, "", "unknown", RUN, RUN, RUN, RUN)]).alias("muid"),
    )
    _, rejects = accept(Batch("rejects", passive=rows), current_stage(t.spark), suffix_rules(t.spark))
    return union(rejects).groupBy("source", "reason", "payload").agg(F.count("*").alias("n"))


def all_sources(t: Tables) -> Batch:
    obs = t.obs()
    return Batch(
        "all",
        # names and facts both read it: diff once
        zone=in_run(written(zone_sightings(t).drop("tld"), "zone-events")),
        ct=in_run(t.cert()),
        passive=in_run(obs.select(F.col("fqdn").alias("query"), "ts")),
        entrada=in_run(warehouse.as_sightings(warehouse_rows(t))),
    )


COUNTED = [
    *[name for table in LEVEL_TABLE.values() for name in (table, f"{table}_anon", f"{table}_anon_links")],
    "certificates", "certificate_to_fqdns", "log_entries", "logs",
    "zonefile_entries", "passive_entries", "entrada_entries",
]


@query
def ingest_table_counts(t: Tables) -> DataFrame:
    store = Store(t.spark, fresh_path(t.spark, "store"))
    ingest(store, all_sources(t), current_stage(t.spark), suffix_rules(t.spark), SALTS)
    return metrics.table_counts({name: store.read(name, []) for name in COUNTED})


def halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Observations before and from :data:`CUT`."""
    return t.obs().where(F.col("ts") < instant(CUT)), t.obs().where(F.col("ts") >= instant(CUT))


@query
def ingest_metrics(t: Tables) -> DataFrame:
    """Counts that two batches leave in the store, the second with the warehouse, the zones and the logs as well."""
    store = Store(t.spark, fresh_path(t.spark, "store"))
    zone = written(zone_sightings(t).drop("tld"), "zone-events")  # names, facts and counts read it: diff once
    more = [{}, {"entrada": in_run(warehouse.as_sightings(warehouse_rows(t))), "zone": in_run(zone), "ct": in_run(t.cert())}]
    for number, (half, also) in enumerate(zip(halves(t), more, strict=True)):
        batch = Batch(str(number), passive=in_run(half.select(F.col("fqdn").alias("query"), "ts")), **also)
        ingest(store, batch, current_stage(t.spark), suffix_rules(t.spark), SALTS)
    tags = [F.coalesce(tag, F.lit("-")).alias(tag) for tag in ("status", "type", "key")]
    return store.read("metrics").groupBy("name", *tags).agg(F.sum("n").alias("n"))


@query
def zone_rounds(t: Tables) -> DataFrame:
    """Two rounds of zone collection of one run; which stage holds which domain."""
    store = Store(t.spark, fresh_path(t.spark, "store"))
    at = datetime(2024, 1, 1)
    record_events(store, "run", runs.run_event(t.spark, runs.START, RUN, ts=at))
    for number, half in enumerate(halves(t)):
        hour = at + timedelta(hours=number + 1)
        store_round(store, number, RUN, half.select(F.col("apex").alias("domain")), suffix_rules(t.spark), hour, hour + timedelta(minutes=30))
    stages = stored_stages(store).select(F.col("id").alias("stage_id"), "stage", F.hour("stop_time").alias("stop_hour"))
    names = store.read("apexes").select(F.col("id").alias("apex_id"), "apex")
    return store.read("zonefile_entries").join(stages, "stage_id").join(names, "apex_id").select("stage", "apex", "stop_hour")


# --- metrics ---


def by_interval(rows: DataFrame) -> DataFrame:
    return rows.withColumn("interval_start", ms("interval_start")).withColumnRenamed("interval_start", "interval_ms")


@query
def metrics_store_hits(t: Tables) -> DataFrame:
    return by_interval(metrics.store_hits(metrics.name_hits(t.obs(), "ts"), "ts"))


@query
def metrics_log_entries(t: Tables) -> DataFrame:
    return by_interval(metrics.interval_counts(t.cert(), "ts", "log_url"))


@query
def metrics_zone_entries(t: Tables) -> DataFrame:
    return by_interval(metrics.interval_counts(zone_sightings(t), "ts", "tld", interval="1 day"))


# --- streams ---


#: days at which the events of the streams are cut into what lands one after the other
LANDINGS = ("2024-01-11", "2024-01-21")


def landed_in_parts(rows: DataFrame, ts: str, label: str, latest_first: bool = False) -> tuple[str, int]:
    """Rows as a folder in which the days up to each of :data:`LANDINGS` landed one after the other; files of each part."""
    path = fresh_path(rows.sparkSession, label)
    cuts = [None, *(instant(day) for day in LANDINGS), None]
    parts = list(zip(cuts[:-1], cuts[1:], strict=True))
    files = 1 + rows.count() // 1_000_000
    for start, end in reversed(parts) if latest_first else parts:
        part = rows if start is None else rows.where(F.col(ts) >= start)
        part = part if end is None else part.where(F.col(ts) < end)
        part.repartition(files).write.mode("append").parquet(path)
    return path, files


def event_stream(t: Tables, latest_first: bool = False) -> DataFrame:
    """The events as a stream of three landings, one for each micro-batch."""
    path, files = landed_in_parts(t.events(), "ts", "landed-events", latest_first)
    return jobs.read_landed(t.spark, path, t.events().schema, files)


def drained(t: Tables, store: str, source: str, stream: DataFrame, sightings: Callable[[DataFrame], DataFrame]) -> Store:
    """Drain a stream into a store."""
    rules: SuffixRules = suffix_rules(t.spark)
    step = jobs.ingest_step(store, source, current_stage(t.spark), rules, SALTS, sightings)
    jobs.run(stream, source, fresh_path(t.spark, f"checkpoint-{source}"), step)
    return Store(t.spark, store)


def passive_records(events: DataFrame) -> DataFrame:
    return in_run(observations(events).select(F.col("fqdn").alias("query"), "ts"))


@query
def stream_zone_ingest(t: Tables) -> DataFrame:
    def records(events: DataFrame) -> DataFrame:
        kind = pick(F.col("event_id") + F.col("user_id"), *[F.lit(k) for k in ("FIRST_SEEN", "REGISTRATION", "EXPIRATION")])
        ts = times.from_unix_ms(times.to_unix_ms(F.col("ts")))
        return in_run(observations(events).withColumn("event_type", kind)).select(
            "muid", F.col("fqdn").alias("domain"), "event_type", ts.alias("ts")
        )

    store = drained(t, fresh_path(t.spark, "store"), "zone", event_stream(t), records)
    apexes = store.read("apexes").select(F.col("id").alias("apex_id"), "apex")
    return store.read("zonefile_entries").join(apexes, "apex_id").groupBy("apex").agg(
        F.count("*").alias("n"), F.count("registered").alias("n_registered"), F.count("expired").alias("n_expired"),
        F.coalesce(F.max(ms("expired")), F.lit(0)).alias("last_expired_ms"),
    )


@query
def stream_passive_ingest(t: Tables) -> DataFrame:
    store = drained(t, fresh_path(t.spark, "store"), "passive", event_stream(t), passive_records)
    fqdns = store.read("fqdns").select(F.col("id").alias("fqdn_id"), "fqdn")
    return store.read("passive_entries").join(fqdns, "fqdn_id").groupBy("fqdn").agg(
        F.count("*").alias("n"), F.min(ms("timestamp")).alias("first_ms"), F.max(ms("timestamp")).alias("last_ms")
    )


@query
def stream_entrada_ingest(t: Tables) -> DataFrame:
    """Warehouse names as pseudonyms, after a plain stream has stored the names of the clicks."""

    def records(events: DataFrame) -> DataFrame:
        obs = observations(events)
        return in_run(obs.select(F.col("fqdn").alias("qname"), F.col("ts").alias("first_seen"), F.col("ts").alias("last_seen")))

    root = fresh_path(t.spark, "store")
    clicks = landed_in_parts(t.events().where("event_type = 'click'"), "ts", "landed-clicks")[0]
    drained(t, root, "passive", jobs.read_landed(t.spark, clicks, t.events().schema), passive_records)
    store = drained(t, root, "entrada", event_stream(t), records)
    pseudonyms = store.anon_view("fqdn").select(F.col("id").alias("fqdn_id"), "fqdn", "plain_fqdn_id")
    return store.read("entrada_entries").join(pseudonyms, "fqdn_id").groupBy("fqdn").agg(
        F.count("*").alias("n"), F.count("plain_fqdn_id").alias("n_linked"), F.max(ms("last_seen")).alias("last_ms")
    )


@query
def stream_ct_tail(t: Tables) -> DataFrame:
    """Logs tailed by index in four bounded micro-batches, over two landings: the second call resumes where the first ended."""
    store = Store(t.spark, fresh_path(t.spark, "store"))
    pages = Pages(t.spark, fresh_path(t.spark, "pages"), t.cert().schema, size=2_000)
    checkpoint = fresh_path(t.spark, "checkpoint-ct")
    for landing, part in (("early", t.cert().where(is_stored())), ("late", t.cert().where(~is_stored()))):
        left = pages_left(pages)
        pages.land(landing, part)
        tail_logs(store, pages, checkpoint, current_stage(t.spark), suffix_rules(t.spark), in_run, entries=max(1, -(-(pages_left(pages) - left) // 2)))
    logs = store.read("logs").select(F.col("id").alias("log_id"), F.col("url").alias("log_url"))
    entries = store.read("log_entries").join(logs, "log_id")
    return entries.groupBy("log_url").agg(
        F.count("*").alias("n_entries"), F.countDistinct("certificate_id").alias("n_certificates"),
        (F.max("index") + 1).alias("resume_index"),
    )


def pages_left(pages: Pages) -> int:
    """Indexes up to the heads of all logs."""
    return pages.heads().agg(F.coalesce(F.sum("tree_size"), F.lit(0)).alias("n")).first().n


@query
def stream_metrics(t: Tables) -> DataFrame:
    root = fresh_path(t.spark, "stream-metrics")
    jobs.stream_interval_counts(observations(event_stream(t)), ["tld"], f"{root}/checkpoint", f"{root}/counts")
    return by_interval(jobs.latest_counts(t.spark, f"{root}/counts", ["tld"]))


@query
def stream_dedup(t: Tables) -> DataFrame:
    root = fresh_path(t.spark, "stream-dedup")
    jobs.run(observations(event_stream(t)), "names", f"{root}/checkpoint", jobs.known_names_step(f"{root}/store"))
    return Store(t.spark, f"{root}/store").read("known_names")


@query
def stream_zone_diff(t: Tables) -> DataFrame:
    """The differ over snapshots of which the latest days land first."""
    root = fresh_path(t.spark, "stream-diff")
    jobs.run(snapshot_rows(event_stream(t, latest_first=True)), "diff", f"{root}/checkpoint", jobs.zone_diff_step(f"{root}/store"))
    return by_day(jobs.zone_events(Store(t.spark, f"{root}/store")))


# --- vantage points ---


def sightings_by_source(t: Tables) -> DataFrame:
    """The same domains seen from four sides, by event type, and the certificates' own names."""
    events = t.snap("event_type", "ts")
    source = (
        F.when(F.col("event_type").isin("signup", "view"), "zone").when(F.col("event_type") == "click", "passive")
        .when(F.col("event_type") == "purchase", "ct").otherwise("entrada")
    )
    seen = events.select(source.alias("source"), F.col("domain").alias("name"), F.col("ts").cast("timestamp").alias("ts"))
    cert = facts.certificate_names(t.cert().select("ts", "dns_names"))
    certified = cert.select(F.lit("ct").alias("source"), F.col("dns_name").alias("name"), "ts")
    return with_domain_parts(seen.unionByName(certified), "name", suffix_rules(t.spark))


@query
def vantage_overlap(t: Tables) -> DataFrame:
    return vantage.overlap(sightings_by_source(t))


@query
def vantage_first_seen(t: Tables) -> DataFrame:
    rows = vantage.first_seen(sightings_by_source(t))
    firsts = [F.coalesce(ms(f"first_{s}"), F.lit(0)).alias(f"first_{s}_ms") for s in vantage.SOURCES]
    return rows.select("apex", *firsts, "leading_source", F.coalesce("lead_ms", F.lit(0)).alias("lead_ms"))

