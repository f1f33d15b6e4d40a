"""One batch of sightings into the stored tables.

All names of the batch are looked up and numbered in one pass; the resulting
ids serve the rows of every level, the links and the facts. Dimensions are
written first, then certificates and facts, then the commit marker.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.pseudonyms import Anonymizer, with_pseudonyms
from ..functions.suffixes import SuffixRules, reject_reason, with_domain_parts
from ..operators import dimensions as dim
from ..operators import bitmaps, facts, metrics
from ..operators.runs import with_stage
from ..schemas import LEVELS
from ..session import workspace, written
from .store import NAME_TABLES, Store


@dataclass
class Batch:
    """Sightings of up to four sources; every frame carries ``muid``.

    zone:    domain, event_type, ts
    ct:      raw, index, ts, is_precert, log_url, description, dns_names
    passive: query, ts
    entrada: qname, first_seen, last_seen (stored as pseudonyms only)
    """

    id: str
    zone: DataFrame | None = None
    ct: DataFrame | None = None
    passive: DataFrame | None = None
    entrada: DataFrame | None = None
    rejects: list[DataFrame] = field(default_factory=list)


_NAME = {"zone": "domain", "passive": "query", "entrada": "qname"}
#: what facts take from an accepted row beside its name and stage
_FACT = {"zone": ["event_type", "ts"], "passive": ["ts"], "entrada": ["first_seen", "last_seen"]}


def split_names(rows: DataFrame, source: str, name: str, rules: SuffixRules) -> tuple[DataFrame, DataFrame]:
    """Rows with name parts, and rows whose name cannot be stored."""
    reason = reject_reason(F.col(name))
    good = with_domain_parts(rows.where(reason.isNull()), name, rules)
    bad = rows.where(reason.isNotNull()).select(
        F.lit(source).alias("source"), reason.alias("reason"), F.col(name).alias("payload"), "stage_id"
    )
    return good, bad


def accept(batch: Batch, current: DataFrame, rules: SuffixRules) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """Accepted rows per source and everything turned away."""
    accepted, rejects = {}, list(batch.rejects)
    for source, name in _NAME.items():
        rows = getattr(batch, source)
        if rows is not None:
            staged, bad = with_stage(rows, current, source, name)
            accepted[source], bad_names = split_names(staged, source, name, rules)
            rejects += [bad, bad_names]
    if batch.ct is not None:
        prints = batch.ct if "sha256_fingerprint" in batch.ct.columns else facts.fingerprinted(batch.ct)
        staged, bad = with_stage(prints, current, "ct", "sha256_fingerprint")
        readable = F.col("dns_names").isNotNull()
        accepted["ct"] = staged.where(readable)
        rejects += [bad, staged.where(~readable).select(
            F.lit("ct").alias("source"), F.lit("unreadable certificate").alias("reason"),
            F.col("sha256_fingerprint").cast("string").alias("payload"), "stage_id",
        )]
    return accepted, rejects


def _certificate_parts(entries: DataFrame, rules: SuffixRules) -> DataFrame:
    """``sha256_fingerprint`` and name parts; bad names in a certificate are passed over."""
    pairs = facts.certificate_names(entries.select("sha256_fingerprint", "dns_names")).distinct()
    return with_domain_parts(pairs.where(reject_reason(F.col("dns_name")).isNull()), "dns_name", rules)


def _all_at_once(spark: SparkSession, *jobs: Callable[[], object]) -> None:
    """Run independent writes side by side: small ones then do not hold up the cluster."""
    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=8) as pool:
        for done in [pool.submit(in_session(job)) for job in jobs]:
            done.result()


def _ids(ids: DataFrame, level: str, twin: str) -> DataFrame:
    rows = ids.where((F.col("twin") == twin) & (F.col("level") == level))
    return rows.select(F.col("name").alias(level), "id")


@dataclass(frozen=True)
class _Open:
    """An open batch: where it writes, what its reads leave out, where its scratch tables are."""

    store: Store
    id: str
    hidden: list[str]
    highest: dict[str, int]
    scratch: str
    #: rows written, by table
    counts: dict[str, int] = field(default_factory=dict)

    def read(self, table: str, wanted: dim.Wanted | None = None) -> DataFrame:
        return self.store.read(table, self.hidden, wanted=wanted)

    def write(self, table: str, rows: DataFrame, at_most: int = 0, size: int = 0) -> None:
        self.counts[table] = self.store.write(table, self.id, rows, at_most, size)

    def write_facts(self, table: str, rows: DataFrame) -> None:
        self.write(table, dim.with_row_ids(rows, self.next_id(table)))

    def next_id(self, table: str) -> int:
        return self.highest.get(table, 0) + 1

    def kept(self, rows: DataFrame, label: str, *folders: str) -> DataFrame:
        return written(rows, label, *folders, path=self.scratch)


def _store_names(at: _Open, names: DataFrame, anonymizer: Anonymizer) -> tuple[DataFrame, DataFrame]:
    """Store the new names of all levels; the ids of all names of the batch that are stored then, and the counts of names.

    ``names`` is ``tld, public_suffix, apex, fqdn, anonymous``.
    """
    spark = at.store.spark
    wanted = at.kept(dim.level_names(names, anonymizer), "wanted")
    asked = dim.wanted_names(wanted)
    known = dim.known_names(wanted, at.store.names(at.hidden, asked))
    # counted as they are written: names to be stored that were new, and that were not
    seen = Observation()
    of = {table: (F.col("twin") == twin) & (F.col("level") == level) & F.col("create") for table, twin, level in NAME_TABLES}
    counts = [F.count_if(c & F.col("id").isNull()).alias(f"new_{table}") for table, c in of.items()]
    counts += [F.count_if(c & F.col("id").isNotNull()).alias(f"old_{table}") for table, c in of.items()]
    known = at.kept(known.observe(seen, *counts), "known")
    highest = {(twin, level): at.next_id(table) - 1 for table, twin, level in NAME_TABLES}
    ids = at.kept(dim.resolve(known, highest), "ids", "twin", "level")
    at_most = {table: w.n for table, w in asked.items()}
    _all_at_once(
        spark, lambda: at.store.write_names(at.id, dim.name_rows(ids), at_most),
        lambda: at.store.write_links(at.id, dim.link_rows(ids, anonymizer)),
    )
    got = seen.get
    return ids, metrics.name_points(spark, {
        (twin, level, new): got.get(f"{'new' if new else 'old'}_{table}") or 0 for table, twin, level in NAME_TABLES for new in (True, False)
    })


def _store_certificates(at: _Open, entries: DataFrame, certificates: DataFrame, size: int, parts: DataFrame, fqdns: DataFrame) -> None:
    """``entries`` are without the bytes, ``certificates`` are ``sha256_fingerprint, raw`` of all of the batch, ``size`` bytes."""
    urls = entries.groupBy(F.col("log_url").alias("url")).agg(F.min("description").alias("description"))
    known_logs = at.read("logs")
    new_logs = dim.new_rows(urls, known_logs, "url")
    logs = at.kept(dim.with_ids(new_logs, "url", at.next_id("logs")), "logs")
    at.write("logs", logs)

    key = "sha256_fingerprint"
    prints = at.kept(entries.select(key).distinct(), "fingerprints")
    asked = dim.wanted_in(prints, key)
    stored = at.read("certificates", asked).select(key, "id")
    # lookup and numbering see fingerprints only; the bytes join as they are written
    numbered = dim.with_ids(dim.new_rows(prints, stored, key), key, at.next_id("certificates"))
    numbered = at.kept(numbered, "certificate-ids")
    hits = stored.join(prints, key, "left_semi")
    rows = facts.log_facts(entries, hits.unionByName(numbered), known_logs.select("id", "url").unionByName(logs.select("id", "url")))
    _all_at_once(
        at.store.spark,
        lambda: at.write("certificates", facts.distinct_certificates(certificates.join(numbered, key)), asked.n, size),
        lambda: at.write_facts("certificate_to_fqdns", facts.bridge(parts, numbered, fqdns)),
        lambda: at.write_facts("log_entries", rows),
    )


def _store_warehouse(at: _Open, rows: DataFrame) -> None:
    at.write_facts("entrada_entries", rows)
    own = at.store.read("entrada_entries", [], only=[at.id])
    at.write("entrada_bitmaps", bitmaps.id_bitmaps(own, "fqdn_id"))


def warehouse_offset(store: Store) -> DataFrame:
    """One row ``resume_offset``: how many different names of the warehouse are stored. Reads bitmaps only."""
    return bitmaps.distinct_ids(store.read("entrada_bitmaps"), "resume_offset")


def ingest(
    store: Store, batch: Batch, current: DataFrame, rules: SuffixRules, anonymizer: Anonymizer | None = None,
    more: dict[str, DataFrame] | None = None,
) -> None:
    """Store a batch. ``current`` is ``muid, stage_id`` of the open runs; ``more`` goes into other tables as it is."""
    with store.batch(batch.id) as opened:
        if opened is None:
            return
        with workspace(store.spark, "ingest") as scratch:
            at = _Open(store, batch.id, opened.hidden, opened.highest, scratch)
            _ingest(at, batch, current, rules, anonymizer or Anonymizer())
            for table, rows in (more or {}).items():
                at.write(table, rows)


def _ingest(at: _Open, batch: Batch, current: DataFrame, rules: SuffixRules, anonymizer: Anonymizer) -> None:
    if batch.ct is not None:
        prints = facts.fingerprinted(batch.ct)
        # many readers; the bytes are read once here, and once more when new certificates are written
        seen_bytes = Observation()
        sized = prints.observe(seen_bytes, F.sum(F.octet_length("raw")).alias("size"))
        batch = replace(batch, ct=at.kept(sized.drop("raw"), "entries"))
        size = seen_bytes.get.get("size") or 0
        certificates = prints.select("sha256_fingerprint", "raw")
    accepted, rejects = accept(batch, current, rules)
    for source in accepted.keys() - {"ct"}:  # names, facts and counts read it: the names are split once
        accepted[source] = at.kept(accepted[source].select(*LEVELS, *_FACT[source], "stage_id"), f"accepted-{source}")
    seen = [
        rows.select(*LEVELS, F.lit(source == "entrada").alias("anonymous"))
        for source, rows in accepted.items() if source != "ct"
    ]
    certificate_parts = None
    points: list[DataFrame] = []
    if "ct" in accepted:
        certificate_parts = at.kept(_certificate_parts(accepted["ct"], rules), "certificate-names")
        seen.append(certificate_parts.select(*LEVELS, F.lit(False).alias("anonymous")))
    if seen:
        # distinct names are far fewer than sightings
        ids, name_points = _store_names(at, reduce(DataFrame.unionByName, seen).distinct(), anonymizer)
        points.append(name_points)

    writes: list[Callable[[], None]] = []
    if "ct" in accepted:
        fqdns = _ids(ids, "fqdn", dim.PLAIN)
        writes.append(partial(_store_certificates, at, accepted["ct"], certificates, size, certificate_parts, fqdns))
    if "zone" in accepted:
        events = accepted["zone"].select("apex", "event_type", "ts", "stage_id")
        rows = facts.zone_facts(events, _ids(ids, "apex", dim.PLAIN))
        writes.append(partial(at.write_facts, "zonefile_entries", rows))
    if "passive" in accepted:
        sightings = accepted["passive"].select("fqdn", "ts", "stage_id")
        rows = facts.passive_facts(sightings, _ids(ids, "fqdn", dim.PLAIN))
        writes.append(partial(at.write_facts, "passive_entries", rows))
    if "entrada" in accepted:
        sightings = with_pseudonyms(accepted["entrada"], anonymizer).select(
            "fqdn_anon", "first_seen", "last_seen", "stage_id"
        )
        rows = facts.warehouse_facts(sightings, _ids(ids, "fqdn", dim.ANON))
        writes.append(partial(_store_warehouse, at, rows))
    if rejects:
        writes.append(partial(at.write, "rejects", reduce(DataFrame.unionByName, rejects)))
    _all_at_once(at.store.spark, *writes)
    points.append(metrics.table_points(at.store.spark, at.counts))
    if "ct" in accepted:
        points.append(metrics.key_points(accepted["ct"], "log-entries", "log_url"))
    if "zone" in accepted:
        points.append(metrics.key_points(accepted["zone"], "zone-entries", "tld"))
    counts = reduce(DataFrame.unionByName, points).withColumn("ts", F.current_timestamp())
    at.write("metrics", counts.coalesce(1))  # a row for each type, log and TLD
