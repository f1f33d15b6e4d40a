"""From landed files or tables to the stored tables: one job per source, one batch per call."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.suffixes import SuffixRules
from ..functions.pseudonyms import Anonymizer
from ..operators import ct, runs
from ..operators.selections import without_finished
from ..operators.snapshots import zone_diff_events
from ..schemas import FIRST_SEEN
from ..session import workspace, written
from ..sources import certificates, passive, warehouse, zones
from .ingest import Batch, ingest
from .runs import current_stage_ids, record_events
from .store import Store


def _of_run(rows: DataFrame, muid: str) -> DataFrame:
    return rows.withColumn("muid", F.lit(muid))


def store_snapshots(
    store: Store, batch: str, muid: str, path: str, rules: SuffixRules, start: str | None = None,
    end: str | None = None, readers: dict[str, zones.Reader] | None = None, max_rejects: int = 0,
) -> None:
    """Diff the snapshots of a folder and store the events.

    A TLD with more than ``max_rejects`` unreadable lines gives rejects only: a
    broken file must not look like expirations. Other TLDs go on the finished
    list, in the batch of their events, and are skipped by later calls.
    """
    spark = store.spark
    with workspace(spark, "snapshots") as scratch:
        finished = store.read("finished_tlds")
        domains, rejects = zones.read_snapshots(spark, path, start, end, readers)
        rejects = written(without_finished(rejects, finished), "rejects", path=scratch)
        broken = rejects.groupBy("tld").agg(F.count("*").alias("n")).where(F.col("n") > max_rejects)
        files = without_finished(zones.snapshot_files(spark, path, start, end), finished)
        files = files.join(broken, "tld", "left_anti").select("tld", "snapshot_date").distinct()
        good = without_finished(domains, finished).join(broken, "tld", "left_anti")
        events = written(zone_diff_events(good, files), "events", path=scratch)
        sightings = events.select("domain", "event_type", F.col("snapshot_date").cast("timestamp").alias("ts"))
        ingest(
            store, Batch(batch, zone=_of_run(sightings, muid), rejects=[rejects.drop("tld")]),
            current_stage_ids(store), rules, more={"finished_tlds": files.select("tld").distinct()},
        )


def store_round(
    store: Store, number: int, muid: str, domains: DataFrame, rules: SuffixRules, at: datetime,
    ended: datetime | None = None, rejects: DataFrame | None = None,
) -> None:
    """One round of zone collection: every ``domain`` as seen at the time of the round, in a stage of its own.

    Rounds count from 0; the first one has the stage that the run opened itself. A
    round ends its stage. A round that is repeated goes on with the step it died in.
    """
    batch = f"{muid}-round-{number:06d}"
    if number:
        record_events(store, f"{batch}-start", runs.run_event(store.spark, runs.STAGE_START, muid, ts=at))
    seen = domains.select("domain").distinct().select("domain", F.lit(FIRST_SEEN).alias("event_type"), F.lit(at).alias("ts"))
    sent = [] if rejects is None else [rejects]
    ingest(store, Batch(batch, zone=_of_run(seen, muid), rejects=sent), current_stage_ids(store), rules)
    record_events(store, f"{batch}-stop", runs.run_event(store.spark, runs.STAGE_STOP, muid, ts=ended, seq=1))


def store_zone_round(
    store: Store, number: int, muid: str, path: str, rules: SuffixRules, at: datetime, start: str | None = None,
    end: str | None = None, readers: dict[str, zones.Reader] | None = None, ended: datetime | None = None,
) -> None:
    """A round over the zone files of a folder; unreadable lines are rejects, the rest of the file is stored."""
    domains, rejects = zones.read_snapshots(store.spark, path, start, end, readers)
    store_round(store, number, muid, domains, rules, at, ended, rejects.drop("tld"))


def store_entry_pages(
    store: Store, batch: str, muid: str, path: str, rules: SuffixRules, logs: DataFrame,
    since: Column | None = None, until: Column | None = None,
) -> None:
    """Store what is new of the landed pages of some logs.

    ``logs`` is ``url, description``. Each log goes on after its highest stored
    index; ``since`` and ``until`` cut by the entries' times.
    """
    spark = store.spark
    with workspace(spark, "pages") as scratch:
        pages = certificates.read_entry_pages(spark, path, overlapping=True)
        decoded = certificates.decode_leaves(pages.join(logs.select(F.col("url").alias("log_url")), "log_url", "left_semi"))
        known = store.read("logs").select(F.col("id").alias("log_id"), F.col("url").alias("log_url"))
        stored = store.read("log_entries").groupBy("log_id").agg((F.max("index") + 1).alias("resume_index"))
        resume = stored.join(known, "log_id").select("log_url", "resume_index")
        left = decoded.join(resume, "log_url", "left").where(
            F.col("resume_index").isNull() | F.col("index").isNull() | (F.col("index") >= F.col("resume_index"))
        ).drop("resume_index")
        good, bad = certificates.split_leaves(written(left, "entries", path=scratch))
        good = good.withColumnRenamed("timestamp", "ts")
        if since is not None or until is not None:
            heads = ct.tree_heads(good)
            # without a bound the window is open on that side
            lower = F.to_timestamp(F.lit("0001-01-01")) if since is None else since
            upper = F.to_timestamp(F.lit("9999-12-31")) if until is None else until
            window = ct.indexes_by_time(good, heads, from_index=lower, to_index=upper)
            good = ct.entries_in_ranges(good, ct.index_ranges(resume, heads, window))
        described = good.join(logs.select(F.col("url").alias("log_url"), "description"), "log_url")
        entries = written(certificates.with_dns_names(described), "named", path=scratch)
        columns = ["muid", "raw", "index", "ts", "is_precert", "log_url", "description", "dns_names"]
        ingest(
            store, Batch(batch, ct=_of_run(entries, muid).select(*columns), rejects=[bad]), current_stage_ids(store), rules,
        )


def store_passive(
    store: Store, batch: str, muid: str, path: str, rules: SuffixRules, shift: str = passive.PASSIVE_SHIFT,
) -> None:
    """Store the queries of a folder of passive logs, their times moved by ``shift``."""
    seen, rejects = passive.read_passive(store.spark, path, shift)
    rows = _of_run(seen.select("query", "ts"), muid)
    ingest(store, Batch(batch, passive=rows, rejects=[rejects]), current_stage_ids(store), rules)


def store_warehouse(
    store: Store, batch: str, muid: str, queries: DataFrame, rules: SuffixRules, anonymizer: Anonymizer, start: str, end: str,
) -> None:
    """Store first and last time of each name that a warehouse table (``qname, unixtime``) has in a window."""
    rows = warehouse.as_sightings(warehouse.first_last(warehouse.in_window(queries, start, end)))
    ingest(store, Batch(batch, entrada=_of_run(rows, muid)), current_stage_ids(store), rules, anonymizer)
