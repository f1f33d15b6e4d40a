"""Structured Streaming jobs: the batch steps, run per micro-batch.

A micro-batch is a batch of the store. Its id is made of the stream's name and
epoch, so a repeated epoch is either skipped or overwrites its own folders.
``availableNow`` drains what has landed; another trigger keeps tailing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pseudonyms import Anonymizer
from ..functions.suffixes import SuffixRules
from ..functions.times import from_unix_ms
from ..operators.dimensions import new_rows, wanted_in
from ..operators.metrics import interval_counts
from ..operators.snapshots import event_changes, held_events
from ..plans.ingest import Batch, ingest
from ..plans.store import Store
from ..session import prepare, workspace, written
from ..sources.certificates import with_dns_names

Step = Callable[[DataFrame, str], None]


def read_landed(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None,
    kind: str = "parquet",
) -> DataFrame:
    """Stream of the files landing in ``path``; all of them at once without a limit."""
    reader = spark.readStream.format(kind).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def run(
    stream: DataFrame, name: str, checkpoint: str, *steps: Step, mode: str = "append", drain: bool = False, **trigger
) -> None:
    """Run the steps on every micro-batch, in order, until the landed data is used up.

    ``trigger`` goes to the writer; without it the stream ends when drained.
    ``drain`` does the same for a source that bounds its micro-batches itself:
    ``availableNow`` would take all it has as one.
    """

    def each(rows: DataFrame, epoch: int) -> None:
        for step in steps:
            step(rows, f"{name}-{epoch:010d}")

    when = trigger or ({"processingTime": "0 seconds"} if drain else {"availableNow": True})
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(**when).foreachBatch(each).start()
    if drain:
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    else:
        query.awaitTermination()


def sightings_of(source: str, records: DataFrame) -> DataFrame:
    """Landed records of a source as the rows :class:`Batch` takes."""
    if source == "zone":
        return records.select("muid", "domain", "event_type", from_unix_ms(F.col("timestamp")).alias("ts"))
    if source == "passive":
        return records.select("muid", "query", from_unix_ms(F.col("timestamp")).alias("ts"))
    if source == "entrada":
        return records.select(
            "muid", F.col("fqdn").alias("qname"), from_unix_ms(F.col("min_timestamp")).alias("first_seen"),
            from_unix_ms(F.col("max_timestamp")).alias("last_seen"),
        )
    if source == "ct":
        return records.select(
            "muid", F.col("certificate").alias("raw"), "index", from_unix_ms(F.col("timestamp")).alias("ts"),
            "is_precert", F.col("log.url").alias("log_url"), F.col("log.description").alias("description"),
        ).transform(with_dns_names)
    raise ValueError(f"unknown source {source!r}")


def ingest_step(
    path: str, source: str, current: DataFrame | Callable[[Store], DataFrame], rules: SuffixRules,
    anonymizer: Anonymizer | None = None, sightings: Callable[[DataFrame], DataFrame] | None = None, wait: float = 600,
) -> Step:
    """Store a micro-batch of one source. ``sightings`` replaces the reading of landed records.

    ``current`` as a function, such as :func:`..plans.runs.current_stage_ids`, is
    asked in every micro-batch, so runs that start later are known. Streams
    into one store wait ``wait`` seconds for each other.
    """

    def step(rows: DataFrame, batch: str) -> None:
        store = Store(prepare(rows.sparkSession), path, wait)
        seen = sightings(rows) if sightings else sightings_of(source, rows)
        now = current(store) if callable(current) else current
        ingest(store, Batch(batch, **{source: seen}), now, rules, anonymizer)

    return step


def zone_diff_step(path: str) -> Step:
    """Differ over arriving snapshots ``tld, snapshot_date, domain``.

    A snapshot must arrive whole. It may come late, between or before known
    ones of its TLD, or again in place of one: the events that no longer hold
    are retracted, see :func:`zone_events`.
    """

    def step(rows: DataFrame, batch: str) -> None:
        store = Store(prepare(rows.sparkSession), path)
        with store.batch(batch) as opened, workspace(store.spark, "diff") as scratch:
            if opened is None:
                return
            touched = rows.select("tld").distinct()
            calendar = store.read("zone_calendar", opened.hidden).join(touched, "tld", "left_semi")
            changes = store.read("zone_events", opened.hidden).join(touched, "tld", "left_semi")
            store.write("zone_events", batch, event_changes(rows, calendar, changes, scratch))
            store.write("zone_calendar", batch, rows.select("tld", "snapshot_date").distinct())

    return step


def zone_events(store: Store) -> DataFrame:
    """The events that hold: those the batch differ gives for the snapshots that have arrived, in whatever order."""
    return held_events(store.read("zone_events"))


def known_names_step(path: str) -> Step:
    """Keep each name once over all batches: new ones are added to ``known_names``."""

    def step(rows: DataFrame, batch: str) -> None:
        store = Store(prepare(rows.sparkSession), path)
        with store.batch(batch) as opened, workspace(store.spark, "names") as scratch:
            if opened is not None:
                names = written(rows.select("fqdn").distinct(), "names", path=scratch)
                asked = wanted_in(names, "fqdn")
                stored = store.read("known_names", opened.hidden, wanted=asked)
                store.write("known_names", batch, new_rows(names, stored, "fqdn"), asked.n)

    return step


def stream_interval_counts(
    stream: DataFrame, keys: list[str], checkpoint: str, out: str, delay: str = "1 hour", interval: str = "1 hour",
    **trigger,
) -> None:
    """Counters per event-time interval; rows later than ``delay`` are left out of them.

    Every epoch writes the intervals it changed, with their count so far.
    """
    counts = interval_counts(stream.withWatermark("ts", delay), "ts", *keys, interval=interval)

    def step(rows: DataFrame, batch: str) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch}")

    run(counts, "metrics", checkpoint, step, mode="update", **trigger)


def latest_counts(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The last written, and so highest, count of each interval and key."""
    return spark.read.parquet(out).groupBy("interval_start", *keys).agg(F.max("n").alias("n"))
