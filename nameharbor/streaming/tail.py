"""Tailing CT logs: a stream whose offset is the next index of each log and whose micro-batches are bounded by entries."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..functions.pseudonyms import Anonymizer
from ..functions.suffixes import SuffixRules
from ..plans.ingest import Batch, ingest
from ..plans.store import Store
from ..session import prepare
from ..sources.pages import Pages
from .jobs import run

#: entries of a micro-batch, and of one range in it
ENTRIES, RANGE = 1_000_000, 100_000


@dataclass
class LogRange(InputPartition):
    log_url: str
    start: int
    end: int


class LogRangeReader(DataSourceStreamReader):
    """Ranges ``start_index <= index < end_index`` of each log, from ``resume`` up to ``heads``.

    An offset is the next index of every log. A micro-batch takes at most
    ``entries`` of them, in even shares; what a log does not use goes to the
    others. Ranges have at most ``range`` entries and are a partition each. The
    reader knows no storage: entries are read by the step that gets the ranges.
    """

    def __init__(self, options: dict[str, str]):
        self.heads = json.loads(options["heads"])
        self.resume = json.loads(options["resume"])
        self.entries, self.range = int(options["entries"]), int(options["range"])
        self.at: dict[str, int] = {log: self.resume.get(log, 0) for log in self.heads}

    def initialOffset(self) -> dict:
        return dict(self.at)

    def latestOffset(self) -> dict:
        out, left = dict(self.at), self.entries
        waiting = sorted((max(0, head - self.at.get(log, 0)), log) for log, head in self.heads.items())
        for i, (n, log) in enumerate(waiting):  # the shortest first: the rest share what they leave
            # a share of less than one entry is one entry while there are any left
            taken = min(n, max(left // (len(waiting) - i), min(1, left)))
            out[log] = self.at.get(log, 0) + taken
            left -= taken
        return out

    def partitions(self, start: dict, end: dict) -> list[LogRange]:
        # also what a restarted stream had planned, which may be ahead of the index it was told to resume at
        self.at = {log: max(at, end.get(log, 0)) for log, at in self.at.items()}
        return [
            LogRange(log, first, min(first + self.range, stop)) for log, stop in sorted(end.items())
            for first in range(start.get(log, self.resume.get(log, 0)), stop, self.range)
        ]

    def read(self, partition: LogRange) -> Iterator[tuple]:
        yield partition.log_url, partition.start, partition.end


class LogRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "log_ranges"

    def schema(self) -> str:
        return "log_url string, start_index bigint, end_index bigint"

    def streamReader(self, schema) -> LogRangeReader:
        return LogRangeReader(self.options)


def resume_indexes(store: Store) -> dict[str, int]:
    """One past the highest stored index of each log; one row per log."""
    hidden = store.open_batches()
    logs = store.read("logs", hidden).select(F.col("id").alias("log_id"), "url")
    stored = store.read("log_entries", hidden).groupBy("log_id").agg((F.max("index") + 1).alias("resume_index"))
    return {r.url: r.resume_index for r in stored.join(logs, "log_id").collect()}


def read_ranges(pages: Pages, resume: dict[str, int], entries: int = ENTRIES, size: int = RANGE) -> DataFrame:
    """Stream of the ranges left to read of the landed logs."""
    spark = pages.spark
    spark.dataSource.register(LogRanges)
    heads = {r.log_url: r.tree_size for r in pages.heads().collect()}  # one row per log
    options = {"heads": json.dumps(heads), "resume": json.dumps(resume), "entries": str(entries), "range": str(size)}
    return spark.readStream.format("log_ranges").options(**options).load()


def tail_logs(
    store: Store, pages: Pages, checkpoint: str, current: DataFrame | Callable[[Store], DataFrame], rules: SuffixRules,
    sightings: Callable[[DataFrame], DataFrame], name: str = "ct", entries: int = ENTRIES, size: int = RANGE,
    anonymizer: Anonymizer | None = None,
) -> None:
    """Store what has landed since the highest stored index of each log, in micro-batches of at most ``entries``.

    ``sightings`` makes the ``ct`` rows of a :class:`Batch` out of landed
    entries. A micro-batch opens the pages of its ranges only. A call ends
    with what had landed when it began; the next one goes on from there.
    """

    def step(ranges: DataFrame, batch: str) -> None:
        target = Store(prepare(ranges.sparkSession), store.path, store.wait, store.bucket_rows)
        # entries / size rows, and one more for each log
        asked = [(r.log_url, r.start_index, r.end_index) for r in ranges.collect()]
        now = current(target) if callable(current) else current
        ingest(target, Batch(batch, ct=sightings(pages.in_ranges(asked))), now, rules, anonymizer)

    run(read_ranges(pages, resume_indexes(store), entries, size), name, checkpoint, step, drain=True)
