"""Measurement runs and their stages, derived from an append-only event log."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES
from .positions import running_count

START, STOP = "measurement_start", "measurement_stop"
STAGE_START, STAGE_STOP = "stage_start", "stage_stop"


def run_event(
    spark: SparkSession, event: str, muid: str | None = None, description: str | None = None,
    host: str | None = None, ts: datetime | None = None, seq: int = 0,
) -> DataFrame:
    """One row for the event log; a start without ``muid`` makes a new run id.

    ``seq`` orders events of one run that share a time.
    """
    muid = muid or uuid.uuid4().hex
    row = (muid, event, description, host, ts or datetime.now(timezone.utc), seq)
    return spark.createDataFrame([row], TABLES["run_events"])


def _numbered(events: DataFrame) -> DataFrame:
    """Events with the stage they belong to. A run opens its first stage itself."""
    opens = F.col("event").isin(START, STAGE_START)
    return running_count(events, "muid", ["ts", "seq"], "stage", opens)


def stages(events: DataFrame) -> DataFrame:
    """``muid, stage, start_time, stop_time``. Stopping a run stops its current stage."""
    opens, closes = F.col("event").isin(START, STAGE_START), F.col("event").isin(STAGE_STOP, STOP)
    return _numbered(events).groupBy("muid", "stage").agg(
        F.min(F.when(opens, F.col("ts"))).alias("start_time"),
        F.max(F.when(closes, F.col("ts"))).alias("stop_time"),
    ).where("stage > 0")


def measurements(events: DataFrame) -> DataFrame:
    """``muid, description, host, start_time, end_time``, one row per run."""
    start = F.col("event") == START
    return events.groupBy("muid").agg(
        F.max(F.when(start, F.col("description"))).alias("description"),
        F.max(F.when(start, F.col("host"))).alias("host"),
        F.min(F.when(start, F.col("ts"))).alias("start_time"),
        F.max(F.when(F.col("event") == STOP, F.col("ts"))).alias("end_time"),
    )


def numbered_starts(starts: DataFrame, run: str, order: list[str]) -> DataFrame:
    """Stage starts with their number within the run, from 1."""
    return running_count(starts, run, order, "stage")


def stage_intervals(starts: DataFrame, run: str, start: str, order: list[str]) -> DataFrame:
    """``run, stage, start_time, stop_time``: a stage lasts until the next one starts.

    Each start also goes out as the stop of the stage before it. The two meet
    by run and stage number, so a long run is never one group.
    """
    numbered = numbered_starts(starts, run, order)
    marks = F.explode(F.array(
        F.struct(F.col("stage"), F.col(start).alias("start_time"), F.lit(None).cast("timestamp").alias("stop_time")),
        F.struct((F.col("stage") - 1).alias("stage"), F.lit(None).cast("timestamp").alias("start_time"), F.col(start).alias("stop_time")),
    ))
    flat = numbered.select(run, marks.alias("m")).select(run, "m.*").where("stage > 0")
    return flat.groupBy(run, "stage").agg(
        F.max("start_time").alias("start_time"), F.max("stop_time").alias("stop_time")
    )


def current_stages(numbered: DataFrame, run: str = "muid") -> DataFrame:
    """``muid, stage``: the latest stage of each run; a stopped one stays current."""
    return numbered.groupBy(F.col(run).alias("muid")).agg(F.max("stage").alias("stage"))


def with_stage(rows: DataFrame, current: DataFrame, source: str, payload: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the ``stage_id`` of their run, and those without one as rejects.

    ``current`` is ``muid, stage_id``, one row per open run.
    """
    joined = rows.join(current.select("muid", "stage_id"), "muid", "left")
    missing = F.col("muid").isNull() | (F.col("muid") == "")
    reason = F.when(missing, "missing run id").otherwise("no active stage")
    bad = joined.where("stage_id is null").select(
        F.lit(source).alias("source"), reason.alias("reason"), F.col(payload).cast("string").alias("payload"),
        F.col("stage_id"),
    )
    return joined.where("stage_id is not null").drop("muid"), bad
