"""Measurement runs in the store: their events, and the ids of runs and stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dimensions as dim
from ..operators import runs
from ..session import workspace, written
from .store import Store


def record_events(store: Store, batch: str, events: DataFrame) -> None:
    """Store run events (rows of :func:`..operators.runs.run_event`) with the runs and stages they open.

    A run or stage gets its id when it starts and keeps it; stops are events
    alone, see :func:`stored_measurements` and :func:`stored_stages`. Events
    must arrive in the order of their time within a run.
    """
    with store.batch(batch) as opened, workspace(store.spark, "runs") as scratch:
        if opened is None:
            return
        touched = written(events, "events", path=scratch)
        earlier = store.read("run_events", opened.hidden).join(touched.select("muid").distinct(), "muid", "left_semi")
        log = written(earlier.unionByName(touched), "log", path=scratch)
        known = store.read("measurements", opened.hidden).select(F.col("id").alias("measurement_id"), "muid")
        fresh = dim.new_rows(runs.measurements(log).where("start_time is not null"), known, "muid")
        fresh = written(dim.with_ids(fresh, "muid", opened.highest.get("measurements", 0) + 1), "new-runs", path=scratch)
        ids = known.unionByName(fresh.select(F.col("id").alias("measurement_id"), "muid"))
        stages = runs.stages(log).join(ids, "muid").drop("stop_time")
        old = store.read("stages", opened.hidden).select("measurement_id", "stage")
        stages = stages.join(old, ["measurement_id", "stage"], "left_anti")
        # one short name per stage: the ids follow from the set of new stages only
        named = stages.withColumn("_name", F.concat_ws("/", "muid", "stage"))
        numbered = dim.with_ids(named, "_name", opened.highest.get("stages", 0) + 1)
        nothing = F.lit(None).cast("timestamp")
        store.write("run_events", batch, touched)
        store.write("measurements", batch, fresh.withColumn("end_time", nothing))
        store.write("stages", batch, numbered.withColumn("stop_time", nothing))


def stored_measurements(store: Store) -> DataFrame:
    """``id, muid, description, host, start_time, end_time``; no end while the run is open."""
    hidden = store.open_batches()
    ended = runs.measurements(store.read("run_events", hidden)).select("muid", "end_time")
    return store.read("measurements", hidden).drop("end_time").join(ended, "muid")


def stored_stages(store: Store) -> DataFrame:
    """``id, measurement_id, muid, stage, start_time, stop_time``; stopping a run stops its last stage."""
    hidden = store.open_batches()
    stopped = runs.stages(store.read("run_events", hidden)).select("muid", "stage", "stop_time")
    of = store.read("measurements", hidden).select(F.col("id").alias("measurement_id"), "muid")
    return store.read("stages", hidden).drop("stop_time").join(of, "measurement_id").join(stopped, ["muid", "stage"])


def current_stage_ids(store: Store) -> DataFrame:
    """``muid, stage_id``: the latest stage of each run, for :func:`.ingest.ingest`; a stopped one stays current."""
    hidden = store.open_batches()
    of = store.read("measurements", hidden).select(F.col("id").alias("measurement_id"), "muid")
    latest = store.read("stages", hidden).groupBy("measurement_id").agg(F.max_by("id", "stage").alias("stage_id"))
    return latest.join(of, "measurement_id").select("muid", "stage_id")
