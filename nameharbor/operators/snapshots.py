"""Zone snapshots over time: calendar, differ, comparison and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import EXPIRATION, FIRST_SEEN, REGISTRATION
from ..session import written


def calendar_of(files: DataFrame) -> DataFrame:
    """``tld, snapshot_date, rank``: the snapshots of each TLD, numbered from 0 in date order.

    ``files`` is a file listing or the snapshots themselves. One row per
    snapshot, so the window partition of a TLD is as long as its history.
    """
    days = files.select("tld", "snapshot_date").distinct()
    rank = F.row_number().over(Window.partitionBy("tld").orderBy("snapshot_date")) - 1
    return days.withColumn("rank", rank)


def zone_diff_events(snapshots: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """``tld, domain, event_type, snapshot_date`` out of successive snapshots.

    A domain of the first snapshot of a TLD is FIRST_SEEN. Later ones give
    REGISTRATION when the snapshot before lacked the domain, and EXPIRATION,
    dated by the later snapshot, when the next one lacks it. Pass ``files``
    when a snapshot may be empty, as it then has no row of its own.

    Copies of a name within a snapshot fall together before the shuffle by name. Whether the
    calendar is broadcast is left to its size in bytes; else adaptive execution
    splits the days of large TLDs. A group is at most one number per snapshot
    of its TLD.
    """
    calendar = written(calendar_of(snapshots if files is None else files), "calendar")
    ranked = snapshots.select("tld", "snapshot_date", "domain").join(calendar, ["tld", "snapshot_date"])
    seen = ranked.groupBy("tld", "domain").agg(F.array_sort(F.collect_set("rank")).alias("ranks"))
    # came: not seen one snapshot before. gone: not seen one snapshot after, dated there.
    came = F.filter("ranks", lambda r, i: (i == 0) | (F.get("ranks", i - 1) != r - 1))
    gone = F.filter("ranks", lambda r, i: (i == F.size("ranks") - 1) | (F.get("ranks", i + 1) != r + 1))
    arrival = lambda r: F.struct(
        r.alias("rank"), F.when(r == 0, FIRST_SEEN).otherwise(REGISTRATION).alias("event_type")
    )
    departure = lambda r: F.struct((r + 1).alias("rank"), F.lit(EXPIRATION).alias("event_type"))
    events = seen.select(
        "tld", "domain", F.inline(F.concat(F.transform(came, arrival), F.transform(gone, departure)))
    )
    # the rank after the last snapshot has no date, which drops departures from it
    dated = events.join(calendar, ["tld", "rank"])
    return dated.select("tld", "domain", "event_type", "snapshot_date")


def held_events(changes: DataFrame) -> DataFrame:
    """Events that hold, out of added (``n`` 1) and retracted (``n`` -1) ones."""
    key = ["tld", "domain", "event_type", "snapshot_date"]
    return changes.groupBy(*key).agg(F.sum("n").alias("n")).where("n > 0").select(*key)


def snapshots_at(events: DataFrame, dates: DataFrame) -> DataFrame:
    """``tld, snapshot_date, domain``: the snapshots of some dates, rebuilt from the events that hold.

    A domain is in a snapshot when its last event up to then is no EXPIRATION.
    A group is the events of one domain; ``dates`` has a few rows for each TLD.
    """
    asked = dates.groupBy("tld").agg(F.sort_array(F.collect_set("snapshot_date")).alias("_asked"))
    # two events of a domain never share a date
    event = F.struct(F.col("snapshot_date").alias("at"), (F.col("event_type") != EXPIRATION).alias("there"))
    history = events.groupBy("tld", "domain").agg(F.sort_array(F.collect_list(event)).alias("_events"))

    def present(day: Column) -> Column:
        last = F.try_element_at(F.filter("_events", lambda e: e["at"] <= day), F.lit(-1))
        return F.coalesce(last["there"], F.lit(False))

    rows = history.join(asked, "tld")
    return rows.select("tld", F.explode(F.filter("_asked", present)).alias("snapshot_date"), "domain")


def event_changes(arrived: DataFrame, calendar: DataFrame, changes: DataFrame, scratch: str | None = None) -> DataFrame:
    """What snapshots that arrive in any order change: ``tld, domain, event_type, snapshot_date, n``.

    ``arrived`` is ``tld, snapshot_date, domain`` of whole snapshots, also
    earlier than known ones or in place of one; ``calendar`` has the known
    snapshots and ``changes`` the added and retracted events, both of the TLDs
    that have something arriving. Only the events of an arrived date and of
    the next one can change: they are found anew from those snapshots and the
    one before, and what differs from the events that held is returned with
    ``n`` 1 or -1.

    Snapshots that are not at hand are rebuilt from the events. Rows move by
    TLD and domain; a TLD's calendar is as long as its history.
    """
    new = arrived.select("tld", "snapshot_date").distinct().withColumn("_new", F.lit(True))
    every = calendar.select("tld", "snapshot_date").distinct().join(new, ["tld", "snapshot_date"], "full")
    order = Window.partitionBy("tld").orderBy("snapshot_date")
    is_new = F.coalesce("_new", F.lit(False))
    days = written(every.select(
        "tld", "snapshot_date", is_new.alias("new"), F.coalesce(F.lag(is_new).over(order), F.lit(False)).alias("after_new"),
        F.coalesce(F.lead(is_new).over(order), F.lit(False)).alias("before_new"),
        F.lag("snapshot_date").over(order).isNull().alias("earliest"), F.lead("snapshot_date").over(order).alias("next_date"),
    ), "calendar", path=scratch)
    held = held_events(changes)
    kept = snapshots_at(held, days.where("not new and (after_new or before_new)"))
    sets = arrived.select("tld", "snapshot_date", "domain").distinct().unionByName(kept)
    # each snapshot is looked at on its own date, and as the one before the next date
    here = F.struct(F.col("snapshot_date").alias("at"), F.lit(True).alias("here"), (F.col("new") | F.col("after_new")).alias("_due"))
    then = F.struct(F.col("next_date").alias("at"), F.lit(False).alias("here"), ((F.col("new") | F.col("before_new")) & F.col("next_date").isNotNull()).alias("_due"))
    seen = sets.join(days, ["tld", "snapshot_date"]).select("tld", "domain", F.inline(F.array(here, then))).where("_due")
    sides = seen.groupBy("tld", "at", "domain").agg(F.bool_or("here").alias("is_here"), F.bool_or(~F.col("here")).alias("was_here"))
    first = days.where("earliest").select("tld", F.col("snapshot_date").alias("_first"))
    kind = F.when(~F.col("is_here"), EXPIRATION).when(F.col("at") == F.col("_first"), FIRST_SEEN).otherwise(REGISTRATION)
    found = sides.where("is_here != was_here").join(first, "tld").select("tld", "domain", kind.alias("event_type"), F.col("at").alias("snapshot_date"))
    due = days.where("new or after_new").select("tld", "snapshot_date")
    held_then = held.join(due, ["tld", "snapshot_date"], "left_semi")
    key = ["tld", "domain", "event_type", "snapshot_date"]
    both = found.select(*key, F.lit(1).alias("n")).unionByName(held_then.select(*key, F.lit(-1).alias("n")))
    return both.groupBy(*key).agg(F.sum("n").alias("n")).where("n <> 0")


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("tld", "snapshot_date", "event_type").agg(F.count("*").alias("n"))


def event_columns(event_type: Column, ts: Column) -> dict[str, Column]:
    """``registered`` and ``expired`` times of an event; a first sighting sets neither."""
    return {
        "registered": F.when(event_type == REGISTRATION, ts),
        "expired": F.when(event_type == EXPIRATION, ts),
    }


def compare_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Values only in ``a`` and only in ``b``: ``key, side``.

    One aggregation instead of two anti joins: copies of a hot value fall
    together before the shuffle.
    """
    sides = a.select(key, F.lit(1).alias("_side")).unionByName(b.select(key, F.lit(2).alias("_side")))
    held = sides.groupBy(key).agg(F.bit_or("_side").alias("_sides")).where("_sides <> 3")
    return held.select(key, F.when(F.col("_sides") == 1, "only_a").otherwise("only_b").alias("side"))


def snapshot_counts(snapshots: DataFrame) -> DataFrame:
    """Snapshots and distinct domains per TLD.

    Counted in two steps so that a large TLD is split by date and domain.
    """
    domains = snapshots.select("tld", "snapshot_date", "domain").distinct()
    per_file = domains.groupBy("tld", "snapshot_date").agg(F.count("*").alias("n_entries"))
    return per_file.groupBy("tld").agg(
        F.count("*").alias("n_snapshots"), F.sum("n_entries").alias("n_entries"),
        F.max("n_entries").alias("largest_snapshot"),
    )


def lifetimes(events: DataFrame) -> DataFrame:
    """Periods a domain was in its zone: ``tld, domain, start_date, end_date, known_start``.

    ``end_date`` is null while the domain is still there; ``known_start`` is
    false when it was already in the first snapshot. A group has no more rows
    than its TLD has snapshots.
    """
    order = Window.partitionBy("tld", "domain").orderBy("snapshot_date")
    follow = events.withColumn("end_date", F.lead("snapshot_date").over(order))
    return follow.where(F.col("event_type") != EXPIRATION).select(
        "tld", "domain", F.col("snapshot_date").alias("start_date"), "end_date",
        (F.col("event_type") == REGISTRATION).alias("known_start"),
    )
