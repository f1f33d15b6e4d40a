"""Times: Unix milliseconds and seconds to timestamps and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The landed passive logs carry a time one day before the sighting.
PASSIVE_SHIFT = "24 hours"


def from_unix_ms(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def to_unix_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def from_unix_s(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def shifted(ts: Column, interval: str = PASSIVE_SHIFT) -> Column:
    return ts + F.expr(f"interval {interval}")
