"""Time helpers that do not depend on the session time zone.

Driver tables carry UTC wall-clock ``TIMESTAMP_NTZ`` values.  Casting those
to ``TIMESTAMP`` (or formatting a ``TIMESTAMP``) goes through the session
time zone and its DST rules; these helpers go through epoch arithmetic
instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970-01-01 of a wall-clock (``TIMESTAMP_NTZ``) value."""
    return F.timestamp_diff("SECOND", _epoch_ntz(), ts.cast("timestamp_ntz"))


def utc_instant(ts: Column) -> Column:
    """UTC wall clock (``TIMESTAMP_NTZ``) → the ``TIMESTAMP`` instant
    (event-time columns for watermarks must be ``TIMESTAMP``)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), ts.cast("timestamp_ntz")))


def utc_wall_clock(instant: Column) -> Column:
    """``TIMESTAMP`` instant → UTC wall clock ``TIMESTAMP_NTZ``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _epoch_ntz())


def local_instant(day: Column, clock: str, tz: str, days_before: int = 0) -> Column:
    """UTC wall clock (``TIMESTAMP_NTZ``) of a local time of day in zone
    ``tz``, ``days_before`` days before ``day``.  A time that the spring
    switch skips counts as late as the switch is long; one that the autumn
    switch repeats is its first occurrence."""
    hours, minutes = (int(x) for x in clock.split(":"))
    local = F.timestamp_add("MINUTE", F.lit(60 * hours + minutes), F.date_sub(day, days_before).cast("timestamp_ntz"))
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), local)
