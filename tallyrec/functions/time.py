"""Clock helpers.  The run date is always a parameter; nothing reads the system clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(t: dt.datetime | dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal (wall-clock, independent of the session time zone)."""
    if isinstance(t, str):
        t = dt.datetime.fromisoformat(t)
    if not isinstance(t, dt.datetime):
        t = dt.datetime(t.year, t.month, t.day)
    return F.expr(f"TIMESTAMP_NTZ'{t.strftime('%Y-%m-%d %H:%M:%S.%f')}'")


def midnight(t: dt.datetime | dt.date) -> dt.datetime:
    return dt.datetime(t.year, t.month, t.day)


def lookback_start(as_of: dt.datetime | dt.date, days: int) -> dt.datetime:
    """``trunc(as_of) - days``: the inclusive lower bound of the look-back window."""
    return midnight(as_of) - dt.timedelta(days=days)


def local_time(utc_ts: Column, tz: str) -> Column:
    """UTC wall-clock -> local wall-clock (DST aware)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_ts)


def from_epoch_seconds(secs: Column) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ (UTC wall-clock) without touching the session time zone."""
    return F.timestamp_add("SECOND", secs, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def epoch_seconds_rounded(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> epoch seconds rounded half up, in exact integer arithmetic."""
    micros = F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), ts) + F.lit(500000)
    # (a - a mod b) is an exact multiple of b, so the division is exact.
    return ((micros - F.pmod(micros, F.lit(1000000))) / F.lit(1000000)).cast("long")


def local_midnight(local_ts: Column) -> Column:
    """Midnight of a wall-clock timestamp, still TIMESTAMP_NTZ."""
    return F.to_date(local_ts).cast("timestamp_ntz")
