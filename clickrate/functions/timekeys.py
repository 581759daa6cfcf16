"""P13-P15 and epoch-ms helpers (session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minute_bucket(ts: Column) -> Column:
    """Start of the minute that holds ``ts``."""
    return F.date_trunc("minute", ts)


def hour_bucket(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def month_key(ts: Column) -> Column:
    """yyyyMM as int."""
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def insert_time() -> Column:
    """Insertion time, millisecond precision."""
    return F.date_trunc("millisecond", F.current_timestamp())


def ms_to_ts(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def ts_to_ms(ts: Column) -> Column:
    return F.unix_millis(ts)


def month_keys_between(start_ms: int, end_ms: int) -> list[int]:
    """Month keys (yyyyMM) covering [start_ms, end_ms]; used to turn a time
    range into a partition filter."""
    import datetime as dt

    start = dt.datetime.fromtimestamp(start_ms / 1000, dt.timezone.utc)
    end = dt.datetime.fromtimestamp(end_ms / 1000, dt.timezone.utc)
    keys, y, m = [], start.year, start.month
    while (y, m) <= (end.year, end.month):
        keys.append(y * 100 + m)
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return keys
