"""Timestamp helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from ``start`` to ``end``, as BIGINT.

    00:00:59 to 00:01:00 is 1, although only one second has passed. Built from
    calendar fields, so naive timestamps never pass through a time zone.
    """
    days = F.datediff(end.cast("date"), start.cast("date")).cast("bigint")
    hours = F.hour(end) - F.hour(start)
    minutes = F.minute(end) - F.minute(start)
    return days * 1440 + hours * 60 + minutes


def plus_seconds(ts: Column, seconds: Column) -> Column:
    """``ts`` moved by a number of seconds; keeps a naive timestamp naive."""
    return F.timestamp_add("SECOND", seconds, ts)


def naive(ts: Column) -> Column:
    """ISO text or any timestamp as a zone-less timestamp."""
    return ts.cast("timestamp_ntz")
