"""Elapsed and remaining time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from `start` to `end`, with microseconds."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return micros / F.lit(1e6)


def hours_left(start: Column, now: Column, done: Column, total: Column) -> Column:
    """Remaining hours if the open jobs take as long as the finished ones did on average."""
    per_job = F.try_divide(seconds_between(start, now), done)
    return per_job * (total - done) / F.lit(3600)


def progress_text(done: Column, total: Column, hours: Column) -> Column:
    """Progress as the text kept with a sub-analysis; NULL while the hours are unknown."""
    return F.when(
        hours.isNotNull(),
        F.format_string("%d / %d jobs finished, time remaining: %.2f hours", done, total, hours),
    )
