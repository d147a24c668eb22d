"""Epoch seconds, calendar buckets and epoch milliseconds, all in UTC whatever the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month")


def epoch_day(epoch_seconds: Column) -> Column:
    """Epoch seconds (number or text) to DATE."""
    days = F.floor(epoch_seconds.cast("bigint") / F.lit(86400)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def parse_epoch(epoch_seconds: Column) -> Column:
    """Epoch seconds (number or text) to a yyyy-MM-dd string."""
    return epoch_day(epoch_seconds).cast("string")


def bucket_time(epoch_seconds: Column, grain: str = "month") -> Column:
    """Bucket date: first of the month, the day, or the Sunday that closes the Monday week."""
    return bucket_date(epoch_day(epoch_seconds), grain)


def bucket_date(day: Column, grain: str = "month") -> Column:
    if grain == "day":
        return day
    if grain == "month":
        return F.trunc(day, "month")
    if grain == "week":
        return F.date_add(F.trunc(day, "week"), 6)
    raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")


def epoch_millis(day: Column) -> Column:
    """DATE to milliseconds since the epoch."""
    return F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint") * F.lit(86_400_000)


def epoch_seconds(wall_clock: Column) -> Column:
    """TIMESTAMP_NTZ read as UTC to epoch seconds."""
    day = F.to_date(wall_clock)
    return (
        F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint") * F.lit(86_400)
        + F.hour(wall_clock) * F.lit(3600)
        + F.minute(wall_clock) * F.lit(60)
        + F.second(wall_clock)
    )
