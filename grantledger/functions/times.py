"""Run times, timestamps and the daily alert window."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def stamp(value: datetime | str) -> Column:
    """Timestamp literal read in the session time zone (aware values are moved to UTC first)."""
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.to_timestamp(F.lit(value))


def run_timestamp(run_date: Column, run_time: Column) -> Column:
    """Integer date 20240131 and integer time 5712 (00:57:12) as one timestamp."""
    padded = F.lpad(run_time.cast("string"), 6, "0")
    return F.try_to_timestamp(
        F.concat(run_date.cast("string"), padded), F.lit("yyyyMMddHHmmss")
    )


def stamp_text(ts: Column) -> Column:
    """Timestamp as text with milliseconds."""
    return F.date_format(ts, STAMP_FORMAT)


def in_alert_window(ts: Column) -> Column:
    """True in the quarter hour from ten o'clock, once a day."""
    return (F.hour(ts) == 10) & (F.minute(ts) < 15)
