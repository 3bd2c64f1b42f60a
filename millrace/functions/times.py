"""Epoch seconds and wall-clock text, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def epoch_seconds(ts_ntz: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp read as UTC: integer arithmetic on its fields."""
    days = F.unix_date(ts_ntz.cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts_ntz) * 3600 + F.minute(ts_ntz) * 60 + F.second(ts_ntz)


def from_epoch(seconds: Column) -> Column:
    """Zone-less UTC timestamp of epoch seconds; stays a timestamp so that range joins compare times, not text."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + seconds * F.expr("interval 1 second")


def epoch_text(seconds: Column) -> Column:
    return F.date_format(from_epoch(seconds), TEXT_FORMAT)


def text_epoch(text: Column) -> Column:
    return epoch_seconds(text.cast("timestamp_ntz"))
