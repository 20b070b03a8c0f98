"""Zone-free timestamps: year filter, text form, reading text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: the datetime texts accepted, a date with an optional time and an optional Z.
DATETIME_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d*)?)?)?Z?$"


def _year_start(year: int) -> Column:
    return F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")


def in_year(ts: Column, year: int) -> Column:
    """``year(ts) = year`` as a half-open range, which reaches the Parquet reader; null drops out."""
    return (ts >= _year_start(year)) & (ts < _year_start(year + 1))


def to_seconds(ts: Column) -> Column:
    """Round to whole seconds, half up, without passing through a zoned type."""
    up = ts + F.expr("interval '0.5' second")
    fraction = F.date_part(F.lit("SECOND"), up) % 1
    zero = F.lit(0)
    return up - F.make_dt_interval(zero, zero, zero, fraction)


def parse_datetime(text: Column) -> Column:
    """Text to timestamp, whole seconds; anything unreadable is null."""
    text = F.trim(text)
    parsed = F.when(text.rlike(DATETIME_TEXT), text.try_cast("timestamp_ntz"))
    return F.when(F.contains(text, F.lit(".")), to_seconds(parsed)).otherwise(parsed)


def datetime_text(ts: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` always, also when every value is midnight; null stays null.

    The plain cast is zone-free, where ``date_format`` would pass through the session's zone.
    """
    return F.substring(ts.cast("string"), 1, 19)
