"""Timestamps: text to time, time to whole microseconds and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.schema import TIME_FORMAT_READ, TIME_FORMATS_READ


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time(c: Column | str) -> Column:
    """Payload time text to a timestamp; null where it does not follow the format."""
    return F.try_to_timestamp(_col(c), F.lit(TIME_FORMAT_READ))


def parse_any_time(c: Column | str, formats: Sequence[str] = TIME_FORMATS_READ) -> Column:
    """Time text as people and programs write it, by the first of ``formats`` that it follows; null where there is none.

    Texts without a zone are in the session's zone; blanks around a text do not count.
    """
    text = F.trim(_col(c))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def micros_of(c: Column | str) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(_col(c).cast("timestamp"))


def millis_interval(n: Column) -> Column:
    """A number of milliseconds as a day-time interval."""
    return F.make_dt_interval(secs=(n / F.lit(1000)).cast("decimal(18,6)"))
