"""Time expressions. Timestamps are instants (session zone UTC); local logic names its zone."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopline.config import LOCAL_ZONE, SERVICE_DAY_START_HOUR

MICROS = 1_000_000


def as_utc(moment: datetime | None) -> datetime | None:
    """A moment without a zone is UTC, whatever zone the driver runs in."""
    return moment.replace(tzinfo=timezone.utc) if moment is not None and moment.tzinfo is None else moment


def local_wall(instant: Column) -> Column:
    """Wall-clock time in the feed's zone, as a zone-less timestamp."""
    return F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_ZONE), instant.cast("timestamp_ntz"))


def service_date_norm(instant: Column) -> Column:
    """Service day: local times before 03:00 belong to the previous date."""
    return F.to_date(local_wall(instant) - F.expr(f"INTERVAL {SERVICE_DAY_START_HOUR} HOURS"))


def local_date(instant: Column) -> Column:
    return F.to_date(local_wall(instant))


def local_hour(instant: Column) -> Column:
    return F.hour(local_wall(instant))


def local_dow(instant: Column) -> Column:
    """Day of week with Sunday as 0."""
    return F.dayofweek(local_wall(instant)) - 1


def micros_between(start: Column, end: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def epoch_seconds(start: Column, end: Column) -> Column:
    """Elapsed seconds as a double."""
    return micros_between(start, end) / F.lit(float(MICROS))


def whole_seconds(micros: Column) -> Column:
    """Seconds from microseconds, half to even, as the delay rule needs."""
    return F.bround(micros / F.lit(float(MICROS))).cast("int")


def int_seconds(micros: Column) -> Column:
    """Seconds from microseconds, half away from zero, as a numeric-to-int cast does."""
    return F.round(micros / F.lit(float(MICROS))).cast("int")


def plus_seconds(instant: Column, seconds: float) -> Column:
    return F.timestamp_micros(F.unix_micros(instant) + F.lit(int(round(seconds * MICROS))))


def iso_utc(instant: Column) -> Column:
    """Fixed-width UTC text with microseconds, so text order is time order."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def truncate_minute(instant: Column) -> Column:
    return F.date_trunc("minute", instant)


def parse_iso(text: Column) -> Column:
    """ISO text with an optional offset (none means UTC); empty or unreadable text gives null."""
    return F.try_to_timestamp(F.nullif(text, F.lit("")))


def month_of(instant: Column) -> Column:
    """First day of the month, the value of the monthly layout column."""
    return F.to_date(F.date_trunc("month", instant))


def time_bucket(instant: Column, seconds: int) -> Column:
    """Number of the fixed-width time bucket an instant falls in."""
    return F.floor(F.unix_micros(instant) / F.lit(seconds * MICROS)).cast("long")
