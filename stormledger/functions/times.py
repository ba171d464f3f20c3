"""Wall time, UTC and offsets. Every timestamp column is ``timestamp_ntz``."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

from stormledger.config import EPOCH, TIME_ZONE

EPOCH_SECONDS = int(datetime.fromisoformat(EPOCH).replace(tzinfo=timezone.utc).timestamp())


def _ts(c: Column) -> Column:
    return c.cast("timestamp")


def _ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def trunc(unit: str, c: Column) -> Column:
    """Start of the unit. From months on it goes through dates, which need no zone."""
    if unit in ("month", "quarter", "year"):
        return _ntz(F.trunc(c.cast("date"), unit))
    return _ntz(F.date_trunc(unit, _ts(c)))


def seconds_from_epoch(c: Column) -> Column:
    """Whole seconds from the fixed epoch, fractions rounded half to even."""
    return F.rint(F.unix_micros(_ts(c)) / F.lit(1e6) - F.lit(EPOCH_SECONDS)).try_cast("int")


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed, which is not the same as full seconds elapsed."""
    return (F.unix_seconds(_ts(end)) - F.unix_seconds(_ts(start))).try_cast("int")


def from_epoch(seconds: Column) -> Column:
    return _ntz(F.timestamp_seconds(seconds.cast("long") + F.lit(EPOCH_SECONDS)))


def add_hours(c: Column, hours: Column | int) -> Column:
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return _ntz(F.timestamp_seconds(F.unix_seconds(_ts(c)) + hours.cast("long") * F.lit(3600)))


def hour_number(c: Column) -> Column:
    """Hours since 1970, for range arithmetic on whole hours."""
    return F.floor(F.unix_seconds(_ts(c)) / F.lit(3600)).cast("long")


def local_to_utc(c: Column, zone: str = TIME_ZONE) -> Column:
    """Wall time to UTC by the zone database.

    In the hour that happens twice when summer time ends, the later instant is
    taken; Spark alone would take the earlier one.
    """
    first = F.to_utc_timestamp(_ts(c), zone)
    later = first + F.expr("interval 1 hour")
    again = F.from_utc_timestamp(later, zone) == _ts(c)
    return _ntz(F.when(again, later).otherwise(first))


def local_hour(c: Column, zone: str = TIME_ZONE) -> Column:
    """Hour of the local day of a UTC instant."""
    return F.hour(F.from_utc_timestamp(_ts(c), zone))


def weekday(c: Column) -> Column:
    """Day of the week with Sunday as 0."""
    return F.dayofweek(c) - F.lit(1)
