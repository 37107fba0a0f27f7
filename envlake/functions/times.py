"""Instants, days and periods in UTC."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

WITH_OFFSET = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$"
FULL_DATE = r"^\d{4}-\d{2}-\d{2}([T ].*)?$"


def instant(c: Column, need_offset: bool = False) -> Column:
    """An ISO 8601 text as a timestamp, null where it is none; naive times count as UTC unless an offset is needed."""
    text = F.trim(c.cast("string"))
    own = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(text, F.lit("T00:00:00Z"))).when(text.rlike(WITH_OFFSET), text).otherwise(F.concat(text, F.lit("Z")))
    return F.when(text.rlike(WITH_OFFSET if need_offset else FULL_DATE), own.try_cast("timestamp"))


def in_utc(c: Column) -> Column:
    """An instant as the date and time that UTC clocks show, without a zone, whatever the session's zone."""
    return F.convert_timezone(None, F.lit("UTC"), c.cast("timestamp").cast("timestamp_ntz"))


def utc_day(c: Column) -> Column:
    """The UTC day of an instant (a date is its own)."""
    return in_utc(c).cast("date")


def natural_key(station: Column, at: Column) -> Column:
    """station|instant in UTC, with microseconds and offset."""
    return F.concat(F.trim(station.cast("string")), F.lit("|"), F.date_format(in_utc(at), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def _bound(at) -> Column:
    """A literal of an instant; a time without a zone is in UTC."""
    if isinstance(at, datetime):
        return F.lit(at if at.tzinfo else at.replace(tzinfo=timezone.utc))
    return F.lit(at)


def half_open(c: Column, start, end) -> Column:
    """start <= c < end; bounds without a zone are in UTC."""
    return (c >= _bound(start)) & (c < _bound(end))


def strict_day(text: str) -> date:
    """A day written YYYY-MM-DD and in no other way."""
    found = date.fromisoformat(text)
    if found.isoformat() != text:
        raise ValueError(f"{text!r} is no day written YYYY-MM-DD")
    return found


def inclusive_days(first: str, last: str) -> tuple[datetime, datetime]:
    """The instants [from, to) of the days from first to last, both included."""
    a, b = strict_day(first), strict_day(last)
    if b < a:
        raise ValueError(f"{last} is before {first}")
    return tuple(datetime(d.year, d.month, d.day) for d in (a, b + timedelta(days=1)))


def exclusive_days(first: str, end: str) -> tuple[datetime, datetime]:
    """The instants [from, to) from the day first up to the day end, which is left out."""
    a, b = strict_day(first), strict_day(end)
    if b <= a:
        raise ValueError(f"{end} is not after {first}")
    return tuple(datetime(d.year, d.month, d.day) for d in (a, b))


def utc_midnight(at: datetime) -> datetime:
    """at, if it is midnight in UTC and says so."""
    if at.tzinfo is None or at.astimezone(timezone.utc).time() != datetime.min.time():
        raise ValueError(f"{at} is no midnight in UTC")
    return at.astimezone(timezone.utc)


def day_parts(day: Column) -> dict[str, Column]:
    """Columns of a time dimension; Monday is 0."""
    return {"ano": F.year(day), "mes": F.month(day), "dia": F.dayofmonth(day), "trimestre": F.quarter(day), "dia_semana": F.weekday(day), "dia_util": F.weekday(day) < 5}
