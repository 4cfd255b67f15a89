"""Instants, all in UTC (the session zone is UTC, see ``session.prepare``)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def now_utc() -> datetime:
    return datetime.now(timezone.utc)


def as_utc(moment: datetime) -> datetime:
    """A moment without a zone counts as UTC."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def instant(moment: datetime) -> Column:
    """Literal instant; folds to a constant, so filters on it push down."""
    return F.lit(as_utc(moment).isoformat()).cast("timestamp")


def from_micros(micros: int | None) -> datetime | None:
    """Driver-side value of ``unix_micros``, free of the local zone."""
    if micros is None:
        return None
    seconds, rest = divmod(micros, 1_000_000)
    return datetime.fromtimestamp(seconds, timezone.utc).replace(microsecond=rest)


def to_utc(value: Column, dtype: T.DataType) -> Column:
    """Timestamp, or null where the value cannot be read as one."""
    if isinstance(dtype, T.TimestampType):
        return value
    if isinstance(dtype, T.NumericType):  # epoch in nanoseconds
        return F.timestamp_micros(F.floor(value / 1000))
    return value.try_cast("timestamp")


def day(value: Column) -> Column:
    return F.to_date(value)


def date_parts(value: Column, prefix: str) -> dict[str, Column]:
    """Year, month and day of week, Monday being 0."""
    return {
        f"{prefix}_year": F.year(value),
        f"{prefix}_month": F.month(value),
        f"{prefix}_day_of_week": F.weekday(value),
    }


def elapsed_seconds(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.round(micros / F.lit(1e6), 2)
