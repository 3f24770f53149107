"""Run-time handling.

Every operator takes an ``as_of`` instead of reading the wall clock, so a run is reproducible and
testable. ``as_of`` becomes a ``timestamp_ntz`` literal: the driver tables are ``timestamp_ntz`` and a
freshness compare must happen in one time zone (pin ``spark.sql.session.timeZone`` when the data is
``timestamp``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampType

AsOf = dt.datetime | dt.date | str | None


def to_datetime(as_of: AsOf) -> dt.datetime:
    """Normalise ``as_of`` to a naive ``datetime`` (``None`` means now, UTC)."""
    if as_of is None:
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(as_of, dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return as_of
    if isinstance(as_of, dt.date):
        return dt.datetime(as_of.year, as_of.month, as_of.day)
    return dt.datetime.fromisoformat(str(as_of).replace("T", " "))


def as_of_ts(as_of: AsOf) -> Column:
    """``as_of`` as a ``timestamp_ntz`` literal (constant-folded by Catalyst)."""
    return F.lit(to_datetime(as_of).isoformat(sep=" ")).cast("timestamp_ntz")


def load_time(as_of: AsOf) -> Column:
    """Load-time column: the given ``as_of``, or the query's start time as UTC wall-clock NTZ when
    it is ``None`` (the same clock as the job-status records, whatever the session time zone)."""
    if as_of is None:
        return F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return as_of_ts(as_of)


def as_of_date(as_of: AsOf) -> dt.date:
    return to_datetime(as_of).date()


def previous_day(as_of: AsOf) -> Column:
    """``current_date() - 1`` relative to ``as_of``, as a ``date`` literal."""
    return F.lit(as_of_date(as_of) - dt.timedelta(days=1))


def hours_before(as_of: AsOf, hours: float) -> Column:
    """``as_of - INTERVAL hours`` as a ``timestamp_ntz`` literal."""
    return as_of_ts(to_datetime(as_of) - dt.timedelta(hours=hours))


def utc_ntz(df: DataFrame, column: str) -> Column:
    """A time column as UTC wall-clock ``timestamp_ntz``: a ``timestamp`` (an instant) is converted
    exactly, whatever the session time zone; ``timestamp_ntz`` is taken as UTC already."""
    c = F.col(column)
    return utc_ntz_of(c, df.schema[column].dataType if column in df.columns else df.select(c).schema[0].dataType)


def utc_ntz_of(c: Column, data_type: DataType) -> Column:
    """``utc_ntz`` of an expression of a known type."""
    if isinstance(data_type, TimestampType):
        seconds = (F.unix_micros(c).cast("decimal(24,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return c.cast("timestamp_ntz")
