"""Zone-free timestamp expressions on ``timestamp_ntz`` columns.

``date_trunc`` and ``timestampdiff`` go through the session zone and shift wall-clock values around daylight-saving
changes, so the expressions here use ``unix_timestamp`` and date casts, which treat the value as written.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AsOf = Column | dt.datetime | str | None


def clock(as_of: AsOf = None) -> Column:
    """The moment a run counts as 'now': given, or the start of the query."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def safe_timestamp(df: DataFrame, name: str) -> Column:
    """Column as ``timestamp_ntz``, null where unreadable. Native timestamps skip the text round trip."""
    if isinstance(df.schema[name].dataType, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return F.col(name).cast("timestamp_ntz")
    return F.col(name).cast("string").try_cast("timestamp_ntz")


def within_years(ts: Column, first_year: int, as_of: AsOf) -> Column:
    """The timestamp itself, or null when its year lies outside ``[first_year, next year]``."""
    return F.when(F.year(ts).between(F.lit(first_year), F.year(clock(as_of)) + 1), ts)


def minute_boundaries(start: Column, end: Column) -> Column:
    """Whole-minute boundaries crossed between two timestamps (10:00:59 to 10:01:01 is 1)."""
    return F.floor(F.unix_timestamp(end) / 60) - F.floor(F.unix_timestamp(start) / 60)


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Fractional minutes between two timestamps."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / 60


def day_start(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def hour_start(ts: Column) -> Column:
    return F.timestamp_add("HOUR", F.hour(ts), day_start(ts))


def day_of_week(ts: Column, sunday: int) -> Column:
    """Day number with Sunday counted as ``sunday`` (0 or 1)."""
    return F.dayofweek(ts) + F.lit(sunday - 1)
