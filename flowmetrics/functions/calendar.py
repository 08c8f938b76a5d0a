"""Calendar expressions: YYYYMMDD keys, ISO week/day, English names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN_DATE_KEY = -1


def date_key(ts: Column) -> Column:
    """``TO_CHAR(ts,'YYYYMMDD')::INT`` as integer arithmetic; NULL → -1."""
    return F.coalesce(F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts),
                      F.lit(UNKNOWN_DATE_KEY))


def iso_day_of_week(d: Column) -> Column:
    return F.weekday(d) + 1


def sprint_name(path: Column) -> Column:
    """Last backslash-separated segment, or the whole path when it is empty."""
    return F.coalesce(F.nullif(F.split_part(path, F.lit("\\"), F.lit(-1)), F.lit("")), path)


def ts_lit(value) -> Column:
    """A UTC wall-clock ``timestamp_ntz`` literal.

    Built from text, so it does not depend on the session time zone (a Python
    ``datetime`` literal would be read as local time and then converted).
    """
    import datetime as dt
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")
