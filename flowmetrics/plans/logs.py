"""Log events: append sink, day index and day slice.

Logs are derived from the driver's ``events`` table (FIXTURES.md §4):
``log_id = event_id``, level Error for ``error`` events, Debug for ``view`` events, else Information,
``source_context = event_type``, ``message = props``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = ["Trace", "Debug", "Information", "Warning", "Error", "Critical"]


def logs_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("log_id"),
        F.when(F.col("event_type") == "error", F.lit("Error")).when(F.col("event_type") == "view", F.lit("Debug"))
        .otherwise(F.lit("Information")).alias("log_level"),
        F.col("event_type").alias("source_context"),
        F.col("props").alias("message"),
        F.lit(None).cast("string").alias("exception"),
        F.col("ts").alias("created_at_utc"))


def level_at_least(logs: DataFrame, minimum: str = "Information") -> DataFrame:
    """Only entries at or above ``minimum`` are kept by the append sink."""
    rank = F.array_position(F.array(*[F.lit(x) for x in LEVELS]), F.col("log_level"))
    return logs.filter(rank >= LEVELS.index(minimum) + 1)


def append_logs(logs: DataFrame, path: str, minimum: str = "Information") -> None:
    """Append sink, partitioned by day so a day slice prunes to one folder."""
    (level_at_least(logs, minimum).withColumn("log_date", F.to_date("created_at_utc"))
     .write.mode("append").partitionBy("log_date").parquet(path))


def log_days(logs: DataFrame) -> DataFrame:
    """Distinct days with entries, newest first, with their entry count."""
    return (logs.groupBy(F.to_date(F.date_trunc("day", "created_at_utc")).alias("log_day"))
            .agg(F.count(F.lit(1)).alias("entries"))
            .orderBy(F.col("log_day").desc()))


def log_day(logs: DataFrame, day) -> DataFrame:
    """Entries of one UTC day ``[d, d + 1 day)``, oldest first."""
    d = day if not isinstance(day, dt.date) else F.lit(dt.datetime(day.year, day.month, day.day))
    lo = d.cast("timestamp_ntz")
    hi = lo + F.expr("INTERVAL 1 DAY")
    return (logs.filter((F.col("created_at_utc") >= lo) & (F.col("created_at_utc") < hi))
            .orderBy("created_at_utc", "log_id"))
