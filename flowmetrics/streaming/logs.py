"""Entries per day of the log stream: tumbling windows with an event-time watermark.

``readStream`` → one-day windows over ``created_at_utc`` → update mode: every
batch upserts the days it touched, with their new totals, into a table keyed by
day. The state holds one count per open day. A row that is late by no more than
``delay`` behind the latest entry is counted in its day; days that end before
that are closed, and rows for them are dropped, as in any watermarked query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import ts_lit
from ..functions.durations import MICROS_PER_DAY
from ..sources.store import KeyedTable

LOG_DAYS = "log_day date, entries long"


def day_counts(logs: DataFrame, delay: str) -> DataFrame:
    """``logs``: a stream with ``created_at_utc`` (UTC wall clock). Event time must be an
    instant, so the wall clock is counted in microseconds, and the day taken back
    from the window's start the same way: the session zone plays no part."""
    at = F.timestamp_micros(F.timestamp_diff("MICROSECOND", ts_lit("1970-01-01 00:00:00"), F.col("created_at_utc")))
    day = F.date_from_unix_date(F.floor(F.unix_micros("w.start") / MICROS_PER_DAY).cast("int"))
    return (logs.select(at.alias("at")).withWatermark("at", delay)
            .groupBy(F.window("at", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("entries"))
            .select(day.alias("log_day"), "entries"))


def log_day_table(spark, root: str) -> KeyedTable:
    return KeyedTable(spark, root, spark.createDataFrame([], LOG_DAYS).schema, ["log_day"], 4)


def start_log_days(logs: DataFrame, table: KeyedTable, checkpoint_location: str, delay: str = "2 days",
                   available_now: bool = True, processing_time: str = "60 seconds"):
    w = (day_counts(logs, delay).writeStream.outputMode("update")
         .foreachBatch(lambda batch, _: table.merge(batch))
         .option("checkpointLocation", checkpoint_location))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()
