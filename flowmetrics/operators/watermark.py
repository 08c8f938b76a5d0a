"""Ingestion high-water marks per (entity, collection, project).

A small control table (``schemas.SYNC_WATERMARKS``) updated with keyed
merges; the delta filter and the advance rule are plain column logic.
This is not an event-time ``withWatermark``: it is the source's change-date
cursor.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import merge_by_key
from ..functions.calendar import ts_lit

KEYS = ["entity_name", "collection_name", "project_name"]
EPOCH = dt.datetime(1970, 1, 1)


def _ts(v) -> Column:
    return ts_lit(v)


def lookup(control: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested keys with their stored state, or the defaults when absent."""
    c = control.select(*KEYS, "last_watermark_utc", "status", "records_extracted_last_run")
    return (requested.select(*KEYS).join(c, KEYS, "left")
            .select(*KEYS,
                    F.coalesce("last_watermark_utc", _ts(EPOCH)).alias("last_watermark_utc"),
                    F.coalesce("status", F.lit("IDLE")).alias("status"),
                    F.coalesce("records_extracted_last_run", F.lit(0)).alias("records_extracted_last_run")))


def _incoming(keys: DataFrame, **cols: Column) -> DataFrame:
    return keys.select(*KEYS, *[v.alias(k) for k, v in cols.items()])


def mark_start(control: DataFrame, keys: DataFrame, now) -> DataFrame:
    """RUNNING, start time, error cleared; a new key starts at the epoch."""
    inc = _incoming(keys, status=F.lit("RUNNING"), last_sync_start_utc=_ts(now),
                    error_message=F.lit(None).cast("string"), updated_at_utc=_ts(now))
    return merge_by_key(control, inc, KEYS,
                        ["status", "last_sync_start_utc", "error_message", "updated_at_utc"],
                        {"last_watermark_utc": _ts(EPOCH), "records_extracted_last_run": F.lit(0),
                         "created_at_utc": _ts(now)})


def mark_success(control: DataFrame, results: DataFrame, now) -> DataFrame:
    """``results``: keys + ``new_watermark`` + ``records``."""
    inc = results.select(*KEYS, F.lit("SUCCESS").alias("status"),
                         F.col("new_watermark").alias("last_watermark_utc"),
                         _ts(now).alias("last_sync_end_utc"),
                         F.col("records").cast("int").alias("records_extracted_last_run"),
                         F.lit(None).cast("string").alias("error_message"),
                         _ts(now).alias("updated_at_utc"))
    return merge_by_key(control, inc, KEYS,
                        ["status", "last_watermark_utc", "last_sync_end_utc",
                         "records_extracted_last_run", "error_message", "updated_at_utc"],
                        {"created_at_utc": _ts(now)})


def mark_failure(control: DataFrame, failures: DataFrame, now) -> DataFrame:
    """``failures``: keys + ``error_message``; the watermark stays."""
    inc = failures.select(*KEYS, F.lit("FAILED").alias("status"), _ts(now).alias("last_sync_end_utc"),
                          F.col("error_message"), _ts(now).alias("updated_at_utc"))
    return merge_by_key(control, inc, KEYS,
                        ["status", "last_sync_end_utc", "error_message", "updated_at_utc"],
                        {"last_watermark_utc": _ts(EPOCH), "records_extracted_last_run": F.lit(0),
                         "created_at_utc": _ts(now)})


def started_rows(control: DataFrame, keys: DataFrame, now) -> DataFrame:
    """The rows of ``keys`` as ``mark_start`` leaves them, from one join."""
    c = keys.select(*KEYS).join(control, KEYS, "left")
    return c.select(*KEYS, F.coalesce("last_watermark_utc", _ts(EPOCH)).alias("last_watermark_utc"),
                    _ts(now).alias("last_sync_start_utc"), "last_sync_end_utc", F.lit("RUNNING").alias("status"),
                    F.coalesce("records_extracted_last_run", F.lit(0)).alias("records_extracted_last_run"),
                    F.lit(None).cast("string").alias("error_message"),
                    F.coalesce("created_at_utc", _ts(now)).alias("created_at_utc"), _ts(now).alias("updated_at_utc"))


def ended_rows(control: DataFrame, outcome: DataFrame, started, now) -> DataFrame:
    """The rows of a run's outcomes as ``mark_success`` and ``mark_failure`` leave them.
    ``outcome``: keys, ``outcome_status``, ``new_watermark``, ``records``, ``failure``."""
    c = outcome.join(control, KEYS, "left")
    ok = F.col("outcome_status") == "SUCCESS"
    return c.select(*KEYS, F.when(ok, F.col("new_watermark")).otherwise(F.coalesce("last_watermark_utc", _ts(EPOCH)))
                    .alias("last_watermark_utc"),
                    _ts(started).alias("last_sync_start_utc"), _ts(now).alias("last_sync_end_utc"),
                    F.col("outcome_status").alias("status"),
                    F.when(ok, F.col("records")).otherwise(F.coalesce("records_extracted_last_run", F.lit(0)))
                    .cast("int").alias("records_extracted_last_run"), F.col("failure").alias("error_message"),
                    F.coalesce("created_at_utc", _ts(started)).alias("created_at_utc"), _ts(now).alias("updated_at_utc"))


def reset(control: DataFrame, entity: str) -> DataFrame:
    """Full resync: every watermark of ``entity`` back to the epoch."""
    return control.withColumn(
        "last_watermark_utc",
        F.when(F.col("entity_name") == entity, _ts(EPOCH)).otherwise(F.col("last_watermark_utc")))


def is_news(changed: Column, watermark: Column) -> Column:
    """Whether a change lies behind the watermark, cut to whole seconds (items of that
    same second are read again; the upsert makes it harmless). No watermark, or
    one at or before the epoch, means no filter."""
    return watermark.isNull() | (watermark <= _ts(EPOCH)) | (changed > F.date_trunc("second", watermark))


def changed_since(items: DataFrame, watermarks: DataFrame, key_cols: list[str],
                  wm_col: str = "last_watermark_utc") -> DataFrame:
    """Items that are news to their key's watermark (see ``is_news``)."""
    w = watermarks.select(*key_cols, F.col(wm_col).alias("_wm"))
    return items.join(w, key_cols, "left").filter(is_news(F.col("changed_date"), F.col("_wm"))).drop("_wm")


def advance(previous: DataFrame, synced: DataFrame, key_cols: list[str]) -> DataFrame:
    """New watermark = max(previous, max changed_date synced); count synced.
    Keys with nothing synced keep their watermark."""
    agg = synced.groupBy(*key_cols).agg(F.max("changed_date").alias("_mx"),
                                        F.count(F.lit(1)).alias("_n"))
    return (previous.select(*key_cols, "last_watermark_utc").join(agg, key_cols, "left")
            .select(*key_cols,
                    F.coalesce(F.greatest("last_watermark_utc", "_mx"), F.col("last_watermark_utc"))
                    .alias("new_watermark"),
                    F.coalesce("_n", F.lit(0)).alias("records")))
