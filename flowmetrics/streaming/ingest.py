"""Landed responses → staging table, incrementally, one outcome per project and run.

``readStream`` over a landing folder of response documents (JSON lines:
``{collection, project, status, message, count, value:[{id, rev, url, fields}]}``;
only ``value`` is required) → ``foreachBatch``:

* the batch is written once; a record without an id or with a field that cannot
  be read, and a line that is not JSON, go to the quarantine;
* the others are mapped to the typed staging columns and joined to the catalog
  and the control table: records of projects that are not enabled and records
  that are no news to their project's watermark are skipped (and counted);
* the rest is reduced to one record per id (the last arrival by file time, file
  and position; ``order_by=["rev"]`` puts the revision first, within the batch and
  against the stored row) and upserted into the keyed staging table;
* what the batch did for each project (records, latest change, refusals) is
  written to a ledger, in a folder of its own per stream and batch.

A run is a drain of all that has landed (``run_available``), in as many batches
as ``max_files_per_trigger`` makes of it, or one trigger of the polling query. It
marks the enabled projects RUNNING, and at its end folds its ledger entries into
one outcome per project: SUCCESS with the run's total and the advanced watermark,
or FAILED with the source's message and the watermark where it was; a project that
sent something without being enabled is SKIPPED. A refused
project (403) becomes FORBIDDEN in the catalog and turns AUTHORIZED again with
the first run that brings it records. One project's failure touches no other;
a run that stops altogether leaves its projects FAILED and moves no watermark.

Replay safety: the streaming checkpoint re-runs only uncommitted batches;
quarantine and ledger folders are overwritten by a replay, staging and control
writes are keyed merges, and a batch whose run was already folded is skipped.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import ts_lit
from ..operators import catalog as C
from ..operators import watermark as WM
from ..operators.merge import dedupe_last
from ..schemas import CATALOG_PROJECTS, RAW_COLUMNS, RAW_WORK_ITEMS, SYNC_WATERMARKS
from ..sources.landing import UNREADABLE, read_records
from ..sources.store import KeyedTable, materialize, path_exists

# ``fields`` is an object in the documents; a string-typed schema keeps its JSON text
RESPONSE_SCHEMA = T.StructType([
    T.StructField("collection", T.StringType()),
    T.StructField("project", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("message", T.StringType()),
    T.StructField("count", T.IntegerType()),
    T.StructField("value", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("rev", T.IntegerType()),
        T.StructField("url", T.StringType()),
        T.StructField("fields", T.StringType()),
    ]))),
    T.StructField("unreadable", T.StringType()),      # the line where it is not such a document
])

# when a record arrived: time and name of its file, block of the file, row of the block
ARRIVED = ["file_time", "file_name", "file_block"]
ARRIVAL = [*ARRIVED, "block_row"]
PROJECT = ["collection_name", "project_name"]
SOURCE = ["collection_name", "requested", "status", "message", "unreadable"]       # what a response says of itself
FORBIDDEN_STATUS, FIRST_ERROR_STATUS = 403, 400
FORBIDDEN_MESSAGE = "403 Forbidden"
DISABLED, OLD = "disabled", "old"

LEDGER = ("collection_name string, project_name string, records long, latest timestamp_ntz, "
          "skipped_old long, skipped_disabled long, forbidden boolean, error string")
OUTCOME = ("collection_name string, project_name string, status string, records long, "
           "new_watermark timestamp_ntz, skipped_old long, skipped_disabled long, error_message string, "
           "last_batch long, started_utc timestamp_ntz, ended_utc timestamp_ntz")


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class Ingest:
    def __init__(self, spark: SparkSession, landing_dir: str, staging_root: str,
                 control_root: str, quarantine_root: str, checkpoint_location: str,
                 collection: str = "DefaultCollection", entity: str = "work_items",
                 order_by: list[str] | None = None, buckets: int = 64,
                 catalog_root: str | None = None, runs_root: str | None = None, only_news: bool = True):
        """``collection``: of responses that name none. ``catalog_root``: the stored project
        catalog; without one every project is taken. ``only_news``: skip records that are
        no news to the watermark."""
        self.spark = spark
        self.landing_dir = landing_dir
        self.staging = KeyedTable(spark, staging_root, RAW_WORK_ITEMS, ["id"], buckets)
        self.control = KeyedTable(spark, control_root, SYNC_WATERMARKS, WM.KEYS, 8)
        self.catalog = KeyedTable(spark, catalog_root, CATALOG_PROJECTS, ["project_id"], 4) if catalog_root else None
        self.quarantine_root = quarantine_root
        self.runs_root = (runs_root or f"{control_root}_runs").rstrip("/")
        self.checkpoint_location = checkpoint_location
        self.max_files_per_trigger = None
        self.polling = False
        self.collection, self.entity, self.order_by = collection, entity, order_by or []
        self.only_news = only_news
        self.started = None
        self._folded = None

    # ------------------------------------------------------------ places
    @property
    def _stream(self) -> str:
        """The stream's name: its checkpoint."""
        return hashlib.md5(self.checkpoint_location.encode()).hexdigest()[:12]

    def _quarantine_path(self, batch_id: int) -> str:
        return f"{self.quarantine_root}/stream={self._stream}/batch_id={batch_id}"

    def _ledger_path(self) -> str:
        return f"{self.runs_root}/ledger/stream={self._stream}"

    def _outcome_path(self) -> str:
        return f"{self.runs_root}/outcomes/stream={self._stream}"

    # ------------------------------------------------------------ one batch
    def lines(self) -> DataFrame:
        reader = self.spark.readStream.schema(RESPONSE_SCHEMA).option("columnNameOfCorruptRecord", "unreadable")
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return reader.json(self.landing_dir).select(
            "*", F.col("_metadata.file_modification_time").alias("file_time"),
            F.col("_metadata.file_path").alias("file_name"), F.col("_metadata.file_block_start").alias("file_block"))

    def _records(self, batch: DataFrame, now: dt.datetime) -> DataFrame:
        """One row per record, or per line that holds none: what it reads as, what is bad about
        it and why a good one is skipped, if it is; written once."""
        one = batch.select(
            F.coalesce("collection", F.lit(self.collection)).alias("collection_name"), F.col("project").alias("requested"),
            "status", "message", "unreadable", (F.size(F.coalesce("value", F.array())) > 0).alias("is_record"),
            F.explode_outer("value").alias("r"), *ARRIVED).select("*", "r.*").drop("r")
        one = one.withColumn("block_row", F.monotonically_increasing_id())
        read = read_records(one, ts_lit(now), keep=["is_record", *SOURCE, *ARRIVAL])
        bad = F.when(F.col("is_record"), F.array_compact(F.concat(
            F.array(F.when(F.col("id").isNull(), F.lit("id"))), F.col("bad_fields"))))
        bad = F.coalesce(bad, F.when(F.col("unreadable").isNotNull(), F.array(F.lit(UNREADABLE))), F.array())
        read = read.withColumn("bad_fields", bad)
        read = read.withColumn("is_bad", F.size("bad_fields") > 0)
        return materialize(self._scoped(read), "landed_records")

    def _scoped(self, items: DataFrame) -> DataFrame:
        """Why a record is skipped, if it is; catalog and control table are joined by their sizes."""
        skip = F.lit(None).cast("string")
        if self.only_news:
            control = self.control.read().filter(F.col("entity_name") == self.entity)
            items = items.join(control.select(*PROJECT, F.col("last_watermark_utc").alias("_wm")), PROJECT, "left")
            skip = F.when(~WM.is_news(F.col("changed_date"), F.col("_wm")), F.lit(OLD))
        if self.catalog:
            known = C.enabled_projects(self.catalog.read()).select(*PROJECT).distinct()
            items = items.join(known.withColumn("_enabled", F.lit(True)), PROJECT, "left")
            skip = F.when(F.col("_enabled").isNull(), F.lit(DISABLED)).otherwise(skip)
        return items.withColumn("skip", skip).drop("_wm", "_enabled")

    def process_batch(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id <= self._last_folded():
            return
        if self.polling:
            self.begin_run()
        now = utc_now()
        landed = self._records(batch, now)
        (landed.filter("is_bad")
         .select("id", "rev", "bad_fields", F.coalesce("fields_json", "unreadable").alias("fields"), "collection_name")
         .write.mode("overwrite").parquet(self._quarantine_path(batch_id)))
        scoped = landed.filter("is_record AND NOT is_bad")
        news = scoped.filter(F.col("skip").isNull()).select(*RAW_COLUMNS, "collection_name", *ARRIVAL)
        last = materialize(dedupe_last(news, ["id"], [*self.order_by, *ARRIVAL]), "staged_records")
        self.staging.merge(last.select(*RAW_COLUMNS), newer=self.order_by or None, written=True)
        self._write_ledger(batch_id, landed, scoped, last)
        if self.polling:
            self.finish_run()

    def _write_ledger(self, batch_id: int, landed: DataFrame, scoped: DataFrame, last: DataFrame) -> None:
        """What the batch did for each project."""
        refused = landed.filter((F.col("status") >= FIRST_ERROR_STATUS) & F.col("requested").isNotNull())
        said = F.coalesce("message", F.concat(F.lit("status "), F.col("status").cast("string")))
        parts = [
            last.select(*PROJECT, F.lit(1).alias("records"), F.col("changed_date").alias("latest")),
            scoped.filter(F.col("skip").isNotNull()).select(
                *PROJECT, (F.col("skip") == OLD).cast("long").alias("skipped_old"),
                (F.col("skip") == DISABLED).cast("long").alias("skipped_disabled")),
            refused.select("collection_name", F.col("requested").alias("project_name"),
                           (F.col("status") == FORBIDDEN_STATUS).alias("forbidden"), said.alias("error"),
                           F.struct(*ARRIVAL).alias("at")),
        ]
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p, allowMissingColumns=True)
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
        (rows.groupBy(*PROJECT).agg(
            total("records"), F.max("latest").alias("latest"), total("skipped_old"), total("skipped_disabled"),
            F.coalesce(F.bool_or("forbidden"), F.lit(False)).alias("forbidden"), F.min_by("error", "at").alias("error"))
         .write.mode("overwrite").parquet(f"{self._ledger_path()}/batch_id={batch_id}"))

    # ------------------------------------------------------------ one run
    def _folded_so_far(self) -> tuple[int, int]:
        """The last batch whose run has ended, and that run's number; read once per object."""
        if self._folded is None:
            got = self.outcomes().agg(F.max("last_batch").alias("batch"), F.max("run").alias("run")).first()
            self._folded = (-1 if got.batch is None else got.batch, got.run or 0)
        return self._folded

    def _last_folded(self) -> int:
        return self._folded_so_far()[0]

    def outcomes(self) -> DataFrame:
        """One row per run and project, and one per run with no project."""
        if not path_exists(self.spark, self._outcome_path()):
            return self.spark.createDataFrame([], OUTCOME + ", run int")
        return self.spark.read.schema(OUTCOME + ", run int").parquet(self._outcome_path())

    def _entries(self) -> DataFrame:
        if not path_exists(self.spark, self._ledger_path()):
            return self.spark.createDataFrame([], LEDGER + ", batch_id long")
        return (self.spark.read.schema(LEDGER + ", batch_id long").parquet(self._ledger_path())
                .filter(F.col("batch_id") > self._last_folded()))

    def _enabled(self) -> DataFrame | None:
        if not self.catalog:
            return None
        known = C.enabled_projects(self.catalog.read()).select(*PROJECT).distinct()
        return known.select(F.lit(self.entity).alias("entity_name"), *PROJECT)

    def begin_run(self) -> None:
        """Every enabled project is RUNNING."""
        self.started = utc_now()
        keys = self._enabled()
        if keys is not None:
            self.control.merge(WM.started_rows(self.control.read(), keys, self.started))

    def finish_run(self) -> None:
        """Fold the run's ledger entries into one outcome per project."""
        now = utc_now()
        started = self.started or now
        entries = self._entries()
        total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
        folded = entries.groupBy(*PROJECT).agg(
            total("records"), F.max("latest").alias("latest"), total("skipped_old"), total("skipped_disabled"),
            F.coalesce(F.bool_or("forbidden"), F.lit(False)).alias("forbidden"),
            F.min_by("error", F.when(F.col("error").isNotNull(), F.col("batch_id"))).alias("error"))
        requested = self._enabled()
        if requested is None:
            requested = folded.select(F.lit(self.entity).alias("entity_name"), *PROJECT)
        state = WM.lookup(self.control.read(), requested).select(*PROJECT, "last_watermark_utc", F.lit(True).alias("asked"))
        failed = F.coalesce("forbidden", F.lit(False)) | F.col("error").isNotNull()
        outcome = materialize(state.join(folded, PROJECT, "full").select(
            *PROJECT, F.when(F.col("asked").isNull(), F.lit("SKIPPED")).when(failed, F.lit("FAILED"))
            .otherwise(F.lit("SUCCESS")).alias("status"),
            F.coalesce("records", F.lit(0)).alias("records"),
            F.when(failed, F.col("last_watermark_utc"))
            .otherwise(F.greatest("last_watermark_utc", "latest")).alias("new_watermark"),
            F.coalesce("skipped_old", F.lit(0)).alias("skipped_old"),
            F.coalesce("skipped_disabled", F.lit(0)).alias("skipped_disabled"),
            F.when(F.col("forbidden"), F.lit(FORBIDDEN_MESSAGE)).otherwise(F.col("error")).alias("error_message"),
            F.coalesce("forbidden", F.lit(False)).alias("forbidden")), "run_outcome")
        asked = outcome.filter("status != 'SKIPPED'")
        self.control.merge(WM.ended_rows(self.control.read(), asked.select(
            F.lit(self.entity).alias("entity_name"), *PROJECT, F.col("status").alias("outcome_status"), "new_watermark",
            "records", F.col("error_message").alias("failure")), started, now))
        if self.catalog:
            self._set_access(asked, now)
        self._write_outcome(outcome, started, now)

    def _set_access(self, outcome: DataFrame, now: dt.datetime) -> None:
        """FORBIDDEN where the source refused; AUTHORIZED again where records came."""
        becomes = (F.when(F.col("forbidden"), F.lit(C.FORBIDDEN))
                   .when((F.col("status") == "SUCCESS") & (F.col("records") > 0), F.lit(C.AUTHORIZED)))
        catalog = self.catalog.read()
        seen = catalog.join(outcome.select(*PROJECT, becomes.alias("becomes")), PROJECT)
        changed = seen.filter(F.col("becomes") != F.col("access_status"))
        self.catalog.merge(changed.withColumn("access_status", F.col("becomes"))
                           .withColumn("last_discovered_utc", ts_lit(now)).select(*catalog.columns))

    def _write_outcome(self, outcome: DataFrame, started: dt.datetime, now: dt.datetime) -> None:
        folded, run = self._folded_so_far()
        last = self._entries().agg(F.max("batch_id").alias("b")).first().b
        last, run = folded if last is None else last, run + 1
        times = [F.lit(last).cast("long").alias("last_batch"), ts_lit(started).alias("started_utc"), ts_lit(now).alias("ended_utc")]
        rows = outcome.drop("forbidden").select("*", *times)
        whole = self.spark.range(1).select(F.lit("RUN").alias("status"), *times)
        (rows.unionByName(whole, allowMissingColumns=True).coalesce(1)
         .write.mode("overwrite").parquet(f"{self._outcome_path()}/run={run}"))
        self._folded = (last, run)

    def fail_run(self, message: str) -> None:
        """The whole run stopped: its projects are FAILED, no watermark moves."""
        keys = self._enabled()
        if keys is not None:
            now = utc_now()
            failed = keys.select(*WM.KEYS, F.lit("FAILED").alias("outcome_status"), ts_lit(now).alias("new_watermark"),
                                 F.lit(0).alias("records"), F.lit(message).alias("failure"))
            self.control.merge(WM.ended_rows(self.control.read(), failed, self.started or now, now))

    # ------------------------------------------------------------ the query
    def start(self, available_now: bool = True, processing_time: str = "300 seconds",
              max_files_per_trigger: int | None = None):
        """The streaming query; polling (``available_now=False``) makes every trigger a run."""
        self.max_files_per_trigger = max_files_per_trigger
        self.polling = not available_now
        w = (self.lines().writeStream.foreachBatch(self.process_batch)
             .option("checkpointLocation", self.checkpoint_location))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
        return w.start()

    def run_available(self, max_files_per_trigger: int | None = None) -> None:
        """One run: drain everything landed so far ("sync now") and stop."""
        self.begin_run()
        try:
            self.start(True, max_files_per_trigger=max_files_per_trigger).awaitTermination()
        except Exception as e:
            self.fail_run(str(e).splitlines()[0][:500] if str(e) else type(e).__name__)
            raise
        self.finish_run()
