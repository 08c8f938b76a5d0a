"""Two sync runs over responses derived from staging rows.

Run 1 lands every item created before the cut-off as it was on its first day. Then
one project is disabled and one is marked FORBIDDEN. Run 2 lands all items as they
are now, repeats of old revisions among them, while the source refuses one project
(403) and breaks down in the middle of another (500).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import ts_lit
from ..operators import catalog as C
from ..schemas import CATALOG_PROJECTS
from ..sources.adapter import fields_object
from ..sources.store import materialize, scratch_path
from ..streaming.ingest import Ingest
from .documents import land, refusals, responses

CUTOFF = dt.datetime(2001, 1, 1)
DISABLED = ("ASIA", "FURNITURE")
REFUSED = ("MIDDLE EAST", "BUILDING")
BROKEN = ("EUROPE", "MACHINERY")
BROKEN_MESSAGE = "upstream timed out"
REOPENED = ("AFRICA", "HOUSEHOLD")


def collection_of(area_path: str = "area_path"):
    """The collection of an item is its area path's root."""
    return F.split_part(F.col(area_path), F.lit("\\"), F.lit(1))


def is_project(pair: tuple[str, str], collection):
    return (collection == pair[0]) & (F.col("project_name") == pair[1])


def first_day(raw: DataFrame) -> DataFrame:
    """Items created before the cut-off, as they were when created."""
    none = F.lit(None).cast("timestamp_ntz")
    return (raw.filter(F.col("created_date") < ts_lit(CUTOFF)).withColumn("rev", F.lit(1))
            .withColumn("state", F.lit("New")).withColumn("changed_date", F.col("created_date"))
            .withColumn("activated_date", none).withColumn("closed_date", none).withColumn("state_change_date", none))


def stale(raw: DataFrame) -> DataFrame:
    """Old revisions that arrive along with the present one."""
    return raw.filter(F.col("id") % 10 == 0).withColumn("rev", F.lit(0)).withColumn("state", F.lit("Stale"))


def answers(records: DataFrame) -> DataFrame:
    """Responses with the records; their payload is made of the typed columns."""
    return responses(records.drop("fields_json", "ingested_at_utc"), collection_of(), fields=fields_object())


def two_runs(raw: DataFrame, discovered: DataFrame) -> Ingest:
    spark, root = raw.sparkSession, scratch_path(raw, "sync")
    landing = f"{root}/landing"
    ing = Ingest(spark, landing, f"{root}/staging", f"{root}/control", f"{root}/quarantine", f"{root}/checkpoint",
                 order_by=["rev"], buckets=8, catalog_root=f"{root}/catalog", runs_root=f"{root}/runs")
    empty = spark.createDataFrame([], CATALOG_PROJECTS)
    ing.catalog.merge(C.upsert_projects(empty, discovered, CUTOFF))
    land(answers(first_day(raw)), landing)
    ing.run_available()
    known = materialize(ing.catalog.read(), "catalog")
    off = is_project(DISABLED, F.col("collection_name"))
    shut = is_project(REOPENED, F.col("collection_name"))
    ing.catalog.merge(known.withColumn("is_enabled", ~off).withColumn(
        "access_status", F.when(shut, F.lit(C.FORBIDDEN)).otherwise(F.col("access_status"))))
    now = raw.unionByName(stale(raw)).filter(~is_project(REFUSED, collection_of()))
    land(answers(now), landing)
    land(refusals(spark.createDataFrame([(*REFUSED, 403, "no access"), (*BROKEN, 500, BROKEN_MESSAGE)],
                                        "collection_name string, project_name string, status int, message string")), landing)
    ing.run_available()
    return ing
