"""One sync cycle in the source's phase order: discover → ingest → transform.

* discover  – upsert collections and projects from discovery documents;
* ingest    – one run over the landed responses of the enabled projects
              (``streaming.ingest.Ingest``), with an outcome per project;
* transform – dimensions (stored, refreshed incrementally), fact and snapshot
              state maintained from the changed items (``plans.incremental``),
              daily snapshot merged into the stored snapshot (rows never
              deleted), views registered. With an empty staging table the
              dimensions are refreshed and the rest is left as it is.

Each table lives under ``root``; every stage reads what the previous wrote.
Tables that are replaced as a whole are written beside the one in use
(``SlotTable``), so a failed stage leaves the earlier ones as they were; re-running
the cycle is safe because every other write is a keyed merge.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession

from ..operators import catalog as C
from ..params import DEFAULT, RunParams
from ..schemas import CATALOG_COLLECTIONS, CATALOG_PROJECTS
from ..sources.store import KeyedTable, SlotTable, materialize
from ..streaming.ingest import Ingest
from . import dims as D
from . import snapshot as SN
from . import views as V
from .incremental import FlowStore

SNAPSHOT_SCHEMA_DDL = SN.SNAPSHOT_SCHEMA


@dataclasses.dataclass
class CycleResult:
    """``fact`` and ``snapshot`` are None where staging has never held a row."""
    dims: dict[str, DataFrame]
    fact: DataFrame | None
    snapshot: DataFrame | None


def _path(root: str, name: str) -> str:
    return os.path.join(root, name)


def discover(spark: SparkSession, root: str, collections: DataFrame, projects: DataFrame,
             now: dt.datetime) -> DataFrame:
    """Refresh the catalog; returns the enabled projects."""
    coll = KeyedTable(spark, _path(root, "catalog_collections"), CATALOG_COLLECTIONS, ["collection_name"], 4)
    proj = KeyedTable(spark, _path(root, "catalog_projects"), CATALOG_PROJECTS, ["project_id"], 4)
    coll.merge(C.upsert_collections(coll.read(), collections, now))
    proj.merge(C.upsert_projects(proj.read(), projects, now))
    return C.enabled_projects(proj.read())


def refresh_dimensions(spark: SparkSession, root: str, raw: DataFrame) -> dict[str, DataFrame]:
    """The stored dimensions, with the members that staging brings."""
    table = SlotTable(spark, _path(root, "dimensions"))
    current = None
    if table.exists():
        current = {s.name: table.read(s.name) for s in D.ALL_DIMS}
    stacked = materialize(D.refresh_stacked(raw, D.stack_current(current, D.ALL_DIMS)), "dimensions")
    table.write(**{s.name: D.from_stacked(s, stacked) for s in D.ALL_DIMS})
    dims = {s.name: table.read(s.name) for s in D.ALL_DIMS}
    dims["dim_date"] = D.dim_date(spark, *D.data_calendar_bounds(raw))
    return dims


def transform(spark: SparkSession, root: str, raw: DataFrame,
              params: RunParams = DEFAULT) -> CycleResult:
    """Dimensions → fact → snapshot, with the stored tables as the current state."""
    dims = refresh_dimensions(spark, root, raw)
    store = FlowStore(spark, root)
    snap_table = KeyedTable(spark, _path(root, "fact_daily_flow_snapshot"),
                            spark.createDataFrame([], SNAPSHOT_SCHEMA_DDL).schema, SN.SNAPSHOT_KEY, 16)
    if not raw.isEmpty():
        store.apply(store.changed(raw), dims)
        snap_table.merge(store.snapshot(params))
    if not store.state.exists():
        return CycleResult(dims, None, None)
    fact = store.read_fact(params)
    register_views(dims, fact)
    return CycleResult(dims, fact, snap_table.read())


def register_views(dims: dict[str, DataFrame], fact: DataFrame) -> None:
    """``CREATE OR REPLACE VIEW`` ×2 as session temp views."""
    V.throughput_weekly(fact, dims).createOrReplaceTempView("vw_throughput_weekly")
    V.flow_metrics_summary(fact, dims).createOrReplaceTempView("vw_flow_metrics_summary")


def run_cycle(spark: SparkSession, root: str, landing_dir: str,
              collections: DataFrame, projects: DataFrame,
              params: RunParams = DEFAULT, now: dt.datetime | None = None) -> CycleResult:
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    discover(spark, root, collections, projects, now)
    ing = Ingest(spark, landing_dir, _path(root, "raw_work_items"), _path(root, "sync_watermarks"),
                 _path(root, "quarantine"), _path(root, "_ingest_checkpoint"),
                 catalog_root=_path(root, "catalog_projects"), runs_root=_path(root, "runs"))
    ing.run_available()
    return transform(spark, root, ing.staging.read(), params)
