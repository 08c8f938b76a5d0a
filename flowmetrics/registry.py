"""Registered queries: name → fn(spark, sf_dir) → DataFrame.

Every query reads the driver's tables (through the work-item adapter or the
``events`` table), so its work grows with the data. Audit timestamps are left
out of compared outputs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import durations as dur
from .functions.calendar import ts_lit
from .functions.classify import dim_state_category, state_category, type_category
from .params import DEFAULT
from .plans import dims as D
from .plans import fact as FT
from .plans import snapshot as SN
from .plans import views as V
from .plans.transform import build_dimensions, build_star
from .sources.adapter import raw_work_items
from .sources.store import materialize, materialize_lines

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _raw(spark, sf_dir):
    """The staging table, written once and read back: for queries of several stages."""
    return materialize(raw_work_items(spark, sf_dir, DEFAULT), "raw_work_items")


def _rows(spark, sf_dir):
    """The staging rows for queries that read them once: only the columns in use are computed."""
    return raw_work_items(spark, sf_dir, DEFAULT)


def _fact_raw(spark, sf_dir):
    """The staging columns of the fact, written once and read back."""
    return materialize(raw_work_items(spark, sf_dir, DEFAULT).select(*FT.FACT_INPUTS), "raw_work_items")


def _star(spark, sf_dir):
    star = build_star(_fact_raw(spark, sf_dir), DEFAULT)
    return star.raw, star.dims, star.fact


# ----------------------------------------------------------------- staging level
@register("staging_count")
def q_staging_count(spark, sf_dir):
    return _rows(spark, sf_dir).agg(F.count(F.lit(1)).alias("raw_count"))


@register("type_category")
def q_type_category(spark, sf_dir):
    return (_rows(spark, sf_dir).groupBy("work_item_type")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("category", type_category(F.col("work_item_type"))))


@register("state_category")
def q_state_category(spark, sf_dir):
    return (_rows(spark, sf_dir).groupBy("state")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("state_category", state_category(F.col("state")))
            .withColumn("dim_category", dim_state_category(F.col("state"))))


@register("flow_durations")
def q_flow_durations(spark, sf_dir):
    r = _rows(spark, sf_dir)
    c, a, x = F.col("created_date"), F.col("activated_date"), F.col("closed_date")
    return r.select(F.col("id").alias("work_item_id"),
                    dur.lead_time(c, x).alias("lead_time_days"),
                    dur.cycle_time(c, a, x).alias("cycle_time_days"),
                    dur.queue_time(c, a).alias("queue_time_days"))


@register("wip_age")
def q_wip_age(spark, sf_dir):
    r = _rows(spark, sf_dir)
    cat = dim_state_category(F.col("state"))
    return r.select(F.col("id").alias("work_item_id"),
                    dur.wip_age(cat, F.col("created_date"), F.col("activated_date"),
                                F.col("closed_date"), DEFAULT.as_of).alias("wip_age_days"))


@register("item_flags")
def q_item_flags(spark, sf_dir):
    r = _rows(spark, sf_dir)
    cat = dim_state_category(F.col("state"))
    return r.select(F.col("id").alias("work_item_id"),
                    dur.is_closed(cat, F.col("closed_date")).alias("is_closed"),
                    dur.is_active(cat, F.col("closed_date")).alias("is_active"))


# ----------------------------------------------------------------- dimensions
@register("dim_date")
def q_dim_date(spark, sf_dir):
    # calendar covering the whole years of the staging data
    lo, hi = D.data_calendar_bounds(_raw(spark, sf_dir))
    return D.dim_date(spark, lo, hi)


def _dim_query(spec):
    def q(spark, sf_dir):
        # surrogate keys only identify (their order is arbitrary): compare members
        return D.refresh(spec, None, _rows(spark, sf_dir)).drop(spec.key)
    q.__name__ = f"q_{spec.name}"
    return q


for _name, _spec in (("dim_project", D.DIM_PROJECT), ("dim_type", D.DIM_TYPE),
                     ("dim_state", D.DIM_STATE), ("dim_iteration", D.DIM_ITERATION),
                     ("dim_area", D.DIM_AREA), ("dim_member", D.DIM_MEMBER)):
    register(_name)(_dim_query(_spec))


@register("dim_refresh")
def q_dim_refresh(spark, sf_dir):
    """Dimensions of the items before 1998, then refreshed with all: the members, and
    whether those of the first build kept their keys."""
    raw = _raw(spark, sf_dir)
    first = materialize(D.refresh_stacked(raw.filter(F.col("changed_date") < ts_lit("1998-01-01")), None), "first_dims")
    both = D.refresh_stacked(raw, first).join(
        first.select("dim", "natural", F.col("key").alias("old_key")), ["dim", "natural"], "left")
    return both.select("dim", "natural", "attr", (F.col("old_key").isNull() | (F.col("old_key") == F.col("key"))).alias("kept"))


@register("dim_keys")
def q_dim_keys(spark, sf_dir):
    dims = build_dimensions(_raw(spark, sf_dir), DEFAULT)
    parts = []
    for spec in D.ALL_DIMS:
        d = dims[spec.name]
        parts.append(d.agg(F.lit(spec.name).alias("dim_name"),
                           F.count(F.lit(1)).alias("n_rows"),
                           F.min(spec.key).alias("min_key"),
                           F.max(spec.key).alias("max_key"),
                           F.count_distinct(spec.key).alias("n_keys")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ----------------------------------------------------------------- fact and views
@register("fact_work_items")
def q_fact_work_items(spark, sf_dir):
    _, dims, fact = _star(spark, sf_dir)
    return FT.with_natural_keys(fact.drop("last_transformed_at_utc"), dims)


@register("weekly_throughput")
def q_weekly_throughput(spark, sf_dir):
    _, dims, fact = _star(spark, sf_dir)
    return V.throughput_weekly(fact, dims)


@register("weekly_throughput_iso")
def q_weekly_throughput_iso(spark, sf_dir):
    _, dims, fact = _star(spark, sf_dir)
    return V.throughput_weekly_iso(fact, dims)


@register("flow_summary")
def q_flow_summary(spark, sf_dir):
    _, dims, fact = _star(spark, sf_dir)
    return V.flow_metrics_summary(fact, dims)


@register("daily_snapshot")
def q_daily_snapshot(spark, sf_dir):
    _, dims, fact = _star(spark, sf_dir)
    snap = SN.daily_flow_snapshot(fact, DEFAULT).drop("snapshot_generated_at_utc")
    return FT.with_natural_keys(snap, dims)


@register("sprint_throughput")
def q_sprint_throughput(spark, sf_dir):
    _, dims, fact = _star(spark, sf_dir)
    return V.sprint_throughput(V.flow_metrics_summary(fact, dims))


# ----------------------------------------------------------------- export
EXPORT_PROJECT = "BUILDING"


@register("export_project")
def q_export_project(spark, sf_dir):
    from .plans.export import export_rows
    return export_rows(_rows(spark, sf_dir), DEFAULT, EXPORT_PROJECT).drop("last_transformed_at_utc")


@register("export_projects")
def q_export_projects(spark, sf_dir):
    from .plans.export import export_rows
    return export_rows(_rows(spark, sf_dir), DEFAULT).drop("last_transformed_at_utc")


# ----------------------------------------------------------------- sources
@register("map_fields")
def q_map_fields(spark, sf_dir):
    """Staging rows rebuilt from their JSON payload alone."""
    from .sources.landing import map_records
    raw = _rows(spark, sf_dir)
    rec = raw.select("id", "rev", "url", F.col("fields_json").alias("fields"))
    return map_records(rec, ts_lit(DEFAULT.as_of)).drop("fields_json", "ingested_at_utc")


@register("custom_fields")
def q_custom_fields(spark, sf_dir):
    """Fields outside the staging columns, one of each kind, and one of another kind."""
    from .sources.landing import read_fields
    k = F.col("id")
    payload = F.to_json(F.struct(
        (k % 5 == 0).alias("Custom.IsBlocked"), (k / 8).alias("Custom.Effort"),
        F.concat(F.date_format("created_date", "yyyy-MM-dd"), F.lit("T06:30:00")).alias("Custom.ReviewedAt"),
        F.date_format("created_date", "yyyy-MM-dd").alias("Custom.DueDate"),
        F.concat(F.date_format("created_date", "yyyy-MM-dd"), F.lit("T23:00:00-03:00")).alias("Custom.SeenAt"),
        F.when(k % 3 == 0, F.lit("yes")).alias("Custom.IsPlanned")))
    records = _rows(spark, sf_dir).select("id", "created_date", payload.alias("fields"))
    return read_fields(records, {
        "is_blocked": ("Custom.IsBlocked", "boolean"), "effort": ("Custom.Effort", "double"),
        "reviewed_at": ("Custom.ReviewedAt", "timestamp"), "due_at": ("Custom.DueDate", "timestamp"),
        "seen_at": ("Custom.SeenAt", "timestamp"), "is_planned": ("Custom.IsPlanned", "boolean"),
        "planned_text": ("Custom.IsPlanned", "string")}, keep=["id"])


@register("page_explode")
def q_page_explode(spark, sf_dir):
    """Records of landed pages (≤200 each), empty, null and broken ones among them."""
    from .sources.landing import read_pages
    from .testdata.documents import awkward, record_pages
    pages = awkward(record_pages(_raw(spark, sf_dir)), "project_name", '{"count": 0, "value": []}')
    return read_pages(materialize_lines(pages, "pages")).select("id", "rev", "url")


@register("id_batches")
def q_id_batches(spark, sf_dir):
    from .operators.batching import id_batches
    b = id_batches(_rows(spark, sf_dir).select("id", "project_name"), 200, partition_cols=["project_name"])
    return (b.groupBy("project_name", "batch")
            .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("min_id"), F.max("id").alias("max_id")))


@register("id_batch_clamp")
def q_id_batch_clamp(spark, sf_dir):
    """Batch sizes outside 1..200 are clamped."""
    from .operators.batching import id_batches
    ids = _rows(spark, sf_dir).select("id")
    parts = [id_batches(ids, n).groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("n").agg(F.count(F.lit(1)).alias("batches")).withColumn("asked", F.lit(n)) for n in (0, 7, 9_999)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("link_ids")
def q_link_ids(spark, sf_dir):
    from .sources.landing import read_id_lists
    from .sources.tables import table
    from .testdata.documents import id_list_documents
    return read_id_lists(materialize_lines(id_list_documents(table(spark, sf_dir, "orders")), "id_lists"))


@register("semi_ids")
def q_semi_ids(spark, sf_dir):
    """Items whose ids were requested (orders with a returned line)."""
    from .sources.tables import table
    req = (table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
           .select(F.col("l_orderkey").alias("id")))
    return _rows(spark, sf_dir).join(req, "id", "left_semi").select("id", "rev", "project_name", "state")


# ----------------------------------------------------------------- watermarks
PREVIOUS_SYNC = dt.datetime(2001, 1, 1)   # cut-off of the previous sync run
ENTITIES = ["work_items", "work_item_links"]


def _collection():
    from .testdata.scenario import collection_of
    return collection_of()


def _sync_keys(raw):
    return raw.select(_collection().alias("collection_name"), "project_name").distinct()


def _previous_control(raw, entities=("work_items",)):
    """Control table after a sync that saw the changes before the cut-off, written: a
    small table that the planner knows the size of."""
    from .operators import watermark as WM
    from .schemas import SYNC_WATERMARKS
    spark = raw.sparkSession
    before = raw.filter(F.col("changed_date") < ts_lit(PREVIOUS_SYNC))
    synced = before.select(F.explode(F.array(*[F.lit(e) for e in entities])).alias("entity_name"),
                           _collection().alias("collection_name"), "project_name", "changed_date")
    synced = materialize(synced.groupBy(*WM.KEYS).agg(F.max("changed_date").alias("new_watermark"),
                                                      F.count(F.lit(1)).alias("records")), "synced")
    started = WM.mark_start(spark.createDataFrame([], SYNC_WATERMARKS), synced, PREVIOUS_SYNC)
    return materialize(WM.mark_success(started, synced, PREVIOUS_SYNC), "sync_watermarks")


def _requested(raw):
    keys = _sync_keys(raw)
    return keys.select(F.explode(F.array(*[F.lit(e) for e in ENTITIES])).alias("entity_name"),
                       "collection_name", "project_name")


@register("watermark_lookup")
def q_watermark_lookup(spark, sf_dir):
    from .operators import watermark as WM
    raw = _raw(spark, sf_dir)
    return WM.lookup(_previous_control(raw), _requested(raw))


def _delta(raw, control):
    from .operators import watermark as WM
    items = raw.select(F.lit("work_items").alias("entity_name"), _collection().alias("collection_name"),
                       "project_name", "id", "changed_date")
    return WM.changed_since(items, control, WM.KEYS)


@register("delta_ids")
def q_delta_ids(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return (_delta(raw, _previous_control(raw))
            .select("collection_name", "project_name", "id", "changed_date")
            .orderBy("changed_date", "id"))


@register("watermark_advance")
def q_watermark_advance(spark, sf_dir):
    from .operators import watermark as WM
    raw = _raw(spark, sf_dir)
    control = _previous_control(raw)
    prev = WM.lookup(control, _requested(raw))
    return WM.advance(prev, _delta(raw, control), WM.KEYS)


SOURCE_ERROR = "the source did not answer"


@register("watermark_lifecycle")
def q_watermark_lifecycle(spark, sf_dir):
    """Start every requested key; one collection fails, the others succeed with the
    advanced watermark."""
    from .operators import watermark as WM
    raw = _raw(spark, sf_dir)
    control = _previous_control(raw)
    req = materialize(_requested(raw), "requested")
    started = materialize(WM.mark_start(control, req, DEFAULT.as_of), "started")
    res = materialize(WM.advance(WM.lookup(started, req), _delta(raw, control), WM.KEYS), "advanced")
    fails = F.col("collection_name") == FORBIDDEN_COLLECTION
    done = WM.mark_success(started, res.filter(~fails), DEFAULT.as_of)
    done = WM.mark_failure(done, res.filter(fails).withColumn("error_message", F.lit(SOURCE_ERROR)), DEFAULT.as_of)
    return done.select(*WM.KEYS, "status", "last_watermark_utc", "records_extracted_last_run",
                       "last_sync_start_utc", "last_sync_end_utc", "error_message")


@register("watermark_reset")
def q_watermark_reset(spark, sf_dir):
    """Full resync of one of two entities."""
    from .operators import watermark as WM
    raw = _raw(spark, sf_dir)
    control = _previous_control(raw, ENTITIES)
    return WM.reset(control, "work_items").select(*WM.KEYS, "last_watermark_utc", "status")


# ----------------------------------------------------------------- catalog
def _discovered(spark, sf_dir, before=None):
    from .operators.catalog import project_uuid
    from .sources.tables import table
    o = table(spark, sf_dir, "orders")
    if before:
        o = o.filter(F.col("o_orderdate") < ts_lit(before))
    geo = (table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
           .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"),
                 F.col("c_nationkey") == F.col("n_nationkey"))
           .join(table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    return (o.join(geo, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy(F.col("r_name").alias("collection_name"), F.col("c_mktsegment").alias("project_name"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(project_uuid(F.col("collection_name"), F.col("project_name")).alias("project_id"),
                    "collection_name", "project_name",
                    F.concat(F.lit("orders: "), F.col("n").cast("string")).alias("description"),
                    F.lit("wellFormed").alias("state")))


FORBIDDEN_COLLECTION = "MIDDLE EAST"


FIRST_DISCOVERY, REFUSED_AT = dt.datetime(1998, 1, 1), dt.datetime(1998, 2, 1)
GONE = ["AFRICA", FORBIDDEN_COLLECTION]      # not among the second discovery's answers


@register("catalog_upsert")
def q_catalog_upsert(spark, sf_dir):
    """Catalog discovered from orders before 1998, one collection's projects marked
    FORBIDDEN (by ids that repeat), then refreshed by a discovery without two collections."""
    from .operators import catalog as C
    from .schemas import CATALOG_PROJECTS
    empty = spark.createDataFrame([], CATALOG_PROJECTS)
    first = C.upsert_projects(empty, _discovered(spark, sf_dir, "1998-01-01"), FIRST_DISCOVERY)
    first = materialize(first, "catalog")
    forbidden = first.filter(F.col("collection_name") == FORBIDDEN_COLLECTION).select("project_id")
    first = C.set_access_status(first, forbidden.unionAll(forbidden), C.FORBIDDEN, REFUSED_AT)
    again = _discovered(spark, sf_dir).filter(~F.col("collection_name").isin(GONE))
    return C.upsert_projects(first, again, DEFAULT.as_of)


@register("collections_upsert")
def q_collections_upsert(spark, sf_dir):
    """Collections of a first discovery touched by a second one; descriptions stay."""
    from .operators import catalog as C
    from .schemas import CATALOG_COLLECTIONS
    seen = lambda d, text: d.select("collection_name", F.lit(text).alias("description")).distinct()
    empty = spark.createDataFrame([], CATALOG_COLLECTIONS)
    before = _discovered(spark, sf_dir).filter(F.col("collection_name") != "EUROPE")
    first = C.upsert_collections(empty, seen(before, "first"), FIRST_DISCOVERY)
    again = _discovered(spark, sf_dir).filter(~F.col("collection_name").isin(GONE))
    return C.upsert_collections(materialize(first, "collections"), seen(again, "second"), DEFAULT.as_of)


@register("enabled_projects")
def q_enabled_projects(spark, sf_dir):
    from .operators import catalog as C
    from .schemas import CATALOG_PROJECTS
    empty = spark.createDataFrame([], CATALOG_PROJECTS)
    cat = C.upsert_projects(empty, _discovered(spark, sf_dir), dt.datetime(2001, 12, 31))
    return (C.enabled_projects(cat).groupBy("collection_name")
            .agg(F.count(F.lit(1)).alias("projects")))


# ----------------------------------------------------------------- logs
def _logs(spark, sf_dir):
    from .plans.logs import logs_from_events
    from .sources.tables import table
    return logs_from_events(table(spark, sf_dir, "events"))


@register("log_days")
def q_log_days(spark, sf_dir):
    from .plans.logs import log_days
    return log_days(_logs(spark, sf_dir))


@register("log_day")
def q_log_day(spark, sf_dir):
    """Entries of the latest day that has entries."""
    from .plans.logs import log_day
    logs = _logs(spark, sf_dir)
    last = logs.select(F.max(F.to_date("created_at_utc"))).scalar()
    return log_day(logs, last)


@register("log_levels")
def q_log_levels(spark, sf_dir):
    """What the append sink keeps at the default minimum level."""
    from .plans.logs import level_at_least
    return (level_at_least(_logs(spark, sf_dir), "Information")
            .groupBy("log_level", "source_context").agg(F.count(F.lit(1)).alias("entries")))


# ----------------------------------------------------------------- checks, upserts, flow
@register("fk_orphans")
def q_fk_orphans(spark, sf_dir):
    from .operators.quality import fk_orphans
    from .params import REFERENCE_CALENDAR
    _, dims, fact = _star(spark, sf_dir)
    return fk_orphans(fact, dims, calendars={"reference_calendar": D.dim_date(spark, *REFERENCE_CALENDAR)})


@register("member_conflicts")
def q_member_conflicts(spark, sf_dir):
    """Creators whose name was spelt differently on some items."""
    renamed = F.when(F.col("id") % 97 == 0, F.concat("created_by_name", F.lit(" (renamed)"))).otherwise(F.col("created_by_name"))
    return D.member_conflicts(_rows(spark, sf_dir).withColumn("created_by_name", renamed))


@register("upsert_raw")
def q_upsert_raw(spark, sf_dir):
    """Staging after a batch with updates, new items and old revisions of the updated ones."""
    from .operators.merge import dedupe_last, merge_by_key
    raw = _raw(spark, sf_dir)
    batch = materialize(dedupe_last(update_batch(raw), ["id"], ["rev"]), "update_batch")
    return merge_by_key(raw, batch, ["id"]).select(
        "id", "rev", "state", "closed_date", "changed_date", "ingested_at_utc")


def update_batch(raw):
    """Open items of the last months closed, each also with a stale revision, and new items."""
    cutoff = ts_lit("2001-06-01 00:00:00")
    batch = raw.filter(F.col("closed_date").isNull() & (F.col("changed_date") >= cutoff))
    closed = F.col("changed_date") + F.expr("INTERVAL 2 DAYS")
    stamped = ts_lit(DEFAULT.as_of)
    updated = (batch.withColumn("rev", F.col("rev") + 1).withColumn("state", F.lit("Closed")).withColumn("closed_date", closed)
               .withColumn("state_change_date", closed).withColumn("changed_date", closed))
    stale = batch.withColumn("rev", F.lit(0)).withColumn("state", F.lit("Stale"))
    new = raw.filter(F.col("id") % 50 == 0).withColumn("id", -F.col("id") - 1).withColumn("rev", F.lit(1))
    return updated.unionByName(stale).unionByName(new).withColumn("ingested_at_utc", stamped)


@register("snapshot_merge")
def q_snapshot_merge(spark, sf_dir):
    """Snapshot stored at an earlier run, then merged with the current run."""
    import dataclasses
    _, dims, fact = _star(spark, sf_dir)
    earlier = dataclasses.replace(DEFAULT, snapshot_end=dt.date(2001, 6, 1))
    old = SN.daily_flow_snapshot(fact, earlier)
    new = SN.daily_flow_snapshot(fact, DEFAULT)
    merged = SN.merge_snapshot(old, new).drop("snapshot_generated_at_utc")
    return FT.with_natural_keys(merged, dims)


@register("cumulative_flow")
def q_cumulative_flow(spark, sf_dir):
    from .plans.flow import cumulative_flow
    end = DEFAULT.snapshot_end
    return cumulative_flow(_raw(spark, sf_dir), end - dt.timedelta(days=DEFAULT.snapshot_days), end)


@register("discovery_read")
def q_discovery_read(spark, sf_dir):
    """Catalog discovery documents (≤200 per page) read back: all projects
    with their collection."""
    from .sources.landing import read_collections, read_projects
    from .testdata.documents import discovery_documents
    disc = _discovered(spark, sf_dir)
    colls, projs = discovery_documents(disc.select("collection_name", "project_id", "project_name", "description"))
    p = read_projects(materialize(projs, "projects_docs"))
    c = read_collections(materialize(colls, "collections_docs"))
    return p.join(c.select("collection_name"), "collection_name", "left_semi").select(
        "collection_name", "project_id", "project_name", "description", "state")


# ----------------------------------------------------------------- sync runs
_RUNS: dict[tuple[str, str], object] = {}


def _two_runs(spark, sf_dir):
    """The scenario's stored tables, written once per application and input."""
    from .testdata.scenario import two_runs
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        # the responses' payload is made of the typed columns when they are landed
        raw = materialize(_rows(spark, sf_dir).drop("fields_json"), "raw_work_items")
        _RUNS[key] = two_runs(raw, materialize(_discovered(spark, sf_dir), "discovered"))
    return _RUNS[key]


@register("ingest_outcome")
def q_ingest_outcome(spark, sf_dir):
    """What each of two runs did for each project: see ``testdata.scenario``."""
    return _two_runs(spark, sf_dir).outcomes().filter(F.col("project_name").isNotNull()).select(
        "run", "collection_name", "project_name", "status", "records", "new_watermark", "skipped_old",
        "skipped_disabled", "error_message")


@register("sync_control")
def q_sync_control(spark, sf_dir):
    """The control table after both runs: one row per project, totals of its last run."""
    return _two_runs(spark, sf_dir).control.read().select(
        "entity_name", "collection_name", "project_name", "status", "last_watermark_utc",
        "records_extracted_last_run", "error_message")


@register("access_status")
def q_access_status(spark, sf_dir):
    """The catalog after both runs."""
    return _two_runs(spark, sf_dir).catalog.read().select(
        "project_id", "collection_name", "project_name", "is_enabled", "access_status")


@register("ingest_merge")
def q_ingest_merge(spark, sf_dir):
    """The staging table after both runs: inserts, updates, skipped and stale records."""
    return _two_runs(spark, sf_dir).staging.read().select(
        "id", "rev", "project_name", "state", "closed_date", "changed_date")


# ----------------------------------------------------------------- stored tables
@register("create_if_missing")
def q_create_if_missing(spark, sf_dir):
    """Rows of a stored table before it exists, after a first merge and after the same merge again."""
    from .schemas import RAW_WORK_ITEMS
    from .sources.store import KeyedTable, scratch_path
    raw = _raw(spark, sf_dir)
    table = KeyedTable(spark, scratch_path(raw, "stored"), RAW_WORK_ITEMS, ["id"], 8)
    steps = [table.read().agg(F.lit("missing").alias("step"), F.count(F.lit(1)).alias("n"))]
    steps[0] = materialize(steps[0], "step")
    table.merge(raw, written=True)
    steps.append(materialize(table.read().agg(F.lit("merged").alias("step"), F.count(F.lit(1)).alias("n")), "step"))
    table.merge(raw, written=True)
    steps.append(table.read().agg(F.lit("again").alias("step"), F.count(F.lit(1)).alias("n")))
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


@register("view_rows")
def q_view_rows(spark, sf_dir):
    """Rows of the two session views, by SQL; a second registration replaces them."""
    from .plans.cycle import register_views
    _, dims, fact = _star(spark, sf_dir)
    register_views(dims, fact.limit(0))
    register_views(dims, fact)
    return spark.sql("SELECT 'vw_throughput_weekly' AS view_name, count(*) AS n, sum(throughput_count) AS items "
                     "FROM vw_throughput_weekly UNION ALL "
                     "SELECT 'vw_flow_metrics_summary', count(*), count(DISTINCT work_item_id) FROM vw_flow_metrics_summary")


def _three_batches(raw):
    """Staging changes in three batches: items as created, half of them on their way, all as they are."""
    at = lambda df, day: df.withColumn("ingested_at_utc", ts_lit(f"2002-01-0{day} 00:00:00"))
    none = F.lit(None).cast("timestamp_ntz")
    first = (raw.withColumn("state", F.lit("New")).withColumn("activated_date", none).withColumn("closed_date", none)
             .withColumn("story_points", F.lit(None).cast("decimal(10,2)")))
    moving = (raw.filter(F.col("id") % 2 == 0).withColumn("state", F.lit("Doing")).withColumn("closed_date", F.expr(
        "CASE WHEN id % 4 = 0 THEN closed_date - INTERVAL 5 DAYS END")).withColumn("project_name", F.lit("MOVED")))
    return [at(first.filter(F.col("id") % 5 != 0), 1), at(moving, 2), at(raw, 3)]


def _incremental(spark, sf_dir):
    from .plans.incremental import FlowStore
    from .sources.store import scratch_path
    raw = _fact_raw(spark, sf_dir)
    batches = _three_batches(raw)
    every = raw.unionByName(batches[0]).unionByName(batches[1])
    dims = build_dimensions(every, DEFAULT)
    store = FlowStore(spark, scratch_path(raw, "flow_store"), buckets=8)
    for batch in batches:
        store.apply(batch, dims)
    return store, dims


@register("incremental_fact")
def q_incremental_fact(spark, sf_dir):
    """The fact after three batches of changes."""
    store, dims = _incremental(spark, sf_dir)
    return FT.with_natural_keys(store.read_fact(DEFAULT).drop("last_transformed_at_utc"), dims)


@register("incremental_snapshot")
def q_incremental_snapshot(spark, sf_dir):
    """The snapshot from the state kept over three batches of changes."""
    store, dims = _incremental(spark, sf_dir)
    return FT.with_natural_keys(store.snapshot(DEFAULT).drop("snapshot_generated_at_utc"), dims)


@register("project_p85_sketch")
def q_project_p85_sketch(spark, sf_dir):
    """85th percentile of cycle time per project and type from daily sketches: the sizes,
    and whether the answer's rank is within twice the sketch's stated error."""
    from .plans import sketches as S
    _, dims, fact = _star(spark, sf_dir)
    by = ["project_key", "type_key"]
    answers = materialize(S.merged_quantile(S.cycle_time_sketches(fact), by), "quantiles")
    values = fact.filter(F.col("is_closed") & (F.col("closed_date_key") != -1)).select(
        *by, F.col("cycle_time_days").cast("double").alias("value"))
    gaps = S.rank_gap(values, answers, by)
    checked = answers.join(gaps, by).select(*by, "items", "measured", (
        (F.col("measured") == F.col("n")) & (F.col("gap") <= 2 * S.rank_error())).alias("within_error"))
    return FT.with_natural_keys(checked, dims)


@register("export_files")
def q_export_files(spark, sf_dir):
    """The written export of all projects, read back: files per project, and whether
    their id ranges overlap."""
    from pyspark.sql import Window

    from .plans.export import export_all_projects
    from .sources.store import scratch_path
    raw = _rows(spark, sf_dir)
    path = export_all_projects(raw, scratch_path(raw, "export"), DEFAULT, rows_per_file=EXPORT_ROWS)
    files = (spark.read.parquet(path).groupBy("project_name", F.col("_metadata.file_name").alias("file"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("work_item_id").alias("lo"), F.max("work_item_id").alias("hi")))
    before = F.lag("hi").over(Window.partitionBy("project_name").orderBy("lo"))
    return (files.withColumn("clash", F.coalesce(F.col("lo") <= before, F.lit(False)))
            .groupBy("project_name").agg(
                F.count(F.lit(1)).alias("files"), F.count_if(F.col("n") < EXPORT_ROWS).alias("small_files"), F.sum("n").alias("n"),
                F.min("lo").alias("min_id"), F.max("hi").alias("max_id"), F.bool_or("clash").alias("overlap")))


EXPORT_ROWS = 700


@register("log_days_stream")
def q_log_days_stream(spark, sf_dir):
    """Entries per day counted by the windowed stream over the landed log."""
    from .sources.store import scratch_path
    from .streaming.logs import log_day_table, start_log_days
    logs = _logs(spark, sf_dir)
    root = scratch_path(logs, "log_stream")
    logs.write.parquet(f"{root}/landed")
    stream = spark.readStream.schema(logs.schema).parquet(f"{root}/landed")
    days = log_day_table(spark, f"{root}/days")
    start_log_days(stream, days, f"{root}/checkpoint").awaitTermination()
    return days.read()
