import datetime as dt

from pyspark.sql import functions as F

from flowmetrics.operators import catalog as C
from flowmetrics.operators import watermark as WM
from flowmetrics.schemas import CATALOG_PROJECTS, SYNC_WATERMARKS

KEY = ("work_items", "DefaultCollection", "TestProject")


def test_watermark_lifecycle(spark):
    empty = spark.createDataFrame([], SYNC_WATERMARKS)
    keys = spark.createDataFrame([KEY], "entity_name string, collection_name string, project_name string")
    first = WM.lookup(empty, keys).first()
    assert first.status == "IDLE" and first.last_watermark_utc == WM.EPOCH
    started = WM.mark_start(empty, keys, dt.datetime(2024, 6, 1, 11))
    assert started.first().status == "RUNNING"
    wm = dt.datetime(2024, 6, 1, 12)
    res = keys.select(*WM.KEYS, F.lit(wm).cast("timestamp_ntz").alias("new_watermark"), F.lit(15).alias("records"))
    done = WM.mark_success(started, res, dt.datetime(2024, 6, 1, 12, 5)).first()
    assert (done.status, done.records_extracted_last_run, done.last_watermark_utc) == ("SUCCESS", 15, wm)
    failed = WM.mark_failure(WM.mark_success(started, res, wm),
                             keys.withColumn("error_message", F.lit("boom")), wm).first()
    assert failed.status == "FAILED" and failed.last_watermark_utc == wm and failed.error_message == "boom"
    assert WM.reset(WM.mark_success(started, res, wm), "work_items").first().last_watermark_utc == WM.EPOCH


def test_delta_truncates_watermark_to_seconds_and_advance(spark):
    wm = dt.datetime(2024, 1, 1, 10, 0, 0, 500000)
    w = spark.createDataFrame([("P", wm)], "project_name string, last_watermark_utc timestamp_ntz")
    items = spark.createDataFrame([
        (1, "P", dt.datetime(2024, 1, 1, 10, 0, 0, 200000)),   # same second: read again
        (2, "P", dt.datetime(2024, 1, 1, 9, 59, 59)),
        (3, "Q", dt.datetime(1999, 1, 1)),                      # no watermark: everything
    ], "id long, project_name string, changed_date timestamp_ntz")
    got = sorted(r.id for r in WM.changed_since(items, w, ["project_name"]).collect())
    assert got == [1, 3]
    prev = spark.createDataFrame([("P", wm), ("R", wm)], "project_name string, last_watermark_utc timestamp_ntz")
    adv = {r.project_name: r for r in WM.advance(prev, items.filter("id = 1"), ["project_name"]).collect()}
    assert adv["P"].new_watermark == wm and adv["P"].records == 1      # max(previous, synced)
    assert adv["R"].new_watermark == wm and adv["R"].records == 0      # nothing found: unchanged


def test_catalog_upsert_keeps_operator_columns(spark):
    empty = spark.createDataFrame([], CATALOG_PROJECTS)
    disc = spark.createDataFrame([("p1", "C", "Old", "d1", "wellFormed")],
                                 "project_id string, collection_name string, project_name string, "
                                 "description string, state string")
    cat = C.upsert_projects(empty, disc, dt.datetime(2024, 1, 1))
    cat = C.set_access_status(cat, spark.createDataFrame([("p1",)], "project_id string"), C.FORBIDDEN, dt.datetime(2024, 1, 2))
    disc2 = spark.createDataFrame([("p1", "Other", "New", "d2", "wellFormed"), ("p2", "C", "B", None, "new")],
                                  "project_id string, collection_name string, project_name string, "
                                  "description string, state string")
    rows = {r.project_id: r for r in C.upsert_projects(cat, disc2, dt.datetime(2024, 2, 1)).collect()}
    assert rows["p1"].project_name == "New" and rows["p1"].access_status == "FORBIDDEN"
    assert rows["p1"].collection_name == "C" and rows["p1"].is_enabled
    assert rows["p2"].access_status == "AUTHORIZED"
    assert C.enabled_projects(C.upsert_projects(cat, disc2, dt.datetime(2024, 2, 1))).count() == 2
