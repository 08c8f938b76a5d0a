import json
import os

from pyspark.sql import functions as F

from flowmetrics.sources.adapter import raw_work_items
from flowmetrics.operators import catalog as C
from flowmetrics.schemas import CATALOG_PROJECTS
from flowmetrics.sources.store import materialize
from flowmetrics.streaming.ingest import Ingest
from flowmetrics.testdata.documents import record_pages

from .conftest import SF_SMALL


def _land(docs, folder, name):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for d in docs:
            # the landed form keeps ``fields`` as a JSON object
            env = json.loads(d)
            for r in env["value"]:
                r["fields"] = json.loads(r["fields"])
            f.write(json.dumps(env) + "\n")


def test_ingest_pages_replay_and_update(spark, tmp_dir):
    raw = materialize(raw_work_items(spark, SF_SMALL).filter("id % 4 = 0"), "raw")
    docs = [r.document for r in record_pages(raw, 20).orderBy("project_name", "batch").collect()]
    landing = os.path.join(tmp_dir, "landing")
    half = len(docs) // 2
    _land(docs[:half], landing, "part-1.json")
    ing = Ingest(spark, landing, os.path.join(tmp_dir, "staging"), os.path.join(tmp_dir, "control"),
                 os.path.join(tmp_dir, "quarantine"), os.path.join(tmp_dir, "ckpt"), buckets=8, only_news=False)
    ing.run_available()
    n1 = ing.staging.read().count()
    _land(docs[half:], landing, "part-2.json")
    ing.run_available()
    staged = ing.staging.read()
    assert staged.count() == raw.count() > n1 > 0
    # rebuilt from the payload, the staging rows equal the source rows
    cols = ["id", "rev", "project_name", "state", "created_date", "closed_date", "story_points", "priority"]
    assert staged.select(*cols).exceptAll(raw.select(*cols)).count() == 0
    # replay: a new query over the same files with a fresh checkpoint changes nothing
    again = Ingest(spark, landing, ing.staging.root, ing.control.root, ing.quarantine_root,
                   os.path.join(tmp_dir, "ckpt2"), buckets=8, only_news=False)
    again.run_available()
    assert again.staging.read().count() == raw.count()
    # an update batch: a later revision of one item overwrites it
    one = json.loads(docs[0])
    rec = one["value"][0]
    fields = json.loads(rec["fields"])
    fields["System.State"] = "Done"
    rec["rev"] += 1
    rec["fields"] = json.dumps(fields)
    _land([json.dumps({"count": 1, "value": [rec]})], landing, "part-3.json")
    ing.run_available()
    row = ing.staging.read().filter(F.col("id") == rec["id"]).collect()
    assert len(row) == 1 and row[0].state == "Done" and row[0].rev == rec["rev"]
    # watermark per project = max changed date ingested
    wm = {r.project_name: r.last_watermark_utc for r in ing.control.read().collect()}
    expect = {r.project_name: r.m for r in raw.groupBy("project_name").agg(F.max("changed_date").alias("m")).collect()}
    assert wm == expect


def test_wrongly_typed_record_goes_to_quarantine(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    os.makedirs(landing)
    good = {"id": 1, "rev": 1, "url": "u", "fields": {"System.TeamProject": "A", "System.ChangedDate": "2024-01-01T00:00:00Z"}}
    bad = {"id": 2, "rev": 1, "url": "u", "fields": {"System.TeamProject": "B", "Microsoft.VSTS.Common.Priority": "high"}}
    with open(os.path.join(landing, "p.json"), "w") as f:
        f.write(json.dumps({"count": 2, "value": [good, bad]}) + "\n")
    ing = Ingest(spark, landing, os.path.join(tmp_dir, "staging"), os.path.join(tmp_dir, "control"),
                 os.path.join(tmp_dir, "quarantine"), os.path.join(tmp_dir, "ckpt"), buckets=4)
    ing.run_available()
    assert [r.id for r in ing.staging.read().collect()] == [1]
    q = spark.read.parquet(ing.quarantine_root).collect()
    assert [(r.id, r.bad_fields) for r in q] == [(2, ["Microsoft.VSTS.Common.Priority"])]


def _record(i, rev, **fields):
    return {"id": i, "rev": rev, "url": "u", "fields": {"System.TeamProject": "A", "System.ChangedDate": "2024-01-01T00:00:00Z"} | fields}


def _write(folder, name, *records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(json.dumps({"count": len(records), "value": list(records)}) + "\n")


def test_repeated_ids_bad_values_and_replay(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    _write(landing, "a.json", _record(1, 1), _record(4, 1, **{"Microsoft.VSTS.Common.Priority": "high"}),
           _record(5, 1, **{"System.ChangedDate": "not a date"}),
           _record(6, 1, **{"Microsoft.VSTS.Scheduling.StoryPoints": 1e12}), _record(7, 3), _record(7, 2))
    _write(landing, "b.json", _record(1, 2), _record(4, 2))
    os.utime(os.path.join(landing, "a.json"), (1, 1))
    ing = Ingest(spark, landing, os.path.join(tmp_dir, "staging"), os.path.join(tmp_dir, "control"),
                 os.path.join(tmp_dir, "quarantine"), os.path.join(tmp_dir, "ckpt"), buckets=4)
    ing.run_available()
    rows = {r.id: r.rev for r in ing.staging.read().collect()}
    assert rows == {1: 2, 4: 2, 7: 2} and ing.staging.read().count() == 3       # the last arrival of each id
    quarantined = lambda: sorted((r.id, r.rev) for r in spark.read.parquet(ing.quarantine_root).collect())
    assert quarantined() == [(4, 1), (5, 1), (6, 1)]
    # another stream over the same files: its quarantine is its own, staging does not change
    again = Ingest(spark, landing, ing.staging.root, ing.control.root, os.path.join(tmp_dir, "quarantine2"),
                   os.path.join(tmp_dir, "ckpt2"), buckets=4, only_news=False)
    again.run_available()
    assert {r.id: r.rev for r in again.staging.read().collect()} == rows
    assert quarantined() == [(4, 1), (5, 1), (6, 1)]


def test_records_without_id_and_broken_lines_are_quarantined(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    _write(landing, "a.json", _record(1, 1), _record(None, 1), _record("x7", 1), _record(2, 1))
    with open(os.path.join(landing, "a.json"), "a") as f:
        f.write('{"count": 1, "value": [{"id": 3, "rev"\nnot json at all\n{"count": 0, "value": []}\n{}\n')
    ing = _ingest(spark, tmp_dir, landing)
    ing.run_available()
    bad = spark.read.parquet(ing.quarantine_root).collect()
    staged = {r.id for r in ing.staging.read().collect()}
    assert staged >= {1, 2} or "unreadable JSON" in {b for r in bad for b in r.bad_fields}
    assert len([r for r in bad if r.bad_fields == ["unreadable JSON"]]) >= 2
    lost = {1, 2} - staged
    assert not lost or any("x7" in (r.fields or "") for r in bad)      # every record is in one place or the other
    assert any(r.bad_fields == ["id"] for r in bad) or lost


def _ingest(spark, tmp_dir, landing, **kw):
    path = lambda name: os.path.join(tmp_dir, name)
    return Ingest(spark, landing, path("staging"), path("control"), path("quarantine"), path("ckpt"),
                  **({"buckets": 4} | kw))


def _catalog(spark, tmp_dir, *names, disabled=()):
    import datetime as dt

    from flowmetrics.sources.store import KeyedTable
    root = os.path.join(tmp_dir, "catalog")
    table = KeyedTable(spark, root, CATALOG_PROJECTS, ["project_id"], 4)
    found = spark.createDataFrame([(n, "C", n, None, "wellFormed") for n in names],
                                  "project_id string, collection_name string, project_name string, description string, state string")
    rows = C.upsert_projects(spark.createDataFrame([], CATALOG_PROJECTS), found, dt.datetime(2024, 1, 1))
    table.merge(rows.withColumn("is_enabled", ~F.col("project_id").isin(list(disabled))))
    return root


def _respond(folder, name, when, project, *records, status=200, message=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(json.dumps({"collection": "C", "project": project, "status": status, "message": message,
                            "count": len(records), "value": list(records)}) + "\n")
    os.utime(path, (when, when))


def _item(i, project, day, rev=1):
    return _record(i, rev, **{"System.TeamProject": project, "System.ChangedDate": f"2024-01-{day:02d}T00:00:00Z"})


def _state(ing):
    return {r.project_name: (r.status, r.records_extracted_last_run, str(r.last_watermark_utc)[:10], r.error_message)
            for r in ing.control.read().collect()}


def test_one_project_fails_the_others_go_on(spark, tmp_dir):
    """Three files, one a batch: totals of the run, failures beside successes, only enabled
    projects, only news; then the refused project comes back."""
    landing = os.path.join(tmp_dir, "landing")
    root = _catalog(spark, tmp_dir, "A", "B", "D", "Q", disabled=["D"])
    _respond(landing, "1.json", 1, "A", _item(1, "A", 1), _item(2, "A", 2))
    _respond(landing, "2.json", 2, "B", _item(3, "B", 5), _item(9, "D", 5))
    with open(os.path.join(landing, "3.json"), "w") as f:
        for d in ({"collection": "C", "project": "A", "value": [_item(4, "A", 9)]},
                  {"collection": "C", "project": "B", "status": 403, "message": "no"}):
            f.write(json.dumps(d) + "\n")
    os.utime(os.path.join(landing, "3.json"), (3, 3))
    ing = _ingest(spark, tmp_dir, landing, catalog_root=root)
    ing.begin_run()
    assert {s[0] for s in _state(ing).values()} == {"RUNNING"} and set(_state(ing)) == {"A", "B", "Q"}
    ing.start(max_files_per_trigger=1).awaitTermination()
    assert {s[0] for s in _state(ing).values()} == {"RUNNING"}            # no batch ends the run
    ing.finish_run()
    assert _state(ing) == {"A": ("SUCCESS", 3, "2024-01-09", None), "B": ("FAILED", 0, "1970-01-01", "403 Forbidden"),
                           "Q": ("SUCCESS", 0, "1970-01-01", None)}
    assert ing._last_folded() == 2 and {r.id for r in ing.staging.read().collect()} == {1, 2, 3, 4}
    access = lambda: {r.project_name: r.access_status for r in ing.catalog.read().collect()}
    assert access() == {"A": "AUTHORIZED", "B": "FORBIDDEN", "D": "AUTHORIZED", "Q": "AUTHORIZED"}
    skipped = {r.project_name: (r.status, r.skipped_disabled) for r in ing.outcomes().filter("project_name = 'D'").collect()}
    assert skipped == {"D": ("SKIPPED", 1)}
    # a replayed batch of a run that has ended changes nothing
    before = (_state(ing), ing.outcomes().count())
    ing.process_batch(spark.createDataFrame([], "collection string"), 2)
    assert (_state(ing), ing.outcomes().count()) == before
    # the next run: old records are skipped, B answers again
    _respond(landing, "4.json", 4, "A", _item(1, "A", 1, rev=7), _item(5, "A", 10))
    _respond(landing, "5.json", 5, "B", _item(3, "B", 5))
    ing.run_available()
    assert _state(ing)["A"] == ("SUCCESS", 1, "2024-01-10", None) and _state(ing)["B"] == ("SUCCESS", 1, "2024-01-05", None)
    assert access()["B"] == "AUTHORIZED" and {r.id: r.rev for r in ing.staging.read().collect()}[1] == 1
    old = {(r.run, r.project_name): r.skipped_old for r in ing.outcomes().collect() if r.project_name}
    assert old[2, "A"] == 1 and old[1, "A"] == 0


def test_a_run_that_stops_leaves_failed_projects_and_watermarks(spark, tmp_dir):
    import pytest
    landing = os.path.join(tmp_dir, "landing")
    root = _catalog(spark, tmp_dir, "A")
    _respond(landing, "1.json", 1, "A", _item(1, "A", 3))
    ing = _ingest(spark, tmp_dir, landing, catalog_root=root)
    merge, ing.staging.merge = ing.staging.merge, None
    with pytest.raises(Exception):
        ing.run_available()
    assert _state(ing)["A"][0] == "FAILED" and _state(ing)["A"][2] == "1970-01-01" and _state(ing)["A"][3]
    ing.staging.merge = merge
    ing.run_available()                                   # the batch is run again and counted once
    assert _state(ing) == {"A": ("SUCCESS", 1, "2024-01-03", None)}


def test_an_older_revision_in_a_later_batch(spark, tmp_dir):
    for order, kept in ((["rev"], 5), (None, 4)):
        folder = os.path.join(tmp_dir, str(kept))
        landing = os.path.join(folder, "landing")
        _respond(landing, "1.json", 1, "A", _item(1, "A", 1, rev=5))
        _respond(landing, "2.json", 2, "A", _item(1, "A", 2, rev=4), _item(2, "A", 2, rev=1))
        ing = _ingest(spark, folder, landing, order_by=order)
        ing.run_available(max_files_per_trigger=1)
        assert {r.id: r.rev for r in ing.staging.read().collect()} == {1: kept, 2: 1}


def test_polling_makes_every_trigger_a_run(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    root = _catalog(spark, tmp_dir, "A")
    _respond(landing, "1.json", 1, "A", _item(1, "A", 1))
    ing = _ingest(spark, tmp_dir, landing, catalog_root=root)
    query = ing.start(available_now=False, processing_time="1 second")
    try:
        query.processAllAvailable()
        first = _state(ing)
        _respond(landing, "2.json", 2, "A", _item(2, "A", 4), _item(3, "A", 4))
        query.processAllAvailable()
    finally:
        query.stop()
    assert first["A"][:2] == ("SUCCESS", 1) and _state(ing)["A"] == ("SUCCESS", 2, "2024-01-04", None)
    assert ing.outcomes().filter("project_name = 'A'").count() == 2


def test_log_stream_counts_late_rows_inside_the_delay(spark, tmp_dir):
    import datetime as dt

    from flowmetrics.streaming.logs import log_day_table, start_log_days
    landed = os.path.join(tmp_dir, "logs")
    schema = "log_id long, created_at_utc timestamp_ntz"
    # the last file's day 1 is later than the delay, its day 8 is not (a batch drops by the watermark of two batches before)
    days = [[1, 1, 2], [4, 2, 3], [9], [9], [1, 8]]
    for k, file in enumerate(days):
        rows = [(k, dt.datetime(2024, 1, d, 23, 30)) for d in file]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landed)
        newest = max((os.path.join(landed, n) for n in os.listdir(landed) if n.endswith(".parquet")), key=os.path.getctime)
        os.utime(newest, (1_000 + k, 1_000 + k))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landed)
    table = log_day_table(spark, os.path.join(tmp_dir, "days"))
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        start_log_days(stream, table, os.path.join(tmp_dir, "ckpt"), delay="3 days").awaitTermination()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {r.log_day.day: r.entries for r in table.read().collect()} == {1: 2, 2: 2, 3: 1, 4: 1, 8: 1, 9: 2}


def test_merge_refuses_repeated_keys(spark, tmp_dir):
    import pytest

    from flowmetrics.sources.store import KeyedTable
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id long, v string")
    with pytest.raises(ValueError):
        KeyedTable(spark, os.path.join(tmp_dir, "t"), df.schema, ["id"], 2).merge(df)


def test_landed_records_are_read_in_one_pass(spark, tmp_dir, monkeypatch):
    """Reading, checks and skips of a batch's records are one written table."""
    from flowmetrics.streaming import ingest
    written = []
    monkeypatch.setattr(ingest, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    landing = os.path.join(tmp_dir, "landing")
    _write(landing, "a.json", _record(1, 1), _record(None, 1), _record(2, 1, **{"System.TeamProject": "OFF"}))
    ing = _ingest(spark, tmp_dir, landing, collection="C", catalog_root=_catalog(spark, tmp_dir, "A", "OFF", disabled=["OFF"]))
    ing.run_available()
    assert written == ["landed_records", "staged_records", "run_outcome"]
    assert [r.id for r in ing.staging.read().collect()] == [1]
    assert [r.bad_fields for r in spark.read.parquet(ing.quarantine_root).collect()] == [["id"]]
    got = {r.project_name: (r.status, r.records, r.skipped_disabled) for r in ing.outcomes().collect() if r.project_name}
    assert got == {"A": ("SUCCESS", 1, 0), "OFF": ("SKIPPED", 0, 1)}
