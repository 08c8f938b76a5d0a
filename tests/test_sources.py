import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from flowmetrics.operators.batching import clamp_batch_size, id_batches
from flowmetrics.sources.landing import field_type_errors, map_records, read_id_lists

RECORD = {
    "System.TeamProject": "Harbour", "System.WorkItemType": "User Story",
    "System.Title": "Paint the north pier", "System.State": "Closed", "System.Reason": "Inspected",
    "System.AssignedTo": {"displayName": "Mara", "uniqueName": "mara@harbour.test"},
    "System.CreatedBy": {"displayName": "Olek"},
    "System.CreatedDate": "2024-01-10T10:00:00Z", "System.ChangedDate": "2024-01-15T18:30:00Z",
    "Microsoft.VSTS.Common.ActivatedDate": "2024-01-11T14:00:00Z",
    "Microsoft.VSTS.Common.ClosedDate": "2024-01-15T18:30:00Z",
    "Microsoft.VSTS.Scheduling.StoryPoints": 8, "Microsoft.VSTS.Scheduling.OriginalEstimate": 16,
    "Microsoft.VSTS.Scheduling.RemainingWork": 0, "Microsoft.VSTS.Scheduling.CompletedWork": 16,
    "Microsoft.VSTS.Common.Priority": 1, "Microsoft.VSTS.Common.Severity": "2 - High",
    "System.AreaPath": "Harbour\\Piers", "System.IterationPath": "Harbour\\Sprint 12",
    "System.Tags": "Paint; Weather",
}


def test_map_record_to_typed_columns(spark):
    rec = spark.createDataFrame([(1, 3, "u", json.dumps(RECORD))], "id long, rev int, url string, fields string")
    r = map_records(rec, F.lit(dt.datetime(2024, 2, 1)).cast("timestamp_ntz")).first()
    assert (r.project_name, r.work_item_type, r.state, r.title) == (
        "Harbour", "User Story", "Closed", "Paint the north pier")
    assert (r.assigned_to_name, r.assigned_to_unique_name) == ("Mara", "mara@harbour.test")
    assert (r.created_by_name, r.created_by_unique_name) == ("Olek", "Olek")    # unique falls back
    assert r.created_date == dt.datetime(2024, 1, 10, 10) and r.state_change_date is None
    assert r.story_points == Decimal("8.00") and r.priority == 1 and r.severity == "2 - High"
    assert r.iteration_path == "Harbour\\Sprint 12" and r.tags.startswith("Paint")


def test_missing_and_mistyped_fields(spark):
    bad = dict(RECORD)
    bad["Microsoft.VSTS.Common.Priority"] = 1.5        # not an int → NULL
    bad["Microsoft.VSTS.Scheduling.StoryPoints"] = "eight"   # string in a number field → quarantine
    del bad["System.State"]
    del bad["System.ChangedDate"]
    rec = spark.createDataFrame([(2, 1, "u", json.dumps(bad))], "id long, rev int, url string, fields string")
    now = dt.datetime(2024, 2, 1)
    r = map_records(rec, F.lit(now).cast("timestamp_ntz")).first()
    assert r.priority is None and r.story_points is None
    assert r.state == "Unknown" and r.changed_date == now
    errs = field_type_errors(rec).first()
    assert errs.bad_fields == ["Microsoft.VSTS.Scheduling.StoryPoints"]


def test_id_batches_450(spark):
    df = spark.range(1, 451).select(F.col("id"))
    sizes = sorted((r.batch, r.n) for r in id_batches(df, 200).groupBy("batch").agg(F.count("*").alias("n")).collect())
    assert sizes == [(0, 200), (1, 200), (2, 50)]
    first = id_batches(df, 200).filter(F.col("batch") == 1).agg(F.min("id"), F.max("id")).first()
    assert tuple(first) == (201, 400)
    assert clamp_batch_size(0) == 1 and clamp_batch_size(999) == 200


def test_id_list_flat_then_links(spark):
    docs = spark.createDataFrame([
        (json.dumps({"workItems": [{"id": 5}, {"id": 3}, {"id": 5}]}),),
        (json.dumps({"workItems": [], "workItemRelations": [
            {"rel": None, "source": None, "target": {"id": 7}},
            {"rel": "x", "source": {"id": 7}, "target": {"id": 9}}]}),),
    ], "document string")
    assert sorted(r.id for r in read_id_lists(docs).collect()) == [3, 5, 7, 9]


def test_times_without_offset_are_utc_in_any_zone(spark):
    from flowmetrics.functions.fields import as_timestamp
    texts = ["2024-03-10T02:30:00", "2024-03-10 02:30:00.5", "2024-03-10", "2024-03-10T02:30:00Z", "2024-03-10T02:30:00+02:00",
             " 2024-03-10T02:30 ", "2024-03-10T02:30:00-0330", "nonsense", ""]
    df = spark.createDataFrame([(json.dumps({"f": t}),) for t in texts], "j string")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = [str(r.t) if r.t else None for r in
               df.select(as_timestamp(F.try_parse_json("j"), "f").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2024-03-10 02:30:00", "2024-03-10 02:30:00.500000", "2024-03-10 00:00:00", "2024-03-10 02:30:00",
                   "2024-03-10 00:30:00", "2024-03-10 02:30:00", "2024-03-10 06:00:00", None, None]


def test_batches_with_an_outlier_id_stay_even(spark):
    """One id at 2^60 does not put all others into one task."""
    from flowmetrics.operators import batching as B
    ids = spark.range(0, 20_000).select(F.col("id").alias("id")).unionByName(spark.sql("SELECT 1L << 60 AS id"))
    got = {r.id: r.batch for r in id_batches(ids, 200).collect()}
    want = {i: i // 200 for i in range(20_000)} | {1 << 60: 100}
    assert got == want
    dealt = ids.repartitionByRange(4, "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == 4 and max(r["count"] for r in dealt) < 8_000
    repeated = spark.createDataFrame([(5, "a"), (5, "a"), (7, "b"), (None, "b"), (6, None), (2, None)], "id long, p string")
    ranked = sorted((str(r.p), r._pos) for r in B.ordered_rank(repeated, "id", ["p"]).collect())
    assert ranked == [("None", 1), ("None", 2), ("a", 1), ("a", 2), ("b", 1), ("b", 2)]


def test_a_payload_is_parsed_once(spark):
    from flowmetrics.sources.landing import read_records
    rec = spark.createDataFrame([(1, 1, "u", "{}")], "id long, rev int, url string, fields string")
    read = read_records(rec, F.lit(None).cast("timestamp_ntz"))
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and plan.count("struct") + plan.count("StructField(System.State") >= 1


def test_fields_read_as_text_keep_their_kind(spark):
    """Texts that only look like an object, a date or a number, and values of other kinds."""
    from flowmetrics.sources.landing import read_records
    created, state, points = "System.CreatedDate", "System.State", "Microsoft.VSTS.Scheduling.StoryPoints"
    cases = [  # payload, created date, state, points, bad fields
        ({created: "2024-01-01T10:00:00.5Z", state: {"displayName": "D"}, points: 5}, "2024-01-01 10:00:00.5", "D", "5.00", []),
        ({created: "2024-01-01T10:00:00+02:00", state: "{", points: "5"}, "2024-01-01 08:00:00", "{", None, [points]),
        ({created: 20240101, state: '{"displayName":"D"}', points: True}, None, '{"displayName":"D"}', None, [created, points]),
        ({created: "2024-01-01T10:00:00\nZ", state: {"name": "n"}, points: 1e12}, None, '{"name":"n"}', None, [created, points]),
        ({created: None, state: [1], points: None}, None, "[1]", None, []),
        ({created: "2024-02-30T00:00:00Z", state: None}, None, "Unknown", None, [created]),
    ]
    rec = spark.createDataFrame([(i, 1, "u", json.dumps(c[0])) for i, c in enumerate(cases)] + [
        (90, 1, "u", "[1]"), (91, 1, "u", "not json"), (92, 1, "u", None)], "id long, rev int, url string, fields string")
    rows = read_records(rec, F.lit(None).cast("timestamp_ntz")).select(
        "id", F.col("created_date").cast("string"), "state", F.col("story_points").cast("string"), "bad_fields").collect()
    got = {r.id: tuple(r)[1:] for r in rows}
    assert {i: got[i] for i in range(len(cases))} == {i: c[1:] for i, c in enumerate(cases)}
    none = (None, "Unknown", None)
    assert got[90] == (*none, []) and got[91] == (*none, ["unreadable JSON"]) and got[92] == (*none, [])


def test_responses_of_typed_columns_are_those_of_the_payload(spark):
    from flowmetrics.sources.adapter import fields_json, fields_object
    from flowmetrics.testdata.documents import responses

    from .fixtures import raw_df
    rows = [dict(id=i, title=f'"{i}" \u00e9', story_points=Decimal(i) / 4, remaining_work=Decimal(10 * i), priority=i, tags=None,
                 assigned_to_unique_name=None if i % 2 else "a", area_path="A\\B") for i in range(5)]
    raw = raw_df(spark, rows).withColumn("fields_json", fields_json())
    texts = lambda df: sorted(r.document for r in df.collect())
    one = F.lit("C")
    typed = responses(raw.drop("fields_json"), one, 1, fields=fields_object())
    assert texts(typed) == texts(responses(raw, one, 1)) and len(rows) == typed.count()
