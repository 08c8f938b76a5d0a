import datetime as dt

from pyspark.sql import functions as F

from flowmetrics.operators.keys import dense_index
from flowmetrics.operators.merge import dedupe_last, merge_by_key
from flowmetrics.plans import dims as D

from .fixtures import raw_df


def test_merge_update_insert_and_idempotence(spark):
    cur = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, n int")
    inc = spark.createDataFrame([(2, None, 21), (3, "c", 30)], "k int, v string, n int")
    once = merge_by_key(cur, inc, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", 10), (2, None, 21), (3, "c", 30)]
    twice = merge_by_key(once, inc, ["k"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    nothing = merge_by_key(cur, inc, ["k"], update_cols=[])
    assert sorted(map(tuple, nothing.collect())) == [(1, "a", 10), (2, "b", 20), (3, "c", 30)]


def test_dedupe_last(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 3, "z"), (1, 2, "y"), (2, 1, "w")], "id int, rev int, s string")
    assert sorted(map(tuple, dedupe_last(df, ["id"], ["rev"]).collect())) == [(1, 3, "z"), (2, 1, "w")]


def test_dense_index_is_dense_and_unique(spark):
    df = spark.range(0, 1000).select(F.col("id").cast("string").alias("nk"), (F.col("id") % 3).alias("g"))
    out = dense_index(df, ["nk"], "key", start=5, group_cols=["g"])
    stats = out.groupBy("g").agg(F.min("key").alias("lo"), F.max("key").alias("hi"),
                                 F.count_distinct("key").alias("d"), F.count("*").alias("n")).collect()
    for r in stats:
        assert r.lo == 5 and r.hi == 4 + r.n and r.d == r.n


def test_seeded_unknown_members_and_incremental_refresh(spark):
    t = dt.datetime(2024, 1, 1)
    raw1 = raw_df(spark, [dict(id=1, project_name="A", state="Active", work_item_type="Bug", changed_date=t),
                          dict(id=2, project_name="B", state="", work_item_type="Task", changed_date=t,
                               assigned_to_name=None, assigned_to_unique_name=None)])
    d1 = D.refresh_all(raw1)
    proj = {r.project_name: r.project_key for r in d1["dim_project"].collect()}
    assert proj["Desconocido"] == 1 and sorted(proj.values()) == [1, 2, 3]
    states = {r.state_name: r.state_category for r in d1["dim_state"].collect()}
    assert states == {"Desconocido": "Unknown", "Active": "In Progress"}     # '' is not a member
    members = {r.unique_name: r.display_name for r in d1["dim_member"].collect()}
    assert members["unassigned"] == "Sin Asignar" and "alice@e2e.test" in members
    # second run: keys of existing members are kept, new ones continue after the max
    raw2 = raw_df(spark, [dict(id=3, project_name="C", state="Desconocido", work_item_type="Bug",
                               changed_date=t, assigned_to_name="Alice Renamed")])
    d2 = D.refresh_all(raw2, {k: v for k, v in d1.items()})
    proj2 = {r.project_name: r.project_key for r in d2["dim_project"].collect()}
    assert {k: proj2[k] for k in proj} == proj and proj2["C"] == 4
    # DO UPDATE dims take the new attribute: a raw state named like the seed updates it
    st2 = {r.state_name: r.state_category for r in d2["dim_state"].collect()}
    assert st2["Desconocido"] == "In Progress"
    mem2 = {r.unique_name: r.display_name for r in d2["dim_member"].collect()}
    assert mem2["alice@e2e.test"] == "Alice Renamed"


def test_member_conflict_latest_change_wins(spark):
    t = dt.datetime(2024, 1, 1)
    raw = raw_df(spark, [
        dict(id=1, assigned_to_name="Old Name", assigned_to_unique_name="u@x", changed_date=t),
        dict(id=2, assigned_to_name="New Name", assigned_to_unique_name="u@x", changed_date=t + dt.timedelta(1)),
    ])
    members = {r.unique_name: r.display_name for r in D.refresh_all(raw)["dim_member"].collect()}
    assert members["u@x"] == "New Name"
    assert [r.unique_name for r in D.member_conflicts(raw).collect()] == ["u@x"]


def test_sprint_name_rules(spark):
    from flowmetrics.functions.calendar import sprint_name
    df = spark.createDataFrame([("P\\Sprint 3",), ("P\\",), ("Backlog",)], "p string")
    assert [r.s for r in df.select(sprint_name(F.col("p")).alias("s")).collect()] == ["Sprint 3", "P\\", "Backlog"]


def test_merge_with_clashing_names_and_newer_only(spark):
    cur = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, None, "c")], "k int, incoming int, _hit string")
    inc = spark.createDataFrame([(1, 4, "old"), (2, 5, "same"), (3, 1, "new"), (4, 1, "ins")], "k int, incoming int, _hit string")
    got = sorted(map(tuple, merge_by_key(cur, inc, ["k"], newer=["incoming"]).collect()))
    assert got == [(1, 5, "a"), (2, 5, "same"), (3, 1, "new"), (4, 1, "ins")]
    twice = merge_by_key(merge_by_key(cur, inc, ["k"]), inc, ["k"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, inc.collect()))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_one_row_batch_moves_no_target_row(spark, tmp_dir):
    from flowmetrics.sources.store import KeyedTable
    rows = spark.range(0, 50_000).select("id", F.lit("x").alias("v"))
    table = KeyedTable(spark, tmp_dir + "/t", rows.schema, ["id"], 8)
    table.merge(rows)
    batch = spark.createDataFrame([(7, "y")], rows.schema)
    stored = batch.withColumn("_bucket", table._bucket())
    touched = table._touched(stored)
    plan = _plan(table.merged(batch, touched, rows=1))
    exchanges = [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
    assert not exchanges and plan.count("BroadcastHashJoin") == 3
    assert f"_bucket#" in plan and len(touched) == 1 and "PartitionFilters" in plan and f"({touched[0]})" in plan.replace(
        f"= {touched[0]})", f"({touched[0]})")
    table.merge(batch)
    assert table.read().count() == 50_000 and table.read().filter("v = 'y'").collect()[0].id == 7


def test_slot_table_survives_a_failed_write(spark, tmp_dir):
    import pytest

    from flowmetrics.sources.store import SlotTable
    t = SlotTable(spark, tmp_dir + "/s")
    assert not t.exists() and t.run() == 0
    t.write(rows=spark.range(3))
    t.write(rows=spark.range(5))
    assert (t.read().count(), t.run()) == (5, 2)
    with pytest.raises(Exception):
        t.write(rows=spark.range(2).select(F.raise_error(F.lit("stop")).alias("x")))
    assert (t.read().count(), t.run()) == (5, 2)
    t.write(rows=spark.range(7))
    assert (t.read().count(), t.run()) == (7, 3)


def test_planner_sees_each_dimension_at_its_own_size(spark):
    from flowmetrics.plans.transform import build_dimensions
    from flowmetrics.sources.adapter import raw_work_items

    from .conftest import SF_SMALL
    dims = build_dimensions(raw_work_items(spark, SF_SMALL))
    size = {n: int(d._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) for n, d in dims.items()}
    assert size["dim_member"] > 2 * size["dim_work_item_type"]
