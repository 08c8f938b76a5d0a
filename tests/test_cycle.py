import dataclasses
import datetime as dt
import json
import os
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from flowmetrics.params import DEFAULT
from flowmetrics.plans import snapshot as SN
from flowmetrics.plans.cycle import run_cycle
from flowmetrics.plans.fact import fact_work_items
from flowmetrics.plans.logs import append_logs, log_day, log_days, logs_from_events
from flowmetrics.plans.transform import build_star
from flowmetrics.sources.adapter import raw_work_items
from flowmetrics.sources.store import materialize
from flowmetrics.testdata.documents import responses
from flowmetrics.sources.tables import table

from .conftest import SF_SMALL


def _mean(values):
    known = [v for v in values if v is not None]
    if not known:
        return Decimal("0.00")
    return (sum(known) / len(known)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def test_snapshot_against_brute_force(spark):
    """Every group on every day of the window, counted item by item."""
    fact = build_star(raw_work_items(spark, SF_SMALL), DEFAULT).fact
    groups = defaultdict(list)
    for item in fact.collect():
        groups[item.project_key, item.type_key, item.state_key].append(item)
    want = {}
    for back in range(91):
        day = int((DEFAULT.snapshot_end - dt.timedelta(days=back)).strftime("%Y%m%d"))
        for group, items in groups.items():
            done = [i for i in items if i.is_closed and i.closed_date_key == day]
            want[day, *group] = (
                sum(bool(i.is_active) for i in items), len(done), sum(i.created_date_key == day for i in items),
                _mean([i.cycle_time_days for i in done]), _mean([i.lead_time_days for i in done]),
                sum((i.story_points or Decimal(0) for i in done), Decimal(0)))
    got = SN.daily_flow_snapshot(fact, DEFAULT).drop("snapshot_generated_at_utc").collect()
    assert {tuple(r)[:4]: tuple(r)[4:] for r in got} == want and len(got) == len(want) > 0


def test_snapshot_merge_never_deletes(spark):
    star = build_star(raw_work_items(spark, SF_SMALL), DEFAULT)
    old = SN.daily_flow_snapshot(star.fact, dataclasses.replace(DEFAULT, snapshot_end=dt.date(2001, 6, 1)))
    new = SN.daily_flow_snapshot(star.fact, DEFAULT)
    merged = SN.merge_snapshot(old, new)
    keys = SN.SNAPSHOT_KEY
    assert merged.count() == old.select(*keys).union(new.select(*keys)).distinct().count()
    assert merged.join(old.select(*keys), keys, "left_semi").count() == old.count()


def _land_pages(spark, landing):
    raw = raw_work_items(spark, SF_SMALL)
    responses(raw, F.lit("C1")).select("document").write.mode("append").text(landing)
    return raw


def _projects(spark, raw, enabled_but="FURNITURE"):
    names = [r.project_name for r in raw.select("project_name").distinct().collect() if r.project_name != enabled_but]
    return spark.createDataFrame([(f"p-{n}", "C1", n, None, "wellFormed") for n in names],
                                 "project_id string, collection_name string, project_name string, "
                                 "description string, state string")


def test_run_cycle_twice(spark, tmp_dir):
    landing, root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "tables")
    raw = _land_pages(spark, landing)
    colls = spark.createDataFrame([("C1", None)], "collection_name string, description string")
    projs = _projects(spark, raw)                      # FURNITURE was never discovered
    r1 = run_cycle(spark, root, landing, colls, projs, DEFAULT, now=dt.datetime(2002, 1, 1))
    n_items = raw.filter("project_name != 'FURNITURE'").count()
    assert r1.fact.count() == n_items < raw.count()
    assert spark.table("vw_flow_metrics_summary").count() == n_items
    assert spark.table("vw_throughput_weekly").count() > 0
    keys1 = {r.project_name: r.project_key for r in r1.dims["dim_project"].collect()}
    n_snap1 = r1.snapshot.count()      # r1's frames read files the next run replaces
    r2 = run_cycle(spark, root, landing, colls, projs, dataclasses.replace(DEFAULT, snapshot_end=dt.date(2001, 9, 1)),
                   now=dt.datetime(2002, 1, 2))
    keys2 = {r.project_name: r.project_key for r in r2.dims["dim_project"].collect()}
    assert keys1 == keys2                                  # surrogate keys are stable across runs
    assert r2.snapshot.count() > n_snap1                  # earlier days are kept
    assert spark.read.parquet(os.path.join(root, "catalog_projects")).count() == projs.count()


def test_empty_staging_skips_fact_and_snapshot(spark, tmp_dir):
    landing, root = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "tables")
    os.makedirs(landing)
    colls = spark.createDataFrame([("C1", None)], "collection_name string, description string")
    projs = _projects(spark, raw_work_items(spark, SF_SMALL))
    r = run_cycle(spark, root, landing, colls, projs, DEFAULT)
    assert r.fact is None and r.snapshot is None and r.dims["dim_project"].count() == 1


def test_incremental_equals_rebuild_after_random_batches(spark, tmp_dir):
    """Three random batches of changes, the second taken in by a run that stops between
    the state and the fact."""
    import random

    import pytest

    from flowmetrics.plans.incremental import FlowStore

    from .fixtures import raw_df
    rng = random.Random(3)
    day = lambda: dt.datetime(2001, 6, 1) + dt.timedelta(minutes=rng.randrange(90 * 1440))
    items = {}
    store = FlowStore(spark, tmp_dir, buckets=4)
    for batch in range(3):
        for i in rng.sample(range(60), 35):
            items[i] = dict(
                id=i, project_name=rng.choice("PQ"), state=rng.choice(["New", "Active", "Closed", "Removed", "", "Odd"]),
                work_item_type=rng.choice(["Bug", "Epic"]), created_date=day(), changed_date=day(),
                activated_date=rng.choice([None, day()]), closed_date=rng.choice([None, day()]),
                story_points=rng.choice([None, Decimal(rng.randrange(9))]), ingested_at_utc=dt.datetime(2002, 1, batch + 1))
        raw = raw_df(spark, list(items.values()))
        raw = materialize(raw, "raw")
        if batch == 0:
            dims = build_star(raw_df(spark, [dict(id=k, project_name=p, state=s, work_item_type=t) for k, (p, s, t) in enumerate(
                (p, s, t) for p in "PQ" for s in ["New", "Active", "Closed", "Removed", "Odd"] for t in ["Bug", "Epic"])]), DEFAULT).dims
        if batch == 1:
            merge, store.fact.merge = store.fact.merge, lambda b: merge(b) if b.columns and b.count() < 0 else _stop()
            with pytest.raises(RuntimeError):
                store.apply(store.changed(raw), dims)
            store.fact.merge = merge
        store.apply(store.changed(raw), dims)
        full = fact_work_items(raw, dims, DEFAULT)
        full = materialize(full, "full_fact")
        rows = lambda df: sorted(map(str, df.collect()))
        assert rows(store.read_fact(DEFAULT)) == rows(full) and full.count() == len(items)
        assert rows(store.snapshot(DEFAULT)) == rows(SN.daily_flow_snapshot(full, DEFAULT)) != []


def _stop():
    raise RuntimeError("stopped")


def test_snapshot_reads_the_fact_once(spark):
    star = build_star(raw_work_items(spark, SF_SMALL), DEFAULT)
    plan = SN.daily_flow_snapshot(star.fact, DEFAULT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


def test_export_files_by_their_footers(spark, tmp_dir):
    import pyarrow.parquet as pq

    from flowmetrics.plans.export import export_all_projects, export_project
    raw = raw_work_items(spark, SF_SMALL)
    path = export_all_projects(raw, os.path.join(tmp_dir, "all"), DEFAULT, rows_per_file=100)
    total = 0
    for project in sorted(n for n in os.listdir(path) if n.startswith("project_name=")):
        folder = os.path.join(path, project)
        ranges = []
        for name in os.listdir(folder):
            if name.endswith(".parquet"):
                meta = pq.ParquetFile(os.path.join(folder, name)).metadata
                column = next(c for c in range(meta.num_columns) if meta.schema.column(c).name == "work_item_id")
                stats = [meta.row_group(g).column(column).statistics for g in range(meta.num_row_groups)]
                ranges.append((min(s.min for s in stats), max(s.max for s in stats), meta.num_rows))
                ids = pq.read_table(os.path.join(folder, name), columns=["work_item_id"]).column(0).to_pylist()
                assert ids == sorted(ids)
        ranges.sort()
        assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
        assert [n for _, _, n in ranges[:-1]] == [100] * (len(ranges) - 1) and ranges[-1][2] <= 100
        total += sum(n for _, _, n in ranges)
    assert total == raw.count()
    one = export_project(raw, "BUILDING", os.path.join(tmp_dir, "one"), DEFAULT)
    assert spark.read.parquet(one).count() == raw.filter("project_name = 'BUILDING'").count()


def test_quantile_sketch_error_and_size(spark):
    from flowmetrics.plans import sketches as S
    days = F.pmod(F.hash("id"), F.lit(1_000_003)).cast("double")
    fact = spark.range(0, 300_000, 1, 8).select(
        (F.lit(20010101) + F.col("id") % 20).cast("int").alias("closed_date_key"), F.lit(1).alias("project_key"),
        (F.col("id") % 2).cast("int").alias("type_key"), F.lit(True).alias("is_closed"), days.alias("cycle_time_days"))
    parts = S.cycle_time_sketches(fact)
    assert parts.agg(F.max(F.length("sketch"))).first()[0] < 40_000
    answers = S.merged_quantile(parts, ["type_key"])
    gaps = S.rank_gap(fact.select("type_key", F.col("cycle_time_days").alias("value")), answers, ["type_key"]).collect()
    assert len(gaps) == 2 and all(g.n == 150_000 and g.gap <= 2 * S.rank_error() for g in gaps)
    small = fact.filter("closed_date_key = 20010101").limit(500)       # below k values: the exact rank
    exact = S.merged_quantile(S.cycle_time_sketches(small), ["project_key"])
    assert S.rank_gap(small.select("project_key", F.col("cycle_time_days").alias("value")), exact, ["project_key"]).first().gap == 0


def test_logs_sink_days_and_slice(spark, tmp_dir):
    logs = logs_from_events(table(spark, SF_SMALL, "events"))
    path = os.path.join(tmp_dir, "logs")
    append_logs(logs, path)
    stored = spark.read.parquet(path)
    assert stored.count() == logs.filter("log_level != 'Debug'").count() < logs.count()
    days = log_days(stored).collect()
    assert [d.log_day for d in days] == sorted([d.log_day for d in days], reverse=True)
    first = days[-1].log_day
    sl = log_day(stored, first).collect()
    assert sl and all(r.created_at_utc.date() == first for r in sl)
    assert [r.created_at_utc for r in sl] == sorted(r.created_at_utc for r in sl)
    assert sum(d.entries for d in days) == stored.count()
    assert stored.filter(F.col("log_level") == "Error").count() == logs.filter(F.col("source_context") == "error").count()
