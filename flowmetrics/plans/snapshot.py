"""Daily flow snapshot: day × (project, type, state), last 91 days.

The literal statement crosses the calendar window with the distinct
combinations and joins the fact back (|fact| × 91 rows before grouping). Here
the fact is read once: each row gives up to three events, one for its group
(``day`` 0: the row, whether it is active), one for the day it was created, one
for the day it was closed, summed by (group, day) with a partial aggregate, so a
hot group costs one row per day and map partition. All measures are additive;
they are also the state that ``plans.incremental`` keeps. The window is generated
per group (at most 91 days) and looked up in the group's few days. Output
size is |groups| × 91.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import UNKNOWN_DATE_KEY, ts_lit
from ..operators.merge import merge_by_key
from ..params import DEFAULT, RunParams
from ..schemas import D2

GROUP = ["project_key", "type_key", "state_key"]
SNAPSHOT_KEY = ["snapshot_date_key", *GROUP]


def window_bounds(params: RunParams) -> tuple[dt.date, dt.date]:
    """First and last day of the window."""
    return params.snapshot_end - dt.timedelta(days=params.snapshot_days), params.snapshot_end


def _key(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


#: Additive measures of a (group, day). Day 0 holds those of the group itself.
MEASURES = {"items": "long", "active": "long", "created": "long", "completed": "long",
            "cycle_days": "decimal(30,2)", "cycle_items": "long", "lead_days": "decimal(30,2)", "lead_items": "long",
            "points": "decimal(30,2)"}
GROUP_DAY = 0


def day_events(fact: DataFrame, lo_key: int | None = None, hi_key: int | None = None) -> DataFrame:
    """The events of every fact row, with the measures each adds; days outside the bounds are left out."""
    def inside(day: Column) -> Column:
        known = day != UNKNOWN_DATE_KEY
        return known if lo_key is None else known & day.between(lo_key, hi_key)

    def event(day: Column, **adds: Column) -> Column:
        return F.struct(day.alias("day"), *[F.coalesce(adds.get(m, F.lit(None)), F.lit(0)).cast(t).alias(m)
                                            for m, t in MEASURES.items()])
    one = F.lit(1)
    closed_day, created_day = F.col("closed_date_key"), F.col("created_date_key")
    has = lambda c: F.col(c).isNotNull().cast("int")
    events = F.array(
        event(F.lit(GROUP_DAY), items=one, active=F.col("is_active").cast("int")),
        F.when(inside(created_day), event(created_day, created=one)),
        F.when(F.col("is_closed") & inside(closed_day), event(
            closed_day, completed=one, cycle_days=F.col("cycle_time_days"), cycle_items=has("cycle_time_days"),
            lead_days=F.col("lead_time_days"), lead_items=has("lead_time_days"), points=F.col("story_points"))))
    return fact.select(*GROUP, F.explode(F.array_compact(events)).alias("e")).select(*GROUP, "e.*")


def summed(events: DataFrame) -> DataFrame:
    """The state: measures per (group, day)."""
    return events.groupBy(*GROUP, "day").agg(*[F.sum(m).cast(t).alias(m) for m, t in MEASURES.items()])


def _average(total: Column, n: Column) -> Column:
    """``ROUND(AVG(x), 2)`` from a sum and a count, 0 without values."""
    exact = F.round(total.cast("decimal(28,8)") / F.when(n > 0, n).cast("decimal(18,0)"), 2)
    return F.coalesce(exact, F.lit(0)).cast(D2)


def snapshot_of_state(state: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    """Every group that has items, on every day of the window."""
    lo, hi = window_bounds(params)
    row = F.struct("day", *MEASURES)
    in_window = F.col("day").between(_key(lo), _key(hi))
    groups = state.groupBy(*GROUP).agg(
        F.sum(F.when(F.col("day") == GROUP_DAY, F.col("items"))).alias("group_items"),
        F.sum(F.when(F.col("day") == GROUP_DAY, F.col("active"))).cast("int").alias("active_wip_count"),
        F.map_from_entries(F.collect_list(F.when(in_window, F.struct(F.col("day").alias("key"), row.alias("value")))))
        .alias("days")).filter(F.col("group_items") > 0)
    day = F.explode(F.sequence(F.lit(lo), F.lit(hi), F.expr("INTERVAL 1 DAY")))
    grid = groups.select(*GROUP, "active_wip_count", "days", day.alias("date")).withColumn(
        "snapshot_date_key", F.year("date") * 10000 + F.month("date") * 100 + F.dayofmonth("date"))
    m = F.col("m")
    whole = lambda c: F.coalesce(m[c], F.lit(0)).cast("int")
    return (grid.withColumn("m", F.try_element_at("days", F.col("snapshot_date_key")))
            .select("snapshot_date_key", *GROUP, "active_wip_count",
                    whole("completed").alias("completed_throughput_count"), whole("created").alias("created_count"),
                    _average(m["cycle_days"], m["cycle_items"]).alias("avg_cycle_time_days"),
                    _average(m["lead_days"], m["lead_items"]).alias("avg_lead_time_days"),
                    F.coalesce(m["points"], F.lit(0)).cast(D2).alias("total_story_points_completed"),
                    ts_lit(params.as_of).alias("snapshot_generated_at_utc")))


def daily_flow_snapshot(fact: DataFrame, params: RunParams = DEFAULT) -> DataFrame:
    lo, hi = window_bounds(params)
    return snapshot_of_state(summed(day_events(fact, _key(lo), _key(hi))), params)


SNAPSHOT_SCHEMA = ("snapshot_date_key int, project_key int, type_key int, state_key int, "
                   "active_wip_count int, completed_throughput_count int, created_count int, "
                   "avg_cycle_time_days decimal(10,2), avg_lead_time_days decimal(10,2), "
                   "total_story_points_completed decimal(10,2), snapshot_generated_at_utc timestamp_ntz")


def merge_snapshot(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """``ON CONFLICT (date, project, type, state) DO UPDATE``; nothing deleted."""
    return merge_by_key(current, incoming, SNAPSHOT_KEY)
