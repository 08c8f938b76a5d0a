"""BI views over the star schema, returned as DataFrames.

* ``throughput_weekly`` – closed items per (calendar year, ISO week, project,
  type): count, points, rounded averages, exact 85th percentile of cycle time.
  ``week_start_date`` is the earliest closure day of the group, and the year is
  the calendar year (so 2018-12-31 is week 1 of 2018), as in the reference.
* ``throughput_weekly_iso`` – same, grouped by ISO week-year instead.
* ``flow_metrics_summary`` – one row per item with dimension labels.
* ``sprint_throughput`` / ``cumulative_flow`` – the two documented BI uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import avg_round2, percentile_cont
from ..functions.calendar import iso_day_of_week
from .fact import in_role


def _labels(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return (fact
            .join(dims["dim_project"].select("project_key", "project_name"), "project_key")
            .join(dims["dim_work_item_type"].select("type_key", "work_item_type"), "type_key"))


def _weekly(fact: DataFrame, dims: dict[str, DataFrame], iso_year: bool) -> DataFrame:
    closed = fact.filter(F.col("is_closed") & (F.col("closed_date_key") != -1))
    # calendar columns follow from the day itself: no range of years can lose a closure
    k = F.col("closed_date_key")
    day = F.make_date(F.floor(k / 10000).cast("int"), F.floor(k / 100).cast("int") % 100, k % 100)
    closed = closed.withColumn("full_date", day).withColumn("week_of_year", F.weekofyear("full_date"))
    of_year = F.date_sub(F.col("full_date"), iso_day_of_week(F.col("full_date")) - 4) if iso_year else F.col("full_date")
    return (_labels(closed.withColumn("year", F.year(of_year)), dims)
            .groupBy("year", "week_of_year", "project_name", "work_item_type")
            .agg(F.min("full_date").alias("week_start_date"),
                 F.count("work_item_id").alias("throughput_count"),
                 F.sum(F.coalesce(F.col("story_points"), F.lit(0).cast("decimal(10,2)")))
                 .alias("total_story_points"),
                 avg_round2(F.col("cycle_time_days")).alias("avg_cycle_time_days"),
                 avg_round2(F.col("lead_time_days")).alias("avg_lead_time_days"),
                 percentile_cont(F.col("cycle_time_days"), 0.85).alias("p85_cycle_time_days"))
            .select("year", "week_of_year", "week_start_date", "project_name", "work_item_type",
                    "throughput_count", "total_story_points", "avg_cycle_time_days",
                    "avg_lead_time_days", "p85_cycle_time_days"))


def throughput_weekly(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return _weekly(fact, dims, iso_year=False)


def throughput_weekly_iso(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """ISO week-year grouping (a week never spans two groups)."""
    return _weekly(fact, dims, iso_year=True)


def flow_metrics_summary(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    f = fact.alias("f")
    ma = in_role(fact, "assigned_to_key", dims["dim_member"].select(
        F.col("member_key").alias("assigned_to_key"), F.col("display_name").alias("assigned_to")), "assigned_to_key")
    mc = dims["dim_member"].select(F.col("member_key").alias("created_by_key"),
                                   F.col("display_name").alias("created_by"))
    return (f
            .join(dims["dim_project"].select("project_key", "project_name"), "project_key")
            .join(dims["dim_work_item_type"].select("type_key", "work_item_type",
                                                    F.col("category").alias("type_category")),
                  "type_key")
            .join(dims["dim_state"].select("state_key", "state_name", "state_category"), "state_key")
            .join(dims["dim_iteration"].select("iteration_key", "sprint_name"), "iteration_key")
            .join(dims["dim_area"].select("area_key", "area_path"), "area_key")
            .join(ma, "assigned_to_key")
            .join(mc, "created_by_key")
            .select("work_item_id", "title", "project_name", "work_item_type", "type_category",
                    "state_name", "state_category", "assigned_to", "created_by", "sprint_name",
                    "area_path", "created_date_utc", "activated_date_utc", "closed_date_utc",
                    "lead_time_days", "cycle_time_days", "queue_time_days", "wip_age_days",
                    "story_points", "priority", "severity", "tags", "is_closed", "is_active"))


def sprint_throughput(summary: DataFrame) -> DataFrame:
    """Closed items and points per (project, sprint) from the summary view."""
    return (summary.filter(F.col("is_closed"))
            .groupBy("project_name", "sprint_name")
            .agg(F.count(F.lit(1)).alias("throughput_count"),
                 F.sum(F.coalesce(F.col("story_points"), F.lit(0).cast("decimal(10,2)")))
                 .alias("total_story_points"),
                 avg_round2(F.col("cycle_time_days")).alias("avg_cycle_time_days")))
