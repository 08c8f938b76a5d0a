"""Accumulating-snapshot fact: one row per work item with flow metrics.

Staging rows LEFT JOIN the dimensions on their natural keys (the member
dimension twice, on ``COALESCE(unique, name)``); misses get the unknown key 1,
missing dates the key -1. Join strategy is left to the planner: dimensions
read from tables are broadcast when their file size is under the broadcast
threshold, otherwise sort-merge joined (AQE re-plans at runtime and splits
hot keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import durations as dur
from ..functions.calendar import date_key, ts_lit
from ..params import DEFAULT, RunParams
from ..sources.store import materialize

FACT_COLUMNS = [
    "work_item_id", "rev", "title", "project_key", "type_key", "state_key", "iteration_key",
    "area_key", "assigned_to_key", "created_by_key", "created_date_key", "activated_date_key",
    "closed_date_key", "changed_date_key", "created_date_utc", "activated_date_utc",
    "closed_date_utc", "changed_date_utc", "lead_time_days", "cycle_time_days", "queue_time_days",
    "wip_age_days", "is_closed", "is_active", "story_points", "original_estimate",
    "remaining_work", "completed_work", "priority", "severity", "tags", "last_transformed_at_utc",
]


#: Staging columns that the fact and its dimensions are made of.
FACT_INPUTS = [
    "id", "rev", "project_name", "work_item_type", "title", "state", "assigned_to_name", "assigned_to_unique_name",
    "created_by_name", "created_by_unique_name", "created_date", "activated_date", "closed_date", "changed_date",
    "story_points", "original_estimate", "remaining_work", "completed_work", "priority", "severity",
    "area_path", "iteration_path", "tags", "ingested_at_utc",
]


def in_role(df: DataFrame, column: str, dim: DataFrame, on: str) -> DataFrame:
    """The members of ``dim`` that stand in ``column`` of ``df``, as a written table: the planner
    knows its size, so a role of few members is broadcast however many there are in all."""
    return materialize(dim.join(df.select(F.col(column).alias(on)).distinct(), on, "left_semi"), "members_in_role")


def _lookup(df: DataFrame, dim: DataFrame, on_col, dim_nk: str, dim_key: str, out_key: str,
            extra: tuple[str, ...] = ()) -> DataFrame:
    d = dim.select(F.col(dim_nk).alias(f"_nk_{out_key}"), F.col(dim_key).alias(out_key),
                   *[F.col(x) for x in extra])
    return df.join(d, on_col == F.col(f"_nk_{out_key}"), "left").drop(f"_nk_{out_key}")


def with_dimension_keys(raw: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    r = raw
    r = _lookup(r, dims["dim_project"], F.col("project_name"), "project_name", "project_key", "project_key")
    r = _lookup(r, dims["dim_work_item_type"], F.col("work_item_type"), "work_item_type", "type_key", "type_key")
    r = _lookup(r, dims["dim_state"], F.col("state"), "state_name", "state_key", "state_key",
                ("state_category",))
    r = _lookup(r, dims["dim_iteration"], F.col("iteration_path"), "iteration_path", "iteration_key",
                "iteration_key")
    r = _lookup(r, dims["dim_area"], F.col("area_path"), "area_path", "area_key", "area_key")
    # the natural keys take the place of the names before the rows are joined by them
    r = (r.withColumn("_assigned", F.coalesce("assigned_to_unique_name", "assigned_to_name"))
         .withColumn("_created", F.coalesce("created_by_unique_name", "created_by_name"))
         .drop("assigned_to_unique_name", "assigned_to_name", "created_by_unique_name", "created_by_name"))
    member = dims["dim_member"].select("member_key", "unique_name")
    assignees = in_role(raw.select(F.coalesce("assigned_to_unique_name", "assigned_to_name").alias("name")),
                        "name", member, "unique_name")
    r = _lookup(r, assignees, F.col("_assigned"), "unique_name", "member_key", "assigned_to_key")
    r = _lookup(r, member, F.col("_created"), "unique_name", "member_key", "created_by_key")
    return r


def flow_columns(category, created, activated, closed, as_of) -> list:
    return [
        dur.lead_time(created, closed).alias("lead_time_days"),
        dur.cycle_time(created, activated, closed).alias("cycle_time_days"),
        dur.queue_time(created, activated).alias("queue_time_days"),
        dur.wip_age(category, created, activated, closed, as_of).alias("wip_age_days"),
        dur.is_closed(category, closed).alias("is_closed"),
        dur.is_active(category, closed).alias("is_active"),
    ]


def fact_work_items(raw: DataFrame, dims: dict[str, DataFrame],
                    params: RunParams = DEFAULT, keep: tuple[str, ...] = ()) -> DataFrame:
    """The fact rows of ``raw``, and its columns ``keep``."""
    r = with_dimension_keys(raw, dims)
    created, activated = F.col("created_date"), F.col("activated_date")
    closed, changed = F.col("closed_date"), F.col("changed_date")
    one = F.lit(1)
    return r.select(
        F.col("id").alias("work_item_id"), "rev", "title",
        *[F.coalesce(F.col(k), one).alias(k) for k in
          ("project_key", "type_key", "state_key", "iteration_key", "area_key",
           "assigned_to_key", "created_by_key")],
        date_key(created).alias("created_date_key"),
        date_key(activated).alias("activated_date_key"),
        date_key(closed).alias("closed_date_key"),
        date_key(changed).alias("changed_date_key"),
        created.alias("created_date_utc"), activated.alias("activated_date_utc"),
        closed.alias("closed_date_utc"), changed.alias("changed_date_utc"),
        *flow_columns(F.col("state_category"), created, activated, closed, params.as_of),
        "story_points", "original_estimate", "remaining_work", "completed_work",
        "priority", "severity", "tags",
        ts_lit(params.as_of).alias("last_transformed_at_utc"), *keep,
    )


# dimension → (fact key column, natural key column of the dim, output label)
KEY_LABELS = [
    ("dim_project", "project_key", "project_key", "project_name", "project_name"),
    ("dim_work_item_type", "type_key", "type_key", "work_item_type", "work_item_type"),
    ("dim_state", "state_key", "state_key", "state_name", "state_name"),
    ("dim_iteration", "iteration_key", "iteration_key", "iteration_path", "iteration_path"),
    ("dim_area", "area_key", "area_key", "area_path", "area_path"),
    ("dim_member", "assigned_to_key", "member_key", "unique_name", "assigned_to_unique_name"),
    ("dim_member", "created_by_key", "member_key", "unique_name", "created_by_unique_name"),
]


def with_natural_keys(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Replace surrogate keys present in ``df`` by the members' natural keys."""
    out = df
    for dim, fk, dk, nk, label in KEY_LABELS:
        if fk not in out.columns:
            continue
        d = dims[dim].select(F.col(dk).alias(fk), F.col(nk).alias(label))
        if fk == "assigned_to_key":
            d = in_role(df, fk, d, fk)
        out = out.join(d, fk, "left").drop(fk)
    return out
