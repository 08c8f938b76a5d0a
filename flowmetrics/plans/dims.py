"""Calendar and conformed dimensions with surrogate keys.

Each dimension is refreshed from the staging rows as
``merge_by_key(current, candidates)`` (insert-only or type-1 update) plus
dense keys for new members only. A fresh build starts from the seeded
unknown member, which always holds key 1.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.classify import (UNASSIGNED_DISPLAY, UNASSIGNED_UNIQUE, UNKNOWN_CATEGORY,
                                  UNKNOWN_NAME, state_category, type_category)
from ..operators.keys import dense_index
from ..sources.store import materialize
from ..params import DEFAULT, RunParams


# --------------------------------------------------------------------------- calendar
def dim_date(spark: SparkSession, start, end, with_unknown: bool = True) -> DataFrame:
    """One row per day in [start, end] (bounded: ~365 rows a year) + the -1 row.

    ``start`` / ``end`` are dates or date Columns (e.g. scalar subqueries).
    """
    lo = start if isinstance(start, Column) else F.lit(start)
    hi = end if isinstance(end, Column) else F.lit(end)
    days = spark.range(1).select(
        F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    d = F.col("full_date")
    dow = cal.iso_day_of_week(d)
    # fixed values: the calendar's columns
    out = days.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        dow.isin(6, 7).alias("is_weekend"),
        dow.isin(1, 2, 3, 4, 5).alias("is_business_day"),
        (F.year(d) * 100 + F.month(d)).alias("year_month"),
    )
    if not with_unknown:
        return out
    # The unknown-date member.
    unknown = spark.createDataFrame(
        [(-1, dt.date(1900, 1, 1), 1900, 1, "N/A", 1, "Unknown", "Unk", 1, 1, 1, "Unknown",
          False, False, 190001)], out.schema)
    return out.unionByName(unknown)


# --------------------------------------------------------------------------- specs
@dataclass(frozen=True)
class DimSpec:
    name: str
    key: str
    natural: str
    attrs: tuple[str, ...] = ()
    update_on_conflict: bool = False
    seed: tuple = field(default=())


DIM_PROJECT = DimSpec("dim_project", "project_key", "project_name", (), False, (UNKNOWN_NAME,))
DIM_TYPE = DimSpec("dim_work_item_type", "type_key", "work_item_type", ("category",), True,
                   (UNKNOWN_NAME, UNKNOWN_CATEGORY))
DIM_STATE = DimSpec("dim_state", "state_key", "state_name", ("state_category",), True,
                    (UNKNOWN_NAME, UNKNOWN_CATEGORY))
DIM_ITERATION = DimSpec("dim_iteration", "iteration_key", "iteration_path", ("sprint_name",), False,
                        (UNKNOWN_NAME, UNKNOWN_NAME))
DIM_AREA = DimSpec("dim_area", "area_key", "area_path", (), False, (UNKNOWN_NAME,))
DIM_MEMBER = DimSpec("dim_member", "member_key", "unique_name", ("display_name",), True,
                     (UNASSIGNED_UNIQUE, UNASSIGNED_DISPLAY))
ALL_DIMS = (DIM_PROJECT, DIM_TYPE, DIM_STATE, DIM_ITERATION, DIM_AREA, DIM_MEMBER)


def _present(c: str):
    return F.col(c).isNotNull() & (F.col(c) != "")


# --------------------------------------------------------------------------- stacked refresh
# All six dimensions are refreshed together as one "stacked" table
# (dim, natural, attr, key): one scan of the staging rows, one partial
# aggregate, one keyed merge and one dense numbering restarting per dim.
STACK_SCHEMA = "dim string, natural string, attr string, key int"


def stacked_members(raw: DataFrame, specs=ALL_DIMS) -> DataFrame:
    """(dim, natural, name, ts) for every member mention in the staging rows.

    One scan of the staging columns, each row exploded into its (at most
    seven) mentions. ``name`` is the display name for members, NULL otherwise.
    """
    null = F.lit(None).cast("string")

    def mention(spec: DimSpec, natural, name, keep_col: str):
        return F.struct(F.lit(spec.name).alias("dim"), natural.alias("natural"), name.alias("name"),
                        F.col("changed_date").alias("ts"), _present(keep_col).alias("keep"))
    by_dim = {
        DIM_PROJECT: [mention(DIM_PROJECT, F.col("project_name"), null, "project_name")],
        DIM_TYPE: [mention(DIM_TYPE, F.col("work_item_type"), null, "work_item_type")],
        DIM_STATE: [mention(DIM_STATE, F.col("state"), null, "state")],
        DIM_ITERATION: [mention(DIM_ITERATION, F.col("iteration_path"), null, "iteration_path")],
        DIM_AREA: [mention(DIM_AREA, F.col("area_path"), null, "area_path")],
        # members are kept when the *display name* is present (COALESCE keeps '')
        DIM_MEMBER: [mention(DIM_MEMBER, F.coalesce("assigned_to_unique_name", "assigned_to_name"),
                             F.col("assigned_to_name"), "assigned_to_name"),
                     mention(DIM_MEMBER, F.coalesce("created_by_unique_name", "created_by_name"),
                             F.col("created_by_name"), "created_by_name")],
    }
    structs = [m for spec in specs for m in by_dim[spec]]
    return (raw.select(F.explode(F.array(*structs)).alias("m")).select("m.*")
            .filter(F.col("keep")).drop("keep"))


def _derived_attr(dim: Column, natural: Column, name: Column) -> Column:
    """Attribute of a member, computed once per distinct member."""
    return (F.when(dim == DIM_TYPE.name, type_category(natural))
            .when(dim == DIM_STATE.name, state_category(natural))
            .when(dim == DIM_ITERATION.name, cal.sprint_name(natural))
            .when(dim == DIM_MEMBER.name, name))


def stacked_candidates(raw: DataFrame, specs=ALL_DIMS) -> DataFrame:
    """Distinct members per dim with their attribute.

    The member display name of the latest change wins (the source statement
    would fail on two names for one key, see ``member_conflicts``). Two steps
    keep the heavy part a hash aggregate with map-side combining:
    (dim, natural, name) → latest change (a hot value, e.g. one project holding
    a third of the rows, collapses to one row per map task), then the choice
    among a key's few distinct names.
    """
    latest = (stacked_members(raw, specs).groupBy("dim", "natural", "name")
              .agg(F.max("ts").alias("ts")))
    chosen = (latest.groupBy("dim", "natural")
              .agg(F.max_by("name", F.struct("ts", "name")).alias("name")))
    return chosen.select("dim", "natural",
                         _derived_attr(F.col("dim"), F.col("natural"), F.col("name")).alias("attr"))


def member_conflicts(raw: DataFrame) -> DataFrame:
    return (stacked_members(raw, [DIM_MEMBER]).groupBy("natural")
            .agg(F.count_distinct("name").alias("n_display_names"))
            .filter(F.col("n_display_names") > 1)
            .withColumnRenamed("natural", "unique_name"))


def to_stacked(spec: DimSpec, dim: DataFrame) -> DataFrame:
    attr = F.col(spec.attrs[0]) if spec.attrs else F.lit(None).cast("string")
    return dim.select(F.lit(spec.name).alias("dim"), F.col(spec.natural).alias("natural"),
                      attr.alias("attr"), F.col(spec.key).cast("int").alias("key"))


def from_stacked(spec: DimSpec, stacked: DataFrame) -> DataFrame:
    cols = [F.col("key").alias(spec.key), F.col("natural").alias(spec.natural)]
    if spec.attrs:
        cols.append(F.col("attr").alias(spec.attrs[0]))
    return stacked.filter(F.col("dim") == spec.name).select(*cols)


def seeds(spark: SparkSession, specs=ALL_DIMS) -> DataFrame:
    rows = [(s.name, s.seed[0], s.seed[1] if len(s.seed) > 1 else None, 1) for s in specs]
    return spark.createDataFrame(rows, STACK_SCHEMA)


def refresh_stacked(raw: DataFrame, current: DataFrame | None, specs=ALL_DIMS) -> DataFrame:
    """``INSERT … SELECT DISTINCT … ON CONFLICT`` for all dims at once."""
    spark = raw.sparkSession
    fresh = current is None
    cur = seeds(spark, specs) if fresh else current
    # written once: read by the attribute update, the anti-join and the numbering
    cand = materialize(stacked_candidates(raw, specs), "dim_candidates")
    updating = [s.name for s in specs if s.update_on_conflict]
    # type-1 update of existing members' attribute (DO UPDATE dims only)
    upd = cand.select("dim", "natural", F.col("attr").alias("_new_attr"), F.lit(True).alias("_hit"))
    cur = (cur.join(upd, ["dim", "natural"], "left")
           .select("dim", "natural",
                   F.when(F.col("_hit") & F.col("dim").isin(updating), F.col("_new_attr"))
                   .otherwise(F.col("attr")).alias("attr"), "key"))
    new = cand.join(cur.select("dim", "natural"), ["dim", "natural"], "left_anti")
    if fresh:
        start = F.lit(2)
    else:
        # one row per dim (bounded by the number of dims)
        maxes = cur.groupBy("dim").agg((F.max("key") + 1).alias("_start"))
        new = new.join(F.broadcast(maxes), "dim", "left")
        start = F.coalesce(F.col("_start"), F.lit(1))
    keyed = dense_index(new, ["natural"], "key", start=start, group_cols=["dim"])
    return cur.unionByName(keyed.select("dim", "natural", "attr", "key"))


def refresh_all(raw: DataFrame, current: dict[str, DataFrame] | None = None,
                specs=ALL_DIMS) -> dict[str, DataFrame]:
    stacked = refresh_stacked(raw, stack_current(current, specs), specs)
    return {s.name: from_stacked(s, stacked) for s in specs}


def stack_current(current: dict[str, DataFrame] | None, specs) -> DataFrame | None:
    if not current:
        return None
    spark = next(iter(current.values())).sparkSession
    parts = [to_stacked(s, current[s.name]) if s.name in current else seeds(spark, [s])
             for s in specs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def refresh(spec: DimSpec, current: DataFrame | None, raw: DataFrame) -> DataFrame:
    """Refresh a single dimension."""
    return refresh_all(raw, {spec.name: current} if current is not None else None, [spec])[spec.name]


def data_calendar_bounds(raw: DataFrame) -> tuple[Column, Column]:
    """Whole years covering all dates of the staging rows. Years outside 1900..2199
    do not stretch the calendar (at most 110,000 days); their items keep their
    date keys and show up in the referential check."""
    dates = ["created_date", "activated_date", "closed_date", "changed_date"]
    year = lambda c: F.least(F.greatest(F.year(c), F.lit(1900)), F.lit(2199))
    lo = raw.select(F.make_date(year(F.min(F.least(*dates))), F.lit(1), F.lit(1))).scalar()
    hi = raw.select(F.make_date(year(F.max(F.greatest(*dates))), F.lit(12), F.lit(31))).scalar()
    return lo, hi
