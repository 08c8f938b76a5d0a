"""Referential checks the source database enforced with foreign keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_FKS = [
    ("project_key", "dim_project", "project_key"),
    ("type_key", "dim_work_item_type", "type_key"),
    ("state_key", "dim_state", "state_key"),
    ("iteration_key", "dim_iteration", "iteration_key"),
    ("area_key", "dim_area", "area_key"),
    ("assigned_to_key", "dim_member", "member_key"),
    ("created_by_key", "dim_member", "member_key"),
    ("created_date_key", "dim_date", "date_key"),
    ("activated_date_key", "dim_date", "date_key"),
    ("closed_date_key", "dim_date", "date_key"),
    ("changed_date_key", "dim_date", "date_key"),
]


def fk_orphans(fact: DataFrame, dims: dict[str, DataFrame], prefix: str = "fact_work_items",
               calendars: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per foreign key: number of fact rows whose key has no parent.

    One scan of the fact: each row is exploded into its key columns and reduced
    to (column, key, rows) with a partial aggregate, so only distinct keys are
    shuffled and anti-joined (a key holding a third of the rows is one row after
    the map side). A NULL key has no parent. ``calendars`` adds further checks
    (prefix → calendar) on the same counts. Every foreign key has its row, also
    where the fact is empty.
    """
    checks = {prefix: dims["dim_date"], **(calendars or {})}
    names = F.array(*[F.struct(F.lit(dim).alias("dim"), F.lit(col).alias("fk"), F.col(col).cast("long").alias("key"))
                      for col, dim, _ in FACT_FKS])
    per_key = (fact.select(F.explode(names).alias("k")).groupBy("k.dim", "k.fk", "k.key")
               .agg(F.count(F.lit(1)).alias("rows"))
               .withColumn("check", F.explode(F.array(*[F.lit(c) for c in checks]))))
    parents = None
    for check, calendar in checks.items():
        for dim, key in dict.fromkeys((dim, key) for _, dim, key in FACT_FKS):
            of = calendar if dim == "dim_date" else dims[dim]
            p = of.select(F.lit(check).alias("check"), F.lit(dim).alias("dim"), F.col(key).cast("long").alias("key"))
            parents = p if parents is None else parents.unionByName(p)
    orphans = per_key.join(parents, ["check", "dim", "key"], "left_anti").groupBy("check", "fk").agg(
        F.sum("rows").alias("orphans"))
    every = fact.sparkSession.createDataFrame([(c, fk) for c in checks for fk, _, _ in FACT_FKS], "check string, fk string")
    return every.join(orphans, ["check", "fk"], "left").select(
        F.concat_ws(".", "check", "fk").alias("fk_name"), F.coalesce("orphans", F.lit(0)).alias("orphans"))
