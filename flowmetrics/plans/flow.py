"""Cumulative flow per day: items per category at the end of each day.

An item is Proposed from its created day, In Progress from its activated
day, Completed from its closed day (a later phase wins once started). Each
phase interval contributes +1 at its start day and −1 at its end day; the
deltas are summed per (project, category, day) — partial aggregation — and
turned into counts by a running sum per (project, category) over days
(one window partition per project and category, bounded by the number of
calendar days). No item × day expansion.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PHASES = ["Proposed", "In Progress", "Completed"]


def cumulative_flow(raw: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    c = F.to_date("created_date")
    a = F.to_date("activated_date")
    x = F.to_date("closed_date")
    inf = F.lit(None).cast("date")

    def least_non_null(*cols):
        return F.least(*cols)  # least() skips NULLs; all NULL → NULL (= open end)

    # phase intervals [start, end): later phases cut earlier ones
    intervals = raw.select("project_name", F.explode(F.array(
        F.struct(F.lit("Proposed").alias("category"), c.alias("s"), least_non_null(a, x).alias("e")),
        F.struct(F.lit("In Progress").alias("category"),
                 F.when(x.isNull() | (a < x), a).alias("s"), x.alias("e")),
        F.struct(F.lit("Completed").alias("category"), x.alias("s"), inf.alias("e")),
    )).alias("i")).select("project_name", "i.*")
    valid = intervals.filter(F.col("s").isNotNull() & (F.col("e").isNull() | (F.col("s") < F.col("e"))))
    # days before the window collapse onto its first day
    first = F.lit(start)
    deltas = valid.select("project_name", "category", F.explode(F.array(
        F.struct(F.greatest(F.col("s"), first).alias("day"), F.lit(1).alias("d")),
        # open intervals (no end) have no −1 event; greatest() would skip the NULL
        F.struct(F.when(F.col("e").isNotNull(), F.greatest(F.col("e"), first)).alias("day"),
                 F.lit(-1).alias("d")),
    )).alias("x")).select("project_name", "category", "x.*").filter(F.col("day").isNotNull())
    per_day = (deltas.filter(F.col("day") <= F.lit(end))
               .groupBy("project_name", "category", "day").agg(F.sum("d").alias("delta")))
    # every project × category × window day (3 × ≤ days rows per project),
    # generated per project, then the running sum of the deltas
    days = F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY")))
    grid = (raw.select("project_name").distinct()
            .select("project_name", F.explode(F.array(*[F.lit(p) for p in PHASES])).alias("category"))
            .select("project_name", "category", days.alias("day")))
    run = Window.partitionBy("project_name", "category").orderBy("day").rowsBetween(
        Window.unboundedPreceding, 0)
    return (grid.join(per_day, ["project_name", "category", "day"], "left")
            .select("project_name", "category", "day",
                    F.sum(F.coalesce("delta", F.lit(0))).over(run).cast("long").alias("items")))
