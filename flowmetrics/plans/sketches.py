"""Percentiles of very large groups from mergeable quantile sketches.

The exact ``percentile_cont`` keeps a group's distinct values in memory. Here each
(closed day, project, type) keeps one KLL sketch of its cycle times: a few
kilobytes however many items it covers, built with map-side combining, and
mergeable, so any coarser grouping (week, sprint, project) comes from the sketches
alone and a day is never read again.

The answer is a value of the group whose rank is off by at most
``rank_error(k)`` of the group's size (99 % confidence, single-sided); a group of
up to ``k`` values is answered exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 800


def rank_error(k: int = K) -> float:
    """Normalised rank error of a KLL sketch with parameter ``k``."""
    return 2.296 / k ** 0.9723


def cycle_time_sketches(fact: DataFrame, k: int = K) -> DataFrame:
    """One sketch per (closed_date_key, project_key, type_key); items without a cycle time are only counted."""
    closed = fact.filter(F.col("is_closed") & (F.col("closed_date_key") != -1))
    days = F.col("cycle_time_days").cast("double")
    return closed.groupBy("closed_date_key", "project_key", "type_key").agg(
        F.count(F.lit(1)).alias("items"), F.count(days).alias("measured"),
        F.kll_sketch_agg_double(days, k).alias("sketch"))


def merged_quantile(sketches: DataFrame, by: list[str], q: float = 0.85, k: int = K) -> DataFrame:
    """The quantile of every coarser group, from its sketches."""
    merged = sketches.groupBy(*by).agg(F.sum("items").alias("items"), F.sum("measured").alias("measured"),
                                       F.kll_merge_agg_double("sketch", k).alias("sketch"))
    value = F.when(F.col("measured") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(q)))
    return merged.select(*by, "items", "measured", value.alias("quantile"))


def rank_gap(values: DataFrame, answers: DataFrame, by: list[str], q: float = 0.85) -> DataFrame:
    """How far the answers' ranks are from ``q``, as a share of the group: 0 where the
    answer's own run of equal values reaches over it. ``values``: ``by`` and ``value``."""
    counted = (values.join(answers.select(*by, "quantile"), by)
               .groupBy(*by).agg(F.count("value").alias("n"),
                                 F.count_if(F.col("value") < F.col("quantile")).alias("below"),
                                 F.count_if(F.col("value") <= F.col("quantile")).alias("up_to")))
    n = F.col("n")
    gap = F.greatest(F.col("below") / n - q, q - F.col("up_to") / n, F.lit(0.0))
    return counted.select(*by, "n", gap.alias("gap"))
