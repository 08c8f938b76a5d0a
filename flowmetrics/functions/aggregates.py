"""Aggregate expressions with reference-exact numeric semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import D2


def avg_round2(c: Column) -> Column:
    """``ROUND(AVG(x), 2)`` on NUMERIC(10,2) input.

    Widening to scale 12 first keeps Spark's decimal average exact to 16
    places, so the final HALF_UP rounding is not a double rounding for any
    group under 10^14 rows.
    """
    return F.round(F.avg(c.cast("decimal(24,12)")), 2).cast(D2)


def percentile_cont(c: Column, q: float) -> Column:
    """Exact continuous percentile (interpolating), NULLs ignored, DOUBLE.

    Spark's exact ``percentile`` keeps a count per distinct value (not the
    rows) and merges partial maps across the shuffle, so a hot group costs
    memory in distinct values: a NUMERIC(10,2) day count has a bounded domain
    however many rows share it.
    """
    return F.percentile(c, F.lit(q))
