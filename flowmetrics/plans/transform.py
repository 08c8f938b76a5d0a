"""The transformation run: staging → dimensions → fact → snapshot.

Each stage's output is written once (shared checkpoint folder or the table
store) and read back by the next stage, as the reference's statements read
the tables the previous statement filled. ``as_of`` is one value per run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import DEFAULT, RunParams
from ..sources.store import materialize, scratch_path
from . import dims as D
from . import fact as FT
from . import snapshot as SN


@dataclass
class Star:
    raw: DataFrame
    dims: dict[str, DataFrame]
    fact: DataFrame


def write_dimensions(stacked: DataFrame) -> str:
    path = scratch_path(stacked, "dimensions")
    stacked.write.partitionBy("dim").parquet(path)
    return path


def read_dimensions(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    read = spark.read.schema("natural string, attr string, key int")
    return {s.name: D.from_stacked(s, read.parquet(f"{path}/dim={s.name}").withColumn("dim", F.lit(s.name)))
            for s in D.ALL_DIMS}


def build_dimensions(raw: DataFrame, params: RunParams = DEFAULT,
                     current: dict[str, DataFrame] | None = None,
                     write: bool = True) -> dict[str, DataFrame]:
    stacked = D.refresh_stacked(raw, D.stack_current(current, D.ALL_DIMS))
    if write:
        # a folder per dimension, read on its own: the planner sees each at its own size
        out = read_dimensions(raw.sparkSession, write_dimensions(stacked))
    else:
        out = {s.name: D.from_stacked(s, stacked) for s in D.ALL_DIMS}
    # the calendar is generated over the years of the data; no need to store it
    out["dim_date"] = D.dim_date(raw.sparkSession, *D.data_calendar_bounds(raw))
    return out


def build_star(raw: DataFrame, params: RunParams = DEFAULT,
               current: dict[str, DataFrame] | None = None, write: bool = True) -> Star:
    dims = build_dimensions(raw, params, current, write)
    fact = FT.fact_work_items(raw, dims, params)
    if write:
        fact = materialize(fact, "fact_work_items")
    return Star(raw, dims, fact)


def snapshot(star: Star, params: RunParams = DEFAULT) -> DataFrame:
    return SN.daily_flow_snapshot(star.fact, params)
