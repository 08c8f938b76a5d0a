"""Hot keys: one project and one member holding a third of all staging rows.

The operators that group or number per key (id chunks, dense keys, dimension
candidates, orphan counts) must give the same answer as a brute-force
pandas computation when one key dominates.
"""

import pandas as pd
from pyspark.sql import functions as F

from .conftest import SF_SMALL
from flowmetrics.operators.batching import id_batches
from flowmetrics.operators.keys import dense_index
from flowmetrics.operators.quality import fk_orphans
from flowmetrics.plans import dims as D
from flowmetrics.plans.fact import fact_work_items
from flowmetrics.plans.transform import build_dimensions
from flowmetrics.sources.adapter import raw_work_items

HOT_PROJECT = "HOT"
HOT_NAME, HOT_UNIQUE = "Hot Member", "hot@x.test"


def hot_raw(spark):
    raw = raw_work_items(spark, SF_SMALL)
    hot = F.col("id") % 3 == 0
    return raw.select(*[
        F.when(hot, F.lit(HOT_PROJECT)).otherwise(F.col(c)).alias(c) if c == "project_name"
        else F.when(hot, F.lit(HOT_NAME)).otherwise(F.col(c)).alias(c) if c == "created_by_name"
        else F.when(hot, F.lit(HOT_UNIQUE)).otherwise(F.col(c)).alias(c) if c == "created_by_unique_name"
        else F.col(c)
        for c in raw.columns])


def test_hot_key_holds_a_third(spark):
    raw = hot_raw(spark)
    n = raw.count()
    n_hot = raw.filter(F.col("project_name") == HOT_PROJECT).count()
    assert n_hot * 3 >= n - 3


def test_id_batches_with_hot_key_match_brute_force(spark):
    raw = hot_raw(spark).select("id", "project_name")
    got = {(r.id, r.batch) for r in id_batches(raw, 200, partition_cols=["project_name"]).collect()}
    pdf = raw.toPandas().sort_values(["project_name", "id"])
    pdf["batch"] = pdf.groupby("project_name").cumcount() // 200
    want = set(zip(pdf["id"].tolist(), pdf["batch"].tolist()))
    assert got == want
    # the hot project really spans many batches
    hot_batches = {b for i, b in got if i % 3 == 0}
    assert len(hot_batches) > 1


def test_dense_keys_with_hot_group(spark):
    raw = hot_raw(spark)
    members = (raw.select(F.lit("m").alias("dim"), F.col("id").cast("string").alias("natural"))
               .unionByName(raw.select(F.lit("p").alias("dim"), F.col("project_name").alias("natural"))
                            .distinct()))
    keyed = dense_index(members, ["natural"], "key", start=2, group_cols=["dim"]).toPandas()
    for _, g in keyed.groupby("dim"):
        assert sorted(g["key"]) == list(range(2, 2 + len(g)))
        assert g["natural"].is_unique


def test_dimension_candidates_with_hot_member(spark):
    raw = hot_raw(spark)
    cand = D.stacked_candidates(raw).toPandas()
    proj = set(cand.loc[cand["dim"] == "dim_project", "natural"])
    pdf = raw.select("project_name", "created_by_name", "created_by_unique_name").toPandas()
    assert proj == set(pdf.loc[pdf["project_name"].fillna("") != "", "project_name"])
    members = cand[cand["dim"] == "dim_member"].set_index("natural")
    assert HOT_UNIQUE in members.index
    assert members.loc[HOT_UNIQUE, "attr"] == HOT_NAME


def test_fk_orphans_with_hot_key(spark):
    raw = hot_raw(spark)
    dims = build_dimensions(raw, write=False)
    fact = fact_work_items(raw, dims)
    broken = dict(dims)
    broken["dim_project"] = dims["dim_project"].filter(F.col("project_name") != HOT_PROJECT)
    got = {r.fk_name: r.orphans for r in fk_orphans(fact, broken).collect()}
    pdf: pd.DataFrame = raw.select("id", "project_name").toPandas()
    assert got["fact_work_items.project_key"] == int((pdf["project_name"] == HOT_PROJECT).sum())
    assert all(v == 0 for k, v in got.items()
               if k.startswith("fact_work_items.") and k != "fact_work_items.project_key")
