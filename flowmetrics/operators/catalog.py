"""Catalog of collections and projects, refreshed from discovery.

Upserts keep the operator-managed columns: a re-discovered project gets its
name, description and state updated but keeps ``is_enabled``,
``access_status`` and ``collection_name``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .merge import merge_by_key
from ..functions.calendar import ts_lit

AUTHORIZED, FORBIDDEN = "AUTHORIZED", "FORBIDDEN"


def upsert_projects(catalog: DataFrame, discovered: DataFrame, now) -> DataFrame:
    """``discovered``: project_id, collection_name, project_name, description, state."""
    ts = ts_lit(now)
    inc = discovered.select("project_id", "collection_name", "project_name", "description", "state",
                            ts.alias("last_discovered_utc"))
    return merge_by_key(catalog, inc, ["project_id"],
                        ["project_name", "description", "state", "last_discovered_utc"],
                        {"is_enabled": F.lit(True), "access_status": F.lit(AUTHORIZED),
                         "process_template": F.lit(None).cast("string")})


def upsert_collections(catalog: DataFrame, discovered: DataFrame, now) -> DataFrame:
    ts = ts_lit(now)
    inc = discovered.select("collection_name", "description", ts.alias("last_discovered_utc"))
    return merge_by_key(catalog, inc, ["collection_name"], ["last_discovered_utc"],
                        {"is_enabled": F.lit(True)})


def set_access_status(catalog: DataFrame, project_ids: DataFrame, status: str, now) -> DataFrame:
    """Access status and discovery time of a set of ids (which may repeat)."""
    hit = project_ids.select("project_id").distinct().withColumn("_hit", F.lit(True))
    return (catalog.join(hit, "project_id", "left")
            .withColumn("access_status",
                        F.when(F.col("_hit"), F.lit(status)).otherwise(F.col("access_status")))
            .withColumn("last_discovered_utc",
                        F.when(F.col("_hit"), ts_lit(now)).otherwise(F.col("last_discovered_utc")))
            .drop("_hit").select(*catalog.columns))


def enabled_projects(catalog: DataFrame) -> DataFrame:
    return (catalog.filter(F.col("is_enabled"))
            .select("project_id", "collection_name", "project_name", "description",
                    "process_template", "state", "is_enabled", "access_status"))


def project_uuid(collection: Column, project: Column) -> Column:
    """A stable UUID-formatted id from the names (discovery ids are opaque)."""
    h = F.md5(F.concat_ws("/", collection, project))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
