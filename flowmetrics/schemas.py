"""Declared schemas of the staging and control tables.

Types follow the reference DDL except where noted: work-item ids are
``bigint`` (source ids at 100 TB scale exceed INT), timestamps are UTC
wall-clock ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import types as T

D2 = T.DecimalType(10, 2)

RAW_WORK_ITEMS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("rev", T.IntegerType(), False),
    T.StructField("url", T.StringType()),
    T.StructField("project_name", T.StringType(), False),
    T.StructField("work_item_type", T.StringType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("state", T.StringType(), False),
    T.StructField("reason", T.StringType()),
    T.StructField("assigned_to_name", T.StringType()),
    T.StructField("assigned_to_unique_name", T.StringType()),
    T.StructField("created_by_name", T.StringType()),
    T.StructField("created_by_unique_name", T.StringType()),
    T.StructField("created_date", T.TimestampNTZType()),
    T.StructField("changed_date", T.TimestampNTZType(), False),
    T.StructField("activated_date", T.TimestampNTZType()),
    T.StructField("closed_date", T.TimestampNTZType()),
    T.StructField("state_change_date", T.TimestampNTZType()),
    T.StructField("story_points", D2),
    T.StructField("original_estimate", D2),
    T.StructField("remaining_work", D2),
    T.StructField("completed_work", D2),
    T.StructField("priority", T.IntegerType()),
    T.StructField("severity", T.StringType()),
    T.StructField("area_path", T.StringType()),
    T.StructField("iteration_path", T.StringType()),
    T.StructField("tags", T.StringType()),
    T.StructField("fields_json", T.StringType(), False),
    T.StructField("ingested_at_utc", T.TimestampNTZType(), False),
])

RAW_COLUMNS = [f.name for f in RAW_WORK_ITEMS.fields]

SYNC_WATERMARKS = T.StructType([
    T.StructField("entity_name", T.StringType(), False),
    T.StructField("collection_name", T.StringType(), False),
    T.StructField("project_name", T.StringType(), False),
    T.StructField("last_watermark_utc", T.TimestampNTZType(), False),
    T.StructField("last_sync_start_utc", T.TimestampNTZType()),
    T.StructField("last_sync_end_utc", T.TimestampNTZType()),
    T.StructField("status", T.StringType(), False),
    T.StructField("records_extracted_last_run", T.IntegerType(), False),
    T.StructField("error_message", T.StringType()),
    T.StructField("created_at_utc", T.TimestampNTZType()),
    T.StructField("updated_at_utc", T.TimestampNTZType()),
])

CATALOG_PROJECTS = T.StructType([
    T.StructField("project_id", T.StringType(), False),
    T.StructField("collection_name", T.StringType(), False),
    T.StructField("project_name", T.StringType(), False),
    T.StructField("description", T.StringType()),
    T.StructField("process_template", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("is_enabled", T.BooleanType(), False),
    T.StructField("access_status", T.StringType(), False),
    T.StructField("last_discovered_utc", T.TimestampNTZType()),
])

CATALOG_COLLECTIONS = T.StructType([
    T.StructField("collection_name", T.StringType(), False),
    T.StructField("description", T.StringType()),
    T.StructField("is_enabled", T.BooleanType(), False),
    T.StructField("last_discovered_utc", T.TimestampNTZType()),
])

# Open record as landed by the source: {id, rev, url, fields: {name: any}}.
# ``fields`` stays a JSON string on read and becomes a VARIANT in mapping.
PAGE_ENVELOPE = T.StructType([
    T.StructField("count", T.IntegerType()),
    T.StructField("value", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("rev", T.IntegerType()),
        T.StructField("url", T.StringType()),
        T.StructField("fields", T.StringType()),
    ]))),
])

_REF = T.StructType([T.StructField("id", T.LongType()), T.StructField("url", T.StringType())])
ID_LIST_ENVELOPE = T.StructType([
    T.StructField("queryType", T.StringType()),
    T.StructField("queryResultType", T.StringType()),
    T.StructField("asOf", T.StringType()),
    T.StructField("workItems", T.ArrayType(_REF)),
    T.StructField("workItemRelations", T.ArrayType(T.StructType([
        T.StructField("rel", T.StringType()),
        T.StructField("source", _REF),
        T.StructField("target", _REF),
    ]))),
])

PROJECTS_ENVELOPE = T.StructType([
    T.StructField("count", T.IntegerType()),
    T.StructField("value", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("revision", T.LongType()),
    ]))),
])

COLLECTIONS_ENVELOPE = T.StructType([
    T.StructField("count", T.IntegerType()),
    T.StructField("value", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("state", T.StringType()),
    ]))),
])
