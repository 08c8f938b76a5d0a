"""Landed documents: record pages, id lists, discovery envelopes.

Every builder is a DataFrame plan over its input, so the documents grow with the
tables. Beside the pages that hold the data each project (or status,
collection) gets an empty one, one whose list is null, a null document and one
cut off in the middle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.batching import id_batches
from ..schemas import ID_LIST_ENVELOPE

MAX_PAGE = 200


def awkward(documents: DataFrame, group: str, empty: str) -> DataFrame:
    """``documents`` (``document``, ``batch``: from 0 in each ``group``) and, per ``group``,
    documents that give no row. The filter on the first batch reaches the rows the
    documents are made of, so the others are not built again."""
    first = documents.filter(F.col("batch") == 0)
    broken = F.expr("left(document, length(document) div 2)")
    extra = first.select(group, F.explode(F.array(
        F.lit(empty), F.lit('{"value": null}'), F.lit(None).cast("string"), broken)).alias("document"))
    return documents.unionByName(extra.withColumn("batch", F.lit(-1)))


def record_pages(raw: DataFrame, page_size: int = MAX_PAGE) -> DataFrame:
    """``{count, value:[{id, rev, url, fields}]}`` documents of at most ``page_size``
    records, per project in id order; ``fields`` as JSON text."""
    b = id_batches(raw.select("id", "rev", "url", "project_name", "fields_json"), page_size, partition_cols=["project_name"])
    rec = F.struct(F.col("id"), F.col("rev"), F.col("url"), F.col("fields_json").alias("fields"))
    return (b.groupBy("project_name", "batch")
            .agg(F.count(F.lit(1)).cast("int").alias("count"), F.sort_array(F.collect_list(rec)).alias("value"))
            .select("project_name", "batch", F.to_json(F.struct("count", "value")).alias("document")))


def responses(records: DataFrame, collection: Column, page_size: int = MAX_PAGE, fields: Column | None = None) -> DataFrame:
    """Responses as the ingest reads them: ``{collection, project, status, count, value}``
    with ``fields`` an object. ``records``: id, rev, url, project_name, area_path, fields_json.
    ``fields``: the object, made of columns of ``records`` in place of ``fields_json``; the
    columns are dealt to the pages, and only the page is written as text."""
    if fields is None:
        records, fields = records.select("id", "rev", "url", "project_name", "area_path", "fields_json"), F.parse_json("fields_json")
    b = id_batches(records.withColumn("collection", collection), page_size, partition_cols=["collection", "project_name"])
    rec = F.struct("id", "rev", "url", fields.alias("fields"))
    page = b.groupBy("collection", "project_name", "batch").agg(
        F.count(F.lit(1)).alias("count"), F.collect_list(rec).alias("value"))
    return page.select("batch", F.to_json(F.struct(
        "collection", F.col("project_name").alias("project"), F.lit(200).alias("status"), "count", "value")).alias("document"))


def refusals(projects: DataFrame) -> DataFrame:
    """Error responses: ``projects`` holds collection_name, project_name, status, message."""
    return projects.select(F.to_json(F.struct(
        F.col("collection_name").alias("collection"), F.col("project_name").alias("project"), "status", "message"))
        .alias("document"))


def land(documents: DataFrame, folder: str) -> None:
    """Append the documents to a landing folder, one a line; each task's file is compressed."""
    documents.select("document").write.mode("append").option("compression", "gzip").text(folder)


def id_list_documents(orders: DataFrame, page_size: int = MAX_PAGE) -> DataFrame:
    """Id-list responses from orders: open orders as flat lists; other orders as
    link lists (order → the customer's first order), with ends missing on either
    side here and there; at most ``page_size`` references each."""
    first = orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("parent"))
    o = orders.select(F.col("o_orderkey").alias("id"), "o_custkey", "o_orderstatus").join(first, "o_custkey")
    b = id_batches(o, page_size, partition_cols=["o_orderstatus"])
    ref = lambda c: F.struct(c.alias("id"), F.lit(None).cast("string").alias("url"))
    # an end that is missing, or whose id is: the order itself stays on the other side
    target = F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(
        ref(F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("parent"))))
    flat = F.struct(F.lit("flat").alias("queryType"), F.lit("workItem").alias("queryResultType"),
                    F.collect_list(ref(F.col("id"))).alias("workItems"),
                    F.array().cast(ID_LIST_ENVELOPE["workItemRelations"].dataType).alias("workItemRelations"))
    link = F.struct(F.lit("oneHop").alias("queryType"), F.lit("workItemLink").alias("queryResultType"),
                    F.array().cast(ID_LIST_ENVELOPE["workItems"].dataType).alias("workItems"),
                    F.collect_list(F.struct(F.lit("parent").alias("rel"), ref(F.col("id")).alias("source"),
                                            target.alias("target"))).alias("workItemRelations"))
    documents = (b.groupBy("o_orderstatus", "batch")
                 .agg(F.when(F.first("o_orderstatus") == "O", F.to_json(flat)).otherwise(F.to_json(link)).alias("document")))
    return awkward(documents, "o_orderstatus", '{"workItems": [], "workItemRelations": []}')


def discovery_documents(projects: DataFrame, page_size: int = MAX_PAGE) -> tuple[DataFrame, DataFrame]:
    """Discovery responses from (collection_name, project_id, project_name,
    description): projects documents per (collection, page), collections documents per page."""
    b = id_batches(projects, page_size, "project_id", partition_cols=["collection_name"])
    proj = F.struct(F.col("project_id").alias("id"), F.col("project_name").alias("name"),
                    F.col("description"), F.lit("wellFormed").alias("state"), F.lit(1).cast("long").alias("revision"))
    value = F.sort_array(F.collect_list(proj)).alias("value")
    pages = (b.groupBy("collection_name", "batch")
             .agg(F.to_json(F.struct(F.count(F.lit(1)).cast("int").alias("count"), value)).alias("document")))
    named = id_batches(projects.select("collection_name").distinct(), page_size, "collection_name")
    coll = F.struct(F.col("collection_name").alias("id"), F.col("collection_name").alias("name"),
                    F.lit(None).cast("string").alias("description"), F.lit("Started").alias("state"))
    collections = (named.groupBy("batch")
                   .agg(F.to_json(F.struct(F.count(F.lit(1)).cast("int").alias("count"),
                                           F.sort_array(F.collect_list(coll)).alias("value"))).alias("document"))
                   .withColumn("kind", F.lit("collections")))
    empty = '{"count": 0, "value": []}'
    return awkward(collections, "kind", empty), awkward(pages, "collection_name", empty)
