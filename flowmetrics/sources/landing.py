"""Readers of landed source documents: record pages, id lists, discovery envelopes.

The HTTP client of the source is not rebuilt; its responses are landed as
JSON documents (one envelope per line) and read with declared schemas. A
document that is null, broken or has no list gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fields as FX
from ..schemas import COLLECTIONS_ENVELOPE, ID_LIST_ENVELOPE, PAGE_ENVELOPE, PROJECTS_ENVELOPE, RAW_COLUMNS


# ------------------------------------------------------------------ record pages
def read_pages(documents: DataFrame, column: str = "document") -> DataFrame:
    """Parse page documents and flatten them to one row per record."""
    env = documents.select(F.from_json(F.col(column), PAGE_ENVELOPE).alias("e"))
    return env.select(F.explode("e.value").alias("r")).select("r.*")


def map_records(records: DataFrame, ingested_at, keep: list[str] | None = None) -> DataFrame:
    """Open record → the 28 typed staging columns (and the columns ``keep``)."""
    return read_records(records, ingested_at, keep).select(*RAW_COLUMNS, *(keep or []))


def read_records(records: DataFrame, ingested_at, keep: list[str] | None = None) -> DataFrame:
    """Open record → the 28 typed staging columns, ``bad_fields`` (see there) and the columns ``keep``."""
    unknown = F.lit("Unknown")
    # fixed values: the source's field names, and the text for missing ones
    s = lambda name: FX.text_string(_field(name), F.col("_payload"), name)
    cols = {
        "id": F.col("id"), "rev": F.col("rev"), "url": F.col("url"),
        "project_name": F.coalesce(s("System.TeamProject"), unknown),
        "work_item_type": F.coalesce(s("System.WorkItemType"), unknown),
        "title": s("System.Title"),
        "state": F.coalesce(s("System.State"), unknown),
        "reason": s("System.Reason"),
        "assigned_to_name": FX.identity_name(_field("System.AssignedTo"), None),
        "assigned_to_unique_name": FX.identity_unique(_field("System.AssignedTo"), None),
        "created_by_name": FX.identity_name(_field("System.CreatedBy"), None),
        "created_by_unique_name": FX.identity_unique(_field("System.CreatedBy"), None),
        "created_date": _read("System.CreatedDate"),
        # a missing change date reads as the ingestion time
        "changed_date": F.coalesce(_read("System.ChangedDate"), ingested_at),
        "activated_date": _read("Microsoft.VSTS.Common.ActivatedDate"),
        "closed_date": _read("Microsoft.VSTS.Common.ClosedDate"),
        "state_change_date": _read("Microsoft.VSTS.Common.StateChangeDate"),
        "story_points": _read("Microsoft.VSTS.Scheduling.StoryPoints"),
        "original_estimate": _read("Microsoft.VSTS.Scheduling.OriginalEstimate"),
        "remaining_work": _read("Microsoft.VSTS.Scheduling.RemainingWork"),
        "completed_work": _read("Microsoft.VSTS.Scheduling.CompletedWork"),
        "priority": FX.as_int(_field("Microsoft.VSTS.Common.Priority"), None),
        "severity": s("Microsoft.VSTS.Common.Severity"),
        "area_path": s("System.AreaPath"),
        "iteration_path": s("System.IterationPath"),
        "tags": s("System.Tags"),
        "fields_json": F.col("fields"),
        "ingested_at_utc": ingested_at,
    }
    return open_records(records).select(*[cols[c].alias(c) for c in RAW_COLUMNS], bad_fields().alias("bad_fields"), *(keep or []))


#: Reader of each kind of field.
READERS = {"string": FX.as_string, "int": FX.as_int, "decimal": FX.as_decimal, "double": FX.as_double,
           "timestamp": FX.as_timestamp, "boolean": FX.as_boolean}


def read_fields(records: DataFrame, kinds: dict[str, tuple[str, str]], keep: list[str]) -> DataFrame:
    """Fields outside the staging columns, typed: ``kinds`` is column → (field name,
    kind of ``READERS``). A missing field or one of another type is NULL."""
    v = F.try_parse_json(F.col("fields"))
    return records.select(*keep, *[READERS[kind](v, name).alias(c) for c, (name, kind) in kinds.items()])


# Fields with a typed reader that can reject a value (source would throw).
TYPED_FIELDS = [
    ("System.CreatedDate", "timestamp"), ("System.ChangedDate", "timestamp"),
    ("Microsoft.VSTS.Common.ActivatedDate", "timestamp"),
    ("Microsoft.VSTS.Common.ClosedDate", "timestamp"),
    ("Microsoft.VSTS.Common.StateChangeDate", "timestamp"),
    ("Microsoft.VSTS.Scheduling.StoryPoints", "number"),
    ("Microsoft.VSTS.Scheduling.OriginalEstimate", "number"),
    ("Microsoft.VSTS.Scheduling.RemainingWork", "number"),
    ("Microsoft.VSTS.Scheduling.CompletedWork", "number"),
    ("Microsoft.VSTS.Common.Priority", "number"),
]


IDENTITIES = ["System.AssignedTo", "System.CreatedBy"]
TEXT_FIELDS = ["System.TeamProject", "System.WorkItemType", "System.Title", "System.State", "System.Reason",
               "Microsoft.VSTS.Common.Severity", "System.AreaPath", "System.IterationPath", "System.Tags"]

UNREADABLE = "unreadable JSON"


def _field(name: str) -> Column:
    """The field of an opened record."""
    return F.col("_open").getField(name)


def _read(name: str) -> Column:
    """What the typed field of an opened record reads as."""
    return F.col(f"`_read {name}`")


def open_records(records: DataFrame) -> DataFrame:
    """The payload ``fields`` is parsed once, each field is looked for once and each typed one
    read once, in projections of their own, however many columns are made of them."""
    kinds = dict(TYPED_FIELDS)
    text = TEXT_FIELDS + [n for n, kind in kinds.items() if kind == "timestamp"]
    types = {n: "string" for n in text} | {n: "variant" for n in [*IDENTITIES, *kinds] if n not in text}
    v = records.withColumn("_payload", F.try_parse_json(F.col("fields")))
    v = v.withColumn("_open", FX.opened(F.col("_payload"), types))
    return v.select("*", *[(FX.text_timestamp(_field(n), F.col("_payload"), n) if kind == "timestamp" else FX.as_decimal(_field(n), None))
                           .alias(f"_read {n}") for n, kind in kinds.items()])


def bad_fields() -> Column:
    """Names of an opened record's typed fields whose value is present but cannot be read; a
    payload that is not JSON gives ``UNREADABLE``."""
    broken = F.when(F.col("fields").isNotNull() & F.col("_payload").isNull(), F.lit(UNREADABLE))
    present = {n: _field(n).isNotNull() if kind == "timestamp" else FX.present(_field(n), None) for n, kind in TYPED_FIELDS}
    return F.array_compact(F.array(broken, *[F.when(p & _read(n).isNull(), F.lit(n)) for n, p in present.items()]))


def field_type_errors(records: DataFrame) -> DataFrame:
    """Records whose typed fields hold unreadable values (quarantine)."""
    return (open_records(records).select("id", "rev", bad_fields().alias("bad_fields"), "fields")
            .filter(F.size("bad_fields") > 0))


# ------------------------------------------------------------------ id lists
def read_id_lists(documents: DataFrame, column: str = "document") -> DataFrame:
    """Ids of id-list responses: the flat list when present, else every
    source and target of the link list; NULLs dropped, de-duplicated."""
    env = documents.select(F.from_json(F.col(column), ID_LIST_ENVELOPE).alias("e"))
    flat = F.transform(F.col("e.workItems"), lambda r: r["id"])
    links = F.flatten(F.transform(F.col("e.workItemRelations"),
                                  lambda r: F.array(r["source"]["id"], r["target"]["id"])))
    ids = F.when(F.size(F.coalesce(F.col("e.workItems"), F.array())) > 0, flat).otherwise(links)
    return (env.select(F.explode(ids).alias("id")).filter(F.col("id").isNotNull())
            .distinct())


# ------------------------------------------------------------------ discovery
def read_projects(documents: DataFrame, collection_col: str = "collection_name",
                  column: str = "document") -> DataFrame:
    """All projects of the discovery responses of each collection."""
    env = documents.select(collection_col, F.from_json(F.col(column), PROJECTS_ENVELOPE).alias("e"))
    return (env.select(collection_col, F.explode(F.col("e.value")).alias("p"))
            .select(collection_col, F.col("p.id").alias("project_id"), F.col("p.name").alias("project_name"),
                    F.col("p.description").alias("description"), F.col("p.state").alias("state")))


def read_collections(documents: DataFrame, column: str = "document") -> DataFrame:
    env = documents.select(F.from_json(F.col(column), COLLECTIONS_ENVELOPE).alias("e"))
    return env.select(F.explode("e.value").alias("c")).select(
        F.col("c.name").alias("collection_name"), F.col("c.description").alias("description"))
