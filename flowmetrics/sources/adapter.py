"""Work items derived from the driver's TPC-H-like tables.

The staging table ``raw_work_items`` is normally filled by ingestion
(``streaming.ingest``). For tests and benchmarks it is derived from
``orders ⋈ customer ⋈ nation ⋈ region``, the per-order lineitem aggregate and
``supplier`` (see FIXTURES.md §3). With ``k = o_orderkey``:

* type and state are picked from fixed lists by ``k`` modulo the list size;
* activation / closure are offsets of the first / last ship date;
* ship dates are independent of order dates, so every guard of the duration
  rules (closed before created, activated after closed, …) is exercised.

Plan shape: lineitem is pre-aggregated per order (partial aggregation before
the shuffle). The per-order aggregate grows with the data, so its join to
``orders`` is a sort-merge join on the order key at every size (hint, not a
size-dependent broadcast); the order key is unique on both sides, so the join
has no hot keys. It is the last join between large inputs, so the 28-column
projection, the JSON serialisation and the write run in its post-shuffle
stage, one task per shuffle partition, however the inputs are split.
Customer, nation, region and supplier are left to the planner (broadcast
under the size threshold, sort-merge above it; AQE splits skewed customers).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import DEFAULT, RunParams
from ..schemas import D2, RAW_COLUMNS
from .tables import table
from ..functions.calendar import ts_lit

# Fixed values of the adapter (FIXTURES.md §3), in order of ``k % len``.
WORK_ITEM_TYPES = ["Epic", "Feature", "User Story", "Product Backlog Item", "BUG",
                   "Defect", "Task", "sub-task", "Spike"]
STATES_F = ["Closed", "Done", "resolved", "Removed"]
STATES_O = ["Active", "In Progress", "DOING", "Triage"]
STATES_P = ["New", "To Do", "Backlog", ""]
MAIL_DOMAIN = "@x.test"
DECIMAL_FIELDS = ["Microsoft.VSTS.Scheduling." + n for n in ("StoryPoints", "OriginalEstimate", "RemainingWork", "CompletedWork")]
URL_PREFIX = "https://tracker.invalid/workitems/"


def _pick(values: list[str], k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))


def _iso(ts: Column) -> Column:
    # 'yyyy-MM-dd HH:mm:ss[.ffffff]' → ISO 8601 in UTC
    return F.concat(F.overlay(ts.cast("string"), F.lit("T"), F.lit(11), F.lit(1)), F.lit("Z"))


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with customer geography, line aggregate, supplier."""
    li = (table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.min("l_shipdate").alias("first_ship"),
               F.max("l_shipdate").alias("last_ship"),
               F.count(F.lit(1)).alias("n_lines"),
               F.sum("l_quantity").alias("qty"),
               F.min("l_suppkey").alias("sk")))
    cust = (table(spark, sf_dir, "customer")
            .select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
            .join(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"),
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
                  F.col("n_regionkey") == F.col("r_regionkey")))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return (orders
            .join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .join(li.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
            .join(supp, F.col("s_suppkey") == F.col("sk"), "left"))


def raw_work_items(spark: SparkSession, sf_dir: str, params: RunParams = DEFAULT) -> DataFrame:
    """The staging table ``raw_work_items`` (28 columns) for ``sf_dir``."""
    src = order_facts(spark, sf_dir)
    k = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    bs = F.lit("\\")

    state = (F.when(status == "F", _pick(STATES_F, k))
             .when(status == "O", _pick(STATES_O, k))
             .otherwise(_pick(STATES_P, k)))
    assigned = F.when(k % 11 != 0, F.col("s_name"))
    assigned_unique = F.when((k % 11 != 0) & (k % 7 != 0),
                             F.concat(F.lower("s_name"), F.lit(MAIL_DOMAIN)))
    activated = F.when(status != "P", F.col("first_ship") + _minutes(k % 1440))
    closed = F.when(((status == "F") & (k % 13 != 0)) | ((status == "O") & (k % 29 == 0)),
                    F.col("last_ship") + _minutes((k * 7) % 1440))
    segment = F.col("r_name")
    iteration = (F.when(k % 17 == 0, F.concat(segment, bs))
                 .when(k % 19 == 0, F.lit("Backlog"))
                 .otherwise(F.concat(segment, bs, F.lit("Sprint "), (k % 10 + 1).cast("string"))))

    typed = src.select(
        k.alias("id"),
        (F.lit(1) + F.coalesce(F.col("n_lines"), F.lit(0))).cast("int").alias("rev"),
        F.concat(F.lit(URL_PREFIX), k.cast("string")).alias("url"),
        F.col("c_mktsegment").alias("project_name"),
        _pick(WORK_ITEM_TYPES, k).alias("work_item_type"),
        F.concat(F.lit("Order "), k.cast("string"), F.lit(" for "), F.col("c_name")).alias("title"),
        state.alias("state"),
        F.when(status == "F", F.lit("Completed")).when(status == "O", F.lit("Work started"))
        .otherwise(F.lit("New")).alias("reason"),
        assigned.alias("assigned_to_name"),
        assigned_unique.alias("assigned_to_unique_name"),
        F.col("c_name").alias("created_by_name"),
        F.concat(F.lower("c_name"), F.lit(MAIL_DOMAIN)).alias("created_by_unique_name"),
        F.col("o_orderdate").alias("created_date"),
        activated.alias("activated_date"),
        closed.alias("closed_date"),
        F.when(k % 10 != 0, F.col("n_lines").cast(D2)).alias("story_points"),
        F.col("qty").cast(D2).alias("original_estimate"),
        (k % 10).cast(D2).alias("remaining_work"),
        (k % 5).cast(D2).alias("completed_work"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.col("o_orderpriority").alias("severity"),
        F.concat(F.col("r_name"), bs, F.col("n_name")).alias("area_path"),
        iteration.alias("iteration_path"),
        F.when(k % 2 == 0, F.lit("Backend; BI")).otherwise(F.lit("Frontend; Urgent")).alias("tags"),
    )
    typed = typed.select(
        "*", F.coalesce("closed_date", "activated_date", "created_date").alias("changed_date"),
        F.coalesce("closed_date", "activated_date").alias("state_change_date"),
        ts_lit(params.as_of).alias("ingested_at_utc"))
    return typed.select(*[c if c != "fields_json" else fields_json().alias(c) for c in RAW_COLUMNS])


def open_fields() -> dict[str, Column]:
    """The source's open field map of the typed columns, by field name."""
    def ident(name: str, unique: str) -> Column:
        return F.when(F.col(name).isNotNull(),
                      F.struct(F.col(name).alias("displayName"), F.col(unique).alias("uniqueName")))
    return {
        "System.TeamProject": F.col("project_name"),
        "System.WorkItemType": F.col("work_item_type"),
        "System.Title": F.col("title"),
        "System.State": F.col("state"),
        "System.Reason": F.col("reason"),
        "System.AssignedTo": ident("assigned_to_name", "assigned_to_unique_name"),
        "System.CreatedBy": ident("created_by_name", "created_by_unique_name"),
        "System.CreatedDate": _iso(F.col("created_date")),
        "System.ChangedDate": _iso(F.col("changed_date")),
        "Microsoft.VSTS.Common.ActivatedDate": _iso(F.col("activated_date")),
        "Microsoft.VSTS.Common.ClosedDate": _iso(F.col("closed_date")),
        "Microsoft.VSTS.Common.StateChangeDate": _iso(F.col("state_change_date")),
        "Microsoft.VSTS.Scheduling.StoryPoints": F.col("story_points"),
        "Microsoft.VSTS.Scheduling.OriginalEstimate": F.col("original_estimate"),
        "Microsoft.VSTS.Scheduling.RemainingWork": F.col("remaining_work"),
        "Microsoft.VSTS.Scheduling.CompletedWork": F.col("completed_work"),
        "Microsoft.VSTS.Common.Priority": F.col("priority"),
        "Microsoft.VSTS.Common.Severity": F.col("severity"),
        "System.AreaPath": F.col("area_path"),
        "System.IterationPath": F.col("iteration_path"),
        "System.Tags": F.col("tags"),
    }


def fields_json() -> Column:
    """Serialise the typed columns back into the source's open field map."""
    return F.to_json(F.struct(*[c.alias(name) for name, c in open_fields().items()]))


def fields_object() -> Column:
    """The same map for a document that holds it as an object: it is written as the VARIANT
    of ``fields_json`` would be (names in order, numbers without closing zeros)."""
    fields = open_fields()
    return F.struct(*[(fields[n].cast("variant") if n in DECIMAL_FIELDS else fields[n]).alias(n) for n in sorted(fields)])
