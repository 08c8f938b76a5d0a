"""Fact and daily state maintained from what changed.

A run takes the staging rows ingested since the last one (a filter on
``ingested_at_utc`` that reaches the scan), computes their fact rows, and

1. writes the new state of the snapshot measures: the stored state, minus what
   the changed items' old fact rows had added, plus what the new ones add, summed
   by (group, day);
2. upserts the new fact rows into the stored fact, touching only their buckets.

Nothing else of the fact is read or written: the old rows come out of the touched
buckets. The state has one row per (group, day), far fewer than items, and is
replaced as a whole beside the one in use. The changed rows are part of that
write, and a run that upserted them marks the state; where the mark is missing, the
run had stopped between the two steps, and the next starts with the missing half.

A work item's age depends on the day of reading, so the stored fact keeps the
instant an item ages from, and ``read_fact`` turns it into days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import durations as dur
from ..functions.calendar import ts_lit
from ..params import DEFAULT, RunParams
from ..schemas import D2
from ..sources.store import KeyedTable, SlotTable, materialize
from . import snapshot as SN
from .fact import FACT_COLUMNS, fact_work_items

ID = ["work_item_id"]
MERGED = "MERGED"       # mark of a state whose changes are in the fact
_TYPES = {"title": T.StringType(), "severity": T.StringType(), "tags": T.StringType(),
          "is_closed": T.BooleanType(), "is_active": T.BooleanType(), "work_item_id": T.LongType(),
          "rev": T.IntegerType(), "priority": T.IntegerType()}


def _type(column: str) -> T.DataType:
    if column in _TYPES:
        return _TYPES[column]
    if column.endswith("_key"):
        return T.IntegerType()
    return T.TimestampNTZType() if column.endswith("_utc") else D2


#: The stored fact: the age is kept as the instant it counts from.
STORED_COLUMNS = [c if c != "wip_age_days" else "ageing_since_utc" for c in FACT_COLUMNS if c != "last_transformed_at_utc"]
STORED_FACT = T.StructType([T.StructField(c, _type(c)) for c in STORED_COLUMNS])


def stored_rows(raw: DataFrame, dims: dict[str, DataFrame], keep: list[str] | None = None) -> DataFrame:
    """Fact rows as stored, and the staging columns ``keep``. An age in days is NULL exactly where the item does not age."""
    rows = fact_work_items(raw, dims, DEFAULT, keep=tuple(keep))
    since = F.when(F.col("wip_age_days").isNotNull(), F.coalesce("activated_date_utc", "created_date_utc"))
    return rows.withColumn("ageing_since_utc", since).select(*STORED_COLUMNS, *(keep or []))


class FlowStore:
    """The stored fact and snapshot state under ``root``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.fact = KeyedTable(spark, f"{root}/fact_work_items", STORED_FACT, ID, buckets, written=True)
        self.state = SlotTable(spark, f"{root}/flow_state")

    def _changes(self) -> DataFrame:
        return self.state.read("changes")

    def ingested_until(self) -> dt.datetime | None:
        """The latest ingestion time that the store has taken in."""
        return self.state.read("until").first().until if self.state.exists() else None

    def changed(self, raw: DataFrame) -> DataFrame:
        """Staging rows of the last ingestion taken in (again, harmlessly) and of those after it."""
        until = self.ingested_until()
        return raw if until is None else raw.filter(F.col("ingested_at_utc") >= ts_lit(until))

    def apply(self, changed: DataFrame, dims: dict[str, DataFrame]) -> None:
        """Take in changed staging rows."""
        if self.state.exists() and not self.state.marked(MERGED):
            self.fact.merge(self._changes())
        # one reading of the changed rows: their facts and how far they reach
        written = materialize(stored_rows(changed, dims, ["ingested_at_utc"]), "changed_facts")
        until = written.agg(F.max("ingested_at_utc").alias("until"))
        if until.first().until is None:
            return
        new = written.drop("ingested_at_utc")
        old = self.fact.rows_of(new.select(*ID))
        minus = SN.day_events(old)
        minus = minus.select(*SN.GROUP, "day", *[(-F.col(m)).cast(t).alias(m) for m, t in SN.MEASURES.items()])
        parts = SN.day_events(new).unionByName(minus)
        if self.state.exists():
            parts = parts.unionByName(self.state.read())
        nothing = " AND ".join(f"{m} = 0" for m in SN.MEASURES)
        state = SN.summed(parts).filter(f"NOT ({nothing})")
        self.state.write(rows=state, changes=new, until=until)
        self.fact.merge(new)
        self.state.mark(MERGED)

    def read_fact(self, params: RunParams = DEFAULT) -> DataFrame:
        """The fact as of ``params.as_of``."""
        age = F.when(F.col("ageing_since_utc").isNotNull(),
                     dur.days_between(F.col("ageing_since_utc"), ts_lit(params.as_of)))
        return (self.fact.read().withColumn("wip_age_days", age)
                .withColumn("last_transformed_at_utc", ts_lit(params.as_of)).select(*FACT_COLUMNS))

    def snapshot(self, params: RunParams = DEFAULT) -> DataFrame:
        """The window's snapshot, from the state alone."""
        return SN.snapshot_of_state(self.state.read(), params)
