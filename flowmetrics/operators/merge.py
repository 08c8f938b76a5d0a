"""Keyed upsert (``INSERT … ON CONFLICT``): a left join for updates, an anti join for inserts.

``merge_by_key(current, incoming, keys, update_cols)`` returns
unmatched current rows ∪ matched rows with ``update_cols`` taken from the
incoming side (even when NULL, like ``SET c = EXCLUDED.c``) ∪ new rows.
``update_cols=[]`` is ``DO NOTHING``. Columns of ``current`` absent from
``incoming`` are filled from ``insert_defaults`` (or NULL) for new rows.
``incoming`` holds at most one row per key. ``newer`` names order columns: a
matched row is updated only if the incoming order is not the earlier one (a
missing order value counts as the earliest).

Shape: the incoming rows are joined to the current ones from the right, so a
batch under the broadcast threshold leaves the current rows where they are. The
insert branch does not look at the whole target: the target is first reduced
to the keys that the batch holds (a left-semi join, again with the batch on the
broadcast side), and only those keys are anti-joined. There are never
more of them than rows in the batch, so ``small_batch`` (the caller has
counted the batch) broadcasts them too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A batch of so many rows at most has its keys broadcast (they are bounded by it).
SMALL_BATCH_ROWS = 100_000


def fresh_name(name: str, taken) -> str:
    """``name``, lengthened until it clashes with no column of ``taken``."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def merge_by_key(current: DataFrame, incoming: DataFrame, keys: list[str],
                 update_cols: list[str] | None = None,
                 insert_defaults: dict[str, Column] | None = None,
                 newer: list[str] | None = None, small_batch: bool = False) -> DataFrame:
    cols = current.columns
    inc_cols = set(incoming.columns)
    updates = set(cols) - set(keys) if update_cols is None else set(update_cols) - set(keys)
    defaults = insert_defaults or {}
    row = fresh_name("incoming", [*cols, *inc_cols])
    batch = incoming.select(F.struct(*[F.col(x) for x in incoming.columns]).alias(row))
    batch_keys = incoming.select(*keys)
    if small_batch:
        batch, batch_keys = F.broadcast(batch), F.broadcast(batch_keys)
    joined = current.join(batch, reduce(Column.__and__, [F.col(k) == F.col(row)[k] for k in keys]), "left")
    hit = F.col(row).isNotNull()
    if newer:
        hit = hit & (F.struct(*[F.col(row)[c] for c in newer]) >= F.struct(*[F.col(c) for c in newer]))

    def incoming_value(x: str, of) -> Column:
        return of(x) if x in inc_cols else defaults.get(x, F.lit(None))
    kept = joined.select(*[
        F.when(hit, incoming_value(x, lambda c: F.col(row)[c])).otherwise(F.col(x))
        .cast(current.schema[x].dataType).alias(x) if x in updates else F.col(x) for x in cols])
    found = current.select(*keys).join(batch_keys, keys, "left_semi")
    if small_batch:
        found = F.broadcast(found)
    new = incoming.join(found, keys, "left_anti").select(*[
        incoming_value(x, F.col).cast(current.schema[x].dataType).alias(x) for x in cols])
    return kept.unionByName(new)


def merge_dealt(current: DataFrame, incoming: DataFrame, keys: list[str], deal, dealt_by: list[str],
                update_cols: list[str] | None = None, newer: list[str] | None = None) -> DataFrame:
    """``merge_by_key`` of two frames with the same columns, for a large batch: ``deal``
    moves the rows of both at once by the columns ``dealt_by`` (functions of the keys, which
    it adds), and a key's rows are then neighbours in their task. A null key matches nothing."""
    cols = current.columns
    updates = set(cols) - set(keys) if update_cols is None else set(update_cols) - set(keys)
    side, row, more = (fresh_name(n, [*cols, *dealt_by]) for n in ("_incoming", "incoming", "_more"))
    both = deal(current.withColumn(side, F.lit(0)).unionByName(incoming.select(*cols).withColumn(side, F.lit(1))))
    of_key = Window.partitionBy(*dealt_by, *keys).orderBy(F.col(side).desc())
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    both = both.withColumn(row, F.first(F.when(F.col(side) == 1, F.struct(*cols))).over(of_key)).withColumn(
        more, F.lead(F.lit(True)).over(of_key))
    hit = (F.col(side) == 0) & known & F.col(row).isNotNull()
    if newer:
        hit = hit & (F.struct(*[F.col(row)[c] for c in newer]) >= F.struct(*[F.col(c) for c in newer]))
    # an incoming row stands for itself only where no stored one has its key
    both = both.filter((F.col(side) == 0) | ~known | F.col(more).isNull())
    return both.select(*[F.when(hit, F.col(row)[c]).otherwise(F.col(c)).alias(c) if c in updates else F.col(c) for c in cols],
                       *dealt_by)


def dedupe_last(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the last by ``order_by``, ties by all other columns.

    ``max`` over a struct aggregates partially before the shuffle, so a hot
    key costs one row per map partition, not one task holding the group. The struct
    holds the order columns first and then the others, each once.
    """
    rest = [c for c in df.columns if c not in keys]
    row = fresh_name("row", df.columns)
    order = [c for c in dict.fromkeys(order_by) if c in rest]
    whole = F.struct(*[F.col(c) for c in [*order, *(c for c in rest if c not in order)]])
    return df.groupBy(*keys).agg(F.max(whole).alias(row)).select(*keys, *[F.col(row)[c].alias(c) for c in rest])
