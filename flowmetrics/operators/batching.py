"""Ordered id chunks of at most ``n`` (the source's 200-item request limit).

``batch = (row_number() over (partition by key order by id) - 1) div n``.
A plain window needs one key's ids in one task. Here the rows are dealt by
range of (key, id): Spark samples the values for the bounds, so the parts
hold about equally many rows whatever the ids look like (one outlier id, hashes,
a key with a third of all rows). Rows are numbered inside their part and shifted
by the rows that the same key has in the parts before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.store import materialize

MAX_BATCH = 200
ROW_BITS = 33           # monotonically_increasing_id: part number above, row of the part below


def clamp_batch_size(n: int) -> int:
    return max(1, min(MAX_BATCH, int(n)))


def id_batches(df: DataFrame, batch_size: int = MAX_BATCH, id_col: str = "id",
               partition_cols: list[str] | None = None) -> DataFrame:
    """Add ``batch`` (0-based) to each row: consecutive ``batch_size`` ids in
    ``id_col`` order per partition key."""
    return chunks(df, clamp_batch_size(batch_size), id_col, partition_cols, "batch")


def chunks(df: DataFrame, size: int, id_col: str, partition_cols: list[str] | None, label: str) -> DataFrame:
    """Add the number ``label`` of each row's chunk of ``size`` rows, per key in ``id_col`` order."""
    ranked = ordered_rank(df, id_col, list(partition_cols or []))
    return ranked.withColumn(label, F.floor((F.col("_pos") - 1) / size).cast("int")).drop("_pos")


def ordered_rank(df: DataFrame, id_col: str, parts: list[str]) -> DataFrame:
    """1-based position ``_pos`` of each row in ``id_col`` order within ``parts``.

    The dealt rows are written once, so that their numbers stand; the table of
    (key, part) counts that is joined back has at most one row per part and key.
    """
    order = [*parts, id_col]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = materialize(dealt.withColumn("_row", F.monotonically_increasing_id()), "ranked")
    dealt = dealt.withColumn("_part", F.shiftright("_row", ROW_BITS))
    # a key's rows of one part are neighbours there
    sizes = dealt.groupBy(*parts, "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*parts).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # written: the planner knows its size, and moves no row of a large input to join it
    shift = materialize(sizes.select(*[F.col(c).alias(f"_of_{c}") for c in parts], F.col("_part").alias("_of_part"),
                         (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift")), "shifts")
    same = F.col("_part") == F.col("_of_part")
    for c in parts:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return dealt.join(shift, same).withColumn("_pos", F.col("_row") + F.col("_shift")).select(*df.columns, "_pos")


__all__ = ["MAX_BATCH", "chunks", "clamp_batch_size", "id_batches", "ordered_rank"]
