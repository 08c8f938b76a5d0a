"""Dense surrogate keys without a single-task window.

``row_number().over(Window.orderBy(k))`` moves every row to one task. Here
rows are spread over ``B`` hash buckets of their ordering columns, numbered
inside each bucket, and shifted by the running total of the earlier buckets'
sizes. The offsets table has one row per (group, bucket), bounded by
``B × groups``, so broadcasting it is safe. Keys are dense and unique; their
order carries no meaning (like identity values, they only identify).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_index(df: DataFrame, order_cols: list[str], index_col: str,
                start: Column | int = 1, num_buckets: int | None = None,
                group_cols: list[str] | None = None) -> DataFrame:
    """Add ``index_col`` = start, start+1, … (per group when ``group_cols``).

    ``start`` may be a column of the group (e.g. its current maximum key + 1).
    """
    spark = df.sparkSession
    n = num_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = list(group_cols or [])
    start_col = start if isinstance(start, Column) else F.lit(start)
    bucketed = df.withColumn("_b", F.pmod(F.xxhash64(*order_cols), F.lit(n)))
    numbered = bucketed.withColumn(
        "_rn", F.row_number().over(Window.partitionBy(*groups, "_b").orderBy(*order_cols)))
    sizes = numbered.groupBy(*groups, "_b").agg(F.max("_rn").alias("_size"))
    before = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*groups, "_b",
                           F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (numbered.join(F.broadcast(offsets), [*groups, "_b"])
            .withColumn(index_col, (start_col + F.col("_offset") + F.col("_rn") - 1).cast("int"))
            .drop("_b", "_rn", "_offset"))
