"""Sharding by a Feistel permutation of global row numbers, in DataFrame operations only.

Rows get global numbers 0..n-1 in the order of a hash of their key columns,
without a global sort in one task: rows go to hash buckets, each bucket is
numbered on its own and shifted by the bucket's offset. A Feistel network
over the smallest power of two that holds n, with cycle walking back into
0..n-1, permutes the numbers. ``permuted % shards`` is the shard and
``permuted // shards`` the slot, so counts are at most one apart, slots have
no gaps, and anybody who knows (n, seed) can compute either from the number.

The network keeps the two halves of a b-bit number (b may be odd, the halves
then swap widths each round, and the number of rounds is even). Less than
half of the domain lies outside 0..n-1, so a walk of ``WALK`` steps fails
with probability below 2**-WALK per row; a failure raises an error instead
of giving a wrong place.

Defined results: null keys hash like a value of their own. Rows that agree in
all key columns are interchangeable; they get distinct numbers. They meet in
one bucket, whose numbering is a streaming sorted pass that spills. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bucket_offsets, power_of_two, staged

ROUNDS = 4
WALK = 96
ROWS_PER_BUCKET = 1_000
MAX_BUCKETS = 4_096


def _low_bits(bits: int) -> int:
    return (1 << bits) - 1


def feistel(number: Column, bits: int, seed: int, rounds: int = ROUNDS) -> Column:
    """One pass of the network over ``bits``-bit numbers."""
    left_bits, right_bits = bits // 2, bits - bits // 2
    left = F.shiftrightunsigned(number, right_bits)
    right = number.bitwiseAND(F.lit(_low_bits(right_bits)))
    for i in range(rounds):
        mixed = F.xxhash64(right, F.lit(seed * 1_000 + i).cast("long")).bitwiseAND(F.lit(_low_bits(left_bits)))
        left, right = right, left.bitwiseXOR(mixed)
        left_bits, right_bits = right_bits, left_bits
    return F.shiftleft(left, right_bits).bitwiseOR(right)


def permute(number: Column, n: int, seed: int) -> Column:
    """The permutation of 0..n-1 at ``number`` (long)."""
    if n <= 2:
        return number if n < 2 or seed % 2 == 0 else 1 - number
    bits = max(2, (n - 1).bit_length())
    step = lambda x: feistel(x, bits, seed)
    inside = lambda x: x < F.lit(n).cast("long")
    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), step(number.cast("long")),
                       lambda x, _: F.when(inside(x), x).otherwise(step(x)))


def global_numbers(df: DataFrame, keys: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """``df`` with gapless numbers 0..n-1 in ``name``, and n. ``df`` is read more
    than once: stage it first when it is costly."""
    n = df.count()
    buckets = power_of_two(-(-n // ROWS_PER_BUCKET), 1, MAX_BUCKETS)
    hashed = df.withColumn("_hash", F.xxhash64(*keys)).withColumn(
        "_bucket", F.col("_hash").bitwiseAND(F.lit(buckets - 1)).cast("int"))
    offsets = bucket_offsets(hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")), "_bucket", "_n", "_offset")
    inside = W.partitionBy("_bucket").orderBy("_hash", *keys)
    numbered = (hashed.withColumn("_rank", F.row_number().over(inside))
                .join(F.broadcast(offsets), "_bucket")   # at most MAX_BUCKETS rows
                .withColumn(name, (F.col("_offset") + F.col("_rank") - 1).cast("long")))
    return numbered.drop("_hash", "_bucket", "_offset", "_rank"), n


def shard_rows(df: DataFrame, keys: list[str], shards: int, seed: int = 42) -> DataFrame:
    """``df`` plus row_number, shard and slot under the law ``rows``."""
    numbered, n = global_numbers(df, keys)
    place = permute(F.col("row_number"), n, seed)
    return (numbered.withColumn("_place", place)
            .withColumn("_place", F.when(F.col("_place") < n, F.col("_place"))
                        .otherwise(F.raise_error(F.lit("cycle walk did not end"))))
            .withColumn("shard", F.pmod("_place", F.lit(shards)).cast("int"))
            .withColumn("slot", F.floor(F.col("_place") / F.lit(shards)).cast("long")).drop("_place"))
