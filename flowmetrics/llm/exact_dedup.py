"""Exact dedup with a two-pass Bloom filter, in DataFrame operations only.

Pass 1 hashes every text and counts, per bit of a blocked Bloom filter, the
rows that set it; the bits that two or more rows set make the *repeat filter*.
Copies are pre-aggregated before that shuffle, so a group that holds a third
of all rows adds a few counts per task. Pass 2 tests every row against the
filter: a row with a bit that no other row sets has no copy and passes
straight through; only the others shuffle, and an exact grouping by SHA-256
decides among them. False positives cost a shuffle of that row and nothing
else, so results are exact at every filter size.

The filter grows with the rows, 16 bits for each, and is broadcast in parts of at
most ``max_bits`` (32 MB by default): ``exact_copies`` deals the written digests
by part, without a shuffle, and tests one part after the other, so the share of
unique rows that shuffle is the same at every size. ``drop_exact_copies`` reads
the texts once against a single part; past ``max_bits / 16`` rows more texts
shuffle there unless ``max_bits`` is raised.

Defined results: a null text counts as empty, empty texts equal each other.
Of repeated rows with one doc_id and equal texts, one row is kept. A null
doc_id sorts below every number. An empty table gives an empty result. Other
columns of the input are not read (``exact_copies``) or ride along unread
(``drop_exact_copies``), so their names cannot clash.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, power_of_two, staged, text_or_empty

BLOCK_BITS = 1 << 15          # bits of one bitmap row (fixed by bitmap_construct_agg)
BITS_PER_ROW = 16
MAX_BITS, MAX_BLOCKS = 1 << 28, 1 << 30
PROBE_SHIFTS = (19, 34, 49)   # three disjoint 15-bit fields; the block takes lower bits


def normalised(text: str = "text") -> Column:
    return ascii_lower(text_or_empty(text))


def digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def _block(sha: Column, blocks: int) -> Column:
    # past 2^19 blocks the lower bits would meet the first probe's
    own = F.xxhash64(sha) if blocks <= 1 << PROBE_SHIFTS[0] else F.xxhash64(sha, F.lit(1))
    return own.bitwiseAND(F.lit(blocks - 1)).cast("int")


def _probes(sha: Column) -> list[Column]:
    return [F.shiftrightunsigned(F.xxhash64(sha), s).bitwiseAND(F.lit(BLOCK_BITS - 1)) for s in PROBE_SHIFTS]


def filter_blocks(rows: int, max_bits: int = MAX_BITS) -> int:
    return power_of_two(rows * BITS_PER_ROW, BLOCK_BITS, max_bits) // BLOCK_BITS


def repeat_filter(hashed: DataFrame, blocks: int, least: int = 2) -> DataFrame:
    """(block, bitmap) of the bits that ``least`` or more rows of ``hashed.sha`` set."""
    return (hashed.select(_block(F.col("sha"), blocks).alias("block"),
                          F.explode(F.array_distinct(F.array(*_probes(F.col("sha"))))).alias("bit"))
            .groupBy("block", "bit").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
            .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap")))


def _bit_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte.cast("long"), bit.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))


def with_repeat_flag(df: DataFrame, bits: DataFrame, blocks: int) -> DataFrame:
    """``df`` (with ``sha``) plus ``maybe_repeated``. The broadcast side has at
    most ``MAX_BITS / BLOCK_BITS`` rows of 4 KB."""
    test = None
    for p in _probes(F.col("sha")):
        one = _bit_set(F.col("bitmap"), p)
        test = one if test is None else test & one
    return (df.withColumn("block", _block(F.col("sha"), blocks))
            .join(F.broadcast(bits), "block", "left")
            .withColumn("maybe_repeated", test).drop("block", "bitmap"))


def _flagged(rows: DataFrame, max_bits: int) -> DataFrame:
    """The written ``rows`` (with ``sha``) plus ``maybe_repeated``, written. A filter beyond
    ``max_bits`` is built, broadcast and tested in parts of whole blocks."""
    blocks = filter_blocks(rows.count(), MAX_BLOCKS * BLOCK_BITS)
    parts = -(-blocks * BLOCK_BITS // max(max_bits, BLOCK_BITS))
    if parts == 1:
        return staged(with_repeat_flag(rows, repeat_filter(rows, blocks), blocks), "flagged")
    part = F.pmod(_block(F.col("sha"), blocks), F.lit(parts))
    dealt = staged(rows.withColumn("part", part), "parts", by="part")
    done = []
    for k in range(parts):
        own = dealt.filter(F.col("part") == k).drop("part")
        done.append(staged(with_repeat_flag(own, repeat_filter(own, blocks), blocks), "flagged"))
    return reduce(DataFrame.unionByName, done)


def exact_copies(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = staged(docs.select("doc_id", digest().alias("sha"),
                              F.monotonically_increasing_id().alias("row_id")), "digests")
    flagged = _flagged(rows, max_bits)
    alone = flagged.filter("NOT maybe_repeated").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha")
    repeated = flagged.filter("maybe_repeated").drop("maybe_repeated")
    # written before the join back, whose row side Spark then splits at hot digests
    groups = staged(repeated.groupBy("sha").agg(F.count(F.lit(1)).alias("group_size"),
                                                F.max(F.struct("doc_id", "row_id")).alias("keep")), "groups")
    grouped = repeated.join(groups, "sha").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("keep.row_id")).alias("kept"), "sha")
    return alone.unionByName(grouped).select("doc_id", "keep_id", "group_size", "kept",
                                             F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with the row of the largest doc_id of each group of equal texts; among
    rows of one doc_id the last by text, then by all columns.

    Rows without a copy keep their place; only possibly repeated rows shuffle,
    after each task has kept its largest row per text."""
    packed = docs.select(F.struct("*").alias("row"), digest().alias("sha"))
    hashes = staged(packed.select("sha"), "hashes")
    blocks = filter_blocks(hashes.count(), max_bits)
    flagged = with_repeat_flag(packed, staged(repeat_filter(hashes, blocks), "repeat_filter"), blocks)
    alone = flagged.filter("NOT maybe_repeated").select("row")
    best = (flagged.filter("maybe_repeated").groupBy("sha")
            .agg(F.max_by("row", F.struct("row.doc_id", "row.text", F.to_json("row"))).alias("row")).select("row"))
    return alone.unionByName(best).select("row.*")
