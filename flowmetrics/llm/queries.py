"""The registered digest queries of the training-data operators."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, exact_dedup, line_rules, mixing, packing, periodic_runs, quality, sharding, simhash, substrings,
               token_counts, toxicity, warc)
from .common import load, staged, text_or_empty

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SHARDS = 8


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_bwt_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(load(spark, sf_dir, "documents")).drop("spans")


@register
def op2_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in shards 0..7 under the law ``rows``; the row number is kept too."""
    raw = text_or_empty().cast("binary")
    rows = staged(load(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")), "sizes")
    return sharding.shard_rows(rows, ["doc_id", "size", "text_crc32"], SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number")


@register
def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judge(load(spark, sf_dir, "documents"))


@register
def op8_bloom_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(load(spark, sf_dir, "documents"))


@register
def op4_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.allocate(load(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


@register
def op6_simhash_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(load(spark, sf_dir, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register
def op5_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


@register
def op7_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_bundles(warc.write_bundles(load(spark, sf_dir, "pages")))


@register
def op9_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@register
def op10_byte_cnn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@register
def op11_merge_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(load(spark, sf_dir, "documents"))


@register
def op12_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_totals(load(spark, sf_dir, "documents"))


def planted(doc_id: int | None, words: list[str]) -> list[str]:
    """The words of one document in ten, by the hash of its id, made periodic from some
    place on. A document without an id keeps its words."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


@register
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the planted words: their number, the longest, and hashes of all of them
    and of the words that are left."""
    found = periodic_runs.find_runs(load(spark, sf_dir, "documents"), prepare=planted)
    # the greatest length, then the smallest start, then the smallest period
    ranked = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("best", ranked).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.expr("best.length * 1000 div -best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
