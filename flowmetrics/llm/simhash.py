"""SimHash near-dedup over a Gray-order hierarchical index.

Fingerprints are 64-bit majority votes over the XXH64 values of word shingles
(Arrow batches, one pass over whole texts). Linking is exact for every pair
of different fingerprints at up to ``DISTANCE`` = 4 differing bits:

1. *Buckets.* 64 bits fall into b blocks; a pair within 4 bits agrees in at
   least b - 4 of them. Each fingerprint goes, once per choice of b - 4
   blocks, to the bucket of its bits there. b grows with the number of
   fingerprints (5, 6, 7: up to 5, 15, 35 choices) so that buckets stay small;
   every b finds every link.
2. *Chunks.* Buckets over ``CHUNK`` members are dealt into chunks, and every
   pair of chunks is a group of its own, so no group outgrows a task.
3. *Index.* Within a group fingerprints are sorted by Gray rank. Runs of
   neighbours form nodes that hold the bits all members share; runs of nodes
   form upper nodes, and a child keeps only the shared bits its parent lacks.
   A search accumulates differences from the top down and drops a whole node
   once it exceeds the distance.
4. *Links.* A group emits a star per local component, never all pairs.
   Components follow by large-star / small-star rounds on Spark.

Equal fingerprints are one node (grouped before linking), so groups of copies
cost one row each. Defined results: a null or empty text has fingerprint 0 and
links like any other; a component_id is the smallest non-null doc_id reached
(null where all are null); repeated rows give repeated rows; an empty table
gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .components import connected

SHINGLE = 4
DISTANCE = 4
SEED = 42
CHUNK = 4_096
FAN_OUT = 16
QUERY_BLOCK = 512
#: (largest number of fingerprints, blocks)
LAYOUTS = ((1 << 21, 5), (1 << 29, 6), (1 << 62, 7))

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_COLUMN = (np.arange(8) * 256).astype(np.int64)


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    words = data.lower().split()      # bytes: A-Z only, and the six separators of the contract
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = len(words) - shingle + 1
    one = xxhash.xxh64_intdigest
    hashes = np.fromiter((one(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())),
                         np.uint64, n)
    counts = np.zeros(2_048, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8) + _COLUMN
        counts += np.bincount(part.ravel(), minlength=2_048)
    votes = (counts.reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint as a signed long; text_hash
    tells rows with one doc_id and different texts apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle)
                               for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "text_hash", "fp"])
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, "doc_id long, text_hash long, fp long")


# ------------------------------------------------------------------ the index within a group
def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of a code word in the binary-reflected Gray sequence."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


class GrayIndex:
    """Levels from the top: each is (pattern, residual mask) per node, where the
    residual holds shared bits that the parent does not hold."""

    def __init__(self, fps: np.ndarray):
        self.order = np.argsort(gray_rank(fps))
        self.fps = fps[self.order]
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        levels = [(self.fps, np.full(len(fps), full))]      # leaves: all bits fixed
        pattern, mask = levels[0]
        while len(pattern) > FAN_OUT:
            at = np.arange(0, len(pattern), FAN_OUT)
            ones, same = np.bitwise_and.reduceat(pattern, at), np.bitwise_and.reduceat(mask, at)
            shared = same & ~(ones ^ np.bitwise_or.reduceat(pattern, at))
            pattern, mask = ones & shared, shared
            levels.append((pattern, mask))
        self.levels = []
        for depth, (pattern, mask) in enumerate(levels):
            if depth + 1 < len(levels):
                mask = mask & ~np.repeat(levels[depth + 1][1], FAN_OUT)[:len(mask)]
            self.levels.append((pattern, mask))
        self.levels.reverse()

    def search(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """(query position, leaf position) of all pairs within ``distance``."""
        top_pattern, _ = self.levels[0]
        q = np.repeat(np.arange(len(queries)), len(top_pattern))
        node = np.tile(np.arange(len(top_pattern)), len(queries))
        acc = np.zeros(len(q), np.int64)
        for depth, (pattern, residual) in enumerate(self.levels):
            if depth:
                q = np.repeat(q, FAN_OUT)
                acc = np.repeat(acc, FAN_OUT)
                node = (node[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                inside = node < len(pattern)
                q, acc, node = q[inside], acc[inside], node[inside]
            acc = acc + np.bitwise_count((queries[q] ^ pattern[node]) & residual[node])
            near = acc <= distance
            q, node, acc = q[near], node[near], acc[near]
        return q, node


def group_links(fps: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (member, root) of the components of ``fps`` within a group."""
    index = GrayIndex(fps)
    label = np.arange(len(fps))
    for i in range(0, len(fps), QUERY_BLOCK):
        q, leaf = index.search(index.fps[i:i + QUERY_BLOCK], distance)
        q = q + i
        upper = leaf > q
        a, b = q[upper], leaf[upper]
        while len(a):
            la, lb = label[a], label[b]
            differ = la != lb
            if not differ.any():
                break
            a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
            low = np.minimum(la, lb)
            np.minimum.at(label, la, low)
            np.minimum.at(label, lb, low)
            while True:                        # every label points at a root
                up = label[label]
                if (up == label).all():
                    break
                label = up
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return index.fps[linked], index.fps[label[linked]]


# ------------------------------------------------------------------ buckets on Spark
def block_masks(blocks: int, distance: int = DISTANCE) -> list[int]:
    """One 64-bit mask per choice of ``blocks - distance`` blocks."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(parts, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _links_of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream of rows sorted by group; at most one group and one batch are held."""
    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        out = [group_links(part) for part in np.split(fps, cuts) if len(part) > 1]
        a = np.concatenate([x[0] for x in out]) if out else np.empty(0, np.uint64)
        b = np.concatenate([x[1] for x in out]) if out else np.empty(0, np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    keys, fps = np.empty((0, 4), np.int64), np.empty(0, np.uint64)
    for batch in batches:
        new = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
        keys = np.concatenate([keys, new])
        fps = np.concatenate([fps, batch.column(4).to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(keys):
            continue
        last = int(np.flatnonzero((keys != keys[-1]).any(axis=1))[-1]) + 1 if (keys != keys[-1]).any() else 0
        if last:
            yield links(keys[:last], fps[:last])
            keys, fps = keys[last:], fps[last:]
    if len(keys):
        yield links(keys, fps)


def links(fps: DataFrame, n: int, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Star edges (a, b) that connect all of ``fps(fp)``, n distinct values, within ``distance``."""
    blocks = next(b for most, b in LAYOUTS if n <= most)
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key"))
                       for i, m in enumerate(block_masks(blocks, distance))])
    keyed = fps.select("fp", F.explode(tables).alias("at")).select("at.t", "at.key", "fp")
    sizes = staged(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "bucket_sizes")
    dealt = (keyed.join(sizes, ["t", "key"])
             .withColumn("chunks", F.ceil(F.col("n") / F.lit(chunk)).cast("long"))
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
             .select(F.col("t").cast("long").alias("t"), "key", F.least("own", "other").alias("i"),
                     F.greatest("own", "other").alias("j"), "fp"))
    return (dealt.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
            .mapInArrow(_links_of_groups, "a long, b long"))


def near_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fp, component_id and root, the
    component's smallest fingerprint (which also tells components apart that share a
    doc_id because ids repeat)."""
    fps = staged(fingerprints(docs, shingle), "fingerprints")
    nodes = staged(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    roots = connected(links(nodes.select("fp"), nodes.count(), distance))
    rooted = (nodes.join(roots, nodes["fp"] == roots["node"], "left")
              .select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    labels = staged(rooted.join(smallest, "root").select("fp", "component_id", "root"), "labels")
    return fps.join(labels, "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest (doc_id, text hash)."""
    groups = staged(near_groups(docs, shingle, distance).select("doc_id", "text_hash", "root"), "near_groups")
    rank = F.struct("doc_id", "text_hash")
    best = staged(groups.groupBy("root").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1"),
                  "best")
    losers = staged(groups.join(best, "root").filter(~rank.eqNullSafe(F.col("best")))
                    .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "losers")
    packed = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    kept = packed.join(losers, packed["doc_id"].eqNullSafe(losers["_id"])
                       & (packed["text_hash"] == losers["_hash"]), "left_anti")
    twice = staged(groups.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                   .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")), "equal_rows")
    if not twice.isEmpty():          # rows equal in id and text are copies too: the first by all columns stays
        same = packed["doc_id"].eqNullSafe(twice["_id"]) & (packed["text_hash"] == twice["_hash"])
        first = (kept.join(twice, same, "left_semi").groupBy("doc_id", "text_hash")
                 .agg(F.min_by("row", F.to_json("row")).alias("row")))
        kept = kept.join(twice, same, "left_anti").select("row").unionByName(first.select("row"))
    return kept.select("row.*")
