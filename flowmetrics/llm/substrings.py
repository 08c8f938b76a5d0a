"""Repeated-substring removal by interval expansion on a Burrows-Wheeler transform.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts
somewhere else in the corpus, in the same document or another.

*Spreading the corpus.* A window of LENGTH bytes belongs to the smallest hash
among its ``GRAM``-byte grams, so equal windows have equal owners. Runs of
neighbouring windows with one owner are anchors (owner, document, run): about
one per 77 bytes. Owners found once cannot hold a repeated window. For the
others each run's bytes, its *context*, go to the owner's partition; equal
contexts are pre-aggregated to one with a count.

*The index.* A partition's contexts are concatenated into blocks at owner
boundaries, suffix-sorted to LENGTH symbols (prefix doubling) and
transformed. Starting from the intervals of single symbols, breadth-first
backward extension visits intervals of strings of length 1, 2, ...; the right
end of each new interval is a boundary where the common prefix is one shorter
than the string; intervals that end at a known boundary are dropped. After
LENGTH levels exactly the boundaries with common prefixes below LENGTH are
known. What lies between two of them are equal windows; they are repeated if
their contexts' counts sum to two or more. An owner with one distinct context that
stands in several places differs from nothing and needs no index: each of its windows
is repeated.

*Hot owners.* Where the distinct contexts of one owner exceed
``OWNER_BYTES``, they are cut into their single windows, each keyed by a
hash of its own, counted, and sent through the same index: no owner outgrows
a task and none is capped.

Documents that hold no repeated window never shuffle their text: a bounded
Bloom filter (see ``exact_dedup``) keeps them out of the joins; its false
positives cost a shuffle only.

Defined results: a null text is empty; texts below LENGTH bytes are kept
whole; repeated rows count as separate places; an empty table gives an empty
result. Only doc_id and text are read; a document is told apart by a 128-bit digest
of doc_id and text, so ids may repeat. Long texts are hashed in overlapping slices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, text_or_empty
from .exact_dedup import filter_blocks, repeat_filter, with_repeat_flag

LENGTH = 200
GRAM = 48
RUN = 256                       # windows of a run at most
BLOCK_BYTES = 1 << 20
OWNER_BYTES = 1 << 22
SLICE = 1 << 20                 # windows of a text hashed at once
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = 0xD6E8FEB86659FD93
_WRAP = (1 << 64) - 1


# ------------------------------------------------------------------ anchors
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class GramHasher:
    """Hashes of all GRAM-byte grams of a text through prefix sums."""

    def __init__(self, gram: int):
        self.gram, self.size = gram, 0

    def __call__(self, b: np.ndarray) -> np.ndarray:
        if len(b) > self.size:
            self.size = max(1 << 16, 2 * len(b))
            self.up, self.down = _powers(_BASE, self.size), _powers(pow(_BASE, -1, 1 << 64), self.size)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.up[:len(b)])])
        h = (sums[self.gram:] - sums[:-self.gram]) * self.down[:len(b) - self.gram + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(_MIX)
        return h ^ (h >> np.uint64(32))


def sliding(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """``op`` (minimum or maximum) over all windows of ``width``."""
    n = len(x) - width + 1
    pad = -len(x) % width
    edge = np.full(pad, _WRAP if op is np.minimum else 0, np.uint64)
    blocks = np.concatenate([x, edge]).reshape(-1, width)
    ahead = op.accumulate(blocks, axis=1).ravel()
    back = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[:n], ahead[width - 1:width - 1 + n])


def anchors_of(data: bytes, hasher: GramHasher, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, first window, windows, owner found twice in reach) per run."""
    grams = hasher(np.frombuffer(data, np.uint8))
    width = length - hasher.gram + 1
    owner = sliding(grams, width, np.minimum)
    cut = np.flatnonzero(owner[1:] != owner[:-1]) + 1
    starts = np.concatenate([[0], cut])
    sizes = np.diff(np.append(starts, len(owner)))
    if sizes.max() > RUN:                        # long runs of periodic texts are cut
        starts = np.concatenate([np.arange(s, s + n, RUN) for s, n in zip(starts.tolist(), sizes.tolist())])
        sizes = np.diff(np.append(starts, len(owner)))
    value = owner[starts]
    # places of owners: where a gram equals the largest minimum among the windows that hold it
    edge = np.zeros(width - 1, np.uint64)
    reach = sliding(np.concatenate([edge, owner, edge]), width, np.maximum)
    places, counts = np.unique(grams[grams == reach], return_counts=True)
    again = places[counts > 1]
    return value, starts, sizes, np.isin(value, again) if len(again) else np.zeros(len(value), bool)


def _utf8(column: pa.Array) -> Iterator[bytes]:
    for t in column:
        yield t.as_buffer().to_pybytes() if t.is_valid else b""


def sliced_anchors(data: bytes, hasher: GramHasher, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``anchors_of`` over slices of windows; a run across two slices is two runs of one owner."""
    for low in range(0, len(data) - length + 1, SLICE):
        value, starts, sizes, twice = anchors_of(data[low:low + SLICE + length - 1], hasher, length)
        yield value, starts + low, sizes, twice


def anchors(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(owner, doc, run): run packs first window, windows - 1 and the twice flag."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = GramHasher(gram)
        for b in batches:
            owner, run_, rows = [], [], []
            for i, data in enumerate(_utf8(b.column(1))):
                for value, starts, sizes, twice in sliced_anchors(data, hasher, length):
                    owner.append(value)
                    run_.append(starts * (2 * RUN) + (sizes - 1) * 2 + twice)
                    rows.append(np.full(len(value), i))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(owner).view(np.int64)), b.column(0).take(pa.array(np.concatenate(rows))),
                     pa.array(np.concatenate(run_).astype(np.int64))], names=["owner", "doc", "run"])
    return docs.mapInArrow(run, "owner long, doc binary, run long")


# ------------------------------------------------------------------ the index of a block
def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least. A rank is the
    place where its class begins; only classes of two or more are sorted again."""
    n = len(symbols)
    top = int(symbols.max()) + 2
    key, reach = symbols.astype(np.int64) + 1, 1
    while reach < 7 and top ** (reach + 1) < 1 << 62:         # first symbols packed into one number
        ahead = np.zeros(n, np.int64)
        ahead[:max(0, n - reach)] = symbols[reach:] + 1
        key = key * top + ahead
        reach += 1

    def classes(ordered: np.ndarray) -> np.ndarray:
        """First position of the class of each position of a sorted array."""
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))

    order = np.argsort(key)
    begin = classes(key[order])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = begin
    while reach < depth:
        alone = begin == np.arange(n)
        alone[:-1] &= begin[1:] != begin[:-1]
        open_ = np.flatnonzero(~alone)                          # positions whose class has company
        if not len(open_):
            break
        suffix = order[open_]
        key = rank[suffix] * (n + 1) + rank[np.minimum(suffix + reach, n)] + 1
        by = np.argsort(key)
        suffix, key = suffix[by], key[by]
        order[open_] = suffix
        begin[open_] = open_[classes(key)]
        rank[suffix] = begin[open_]
        reach *= 2
    return order


def boundaries(sa: np.ndarray, symbols: np.ndarray, separators: int, length: int) -> np.ndarray:
    """True at i where suffixes i - 1 and i of the suffix array agree in fewer than ``length``
    symbols. Symbols below ``separators`` occur once each and end a text."""
    n = len(sa)
    place = np.empty(n, np.int32)
    place[sa] = np.arange(n, dtype=np.int32)
    before = sa - 1
    extends = (sa > 0) & (symbols[before] >= separators)
    char = np.where(extends, symbols[before] - separators, 0).astype(np.uint8)     # the transform
    back = np.where(extends, place[before], -1).astype(np.int32)                   # backward step
    first = symbols[sa]
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    lo = np.concatenate([[0], np.flatnonzero(first[1:] != first[:-1]) + 1])
    hi = np.append(lo[1:], n)
    known[hi] = True                                  # common prefix 0
    for _ in range(1, length):
        if not len(lo):
            break
        size = hi - lo
        owner = np.repeat(np.arange(len(lo)), size)
        rows = np.arange(len(owner)) + np.repeat(lo - (np.cumsum(size) - size), size)
        real = back[rows] >= 0                        # nothing extends over a text's end
        rows, owner = rows[real], owner[real]
        if not len(rows):
            break
        symbol = char[rows]
        order = np.argsort(symbol, kind="stable")     # by symbol, then by interval
        symbol, owner, target = symbol[order], owner[order], back[rows[order]]
        start = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])]))
        lo = np.minimum.reduceat(target, start).astype(np.int64)
        hi = lo + np.diff(np.append(start, len(target)))
        fresh = ~known[hi]                            # known ends: nothing new behind them
        lo, hi = lo[fresh], hi[fresh]
        known[hi] = True
    return known


def repeated_windows(contexts: list[bytes], counts: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """Per context, whether the window at each start is found twice or more, a context
    counting ``counts`` times."""
    m = len(contexts)
    sizes = np.array([len(c) for c in contexts])
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.frombuffer(b"\0".join(contexts) + b"\0", np.uint8).astype(np.int64) + m
    symbols[ends] = np.arange(m)
    owner = np.repeat(np.arange(m), sizes + 1)
    sa = suffix_array(symbols, length)
    known = boundaries(sa, symbols, m, length)
    group = np.cumsum(known[:-1]) - 1
    whole = np.arange(len(symbols)) + length <= ends[owner]            # a window starts here
    weight = np.bincount(group, np.where(whole[sa], counts[owner[sa]], 0))
    flag = np.empty(len(symbols), bool)
    flag[sa] = (weight[group] >= 2) & whole[sa]
    return [flag[e - s:e - s + max(0, s - length + 1)] for s, e in zip(sizes.tolist(), ends.tolist())]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def index_contexts(contexts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(cid, first, last): repeated windows of each of ``contexts(owner, cid, context, n)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(block: list) -> pa.RecordBatch:
            flags = repeated_windows([x[2] for x in block], np.array([x[3] for x in block]), length)
            cid, first, last = [], [], []
            for x, f in zip(block, flags):
                a, b = _runs(f)
                cid += [x[1]] * len(a)
                first += a.tolist()
                last += b.tolist()
            return pa.RecordBatch.from_arrays([pa.array(cid, pa.binary()), pa.array(first, pa.int32()),
                                               pa.array(last, pa.int32())], names=["cid", "first", "last"])

        def lone(row: tuple) -> pa.RecordBatch:
            """All windows of an owner's only context."""
            return pa.RecordBatch.from_arrays([pa.array([row[1]], pa.binary()), pa.array([0], pa.int32()),
                                               pa.array([len(row[2]) - length], pa.int32())], names=["cid", "first", "last"])

        block, held, group, spared = [], 0, [], []
        for row in chain(rows(batches), [None]):
            if group and (row is None or row[0] != group[0][0]):         # an owner is complete
                if len(group) == 1 and group[0][3] > 1:
                    spared.append(lone(group[0]))
                else:
                    block += group
                    held += sum(len(x[2]) for x in group)
                group = []
                if block and (held >= BLOCK_BYTES or row is None):
                    yield solve(block)
                    block, held = [], 0
                if spared and (len(spared) >= 4_096 or row is None):
                    yield pa.Table.from_batches(spared).combine_chunks().to_batches()[0]
                    spared = []
            if row is not None:
                group.append(row)
    return (contexts.select("owner", "cid", "context", "n").repartition("owner").sortWithinPartitions("owner")
            .mapInArrow(run, "cid binary, first int, last int"))


# ------------------------------------------------------------------ on Spark
def _key() -> Column:
    """The Bloom filter's hash of a document."""
    return F.xxhash64("doc")


def _contexts(docs: DataFrame, hits: DataFrame, length: int) -> DataFrame:
    """(owner, cid, context, doc, start) of every run in ``hits``."""
    per_doc = hits.groupBy("doc").agg(F.collect_list(F.struct("owner", "run")).alias("runs"))
    blocks = filter_blocks(docs.count())
    wanted = staged(repeat_filter(hits.select(_key().alias("sha")).distinct(), blocks, 1), "hit_filter")
    texts = with_repeat_flag(docs.withColumn("sha", _key()), wanted, blocks).filter("maybe_repeated").select("doc", "text")
    # rows that repeat in id and text hold their runs once each, so one text serves
    joined = texts.dropDuplicates(["doc"]).join(per_doc, "doc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["owner", "cid", "context", "doc", "start"]
        for b in batches:
            for i, data in enumerate(_utf8(b.column(1))):
                runs = b.column(2)[i].values
                packed = runs.field("run").to_numpy(zero_copy_only=False)
                start, size = packed // (2 * RUN), packed % (2 * RUN) // 2 + 1
                context = [data[s:s + n + length - 1] for s, n in zip(start.tolist(), size.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [runs.field("owner"), pa.array([hashlib.md5(c).digest() for c in context], pa.binary()),
                     pa.array(context, pa.binary()), pa.array([b.column(0)[i].as_py()] * len(context), pa.binary()),
                     pa.array(start)], names=names)
    return joined.select("doc", "text", "runs").mapInArrow(
        run, "owner long, cid binary, context binary, doc binary, start long")


def _index(distinct: DataFrame, length: int, owner_bytes: int) -> DataFrame:
    """Repeated windows of all distinct contexts; hot owners go window by window."""
    weight = distinct.groupBy("owner").agg(F.sum(F.length("context")).alias("bytes"))
    hot = staged(weight.filter(F.col("bytes") > owner_bytes).select("owner"), "hot_owners")
    cold = distinct.join(hot, "owner", "left_anti")
    found = index_contexts(cold, length)
    if not hot.limit(1).count():
        return found
    windows = distinct.join(hot, "owner", "left_semi").select(
        "cid", "n", "context", F.explode(F.sequence(F.lit(0), F.length("context") - length)).alias("first"))
    windows = staged(windows.select("cid", "n", "first", F.expr(f"substring(context, first + 1, {length})").alias("context"))
                     .withColumn("wid", F.unhex(F.md5("context"))), "hot_windows")
    single = windows.groupBy("wid").agg(F.sum("n").alias("n"), F.first("context").alias("context"))
    repeated = index_contexts(single.select(F.xxhash64("wid").alias("owner"), F.col("wid").alias("cid"), "context", "n"),
                              length).select(F.col("cid").alias("wid"))
    return found.unionByName(windows.join(repeated, "wid", "left_semi").select(
        "cid", "first", F.col("first").alias("last")))


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, owner_bytes: int = OWNER_BYTES) -> DataFrame:
    """(doc, first, last): first and last byte of covered pieces of ``docs(doc, text)``;
    pieces may overlap."""
    found = staged(anchors(docs.select("doc", "text"), length, gram), "anchors")
    twice = found.groupBy("owner").agg(F.sum(1 + F.col("run") % 2).alias("n")).filter("n > 1").select("owner")
    hits = staged(found.join(staged(twice, "owners"), "owner", "left_semi"), "hits")
    contexts = staged(_contexts(docs, hits.dropDuplicates(["doc", "run"]), length), "contexts")
    # rows that repeat in id and text are places of their own: their runs count each time
    copies = hits.groupBy("doc", "run").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    copies = staged(copies.select("doc", F.expr(f"run div {2 * RUN}").alias("start"), "copies"), "row_copies")
    counted = contexts.join(copies, ["doc", "start"], "left")
    distinct = staged(counted.groupBy("cid").agg(
        F.sum(F.coalesce("copies", F.lit(1))).alias("n"), F.first("owner").alias("owner"),
        F.first("context").alias("context")), "distinct_contexts")
    repeated = staged(_index(distinct, length, owner_bytes), "repeated")
    return (contexts.select("cid", "doc", "start").join(repeated, "cid")
            .select("doc", (F.col("start") + F.col("first")).alias("first"),
                    (F.col("start") + F.col("last") + length - 1).alias("last")))


def _merged(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs [a, b) of covered bytes."""
    out = []
    for k in np.argsort(first):
        a, b = int(first[k]), int(last[k]) + 1
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), text)
    return docs.select("doc_id", F.unhex(F.md5(named.cast("binary"))).alias("doc"), text.alias("text"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, owner_bytes: int = OWNER_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans
    (removed runs as [first, behind)). The remaining bytes follow from text and spans."""
    keyed = _keyed(docs)
    spans = staged(repeated_spans(keyed, length, gram, owner_bytes).groupBy("doc").agg(
        F.collect_set(F.struct("first", "last")).alias("pieces")), "spans")
    blocks = filter_blocks(docs.count())
    touched = staged(repeat_filter(spans.select(_key().alias("sha")), blocks, 1), "span_filter")
    flagged = with_repeat_flag(keyed.withColumn("sha", _key()), touched, blocks)
    zero = F.lit(0).cast("long")
    whole = flagged.filter("NOT maybe_repeated").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
        F.array().cast("array<struct<first:bigint,behind:bigint>>").alias("spans"))
    cut = flagged.filter("maybe_repeated").select("doc_id", "doc", "text")
    cut = cut.join(spans, "doc", "left").select("doc_id", "text", "pieces")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, data, pieces in zip(b.column(0).to_pylist(), _utf8(b.column(1)), b.column(2)):
                merged = []
                if pieces.is_valid:
                    merged = _merged(*(pieces.values.field(k).to_numpy(zero_copy_only=False) for k in ("first", "last")))
                left, at = hashlib.sha256(), 0
                for a, z in merged:
                    left.update(data[at:a])
                    at = z
                left.update(data[at:])
                out.append({"doc_id": doc_id, "n_bytes": len(data), "n_removed": sum(z - a for a, z in merged),
                            "n_spans": len(merged), "kept_sha256": left.hexdigest(),
                            "spans": [{"first": a, "behind": z} for a, z in merged]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                ("kept_sha256", pa.string()),
                ("spans", pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64())])))]))
    done = cut.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                               "spans array<struct<first:bigint,behind:bigint>>")
    return whole.unionByName(done)
