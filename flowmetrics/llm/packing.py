"""Packing token sequences by cutting-stock column generation.

Documents are tokenized in Arrow batches; each becomes its ids plus an end
id, cut into full sequences and one remainder piece. Pieces fall into
``BINS`` length classes of 8 tokens (rounded up). The histogram of classes,
256 numbers at any scale, is a cutting-stock problem: a linear program over
patterns (how many pieces of each class fill a sequence) whose columns are
priced by a knapsack dynamic program over the duals. Patterns are rounded
down, the few pieces left over are packed largest first.

Pieces are ranked within their class on Spark (hash buckets with offsets, so
a class that holds a third of all pieces is ranked by many tasks), and the
rank alone says which copy of which pattern, hence which sequence and place,
a piece goes to. The table of patterns that this joins to has a few thousand
rows at any scale.

Defined results: a null text is empty and gives one piece with the end id;
repeated rows are packed as separate documents; an empty table gives no
piece. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import per_worker, power_of_two, slices, staged

CAPACITY = 2_048
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
GRAIN = 8
BINS = CAPACITY // GRAIN
MEMO_KEYS = 400_000
MEMO_KEY_CHARS = 64
SLICE_BYTES = 4 << 20     # texts encoded at once
WHITE = re.compile("[ \t\n\x0b\x0c\r]+")
ROWS_PER_BUCKET = 4_096
MAX_BUCKETS = 1_024
MAX_COLUMNS = 3_000
GAP = 5e-3        # stop once the program is proven within 0.5 % of its optimum

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Encoder:
    """Little-endian 32-bit ids of whole texts.

    The tokenizer composes characters, lowers case, drops white space and never
    joins across it, and its vocabulary is applied to one letter run, digit or sign
    run at a time. Texts of ASCII and the accented Latin-1 letters, which are
    composed already, are cut into words in Arrow, and only the distinct words of a
    batch are looked up in a table of bounded size; the runs (``RUN``) of new words go
    through the vocabulary together, each closed by ``MARK`` as the sign of a word's
    end. Texts with other characters, or with what may be a special token, are split
    by ``OTHER``, and their other words go through the whole tokenizer.
    """

    # fixed values: the tokenizer file's split pattern and white space, within ASCII and the Latin-1 letters
    RUN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|'(?:s|t|re|ve|m|ll|d)|[0-9]"
                     "|[^ \t\n\x0b\x0c\ra-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
    #: what sends a text through ``OTHER``: "<|", ``MARK``, or a character beyond ASCII and the Latin-1 letters
    UNUSUAL = re.compile("[^\x00-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]|<\\|")
    #: a blank-separated word that holds such a character or "<|"
    OTHER = re.compile("((?<![^ \n\t\r])(?:(?!<\\|)[\x00-\x08\x0b\x0c\x0e-\x1f!-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff])*+"
                       "[^ \n\t\r]+)")
    # fixed values: the byte alphabet of the vocabulary; bytes without a printable Latin-1 sign stand from 256 on
    BYTE_SIGNS = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}
    WORD_END, MARK = "</w>", "\x7f"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        signs = {chr(self.BYTE_SIGNS.get(b, b)): b for b in range(256)}
        special = set(self.tokenizer.get_added_tokens_decoder())
        ranks, self.ends = {}, np.zeros(len(vocab) + 1, bool)
        for token, i in vocab.items():
            if i not in special:
                ends = token.endswith(self.WORD_END)
                spelled = bytes(signs[c] for c in (token.removesuffix(self.WORD_END) if ends else token))
                if self.MARK.encode() not in spelled:          # runs hold no mark
                    ranks[spelled + (self.MARK.encode() if ends else b"")] = i
                    self.ends[i] = ends
        ranks[self.MARK.encode()] = len(vocab)                # always joins the byte before it
        for sign, b in signs.items():
            ranks.setdefault(bytes([b]), vocab[sign])
        #: ids are ranks here: bytes, bytes that end a word, then the merges in their order
        self.bpe = tiktoken.Encoding("runs", pat_str=f"[^{self.MARK}]+{self.MARK}", mergeable_ranks=ranks, special_tokens={})
        self.memo: dict[str, bytes] = {}

    def _spelled(self, words: list[str]) -> list[bytes]:
        """Ids of usual words in lower case."""
        runs = [[w] if w.isalpha() else self.RUN.findall(w) for w in words]
        flat = [r for rs in runs for r in rs]
        if not flat:
            return [b""] * len(words)
        ids = np.array(self.bpe.encode_ordinary(self.MARK.join(flat) + self.MARK), "<u4")
        ends = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])       # of the runs
        if len(ends) != len(flat) + 1:
            raise ValueError("a run of the vocabulary has no end of its own")
        bounds = ends[np.cumsum([0] + [len(rs) for rs in runs])].tolist()
        return [ids[s:e].tobytes() for s, e in zip(bounds[:-1], bounds[1:])]

    def _looked_up(self, words: list[str]) -> list[bytes]:
        memo = self.memo
        missing = [w for w in words if w not in memo]
        if len(memo) + len(missing) > MEMO_KEYS:
            memo.clear()
            missing = words
        found = dict(zip(missing, self._spelled(missing)))
        out = [found[w] if w in found else memo[w] for w in words]
        memo.update((w, ids) for w, ids in found.items() if len(w) <= MEMO_KEY_CHARS)
        return out

    def _other(self, text: str) -> bytes:
        out = []
        for i, part in enumerate(self.OTHER.split(text)):    # usual words, then one other word, and so on
            if i % 2 and self.UNUSUAL.search(part):
                ids = self.tokenizer.encode(part, add_special_tokens=False).ids
                out.append(struct.pack(f"<{len(ids)}I", *ids))
            elif part != " ":
                out += self._looked_up(WHITE.split(part.lower()))
        return b"".join(out)

    def _usual(self, texts: pa.Array) -> list[bytes]:
        words = pc.ascii_split_whitespace(pc.utf8_lower(texts))
        coded = words.flatten().dictionary_encode()
        ids = self._looked_up(coded.dictionary.to_pylist())
        size = np.array([len(x) // 4 for x in ids], np.int64)
        flat, first = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        which = np.asarray(coded.indices)
        n = size[which]
        at = np.arange(int(n.sum())) + np.repeat(first[which] - (np.cumsum(n) - n), n)
        joined = flat[at].tobytes()
        offsets = np.asarray(words.offsets) - words.offsets[0].as_py()
        bounds = (4 * np.concatenate([[0], np.cumsum(n)])[offsets]).tolist()
        return [joined[s:e] for s, e in zip(bounds[:-1], bounds[1:])]

    def batch(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text of a column without nulls."""
        strings = texts.to_pylist()
        usual = [not self.UNUSUAL.search(t) for t in strings]
        found = iter(self._usual(texts.filter(pa.array(usual, pa.bool_())))) if any(usual) else iter(())
        return [next(found) if u else self._other(t) for u, t in zip(usual, strings)]

    def __call__(self, text: str) -> bytes:
        return self.batch(pa.array([text], pa.string()))[0]


def pieces(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The pieces of every document: full sequences, then the remainder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        path = tokenizer or public_tokenizers.path(TOKENIZER)
        encode = per_worker(f"packing encoder {path}", lambda: Encoder(path))
        end = END_ID.to_bytes(4, "little")
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()
            for low, high in slices(sizes, SLICE_BYTES):
                texts = pc.fill_null(b.column(1).slice(low, high - low), "")
                out = []
                for doc_id, ids in zip(b.column(0).slice(low, high - low).to_pylist(), encode.batch(texts)):
                    ids = memoryview(ids + end)
                    n = len(ids) // 4
                    out += [(doc_id, s, min(CAPACITY, n - s), zlib.crc32(ids[4 * s:4 * (s + CAPACITY)]), n)
                            for s in range(0, n, CAPACITY)]
                columns = list(zip(*out)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


# ------------------------------------------------------------------ cutting stock
def price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of the greatest value."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right").tolist()
    for room in range(1, capacity + 1):
        fit = fits[room]
        best[room] = best[room - 1]
        if fit:
            total = best[room - sizes[:fit]] + values[:fit]
            k = int(total.argmax())
            if total[k] > best[room] + 1e-12:
                best[room], choice[room] = total[k], k
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= sizes[choice[room]]
    return best[capacity], pattern


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one per column) and how often the linear program cuts each."""
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse, x = np.diag(1.0 / (capacity // sizes)), demand / (capacity // sizes)
    enough = float(sizes @ demand) / capacity * (1 + GAP)       # no cutting can use fewer than all pieces fill
    for _ in range(MAX_COLUMNS):
        if x.sum() <= enough:
            break
        duals = inverse.sum(axis=0)
        value, pattern = price(np.maximum(duals, 0.0), sizes, capacity)
        if value <= 1 + GAP:         # objective / value bounds the optimum from below
            break
        direction = inverse @ pattern
        up = direction > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = x[up] / direction[up]
        leave = int(ratio.argmin())
        basis[:, leave] = pattern
        theta = ratio[leave]
        x = np.maximum(x - theta * direction, 0.0)
        x[leave] = theta
        row = inverse[leave] / direction[leave]
        inverse = inverse - np.outer(direction, row)
        inverse[leave] = row
    return np.rint(basis).astype(np.int64), x


def cut_patterns(histogram: dict[int, int], capacity: int = BINS) -> list[tuple[int, dict[int, int]]]:
    """(copies, {size: pieces}) that hold exactly the pieces of ``histogram``."""
    sizes = np.array(sorted(s for s, n in histogram.items() if n), np.int64)
    if not len(sizes):
        return []
    left = np.array([histogram[int(s)] for s in sizes], np.int64)
    patterns, counts = column_generation(sizes, left.astype(float), capacity)
    out = []
    for k in np.argsort(-counts):
        pattern = patterns[:, k]
        used = pattern > 0
        copies = int(min(np.floor(counts[k] + 1e-6), (left[used] // pattern[used]).min()))
        if copies:
            left = left - copies * pattern
            out.append((copies, {int(s): int(n) for s, n in zip(sizes, pattern) if n}))
    while left.any():                          # what rounding left over: largest first
        room, pattern = capacity, np.zeros_like(left)
        for i in range(len(sizes) - 1, -1, -1):
            n = min(int(left[i]), room // int(sizes[i]))
            pattern[i] = n
            room -= n * int(sizes[i])
        used = pattern > 0
        copies = int((left[used] // pattern[used]).min())
        left = left - copies * pattern
        out.append((copies, {int(s): int(n) for s, n in zip(sizes, pattern) if n}))
    return out


def pattern_rows(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(size, from_rank, to_rank, per_sequence, first_sequence, first_slot)."""
    rows, next_rank, sequence = [], {}, 0
    for copies, pattern in patterns:
        slot = 0
        for size, n in sorted(pattern.items(), reverse=True):
            start = next_rank.get(size, 0)
            next_rank[size] = start + copies * n
            rows.append((size, start, start + copies * n, n, sequence, slot))
            slot += n
        sequence += copies
    return rows


# ------------------------------------------------------------------ placement on Spark
def place(cut: DataFrame) -> DataFrame:
    """``cut`` (rows of :func:`pieces`, staged) plus sequence_id and offset."""
    spark = cut.sparkSession
    sized = cut.withColumn("size", F.ceil(F.col("length") / F.lit(GRAIN)).cast("int"))
    histogram = {r["size"]: r["n"] for r in sized.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.createDataFrame(
        pattern_rows(cut_patterns(histogram)),
        "p_size int, from_rank long, to_rank long, per_sequence long, first_sequence long, first_slot long")
    buckets = power_of_two(-(-sum(histogram.values()) // ROWS_PER_BUCKET), 1, MAX_BUCKETS)
    keys = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    hashed = sized.withColumn("hash", F.xxhash64(*keys)).withColumn(
        "bucket", F.col("hash").bitwiseAND(F.lit(buckets - 1)).cast("int"))
    before = W.partitionBy("size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (hashed.groupBy("size", "bucket").agg(F.count(F.lit(1)).alias("n"))
               .select("size", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    inside = W.partitionBy("size", "bucket").orderBy("hash", *keys)
    ranked = (hashed.withColumn("rank", F.row_number().over(inside)).join(offsets, ["size", "bucket"])
              .withColumn("rank", F.col("before") + F.col("rank") - 1))
    placed = ranked.join(F.broadcast(table), (F.col("size") == F.col("p_size")) & (F.col("rank") >= F.col("from_rank"))
                         & (F.col("rank") < F.col("to_rank")))
    nth = F.col("rank") - F.col("from_rank")
    placed = (placed.withColumn("sequence_id", F.col("first_sequence") + F.floor(nth / F.col("per_sequence")))
              .withColumn("slot", F.col("first_slot") + nth % F.col("per_sequence")))
    earlier = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    return (placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("long"))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    F.col("sequence_id").cast("long").alias("sequence_id"), "offset"))


def pack(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return place(staged(pieces(docs, tokenizer), "pieces"))
