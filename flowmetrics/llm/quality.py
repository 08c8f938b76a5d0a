"""Quality scores by a byte-level convolutional network in numpy.

The network reads the bytes of the whole text and nothing computed from them.
``FILTERS`` learned filters of ``WIDTH`` bytes slide by ``STRIDE``;
their outputs are max-pooled over chunks of 512 bytes that overlap by half
and cover the document. The mean and the maximum of the chunks' pooled
outputs are combined into one probability. The mean tells how many chunks hold
what a filter looks for, so repeated words show by what their chunks lack. A
one-hot convolution is a sum of table rows, so numpy gathers do it.

Training (numpy on the driver, Adam) sees a bounded sample of labelled rows,
each with all its chunks: about ``MAX_PER_CLASS`` documents per class, and of
these, in id-hash order, those that fit into ``MAX_BYTES`` per class. Scoring
covers all chunks of every document. Labels of the held-out fold, lang,
source and doc_id never enter a score.

Defined results: null and empty texts are one chunk of padding and get its
score. Without training rows of both classes every score is the share of label
1 (0.5 without any). Repeated rows get equal scores; of rows that share a
labelled id the greatest text is learnt from; an empty table gives an empty
result. Other columns ride along in ``accept`` and are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .samples import class_counts, fold, sampled, texts_of, training_labels

FOLDS, HELD_OUT = 5, 0
CUT = 0.3
FILTERS, WIDTH, STRIDE = 16, 4, 2
CHUNK, HALF = 512, 256
SYMBOLS, PAD = 257, 256       # the byte values and the padding
MAX_PER_CLASS, MAX_BYTES = 1_000, 8 << 20
EPOCHS, BATCH, RATE = 20, 32, 0.01
SLICE, PEAK_ROWS = 1 << 16, 512


def symbols(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).astype(np.int16)


def n_halves(n: int) -> int:
    return max(1, -(-n // HALF))


def n_chunks(n: int) -> int:
    return max(1, n_halves(n) - 1)


def valid_positions(n: int) -> int:
    """Filter positions that start inside a text of ``n`` bytes."""
    return max(1, -(-n // STRIDE))


class Network:
    def __init__(self, seed: int = 42):
        rng = np.random.default_rng(seed)
        self.p = {"table": rng.normal(0, 0.1, (WIDTH, SYMBOLS, FILTERS)), "bias": np.zeros(FILTERS),
                  "mean": rng.normal(0, 0.3, FILTERS), "max": rng.normal(0, 0.3, FILTERS), "out": np.zeros(1)}
        self.p["table"][:, PAD] = 0

    def convolve(self, s: np.ndarray) -> np.ndarray:
        """Filter outputs at every STRIDE-th place of symbols ``s`` (last axis); WIDTH - STRIDE are context."""
        n = (s.shape[-1] - WIDTH) // STRIDE + 1
        table = self.p["table"]
        out = table[0][s[..., 0:STRIDE * n:STRIDE]]
        for j in range(1, WIDTH):
            out += table[j][s[..., j:j + STRIDE * n:STRIDE]]
        return out

    def head(self, mean, top):
        return mean @ self.p["mean"] + top @ self.p["max"] + self.p["out"][0]

    # ---------------------------------------------------------------- training
    def peaks(self, chunks, valid) -> tuple[np.ndarray, np.ndarray]:
        """Place and value of each filter's maximum in each chunk, some chunks at a time."""
        at, best = [], []
        for i in range(0, len(chunks), PEAK_ROWS):
            conv = self.convolve(chunks[i:i + PEAK_ROWS])[:, :CHUNK // STRIDE]
            conv[np.arange(conv.shape[1]) >= valid[i:i + PEAK_ROWS, None]] = -1e9
            at.append(conv.argmax(axis=1))
            best.append(conv.max(axis=1))
        return np.concatenate(at), np.concatenate(best)

    def step(self, chunks, valid, starts, y, weight):
        """Gradients for a batch: ``chunks`` (c, CHUNK + WIDTH) symbols, ``valid`` filter
        places per chunk, ``starts`` the first chunk of each document."""
        at, best = self.peaks(chunks, valid)                                # (c, F)
        pooled = best + self.p["bias"]
        h = np.maximum(pooled, 0)
        counts = np.diff(np.append(starts, len(h)))
        mean, top = np.add.reduceat(h, starts) / counts[:, None], np.maximum.reduceat(h, starts)
        prob = 1 / (1 + np.exp(-np.clip(self.head(mean, top), -30, 30)))
        dz = (prob - y) * weight / weight.sum()
        owner = np.repeat(np.arange(len(y)), counts)
        is_top = h == top[owner]                  # overlapping chunks often share the place of their maximum
        is_top = is_top / np.add.reduceat(is_top, starts)[owner]
        dh = (dz / counts)[owner, None] * self.p["mean"] + dz[owner, None] * self.p["max"] * is_top
        dp = dh * (pooled > 0)
        grad = {"bias": dp.sum(0), "mean": dz @ mean, "max": dz @ top, "out": np.array([dz.sum()]),
                "table": np.zeros_like(self.p["table"])}
        rows, filters = np.arange(len(h))[:, None], np.arange(FILTERS)
        for j in range(WIDTH):
            np.add.at(grad["table"][j], (chunks[rows, at * STRIDE + j], np.broadcast_to(filters, at.shape)), dp)
        grad["table"][:, PAD] = 0
        return grad

    def train(self, docs: list, y: np.ndarray, weight: np.ndarray, seed: int = 42):
        """``docs``: the symbols of each document."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        t = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(docs))
            for i in range(0, len(order), BATCH):
                batch = order[i:i + BATCH]
                chunks, valid = zip(*(training_chunks(docs[k]) for k in batch))
                starts = np.cumsum([0] + [len(v) for v in valid[:-1]])
                g = self.step(np.concatenate(chunks), np.concatenate(valid), starts, y[batch], weight[batch])
                t += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
                    self.p[k] -= RATE * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-8)

    # ---------------------------------------------------------------- scoring
    def frozen(self) -> Network:
        self.p = {k: x.astype(np.float32) for k, x in self.p.items()}
        return self

    def pooled_halves(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Maximum of the filters over each half chunk of each text, and the halves per text."""
        parts, cuts, at, halves, out = [], [], 0, [], []

        def flush():
            nonlocal parts, cuts, at
            if parts:
                conv = self.convolve(np.concatenate(parts))
                # the pieces' context lies between them: bounds are (start, end) pairs
                bounds = np.array(cuts).ravel()
                out.append(np.maximum.reduceat(np.concatenate([conv, conv[-1:]]), bounds)[::2])
                parts, cuts, at = [], [], 0

        context = np.full(WIDTH, PAD, np.int16)
        for data in texts:
            s = symbols(data) if data else np.full(1, PAD, np.int16)
            n = len(s)
            halves.append(n_halves(n))
            padded = np.concatenate([s, context])
            for start in range(0, n, SLICE):
                size = min(SLICE, n - start)
                piece = padded[start:start + size + WIDTH]
                if len(piece) % STRIDE:
                    piece = np.append(piece, np.int16(PAD))
                places = valid_positions(size)
                for h in range(0, places, HALF // STRIDE):
                    first = at // STRIDE + h
                    cuts.append((first, min(first + HALF // STRIDE, at // STRIDE + places)))
                parts.append(piece)
                at += len(piece)
                if at >= 4 * SLICE:
                    flush()
        flush()
        pooled = np.concatenate(out) if out else np.empty((0, FILTERS), np.float32)
        return np.maximum(pooled + self.p["bias"], 0), np.array(halves, np.int64)

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        h, halves = self.pooled_halves(texts)
        first = np.cumsum(halves) - halves
        last = first + halves - 1
        pair = np.maximum(h, np.concatenate([h[1:], h[-1:]]))              # chunk k: halves k and k + 1
        ends = np.zeros(len(h), bool)
        ends[last] = True
        single = halves == 1
        pair[last[single]] = h[last[single]]
        pair[ends & ~np.isin(np.arange(len(h)), last[single])] = 0          # no chunk starts at a last half
        counts = np.maximum(1, halves - 1)
        mean, top = np.add.reduceat(pair, first) / counts[:, None], np.maximum.reduceat(pair, first)
        return 1 / (1 + np.exp(-np.clip(self.head(mean, top).astype(np.float64), -30, 30)))


def training_chunks(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All chunks of a text's symbols with their context, and the valid places of each."""
    starts = np.arange(n_chunks(len(s))) * HALF
    padded = np.concatenate([s, np.full(CHUNK + WIDTH, PAD, np.int16)])
    chunks = np.lib.stride_tricks.sliding_window_view(padded, CHUNK + WIDTH)[starts]
    return chunks, np.minimum(CHUNK // STRIDE, [valid_positions(len(s) - k) for k in starts])


def _examples(rows: DataFrame) -> list:
    """(y, text) of the staged sample ``rows(doc_id, y, text)``: in id-hash order those that
    fit into MAX_BYTES per class. Only ids and sizes, and then these texts, are fetched."""
    sizes = rows.select("doc_id", "y", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n")).collect()
    left, ids = {0: MAX_BYTES, 1: MAX_BYTES}, []
    for r in sorted(sizes, key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"])):
        if r["n"] <= left[r["y"]]:
            left[r["y"]] -= r["n"]
            ids.append(r["doc_id"])
    table = (rows if len(ids) == len(sizes) else rows.filter(F.col("doc_id").isin(ids))).toArrow()
    found = sorted(zip(*(table.column(k).to_pylist() for k in ("doc_id", "y", "text"))), key=lambda r: r[0])
    return [(y, (text or "").encode()) for _, y, text in found]


def fit(docs: DataFrame, labels: DataFrame) -> Network | float:
    """The trained network; a constant score where one class is missing."""
    train = staged(training_labels(labels, "quality", FOLDS, HELD_OUT), "quality_labels")
    zeros, ones = class_counts(train)
    chosen = sampled(train.filter("y = 1"), ones, MAX_PER_CLASS, 1).unionByName(
        sampled(train.filter("y = 0"), zeros, MAX_PER_CLASS, 2))
    rows = _examples(staged(texts_of(docs, chosen), "quality_sample"))
    y = np.array([label for label, _ in rows], np.float64)
    if not 0 < y.sum() < len(y):
        return ones / (zeros + ones) if zeros + ones else 0.5
    # the classes are sampled apart: weights restore their shares
    share = ones / (zeros + ones)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    net = Network()
    net.train([symbols(text) if text else np.full(1, PAD, np.int16) for _, text in rows], y, weight)
    return net.frozen()


def _scored(df: DataFrame, model: Network | float, schema: str) -> DataFrame:
    """``df`` with its last column, the text, replaced by the score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in b.column(b.num_columns - 1)]
            scores = np.full(len(texts), model) if isinstance(model, float) else model.probabilities(texts)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores, pa.float64())],
                                             names=[*b.schema.names[:-1], "score"])
    return df.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``."""
    rows = docs.select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "text")
    scored = _scored(rows, fit(docs, labels), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def accept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text scores ``CUT`` or more."""
    from pyspark.sql import types as T
    packed = docs.select(F.struct("*").alias("row"), "text")
    schema = T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType())])
    return _scored(packed, fit(docs, labels), schema).filter(F.col("score") >= CUT).select("row.*")
