"""Toxicity scores by non-negative positive-unlabelled learning.

Positives are documents confirmed toxic; everything else of the training
folds is unlabelled, whatever it may be. With class prior pi the risk is

    pi * E_P[l(z, +)] + max(0, E_U[l(z, -)] - pi * E_P[l(z, -)])

and where the bracket falls below zero its gradient is turned round, so the
classifier cannot drive the estimated negative risk below what is possible
(logistic loss, proximal gradient steps, soft-thresholded weights). The model is linear over the
set of hashed words and word prefixes of the whole text; words are runs of
letters, lower-cased.
It is trained by numpy on the driver from a bounded sample of the labelled rows
of the training folds (of which only word indices are fetched) and applied in
Arrow batches: at most about ``MAX_POSITIVE`` rows with label 1 are the
confirmed positives, and about ``MAX_UNLABELLED`` rows drawn whatever their
label are the unlabelled text.

The prior is the share of label 1 among labels of the training folds. It also
places the 0.7 cut: as large a share of the unlabelled texts lies above it, so
no negative label is used. Labels of the held-out fold, lang, source and
doc_id never enter a score.

Defined results: null and empty texts get the score of no words. Without any
positive training text every score is 0. Repeated rows get equal scores; of
rows that share a labelled id the greatest text is learnt from; an empty
table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .samples import class_counts, fold, sampled, texts_of, training_labels

FOLDS, HELD_OUT = 3, 1
CUT = 0.7
BUCKETS = 1 << 18
MAX_POSITIVE, MAX_UNLABELLED = 3_000, 6_000
PREFIXES = range(4, 9)
STEPS, MIN_SHARE = 200, 0.005
PENALTY = 0.2                 # by cross-validation inside the training fold
MEMO_WORDS = 300_000
WORDS = re.compile(rb"[a-z\x80-\xff]+")


def word_set(data: bytes) -> set[bytes]:
    return set(WORDS.findall(data.lower()))


def word_indices(word: bytes) -> list[int]:
    """The word itself and its proper prefixes, which gather the inflections of a stem."""
    forms = [word] + [word[:n] + b"-" for n in PREFIXES if n < len(word)]
    return [zlib.crc32(f) & (BUCKETS - 1) for f in forms]


def indices(data: bytes) -> np.ndarray:
    found = {i for w in word_set(data) for i in word_indices(w)}
    return np.fromiter(found, np.int32, len(found))


def _features(df: DataFrame) -> list:
    """(y, indices) of every row of ``df(doc_id, y, text)`` by doc_id, fetched: the caller bounds the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [indices(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([i.tobytes() for i in x], pa.binary())],
                                             names=["doc_id", "y", "x"])
    table = df.select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, x binary").toArrow()
    rows = sorted(zip(*(table.column(k).to_pylist() for k in ("doc_id", "y", "x"))))
    return [(y, np.frombuffer(x, np.int32)) for _, y, x in rows]


@dataclass
class Model:
    weights: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    centre: float = 0.0

    def probability(self, z):
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * (z - self.centre) + np.log(CUT / (1 - CUT)), -30, 30)))


def _logits(w, bias, rows):
    return np.array([w[x].sum() + bias for x in rows])


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class _Rows:
    """Documents as flat indices of the columns in use."""

    def __init__(self, rows: list, column: np.ndarray):
        kept = [column[x] for x in rows]
        kept = [x[x >= 0] for x in kept]
        self.n, self.width = len(rows), int(column.max()) + 1
        self.at = np.concatenate([*kept, np.empty(0, np.int64)])
        self.owner = np.repeat(np.arange(self.n), [len(x) for x in kept])

    def logits(self, w: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.owner, w[self.at], minlength=self.n) + bias

    def gradient(self, per_row: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(self.at, per_row[self.owner], minlength=self.width), per_row.sum())


def _curvature(parts: list[_Rows]) -> float:
    """Bound of the loss's second derivative: a few power iterations on the second moments."""
    x = np.ones(parts[0].width + 1)
    size = 1.0
    for _ in range(12):
        x = sum(r.gradient(r.logits(x[:-1], x[-1]) / r.n) for r in parts)
        size = float(np.sqrt(x @ x)) or 1.0
        x /= size
    return 0.25 * size


def train_nnpu(positive: list, unlabelled: list, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias by proximal gradient steps with momentum. Only words of
    ``MIN_SHARE`` of the positives get a column, and the penalty is set by how far
    a chance difference between the two samples reaches."""
    seen = np.bincount(np.concatenate(positive), minlength=BUCKETS)
    used = np.flatnonzero(seen >= max(2, MIN_SHARE * len(positive)))
    column = np.full(BUCKETS, -1)
    column[used] = np.arange(len(used))
    weights, bias = np.zeros(BUCKETS), float(np.log(prior / (1 - prior)))
    if not len(used):
        return weights, bias
    p, u = _Rows(positive, column), _Rows(unlabelled, column)
    rate = 1.0 / max(1e-9, (1 + 2 * prior) * _curvature([p, u]))
    shrink = PENALTY * prior / np.sqrt(len(positive))
    w = look = np.append(np.zeros(len(used)), bias)
    t = 1.0
    for _ in range(STEPS):
        zp, zu = p.logits(look[:-1], look[-1]), u.logits(look[:-1], look[-1])
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_neg = u.gradient(_sigmoid(zu) / u.n) - p.gradient(prior * _sigmoid(zp) / p.n)
        g = p.gradient(-prior * _sigmoid(-zp) / p.n) + g_neg if negative >= 0 else -g_neg
        new = look - rate * g
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * shrink, 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, look, t = new, new + (t - 1) / t_next * (new - w), t_next
    weights[used] = w[:-1]
    return weights, float(w[-1])


def place_cut(z: np.ndarray, prior: float) -> tuple[float, float]:
    """(centre, slope) from the logits of unlabelled rows: ``prior`` of them lie above the
    centre, as nearly as ties allow; equal logits are never parted."""
    z = np.sort(z)[::-1]
    edges = np.flatnonzero(z[:-1] > z[1:]) + 1                  # rows above each possible cut
    if not len(edges):
        return float(z[0]) + 1, 1.0
    k = edges[np.abs(edges - prior * len(z)).argmin()]
    return float(z[k - 1] + z[k]) / 2, float(4.0 / max(1e-3, z.std()))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    train = staged(training_labels(labels, "toxic", FOLDS, HELD_OUT), "toxic_labels")
    zeros, ones = class_counts(train)
    confirmed = sampled(train.filter("y = 1"), ones, MAX_POSITIVE, 1)
    hidden = sampled(train.select("doc_id", F.lit(0).alias("y")), zeros + ones, MAX_UNLABELLED, 3)
    rows = _features(texts_of(docs, confirmed.unionByName(hidden)))       # y: 1 confirmed, 0 unlabelled
    positive, unlabelled = ([x for y, x in rows if y == k] for k in (1, 0))
    if not positive or not unlabelled:
        return None
    prior = float(np.clip(ones / max(1, ones + zeros), 0.01, 0.5))
    weights, bias = train_nnpu(positive, unlabelled, prior)
    centre, slope = place_cut(_logits(weights, bias, unlabelled), prior)
    return Model(weights.astype(np.float32), bias, slope, centre)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs``."""
    out = docs.select("doc_id", (fold(FOLDS) == HELD_OUT).alias("held_out"), "text")
    if model is None:
        scored = out.select("doc_id", "held_out", F.lit(0.0).alias("score"))
    else:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, memo = model.weights, {}        # memo: a word's indices that weigh anything
            for b in batches:
                z = np.full(b.num_rows, model.bias)
                for i, t in enumerate(b.column(2)):
                    words = word_set(t.as_buffer().to_pybytes() if t.is_valid else b"")
                    if len(memo) + len(words) > MEMO_WORDS:
                        memo.clear()
                    for w in words:
                        if w not in memo:
                            memo[w] = [k for k in word_indices(w) if weights[k]]
                    used = {k for w in words for k in memo[w]}
                    if used:
                        z[i] += weights[sorted(used)].sum()
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(model.probability(z))],
                                                 names=["doc_id", "held_out", "score"])
        scored = out.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
