"""Maximal periodic runs of words, by longest common extensions over a difference cover.

A run is a stretch of words with smallest period q, at least ``max(6, 4 q)``
words long, that no neighbouring word extends. The documents of a slice are
numbered into one array of word ids and searched together:

* Harmonic grid: a run of period q holds four neighbouring multiples of q
  (counted from the document's start), which carry the same word. All grid
  places (q, k) of all documents are listed in bounded portions, n/1 + n/2 +
  ... of them, and those whose four words agree stay.
* Longest common extension of places i and i + q, forward and backward: the
  suffixes that start at a place of the difference cover (5 of every 21
  places) are sorted, first by 21 words, then by doubling; their common
  prefixes go into a sparse table of range minima. For any two places some
  shift under 21 brings both onto the cover, so a query compares that many
  words and then asks the table. The mirrored array serves the backward half.
* The extensions give the whole run; runs found at several grid places or under
  a multiple of their period are the same stretch, and the smallest period stays.

Documents that no grid place speaks for have no run and take no part in the
sort. Every row is worked on where it is read: no shuffle, nothing grows but
with the longest text (some 200 bytes per word of it).

Defined results: a null or empty text, or one without words, has no runs;
every row gives one row, repeated rows and null ids too; an empty table gives
none; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

WORDS = re.compile("[^\x20\x09-\x0d]+")
COVER, MODULUS = (0, 1, 4, 14, 16), 21      # every difference modulo 21 is one of two of these
REPEATS, LEAST_WORDS = 4, 6                 # a run repeats its period four times and has six words
SLICE_BYTES = 4 << 20
PORTION = 1 << 20                           # grid places and queries taken at once

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def cover_shifts() -> np.ndarray:
    """``[i % 21, j % 21]`` -> the least shift that brings both places onto the cover."""
    out = np.full((MODULUS, MODULUS), MODULUS, np.int64)
    for i in range(MODULUS):
        for j in range(MODULUS):
            out[i, j] = next(s for s in range(MODULUS) if (i + s) % MODULUS in COVER and (j + s) % MODULUS in COVER)
    return out


def same_words(words: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many words agree from ``i`` and ``j`` on, up to ``most`` (one number a query)."""
    out = np.zeros(len(i), np.int64)
    open_ = np.flatnonzero(most > 0)
    step = 0
    while len(open_):
        open_ = open_[words[i[open_] + step] == words[j[open_] + step]]
        step += 1
        out[open_] = step
        open_ = open_[most[open_] > step]
    return out


class Extensions:
    """Longest common extensions within documents. ``words``: ids of all documents, each
    document closed by a word of its own; ``doc``: the document of each place."""

    def __init__(self, words: np.ndarray, doc: np.ndarray):
        n = len(words)
        self.words = np.concatenate([words, np.full(MODULUS + 1, -1, words.dtype)])
        self.shift = cover_shifts()
        base = np.arange(0, n + MODULUS, MODULUS)
        places = (base[:, None] + np.array(COVER)).ravel()
        self.places = places = places[places < n]
        number = np.full(n + MODULUS + 1, -1, np.int64)
        number[places] = np.arange(len(places))
        self.levels = [self._by_words(doc[places])]
        width = MODULUS
        while len(places) and self.levels[-1].max() + 1 < len(places):
            later = number[np.minimum(places + width, n + MODULUS)]
            second = np.where(later >= 0, self.levels[-1][later], -1) + 1
            self.levels.append(self._ranks(self.levels[-1] * (len(places) + 1) + second))
            width *= 2
        self.rank, self.number = self.levels[-1] if len(places) else np.empty(0, np.int64), number
        self._table(doc)

    def _by_words(self, doc: np.ndarray) -> np.ndarray:
        """Ranks of the sampled suffixes by document, then by their first 21 words."""
        bits = max(1, int(self.words.max(initial=0) + 1).bit_length())
        per = max(1, 62 // bits)
        keys = [doc]
        for at in range(0, MODULUS, per):
            key = np.zeros(len(self.places), np.int64)
            for k in range(at, min(at + per, MODULUS)):
                key = (key << bits) + (self.words[np.minimum(self.places + k, len(self.words) - 1)] + 1)
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(new)
        return out

    @staticmethod
    def _ranks(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key, kind="stable")
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(np.concatenate([[False], key[order[1:]] != key[order[:-1]]]))
        return out

    def _table(self, doc: np.ndarray) -> None:
        """Common prefixes of neighbours in rank order, and their range minima."""
        m = len(self.places)
        at = np.empty(m, np.int64)
        at[self.rank] = np.arange(m)
        left, right = self.places[at[:-1]], self.places[at[1:]]
        lcp = np.zeros(max(m - 1, 0), np.int64)
        live = np.flatnonzero(doc[left] == doc[right])
        for k in range(len(self.levels) - 1, -1, -1):
            rank, width = self.levels[k], MODULUS << k
            i, j = self.number[left[live] + lcp[live]], self.number[right[live] + lcp[live]]
            equal = (i >= 0) & (j >= 0)
            equal[equal] = rank[i[equal]] == rank[j[equal]]
            lcp[live[equal]] += width
        i, j = left[live] + lcp[live], right[live] + lcp[live]
        lcp[live] += same_words(self.words, i, j, np.full(len(live), MODULUS))
        self.levels = []
        self.minima = [lcp]
        while 2 << (len(self.minima) - 1) <= len(lcp):
            last, half = self.minima[-1], 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from ``i`` and ``j`` on; ``i < j``, of one document."""
        shift = self.shift[i % MODULUS, j % MODULUS]
        out = same_words(self.words, i, j, shift)
        far = np.flatnonzero(out == shift)
        a, b = self.number[i[far] + shift[far]], self.number[j[far] + shift[far]]
        known = (a >= 0) & (b >= 0)
        far, a, b = far[known], self.rank[a[known]], self.rank[b[known]]
        low, high = np.minimum(a, b), np.maximum(a, b)       # neighbours low .. high - 1
        level = np.frexp((high - low).astype(float))[1] - 1
        for k in np.unique(level):
            pick = np.flatnonzero(level == k)
            row = self.minima[k]
            out[far[pick]] += np.minimum(row[low[pick]], row[high[pick] - (1 << k)])
        return out


def grid(words: np.ndarray, first: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, place, period) of the grid places whose next three multiples carry the
    same word. ``first``, ``n``: first place and number of words of each document."""
    most = np.where(n >= LEAST_WORDS, n // REPEATS, 0)
    doc = np.repeat(np.arange(len(n)), most)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    count = (n[doc] - 1) // period - (REPEATS - 2)          # k with place k + 3 still inside
    ends = np.cumsum(count)
    for low in range(0, int(ends[-1]) if len(ends) else 0, PORTION):
        high = min(low + PORTION, int(ends[-1]))
        p0, p1 = np.searchsorted(ends, [low, high - 1], side="right")
        part = np.minimum(ends[p0:p1 + 1], high) - np.maximum(ends[p0:p1 + 1] - count[p0:p1 + 1], low)
        pair = np.repeat(np.arange(p0, p1 + 1), part)
        k = np.arange(low, high) - (ends[pair] - count[pair])
        q = period[pair]
        place = first[doc[pair]] + k * q
        for r in range(1, REPEATS):
            keep = words[place] == words[place + r * q]
            pair, q, place = pair[keep], q[keep], place[keep]
        if len(pair):
            yield doc[pair], place, q


def enumerate_runs(texts: list[list[str]]) -> list[np.ndarray]:
    """Per list of words its runs as rows (start, length, period), by start, then period."""
    none = np.empty((0, 3), np.int64)
    out = [none] * len(texts)
    vocabulary: defaultdict = defaultdict()
    vocabulary.default_factory = vocabulary.__len__
    n = np.array([len(t) for t in texts], np.int64)
    words = np.fromiter((vocabulary[w] for t in texts for w in t), np.int64, int(n.sum()))
    first = np.cumsum(n) - n
    found = list(grid(words, first, n))
    if not found:
        return out
    doc, place, period = map(np.concatenate, zip(*found))
    speaks = np.unique(doc)                                  # only these documents are sorted
    m = n[speaks]
    base = np.cumsum(m + 1) - (m + 1)                        # one closing word after each
    owner = np.repeat(np.arange(len(speaks)), m + 1)
    inside = np.arange(len(owner)) - base[owner]
    closing = inside == m[owner]
    joined = np.where(closing, len(vocabulary) + owner, words[np.minimum(first[speaks][owner] + inside, len(words) - 1)])
    mirror = np.where(closing, joined, words[np.maximum(first[speaks][owner] + m[owner] - 1 - inside, 0)])
    ahead, behind = Extensions(joined, owner), Extensions(mirror, owner)
    doc = np.searchsorted(speaks, doc)
    place = place - first[speaks][doc]
    rows = []
    for low in range(0, len(doc), PORTION):
        d, i, q = doc[low:low + PORTION], place[low:low + PORTION], period[low:low + PORTION]
        fore = ahead(base[d] + i, base[d] + i + q)
        back = np.zeros(len(d), np.int64)
        some = np.flatnonzero(i > 0)
        # the word before place i stands at m - i in the mirrored document
        right = base[d[some]] + m[d[some]] - i[some]
        back[some] = behind(right - q[some], right)
        length = back + q + fore
        keep = length >= np.maximum(LEAST_WORDS, REPEATS * q)
        rows.append(np.stack([d, i - back, length, q], axis=1)[keep])
    runs = np.concatenate(rows)
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :3] != runs[:-1, :3]).any(axis=1)    # one stretch: its smallest period
    runs = runs[new]
    runs = runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]
    bounds = np.searchsorted(runs[:, 0], np.arange(len(speaks) + 1))
    for k, d in enumerate(speaks):
        out[d] = runs[bounds[k]:bounds[k + 1], 1:]
    return out


def collapsed(words: list[str], runs: np.ndarray) -> str:
    """The words that stand in no run behind its first period, joined by one blank."""
    if not len(runs):
        return " ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(depth[:-1]) == 0
    return " ".join([w for w, k in zip(words, kept.tolist()) if k])


def find_runs(docs: DataFrame, prepare: Callable[[int | None, list[str]], list[str]] | None = None) -> DataFrame:
    """Per document its number of words, its runs by start, then period, and its text
    without their repeats. ``prepare(doc_id, words)`` may replace the words first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()
            for low, high in slices(sizes, SLICE_BYTES):
                ids = b.column(0).slice(low, high - low)
                words = [WORDS.findall(t.as_py() or "") for t in b.column(1).slice(low, high - low)]
                if prepare:
                    words = [prepare(i, w) for i, w in zip(ids.to_pylist(), words)]
                runs = enumerate_runs(words)
                ends = np.cumsum([0] + [len(r) for r in runs])
                flat = np.concatenate(runs)
                values = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(shape.value_type))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([len(w) for w in words], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
                     pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, RUNS)
