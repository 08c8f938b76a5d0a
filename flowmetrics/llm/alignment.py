"""Aligning the tokens of two tokenizers over the same bytes, by lockstep merging.

Both token sequences of a document cover the bytes of a blank and its text.
The documents of a block are laid end to end; a state vector holds one pair
of pointers (A token, B token) for every lane, and all lanes step at once in
NumPy: emit the link of the two tokens pointed at, emit a cut where they end on
the same byte, advance whichever ends first (both at a cut), drop the lanes
that are done. A document is one lane, a long one several: a lane starts at
every ``LANE`` th A token of a document, with the B token that holds its first byte,
so a block takes about ``2 * LANE`` steps however long its documents are.

An id pair's count is the number of documents that hold it linked, over the
whole table. Each block puts out its distinct pairs once, with the number of
its documents that hold them, and each document the pairs it holds as numbers
into that list. Pairs are summed over blocks in a shuffle, the highest count
of each A id (one row an id of the vocabulary, hence the broadcast) is joined
to them, and the answers go back to their blocks, where the documents add
them up. So what shuffles is a block's distinct pairs, not its links; a pair that
every document holds still has one row a block; nothing else is gathered.

Texts longer than ``PIECE_CHARS`` are encoded piece by piece: a piece ends before
a single blank between two other characters, where neither tokenizer joins
(checked against B's vocabulary when it is loaded). B's processor puts back
the blank that the cut takes away.

Defined results: texts that are null or empty, or whose joined A or B bytes
differ from the blank and the text (a literal U+2581, say), have no tokens and
zeros everywhere; repeated rows count as documents of their own; null ids pass;
an empty table gives no row; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_worker, slices, staged
from .pretokens import UNSETTLED, byte_signs, rank_file, read_json

TOKENIZER_A, RANKS_A, TOKENIZER_B = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
BLOCK_BYTES = 6 << 20       # texts of a block; a longer text is a block of its own
LANE = 512                  # A tokens of a lane
PIECE_CHARS = 16_384
PORTION = 64                # pieces whose ids B gives as Python numbers at a time
PAIR = 1 << 32              # a pair is A id * PAIR + B id
SEPARATORS = (",", "|", ";", "")

ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "block long, place long, pair long, docs long, held binary, times binary")
TOTALS = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


class Pair:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, json_a: str, ranks_a: str, model_b: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        vocab = read_json(json_a)["model"]["vocab"]
        ranks = rank_file(ranks_a)
        signs = byte_signs()
        self.bytes_a = [b""] * len(vocab)
        for token, i in vocab.items():
            if all(sign in signs for sign in token):
                self.bytes_a[i] = bytes(signs[sign] for sign in token)
        if any(ranks.get(b, i) != i for i, b in enumerate(self.bytes_a) if b):
            raise ValueError(f"{ranks_a} is not the vocabulary of {json_a}")
        #: the same vocabulary as ranks; its splitting pattern is that of settled characters
        self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.library = Tokenizer.from_file(json_a)
        self.library.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.splits = not any(re.search("[^▁]▁", p) for i, p in enumerate(pieces) if not self.b.is_control(i))
        self.width_a = np.array([len(t) for t in self.bytes_a], np.int64)
        self.width_b = np.array([len(t) for t in self.bytes_b], np.int64)
        self.spell_a = self.speller(self.bytes_a, self.width_a)
        self.spell_b = self.speller(self.bytes_b, self.width_b)
        # "id" + separator; an id's four texts stand together, A's ids first
        self.written = [f"{i}{s}" for n in (len(self.bytes_a), len(self.bytes_b)) for i in range(n) for s in SEPARATORS]

    @staticmethod
    def speller(tokens: list[bytes], width: np.ndarray):
        """ids -> the bytes of their tokens, joined."""
        flat, first = np.frombuffer(b"".join(tokens), np.uint8), (np.cumsum(width) - width).astype(np.int32)

        def spell(ids: np.ndarray) -> np.ndarray:
            n = width[ids]
            at = np.repeat(first[ids] - (np.cumsum(n) - n).astype(np.int32), n)
            at += np.arange(len(at), dtype=np.int32)
            return flat[at]
        return spell

    def pieces(self, text: str) -> list[str]:
        if len(text) <= PIECE_CHARS or not self.splits:
            return [text]
        out, start = [], 0
        single = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
        while cut := single.search(text, start + PIECE_CHARS):
            out.append(text[start:cut.start()])
            start = cut.end()
        return [*out, text[start:]]

    def encode_a(self, pieces: list[str], settled: bool) -> list[np.ndarray]:
        if settled:
            return [np.array(self.fast.encode_ordinary(" " + p), np.int32) for p in pieces]
        return [np.array(self.library.encode(" " + p, add_special_tokens=False).ids, np.int32) for p in pieces]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both tokenizers over all texts, and how many of them each text has: none
        where the joined bytes of either differ from the blank and the text."""
        pieces = [self.pieces(t) if t else [] for t in texts]
        doc = np.repeat(np.arange(len(texts)), [len(p) for p in pieces])
        ids_a = [i for t, p in zip(texts, pieces) if p for i in self.encode_a(p, not UNSETTLED.search(t))]
        every = [q for p in pieces for q in p]
        ids_b = [np.array(i, np.int32) for s in range(0, len(every), PORTION)
                 for i in self.b.encode(every[s:s + PORTION], num_threads=1)]
        whole = [b" " + t.encode() if t else b"" for t in texts]
        size = np.array([len(w) for w in whole], np.int64)
        good = np.ones(len(texts), bool)
        sides = []
        for ids, width, spelled in ((ids_a, self.width_a, self.spell_a), (ids_b, self.width_b, self.spell_b)):
            owner = np.repeat(doc.astype(np.int32), [len(i) for i in ids])
            ids = np.concatenate([np.empty(0, np.int32), *ids])
            good &= np.bincount(owner, width[ids], len(texts)).astype(np.int64) == size
            sides.append((ids, owner, spelled))
        wrong = np.zeros(len(texts), bool)
        text = np.frombuffer(b"".join(w for w, g in zip(whole, good) if g), np.uint8)
        for ids, owner, spelled in sides:
            differ = np.flatnonzero(spelled(ids[good[owner]]) != text)
            wrong[np.flatnonzero(good)[np.searchsorted(np.cumsum(size[good]), differ, side="right")]] = True
        good &= ~wrong
        (a, owner_a, _), (b, owner_b, _) = sides
        keep_a, keep_b = good[owner_a], good[owner_b]
        return (a[keep_a], np.bincount(owner_a[keep_a], minlength=len(texts)),
                b[keep_b], np.bincount(owner_b[keep_b], minlength=len(texts)))


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple:
    """Links and cuts of all lanes. ``ends_*``: last byte + 1 of every token over one
    byte axis; a lane takes the A tokens ``starts`` .. ``stops - 1``.
    Returns the A and B token numbers of the links, sorted, and those of the cuts."""
    # 32-bit numbers: a block has fewer tokens than bytes, and fewer than 2^31 of them
    a, stop = starts.astype(np.int32), stops.astype(np.int32)
    b = np.searchsorted(ends_b, np.where(a > 0, ends_a[a - 1], 0), side="right").astype(np.int32)
    links, cuts = [], []
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        links.append((a, b))
        cut = end_a == end_b
        if cut.any():
            cuts.append((a[cut], b[cut]))
        a = a + (end_a <= end_b)
        b = b + (end_b <= end_a)
        live = a < stop
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    if not links:
        none = np.empty(0, np.int32)
        return none, none, none, none
    link_a, link_b = map(np.concatenate, zip(*links))
    links.clear()
    order = np.lexsort((link_b, link_a))
    cut_a, cut_b = (np.sort(np.concatenate(c)) for c in zip(*cuts))
    return link_a[order], link_b[order], cut_a, cut_b


def lanes(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 A token of the lanes of documents with ``n`` A tokens each."""
    many = -(-n // LANE)
    doc = np.repeat(np.arange(len(n)), many)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    first = np.cumsum(n) - n
    return first[doc] + k * LANE, first[doc] + np.minimum((k + 1) * LANE, n[doc])


class Block:
    """The alignment of some texts, as arrays over all of their tokens."""

    def __init__(self, pair: Pair, texts: list[str | None]):
        self.a, self.n_a, self.b, self.n_b = pair.encode(texts)
        link_a, link_b, self.cut_a, self.cut_b = lockstep(
            np.cumsum(pair.width_a[self.a]), np.cumsum(pair.width_b[self.b]), *lanes(self.n_a))
        self.link_doc = np.repeat(np.arange(len(texts), dtype=np.int32), self.n_a)[link_a]
        self.link_pair = self.a[link_a].astype(np.int64) * PAIR
        self.link_pair += self.b[link_b]
        self.n_links = np.bincount(self.link_doc, minlength=len(texts))
        self.cut_doc = np.searchsorted(np.cumsum(self.n_a), self.cut_a, side="right")
        self.n_groups = np.bincount(self.cut_doc, minlength=len(texts))

    def groups(self, pair: Pair) -> list[str]:
        """Per text its groups as ``a1,a2|b1;a3|b2,b3``."""
        na, nb = len(self.a), len(self.b)
        codes = np.empty(na + nb, np.int32)
        sign_a, sign_b = np.zeros(na, np.int8), np.zeros(nb, np.int8)
        sign_a[self.cut_a] = 1
        sign_b[self.cut_b] = 2
        last = np.cumsum(self.n_b)[self.n_b > 0] - 1
        sign_b[last] = 3
        size_a, size_b = (np.diff(cut, prepend=-1) for cut in (self.cut_a, self.cut_b))     # tokens of each group
        before = self.cut_b + 1 - size_b                          # B tokens of the groups before
        through = self.cut_a + 1                                  # A tokens up to the group's end
        n = len(SEPARATORS)
        codes[np.arange(na, dtype=np.int32) + np.repeat(before, size_a)] = self.a * n + sign_a
        codes[np.arange(nb, dtype=np.int32) + np.repeat(through, size_b)] = (len(pair.bytes_a) + self.b) * n + sign_b
        ends = np.cumsum(self.n_a + self.n_b)
        return ["".join(map(pair.written.__getitem__, codes[e - k:e].tolist()))
                for e, k in zip(ends.tolist(), (self.n_a + self.n_b).tolist())]

    def holdings(self) -> tuple[np.ndarray, np.ndarray, list[tuple[bytes, bytes]]]:
        """Distinct pairs with the number of texts that hold them, and per text the
        numbers of its pairs in that list (as steps) with the times each is linked."""
        pairs, number = np.unique(self.link_pair, return_inverse=True)
        number += self.link_doc * np.int64(max(len(pairs), 1))
        key, times = np.unique(number, return_counts=True)
        doc, held = np.divmod(key, max(len(pairs), 1))
        bounds = np.searchsorted(doc, np.arange(len(self.n_a) + 1))
        per = [(np.diff(held[s:e], prepend=0).astype("<u4").tobytes(), times[s:e].astype("<u4").tobytes())
               for s, e in zip(bounds[:-1], bounds[1:])]
        return pairs, np.bincount(held, minlength=len(pairs)), per


def align(docs: DataFrame, json_a: str | None = None, ranks_a: str | None = None, model_b: str | None = None,
          digest: bool = False) -> DataFrame:
    """Rows of documents (``place`` null) with their counts and groups, and rows of
    blocks (``place`` the pair's number in its block) with distinct pairs and the number
    of the block's documents that hold them. With ``digest`` the groups are hashed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        files = (json_a or public_tokenizers.path(TOKENIZER_A), ranks_a or public_tokenizers.path(RANKS_A),
                 model_b or public_tokenizers.path(TOKENIZER_B))
        pair = per_worker(f"tokenizer pair {files}", lambda: Pair(*files))
        task, made = TaskContext.get().partitionId() << 32, 0
        types = [pa.int64()] * 5 + [pa.string()] + [pa.int64()] * 4 + [pa.binary()] * 2
        names = [c.split()[0] for c in ALIGNED.split(", ")]

        def rows(n: int, given: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(given[c], t) if c in given else pa.nulls(n, t) for c, t in zip(names, types)], names=names)

        for ids, texts in blocks(batches):
            block = Block(pair, texts)
            groups = block.groups(pair)
            if digest:
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            pairs, held_by, held = block.holdings()
            label = np.full(max(len(texts), len(pairs)), task + made)
            made += 1
            yield rows(len(texts), {
                "doc_id": ids, "n_a": block.n_a, "n_b": block.n_b, "n_groups": block.n_groups, "n_links": block.n_links,
                "groups": groups, "block": label[:len(texts)], "held": [h for h, _ in held], "times": [t for _, t in held]})
            for s in range(0, len(pairs), 1 << 16):
                part = pairs[s:s + (1 << 16)]
                yield rows(len(part), {"block": label[:len(part)], "place": np.arange(s, s + len(part)), "pair": part,
                                       "docs": held_by[s:s + len(part)]})
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ALIGNED)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts of blocks; a block may span Arrow batches."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t, n in zip(b.column(0).to_pylist(), b.column(1),
                           pc.fill_null(pc.binary_length(b.column(1)), 0).to_pylist()):
            if ids and size + n > BLOCK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t.as_py())
            size += n
    if ids:
        yield ids, texts


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Every linked pair of ids: the documents that hold it, and whether no pair of its A id has more."""
    summed = staged(aligned.where("place is not null").groupBy("pair").agg(F.sum("docs").alias("count"))
                    .withColumn("a", F.expr(f"pair div {PAIR}")), "pair_counts")
    top = summed.groupBy("a").agg(F.max("count").alias("top"))      # one row an A id: at most the vocabulary
    return summed.join(F.broadcast(top), "a").select(
        "pair", (F.col("pair") % PAIR).alias("b"), "a", "count", (F.col("count") == F.col("top")).alias("best"))


def totals(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document the sum of its links' counts, and how many of them are best for their A id."""
    answers = (aligned.where("place is not null").select("block", "place", "pair")
               .join(counts.select("pair", "count", "best"), "pair"))
    asked = aligned.where("place is null").drop("place", "pair", "docs")
    both = asked.unionByName(answers.select(
        "block", "place", (F.col("count") * 2 + F.col("best").cast("int")).alias("answer")), allowMissingColumns=True)
    placed = both.repartition("block").sortWithinPartitions("block", F.asc_nulls_last("place"))
    columns = ["block", "place", "answer", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "held", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, count, best = None, [], None, None
        for b in batches:
            block = np.asarray(b.column(0))
            bounds = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for s, e in zip(bounds[:-1], bounds[1:]):
                if s == e:
                    continue
                if block[s] != current:
                    current, parts, count = block[s], [], None
                rows = b.slice(s, e - s)
                n = len(rows) - rows.column(1).null_count            # answers come first, in the order of their places
                if n:
                    parts.append(np.asarray(rows.column(2).slice(0, n)))
                if n == len(rows):
                    continue
                if count is None:
                    answer = np.concatenate(parts) if parts else np.empty(0, np.int64)
                    count, best = answer >> 1, answer & 1
                asked = rows.slice(n)
                sums = np.zeros((2, len(asked)), np.int64)
                for k, (held, times) in enumerate(zip(asked.column(9), asked.column(10))):
                    at = np.cumsum(np.frombuffer(held.as_buffer(), "<u4"))
                    t = np.frombuffer(times.as_buffer(), "<u4").astype(np.int64)
                    sums[:, k] = best[at] @ t, count[at] @ t
                yield pa.RecordBatch.from_arrays(
                    [*(asked.column(c) for c in range(3, 8)), pa.array(sums[0]), pa.array(sums[1]), asked.column(8)],
                    names=[c.split()[0] for c in TOTALS.split(", ")])
    return placed.select(*columns).mapInArrow(run, TOTALS)


def alignment_totals(docs: DataFrame) -> DataFrame:
    """One row per document: tokens, groups, links, corpus-wide link counts, hash of the groups."""
    aligned = staged(align(docs, digest=True), "aligned")
    return totals(aligned, pair_counts(aligned))
