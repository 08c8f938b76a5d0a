"""Token counts by byte-pair merging over a heap and a linked list.

A text is cut at the special strings (one token each) and then into the
tokenizer's pre-tokens. Each pre-token starts as one symbol a byte, chained in
a doubly linked list; a heap holds its adjacent pairs as (rank, place). The
lowest pair is popped again and again: if it is still there, its right symbol
joins the left one and the two new neighbour pairs are pushed. The count is
the number of initial symbols minus the merges; no token ids are put out.
Counts of short pre-tokens are remembered per worker process, in a table of
bounded size.

There is no shuffle: each row is counted where it is read. A long text is
walked in portions of its pre-tokens, so beside the text itself memory is
bounded, except by a single pre-token (a run of letters, digits, signs or
blanks), which takes some 100 bytes per byte.

Defined results: a null or empty text has 0 bytes and 0 tokens; every row
gives one row, repeated rows and null ids too; an empty table gives none; other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_worker
from .pretokens import UNSETTLED, byte_signs, read_json

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1_024
MEMO_KEYS = 600_000
MEMO_KEY_CHARS = 48
PORTION = 50_000        # pre-tokens taken at once
SHIFT = 40              # a heap entry is rank << SHIFT | place
WIDE = 1 << 24          # a pair is left id * WIDE + right id

COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class MergeCounter:
    """Numbers of tokens of whole texts under one byte-level tokenizer file."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer
        data = read_json(path)
        vocab = data["model"]["vocab"]
        signs = byte_signs()
        self.first = [0] * 256
        for sign, byte in signs.items():
            self.first[byte] = vocab[sign]
        #: pair of ids -> (rank, id of the merged symbol)
        self.merges = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[vocab[left] * WIDE + vocab[right]] = (rank, vocab[left + right])
        specials = sorted((t["content"] for t in data["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.library = Tokenizer.from_file(path).pre_tokenizer
        self.memo: dict[str, int] = {}

    def merged(self, word: str) -> int:
        """Symbols of one pre-token after all merges."""
        symbols = [self.first[b] for b in word.encode()]
        n = len(symbols)
        if n < 2:
            return n
        merges = self.merges
        heap = []
        for i in range(n - 1):
            found = merges.get(symbols[i] * WIDE + symbols[i + 1])
            if found:
                heap.append(found[0] << SHIFT | i)
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        done, mask = 0, (1 << SHIFT) - 1
        while heap:
            entry = heappop(heap)
            i = entry & mask
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue
            found = merges.get(symbols[i] * WIDE + symbols[j])
            if not found or found[0] != entry >> SHIFT:
                continue                        # the pair went with an earlier merge
            symbols[i], symbols[j] = found[1], -1
            after[i] = k = after[j]
            done += 1
            if k < n:
                before[k] = i
                found = merges.get(symbols[i] * WIDE + symbols[k])
                if found:
                    heappush(heap, found[0] << SHIFT | i)
            h = before[i]
            if h >= 0:
                found = merges.get(symbols[h] * WIDE + symbols[i])
                if found:
                    heappush(heap, found[0] << SHIFT | h)
        return n - done

    def _sum(self, words: list[str]) -> int:
        memo = self.memo
        try:
            return sum(map(memo.__getitem__, words))
        except KeyError:
            pass
        if len(memo) > MEMO_KEYS:
            memo.clear()
        total = 0
        for w in words:
            n = memo.get(w)
            if n is None:
                n = self.merged(w)
                if len(w) <= MEMO_KEY_CHARS:
                    memo[w] = n
            total += n
        return total

    def _plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if not text:
            return 0
        if UNSETTLED.search(text):
            words = (text[s:e] for _, (s, e) in self.library.pre_tokenize_str(text))
        elif len(text) < 4 * PORTION:
            return self._sum(self.pattern.findall(text))
        else:
            words = (m.group() for m in self.pattern.finditer(text))
        total = 0
        while portion := list(islice(words, PORTION)):
            total += self._sum(portion)
        return total

    def __call__(self, text: str) -> int:
        if not self.special:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


def count_tokens(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per document its UTF-8 bytes, its tokens, and whether they exceed ``limit``.
    ``tokenizer``: a byte-level tokenizer file that the executors can open."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        path = tokenizer or public_tokenizers.path(TOKENIZER)
        count = per_worker(f"merge counter {path}", lambda: MergeCounter(path))
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            n = pa.array([count(t.as_py()) if t.is_valid else 0 for t in texts], pa.int64())
            size = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, size, n, pc.greater(n, limit)],
                                             names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, COUNTS)
