"""Token counts, tokenizer alignment and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowmetrics.llm import alignment, periodic_runs, queries, token_counts
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS, awkward_texts, rows, words

public_tokenizers = pytest.importorskip("public_tokenizers")

#: Pieces of awkward token material: special strings, blanks, composed and unsettled characters.
ODD = ["<|endoftext|>", "<|endof", "<s>", "</s>", "<unk>", "<0x41>", "a", "aa", "the", " word", " ", "  ", "\n", "\r\n", "\t",
       "é", "ß", "日本", "՘", "\U0001f600", "'s", "'LL", "12", "...", "\x00", "́", "ﬁ", "　", "​"]


def odd_texts(seed: int, n: int, extra: list[str] = ()) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice([*ODD, *extra, chr(rng.randrange(0x20, 0xD7FF))]) for _ in range(rng.choice([2, 15, 60])))
            for _ in range(n)]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(token_counts.TOKENIZER))


# ------------------------------------------------------------------ token counts
def test_counts_equal_the_library(spark, tokenizer):
    texts = awkward_texts() + odd_texts(3, 400) + ["x" * 20_000, " " * 20_000, "ab" * 10_000, words(random.Random(2), 20_000)]
    texts += texts[:30]
    docs = spark.createDataFrame(rows(texts, ids=[None, *range(1, len(texts))]), DOCS)
    clash = docs.withColumnRenamed("lang", "n_tokens").withColumnRenamed("source", "n_bytes")
    want = Counter((i, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > 1_024)
                   for i, t in zip([None, *range(1, len(texts))], texts))
    assert Counter(map(tuple, token_counts.count_tokens(clash).collect())) == want


def test_counts_of_the_driver_table(spark, tokenizer):
    docs = queries.load(spark, SF_SMALL, "documents").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op11_merge_token_counts"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        assert got[d.doc_id].n_tokens == len(tokenizer.encode(d.text or "", add_special_tokens=False).ids)


def test_long_texts_are_counted_in_portions(tokenizer, monkeypatch):
    count = token_counts.MergeCounter(public_tokenizers.path(token_counts.TOKENIZER))
    monkeypatch.setattr(token_counts, "PORTION", 7)
    monkeypatch.setattr(token_counts, "MEMO_KEYS", 20)
    for t in odd_texts(4, 100) + [words(random.Random(5), 400)]:
        assert count(t) == len(tokenizer.encode(t, add_special_tokens=False).ids)


def test_empty_table_counts(spark):
    assert token_counts.count_tokens(spark.createDataFrame([], DOCS)).count() == 0


# ------------------------------------------------------------------ alignment
@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(*(public_tokenizers.path(p) for p in (alignment.TOKENIZER_A, alignment.RANKS_A, alignment.TOKENIZER_B)))


def plain_alignment(pair, text):
    """ids of A and B, every overlapping pair of token occurrences, groups as text."""
    if not text:
        return [], [], [], ""
    a = pair.library.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    spelled = [b"".join(table[i] for i in ids) for table, ids in ((pair.bytes_a, a), (pair.bytes_b, b))]
    if spelled != [b" " + text.encode()] * 2:
        return [], [], [], ""
    end_a = np.cumsum([len(pair.bytes_a[i]) for i in a]).tolist()
    end_b = np.cumsum([len(pair.bytes_b[i]) for i in b]).tolist()
    spans_a, spans_b = list(zip([0, *end_a], end_a)), list(zip([0, *end_b], end_b))
    links, near = [], 0
    for i, (s, e) in zip(a, spans_a):
        while spans_b[near][1] <= s:
            near += 1
        for j in range(near, len(b)):
            if spans_b[j][0] >= e:
                break
            links.append((i, b[j]))
    groups, i, j = [], 0, 0
    for cut in sorted(set(end_a) & set(end_b)):
        m, n = end_a.index(cut, i) + 1, end_b.index(cut, j) + 1
        groups.append(",".join(map(str, a[i:m])) + "|" + ",".join(map(str, b[j:n])))
        i, j = m, n
    return a, b, links, ";".join(groups)


def plain_totals(pair, docs):
    found = [(i, *plain_alignment(pair, t)) for i, t in docs]
    held = Counter(p for _, _, _, links, _ in found for p in set(links))
    top = defaultdict(int)
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    return Counter((i, len(a), len(b), groups.count("|") if groups else 0, len(links),
                    sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links),
                    hashlib.sha256(groups.encode()).hexdigest() if groups else "")
                   for i, a, b, links, groups in found)


def totals_of(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return Counter(map(tuple, df.select(*names).collect()))


def test_alignment_equals_brute_force(spark, pair):
    odd = [t for t in odd_texts(6, 150) + odd_texts(7, 20, ["▁"] * 20)]
    texts = awkward_texts() + odd + [words(random.Random(8), 3_000)]
    texts += texts[:25]
    ids = [None, 7, 7, *range(3, len(texts))]
    docs = spark.createDataFrame(rows(texts, ids=ids), DOCS).repartition(5)
    clash = docs.withColumnRenamed("lang", "pair").withColumnRenamed("source", "block")
    want = plain_totals(pair, zip(ids, texts))
    assert any(t and not k[1] for k, t in zip(want, texts)) and totals_of(alignment.alignment_totals(clash)) == want


def test_alignment_of_the_driver_table(spark, pair):
    docs = [(r.doc_id, r.text) for r in queries.load(spark, SF_SMALL, "documents").collect()]
    assert totals_of(queries.QUERIES["op12_lockstep_alignment"](spark, SF_SMALL)) == plain_totals(pair, docs)


def test_small_blocks_lanes_and_pieces_change_nothing(pair, monkeypatch):
    texts = [t for t in awkward_texts(9) + odd_texts(10, 60) if t]
    whole = alignment.Block(pair, texts)
    groups = whole.groups(pair)
    monkeypatch.setattr(alignment, "PIECE_CHARS", 40)
    monkeypatch.setattr(alignment, "LANE", 3)
    small = alignment.Block(pair, texts)
    assert small.groups(pair) == groups
    assert (small.link_pair == whole.link_pair).all() and (small.n_groups == whole.n_groups).all()
    assert [plain_alignment(pair, t)[3] for t in texts] == groups


def test_empty_table_alignment(spark):
    assert alignment.alignment_totals(spark.createDataFrame([], DOCS)).count() == 0
    assert alignment.alignment_totals(spark.createDataFrame(rows([None, ""]), DOCS)).count() == 2


def test_groups_are_an_output(spark, pair):
    docs = spark.createDataFrame(rows(["the aligned words", "naïve façade"]), DOCS)
    got = {r.doc_id: r.groups for r in alignment.align(docs).where("place is null").collect()}
    assert got == {i: plain_alignment(pair, t)[3] for i, t in enumerate(["the aligned words", "naïve façade"])}


# ------------------------------------------------------------------ periodic runs
def plain_runs(w):
    """Every maximal stretch of each period, smallest period first."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_digest(doc_id, text):
    w = periodic_runs.WORDS.findall(text or "")
    n = len(w)
    if n and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1_000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def periodic_text(rng):
    w = [rng.choice("abcd") * rng.randint(1, 2) for _ in range(rng.choice([0, 3, 6, 9, 40, 200]))]
    if w and rng.random() < 0.7:
        a, p = rng.randrange(len(w)), rng.randint(1, max(1, len(w) // 4))
        w[a:] = [w[a + i % p] if a + i % p < len(w) else "z" for i in range(len(w) - a)]
    return rng.choice([" ", "\n", " \t"]).join(w)


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(60):
        texts = [periodic_text(rng).split() for _ in range(rng.randint(0, 25))]
        texts += texts[:3]
        got = periodic_runs.enumerate_runs(texts)
        assert [[tuple(map(int, r)) for r in g] for g in got] == [plain_runs(w) for w in texts]


def test_runs_in_small_portions(monkeypatch):
    rng = random.Random(12)
    texts = [periodic_text(rng).split() for _ in range(30)]
    monkeypatch.setattr(periodic_runs, "PORTION", 5)
    got = periodic_runs.enumerate_runs(texts)
    assert [[tuple(map(int, r)) for r in g] for g in got] == [plain_runs(w) for w in texts]


def test_extensions_equal_a_scan():
    rng = random.Random(13)
    docs = [[rng.choice([0, 1]) for _ in range(rng.choice([1, 30, 300]))] * rng.randint(1, 3) for _ in range(6)]
    joined = np.array([x for k, d in enumerate(docs) for x in [*d, 2 + k]])
    owner = np.repeat(np.arange(len(docs)), [len(d) + 1 for d in docs])
    extensions = periodic_runs.Extensions(joined, owner)
    base = 0
    for d in docs:
        pairs = [sorted(rng.sample(range(len(d)), 2)) for _ in range(200)] if len(d) > 1 else []
        for i, j in pairs:
            k = 0
            while j + k < len(d) and d[i + k] == d[j + k]:
                k += 1
            assert extensions(np.array([base + i]), np.array([base + j]))[0] == k
        base += len(d) + 1


def test_query_equals_brute_force(spark):
    rng = random.Random(14)
    texts = awkward_texts() + [periodic_text(rng) for _ in range(150)] + ["x " * 5_000, "a b c " * 3_000]
    texts += texts[:20]
    ids = [None, 7, 7, *range(3, len(texts))]
    docs = spark.createDataFrame(rows(texts, ids=ids), DOCS)
    clash = docs.withColumnRenamed("lang", "runs").withColumnRenamed("source", "start")
    original = queries.load
    queries.load = lambda *_: clash
    try:
        got = Counter(map(tuple, queries.op13_periodic_runs(spark, "").collect()))
    finally:
        queries.load = original
    assert got == Counter(plain_digest(i, t) for i, t in zip(ids, texts))


def test_runs_of_the_driver_table(spark):
    docs = queries.load(spark, SF_SMALL, "documents").collect()
    got = Counter(map(tuple, queries.QUERIES["op13_periodic_runs"](spark, SF_SMALL).collect()))
    assert got == Counter(plain_digest(d.doc_id, d.text) for d in docs)


def test_empty_table_runs(spark):
    assert periodic_runs.find_runs(spark.createDataFrame([], DOCS)).count() == 0
