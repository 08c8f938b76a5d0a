"""Pareto mixing and SimHash grouping against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from flowmetrics.llm import mixing, simhash

from .helpers import DOCS, awkward_texts, rows, words


def _docs(spark, texts, **kw):
    return spark.createDataFrame(rows(texts, **kw), DOCS)


# ---------------------------------------------------------------- mixing
def _targets(sizes):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        share = {s: (total - sum(target.values())) * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]} or None
        if not over:
            return target | share
        target |= {s: 2.0 * sizes[s] for s in over}
        open_ -= over
    return target


def _mix_docs(seed=5):
    rng = random.Random(seed)
    texts = awkward_texts() + [words(rng, rng.randint(1, 400)) for _ in range(900)]
    sources = [rng.choice(["a", "a", "a", "b", "Z", "é", None, "tiny"] if i % 7 else ["hot"]) for i in range(len(texts))]
    return texts, sources


def test_mixing(spark):
    texts, sources = _mix_docs()
    out = mixing.allocate(_docs(spark, texts, sources=sources)).collect()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    per = defaultdict(int)
    for s, n in zip(sources, size):
        per[s] += n
    want = _targets(dict(per))
    taken, largest = defaultdict(int), defaultdict(int)
    assert len(out) == len(texts)
    for r in out:
        assert r["size"] == size[r["doc_id"]] and r["source"] == sources[r["doc_id"]]
        assert r["source_size"] == per[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in per:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1
    assert len({r["copies"] for r in out if r["size"]}) > 1
    again = mixing.allocate(_docs(spark, texts, sources=sources).repartition(3)).collect()
    assert {r["doc_id"]: r["copies"] for r in out} == {r["doc_id"]: r["copies"] for r in again}


def test_mixed_rows(spark):
    texts, sources = _mix_docs(9)
    df = _docs(spark, texts, sources=sources).selectExpr("*", "'x' AS size", "1 AS copies", "2 AS class")
    copies = {r["doc_id"]: r["copies"] for r in mixing.allocate(df).collect()}
    out = mixing.mixed(df)
    assert out.columns == df.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({k: v for k, v in copies.items() if v})


def test_inclusion_follows_expected_copies(spark):
    """Over many seeds a document is taken about as often as expected."""
    rng = random.Random(2)
    df = _docs(spark, [words(rng, rng.choice([3, 30, 300])) for _ in range(120)], sources=["a"] * 40 + ["b"] * 80).cache()
    n, got, goal = 2, Counter(), Counter()
    for seed in range(n):
        for r in mixing.allocate(df, seed).collect():
            got[(r["source"], r["size"].bit_length())] += r["copies"]
            goal[(r["source"], r["size"].bit_length())] += 1
    df.unpersist()
    rate = {k: got[k] / goal[k] for k in got}
    longest = max(k[1] for k in rate)
    assert rate[("b", longest)] > rate[("b", 2)]


def test_copies_of_one_row_fill_the_target(spark):
    """400 copies of one row, all in one place of the ranking, are taken one by one."""
    rng = random.Random(3)
    texts = [words(rng, 100)] * 400 + [words(rng, rng.randint(50, 150)) for _ in range(400)] + [words(rng, 90)] * 300
    ids = [7] * 400 + list(range(100, 500)) + [8] * 300
    sources = ["a"] * 800 + [None] * 300
    df = _docs(spark, texts, sources=sources, ids=ids).selectExpr("*", "1 AS number", "2 AS fit")
    runs = [mixing.allocate(d).collect() for d in (df, df.repartition(5))]
    for source in ("a", None):
        mine = [r for r in runs[0] if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 75
    key = lambda rows: Counter((r["doc_id"], r["size"], r["copies"]) for r in rows)
    assert key(runs[0]) == key(runs[1]) and len({c for i, _, c in key(runs[0]) if i == 8}) == 2
    mix = mixing.mixed(df)
    want = Counter()
    for (i, _, c), n in key(runs[0]).items():
        want[i] += c * n
    assert mix.columns == df.columns and Counter(r["doc_id"] for r in mix.collect()) == +want


@pytest.mark.parametrize("texts", [[], [None, ""], ["one two"]])
def test_mixing_small(spark, texts):
    out = mixing.allocate(_docs(spark, texts)).collect()
    assert len(out) == len(texts)


# ---------------------------------------------------------------- SimHash
def _fingerprint(text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    found = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not found:
        return 0
    shingles = [b" ".join(found[i:i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def _components(fps):
    ids, root = list(fps), {i: i for i in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_fingerprints_and_groups(spark):
    rng = random.Random(4)
    texts = awkward_texts()
    long = words(rng, 900).split(" ")
    for i in range(30):
        copy = list(long)
        copy[rng.randrange(900)] = f"edit{i}"
        texts.append(" ".join(copy))
    df = _docs(spark, texts).selectExpr("*", "1 AS fp", "2 AS rep", "3 AS text_hash")
    fps = {i: _fingerprint(t) for i, t in enumerate(texts)}
    want = _components(fps)
    out = simhash.near_groups(df).collect()
    assert {r["doc_id"]: r["fp"] & (1 << 64) - 1 for r in out} == fps
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_keep_one_repeated_rows(spark):
    text = "one two three four five six"
    df = _docs(spark, [text, text, text, "other words here, many of them indeed", None, ""], ids=[4, 4, 9, 4, 1, 1])
    out = simhash.keep_one(df).collect()
    assert sorted((r["doc_id"], r["text"] or "") for r in out) == [(1, ""), (4, text), (4, "other words here, many of them indeed")]
    assert simhash.keep_one(_docs(spark, [])).count() == 0


def test_keep_one_keeps_every_column(spark):
    df = spark.createDataFrame([(1, "same words in every row here", k, f"c{k % 2}", {"m": k}) for k in range(4)]
                               + [(2, "quite other words stand over there", 9, "d", None)],
                               "doc_id long, text string, _text_hash int, row string, extra map<string,int>")
    out = [sorted(map(str, simhash.keep_one(d).collect())) for d in (df, df.repartition(3))]
    assert simhash.keep_one(df).columns == df.columns and len(out[0]) == 2 and out[0] == out[1]
    from flowmetrics.llm import exact_dedup
    out = [sorted(map(str, exact_dedup.drop_exact_copies(d).collect())) for d in (df, df.repartition(3))]
    assert len(out[0]) == 2 and out[0] == out[1]


def _cloud(rng, n):
    """Chains and clusters of fingerprints at small distances among random ones."""
    fps = [rng.getrandbits(64) for _ in range(n // 2)]
    while len(fps) < n:
        x = rng.choice(fps)
        for b in rng.sample(range(64), rng.randint(1, 7)):
            x ^= 1 << b
        fps.append(x)
    return sorted(set(fps))


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_links_are_complete(spark, monkeypatch, blocks):
    """All layouts, and chunks far smaller than the buckets, give the components of brute force."""
    monkeypatch.setattr(simhash, "LAYOUTS", ((1 << 62, blocks),))
    fps = _cloud(random.Random(blocks), 700) + [0, (1 << 64) - 1]
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    edges = simhash.links(df, len(fps), chunk=40)
    roots = {r["node"]: r["root"] for r in simhash.connected(edges).collect()}
    got = {x: roots.get(simhash._signed(x), simhash._signed(x)) for x in fps}
    want = _components({x: x for x in fps})
    pairs = lambda m: {frozenset(k for k in m if m[k] == v) for v in set(m.values())}
    assert pairs(got) == pairs(want)


def test_gray_index_search():
    rng = random.Random(8)
    fps = np.array(_cloud(rng, 1_500), np.uint64)
    index = simhash.GrayIndex(fps)
    q, leaf = index.search(fps[:200], 4)
    got = set(zip(q.tolist(), index.fps[leaf].tolist()))
    want = {(i, int(b)) for i, a in enumerate(fps[:200]) for b in fps if int(a ^ b).bit_count() <= 4}
    assert got == want
    g = np.arange(64, dtype=np.uint64)
    assert (simhash.gray_rank(g ^ (g >> np.uint64(1))) == g).all()
