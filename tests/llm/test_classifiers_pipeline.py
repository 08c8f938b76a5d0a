"""Held-out accuracy of the classifiers, and the pipeline stage by stage."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowmetrics.llm import quality, toxicity
from flowmetrics.llm.common import load, staged

from .helpers import DOCS, rows

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    docs = load(spark, SF, "documents")
    awkward = spark.createDataFrame([(-1, None, None, None, None), (-2, "", "en", "s", 0), (None, "text", "en", "s", 4)], DOCS)
    return docs.unionByName(awkward), load(spark, SF, "labels")


@pytest.mark.parametrize("score,label,folds,held,cut,least", [
    (toxicity.toxicity, "toxic", 3, 1, 0.7, 0.85), (quality.quality, "quality", 5, 0, 0.3, 0.95)])
def test_held_out(spark, tables, score, label, folds, held, cut, least):
    docs, labels = tables
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    out = score(docs, labels).collect()
    assert len(out) == docs.count()
    for r in out:
        expected = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % folds == held
        assert r["held_out"] == expected and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= cut)
    seen = [(r["predicted"], truth[r["doc_id"]]) for r in out if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in seen) / len(seen) >= least


def test_without_labels_or_rows(spark, tables):
    docs, labels = tables
    none = labels.limit(0)
    assert {r["score"] for r in toxicity.toxicity(docs, none).select("score").distinct().collect()} == {0.0}
    assert quality.quality(docs.limit(0), none).count() == 0
    assert toxicity.toxicity(docs.limit(0), none).count() == 0


def test_risk_gradient_and_training_equal_a_plain_computation():
    """The non-negative risk by its definition, over dense rows."""
    rng = np.random.default_rng(1)
    features = 12
    draw = lambda n, p: [np.flatnonzero(rng.random(features) < p).astype(np.int32) for _ in range(n)]
    positive, unlabelled, prior = draw(60, 0.5), draw(90, 0.25), 0.2
    dense = lambda rows: np.array([[k in set(r.tolist()) for k in range(features)] + [True] for r in rows], float)
    p, u = dense(positive), dense(unlabelled)

    def parts(w):
        plus, minus = lambda z: np.logaddexp(0, -z), lambda z: np.logaddexp(0, z)
        return prior * plus(p @ w).mean(), minus(u @ w).mean() - prior * minus(p @ w).mean()

    def gradient(w):
        s = lambda z: 1 / (1 + np.exp(-z))
        negative = u.T @ s(u @ w) / len(u) - prior * p.T @ s(p @ w) / len(p)
        if parts(w)[1] < 0:
            return -negative
        return -prior * p.T @ s(-(p @ w)) / len(p) + negative
    for _ in range(5):
        w = rng.normal(0, 0.5, features + 1)
        sign = 1 if parts(w)[1] >= 0 else None
        numeric = [(f(w + e) - f(w - e)) / 2e-6 for e in 1e-6 * np.eye(features + 1)
                   for f in [sum_of(parts, sign)]]
        assert np.allclose(gradient(w), numeric, atol=1e-6)
    got, bias = toxicity.train_nnpu(positive, unlabelled, prior)
    column = np.full(toxicity.BUCKETS, -1)
    column[:features] = np.arange(features)
    size = toxicity._curvature([toxicity._Rows(positive, column), toxicity._Rows(unlabelled, column)])
    rate = 1 / ((1 + 2 * prior) * size)
    w = look = np.append(np.zeros(features), np.log(prior / (1 - prior)))
    t = 1.0
    for _ in range(toxicity.STEPS):
        new = look - rate * gradient(look)
        edge = rate * toxicity.PENALTY * prior / np.sqrt(len(positive))
        new[:-1] = np.where(np.abs(new[:-1]) <= edge, 0, new[:-1] - np.sign(new[:-1]) * edge)
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        w, look, t = new, new + (t - 1) / after * (new - w), after
    assert np.allclose(got[:features], w[:-1]) and np.isclose(bias, w[-1]) and not got[features:].any()


def sum_of(parts, sign):
    """The estimate whose gradient is followed: the risk, or the turned-round bracket."""
    return (lambda w: sum(parts(w))) if sign else (lambda w: -parts(w)[1])


def _plain_probability(net, data):
    """The network by its definition: every chunk, filter and place in turn."""
    s = quality.symbols(data).tolist() if data else [quality.PAD]
    n, pooled = len(s), []
    for c in range(quality.n_chunks(n)):
        best = np.full(quality.FILTERS, -np.inf)
        for place in range(c * quality.HALF, min(c * quality.HALF + quality.CHUNK, n), quality.STRIDE):
            out = sum(net.p["table"][j][s[place + j] if place + j < n else quality.PAD] for j in range(quality.WIDTH))
            best = np.maximum(best, out)
        pooled.append(np.maximum(best + net.p["bias"], 0))
    z = np.mean(pooled, axis=0) @ net.p["mean"] + np.max(pooled, axis=0) @ net.p["max"] + net.p["out"][0]
    return 1 / (1 + np.exp(-z))


def test_network_equals_a_plain_convolution():
    rng = random.Random(2)
    net = quality.Network(3)
    net.p["bias"] += 0.05
    texts = [bytes(rng.choice(b"ab c.") for _ in range(n)) for n in (0, 1, 7, 255, 256, 257, 511, 512, 513, 1_300, 5_000)]
    texts.append(b"x" * (quality.SLICE + 700))
    want = [_plain_probability(net, t) for t in texts]
    assert np.allclose(net.probabilities(texts), want, atol=1e-9)
    assert np.allclose(net.probabilities(texts[::-1]), want[::-1], atol=1e-9)


def test_gradients_of_the_network(monkeypatch):
    """Backward pass against differences of the loss, for texts short enough to train on whole."""
    rng = random.Random(4)
    net = quality.Network(5)
    texts = [bytes(rng.choice(b"abc d") for _ in range(n)) for n in (40, 600, 1_100)]
    monkeypatch.setattr(quality, "PEAK_ROWS", 2)
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    made = [quality.training_chunks(quality.symbols(t)) for t in texts]
    starts = np.cumsum([0] + [len(v) for _, v in made[:-1]])
    grad = net.step(np.concatenate([c for c, _ in made]), np.concatenate([v for _, v in made]), starts, y, weight)

    def loss():
        prob = np.array([_plain_probability(net, t) for t in texts])
        return -(weight * (y * np.log(prob) + (1 - y) * np.log(1 - prob))).sum() / weight.sum()
    for name, places in (("out", [0]), ("mean", [0, 3]), ("max", [1, 5]), ("bias", [2, 6]),
                         ("table", [(0, ord("a"), 1), (2, ord("b"), 4), (3, ord("d"), 11)])):
        for at in places:
            kept = net.p[name][at]
            net.p[name][at] = kept + 1e-6
            up = loss()
            net.p[name][at] = kept - 1e-6
            down = loss()
            net.p[name][at] = kept
            assert np.isclose(grad[name][at], (up - down) / 2e-6, atol=1e-6), (name, at)


def test_cut_lies_where_the_prior_says():
    z = np.array([5.0, 4, 3, 2, 1, 0, -1, -2, -3, -4])
    centre, slope = toxicity.place_cut(z[::-1], 0.3)
    assert centre == 2.5 and slope > 0
    # ties are not parted: two or five of the ten rows may lie above, two are nearer to three
    assert toxicity.place_cut(np.array([9.0, 9, 1, 1, 1, 0, 0, 0, 0, 0]), 0.3)[0] == 5.0
    assert toxicity.place_cut(np.zeros(4), 0.3)[0] > 0


def test_recall_of_held_out_toxic_texts(spark):
    """The cut is placed without a negative label; it still finds the toxic texts of the fold."""
    docs, labels = (load(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels).filter("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    found = sum(r["predicted"] for r in out if r["toxic"] == 1)
    assert found >= 0.9 * sum(r["toxic"] == 1 for r in out)
    assert found >= 0.85 * sum(r["predicted"] for r in out)


@pytest.mark.parametrize("score,label", [(toxicity.toxicity, "toxic"), (quality.quality, "quality")])
def test_awkward_rows_of_the_classifiers(spark, score, label):
    """Repeated labels and ids, clashing names, one very long text; reruns agree whatever the partitions."""
    good, bad = "A calm and careful line of prose. ", "awful vile nasty words "
    texts = [(i, (good if i % 3 else bad) * (1 + i % 4)) for i in range(240)]
    texts += [(3, bad)] * 40 + [(500, good * 60_000), (501, bad * 60_000), (None, None), (502, "")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS y", "2 AS score", "3 AS _id", "4 AS x")
    value = lambda i: int(i % 3 == 0) if label == "toxic" else int(i % 3 != 0)
    marks = [(i, value(i)) for i in range(240)] + [(7, value(7))] * 5 + [(500, value(1)), (None, 1), (6, None)]
    labels = spark.createDataFrame(marks, f"doc_id long, {label} int")
    rounded = F.round("score", 6).alias("score")
    first, again = (sorted(map(str, score(d, labels).withColumn("score", rounded).collect())) for d in (docs, docs.repartition(5)))
    assert first == again and len(first) == len(texts)
    same = {r["score"] for r in score(docs, labels).filter("doc_id = 3").select("doc_id", rounded).collect()}
    assert len(same) <= 2                         # one score for each of its two texts
    by_id = {r["doc_id"]: r["predicted"] for r in score(docs, labels).collect()}
    assert (by_id[500], by_id[501]) == (value(1), value(3))


def test_texts_beyond_the_training_bytes_are_not_fetched(spark, monkeypatch):
    monkeypatch.setattr(quality, "MAX_BYTES", 100)
    sample = spark.createDataFrame([(1, 1, "a" * 60), (2, 1, "b" * 60), (3, 1, "c" * 30), (4, 0, "d" * 101), (5, 0, None)],
                                   "doc_id long, y int, text string")
    got = quality._examples(sample)
    ones = sum(len(t) for y, t in got if y == 1)
    assert ones == 90 and [t for y, t in got if y == 0] == [b""]


def _plain_near(rows):
    """One row a component: smallest (doc_id, hash) of the fingerprints that link."""
    from .test_mixing_simhash import _components, _fingerprint
    found = _components({r["doc_id"]: _fingerprint(r["text"]) for r in rows})
    return sorted(set(found.values()))


def test_pipeline_run_equals_brute_force(spark, tmp_path):
    """run() over documents with nulls, empty texts, copies and clashing names, stage by
    stage: exact copies, near copies and tokens by plain Python; the classifier's and the
    mix's decisions are those of their operators, tested on their own."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from flowmetrics.llm import mixing, packing
    folder = str(tmp_path)
    docs = load(spark, "/root/testdata/sf0.001", "documents")
    extra = [(-1, None, None, None, None), (-2, "", "en", "s", 0), (-3, docs.first()["text"], "en", "s", 9)]
    docs = docs.unionByName(spark.createDataFrame(extra, DOCS)).selectExpr("*", "1 AS row", "'t' AS sha", "2 AS _text_hash")
    docs.write.parquet(f"{folder}/documents.parquet")
    load(spark, "/root/testdata/sf0.001", "labels").write.parquet(f"{folder}/labels.parquet")
    docs = load(spark, folder, "documents")
    scores = quality.quality(docs, load(spark, folder, "labels")).filter("predicted = 1").select("doc_id").collect()
    kept = {r["doc_id"] for r in scores}
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    best = {}
    for r in docs.collect():
        if r["doc_id"] in kept:
            best[lower(r["text"])] = max([r, *([best[lower(r["text"])]] if lower(r["text"]) in best else [])],
                                         key=lambda x: x["doc_id"])
    survivors = set(_plain_near(sorted(best.values(), key=lambda r: r["doc_id"])))
    near = docs.filter(F.col("doc_id").isin(sorted(survivors)))
    assert near.count() == len(survivors) < docs.count()
    mix = mixing.mixed(near)
    assert mix.columns == docs.columns
    encode = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER)).encode
    want = Counter((r["doc_id"], len(encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in mix.collect())
    out = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in out if r["start"] == 0) == want
    held, filled = Counter(), Counter()
    for r in out:
        held[r["doc_id"]] += r["length"]
        filled[r["sequence_id"]] += r["length"]
    assert held == sum((Counter({i: n * k}) for (i, n), k in want.items()), Counter())
    assert max(filled.values()) <= packing.CAPACITY


def test_pipeline_of_an_empty_table(spark, tmp_path):
    load(spark, "/root/testdata/sf0.001", "documents").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    load(spark, "/root/testdata/sf0.001", "labels").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline(spark):
    """Every stage acts on what the one before kept; columns stay until the last."""
    docs = load(spark, SF, "documents")
    columns = docs.columns
    truth = {r["doc_id"]: r["quality"] for r in load(spark, SF, "labels").collect()}
    stages = dict(corpus_pipeline.STAGES)
    accepted = staged(stages["quality classifier"](spark, docs, SF), "t")
    ids = {r["doc_id"] for r in accepted.select("doc_id").collect()}
    clean = [i for i, q in truth.items() if q == 1]
    assert accepted.columns == columns and len(ids & set(clean)) >= 0.97 * len(clean)
    exact = staged(stages["exact dedup"](spark, accepted, SF), "t")
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    best = {}
    for r in accepted.collect():
        best[lower(r["text"])] = max(best.get(lower(r["text"]), -1), r["doc_id"])
    assert exact.columns == columns and sorted(r["doc_id"] for r in exact.collect()) == sorted(best.values())
    near = staged(stages["SimHash near-dedup"](spark, exact, SF), "t")
    assert near.columns == columns and 0 < near.count() <= exact.count()
    mix = staged(stages["source mixing"](spark, near, SF), "t")
    words = lambda df: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in df.collect())
    assert mix.columns == columns and words(mix) == pytest.approx(1.5 * words(near), rel=0.1)
    packed = stages["packing"](spark, mix, SF)
    assert packed.filter("start = 0").count() == mix.count()
