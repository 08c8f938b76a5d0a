"""Substring removal, packing and WARC bundles against brute force and round trips."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from flowmetrics.llm import packing, substrings, warc

from .helpers import DOCS, awkward_texts, rows, words


def _docs(spark, texts, **kw):
    return spark.createDataFrame(rows(texts, **kw), DOCS)


# ---------------------------------------------------------------- substrings
def _removed(texts, n):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + n] for d in data for i in range(len(d) - n + 1))
    out = {}
    for k, d in enumerate(data):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - n + 1):
            if seen[d[i:i + n]] > 1:
                gone[i:i + n] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out[k] = (len(d), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()),
                  hashlib.sha256(kept).hexdigest())
    return out


def _corpus(seed=6):
    rng = random.Random(seed)
    passage, common = words(rng, 40), words(rng, 12)
    texts = awkward_texts() + ["ab" * 150, "x" * 31, words(rng, 20) + passage + words(rng, 9)]
    texts += [words(rng, rng.randint(1, 50)) + rng.choice([passage, common, ""]) + words(rng, 30) for _ in range(60)]
    return texts


@pytest.mark.parametrize("owner_bytes", [substrings.OWNER_BYTES, 600])
def test_repeats_are_removed(spark, owner_bytes):
    """The small owner limit sends hot owners through the window path."""
    texts = _corpus()
    df = _docs(spark, texts).selectExpr("*", "1 AS crc", "'x' AS owner")
    out = substrings.remove_repeats(df, length=50, gram=16, owner_bytes=owner_bytes).collect()
    assert {r["doc_id"]: tuple(r)[1:5] for r in out} == _removed(texts, 50)
    for r in out:
        assert r["n_removed"] == sum(s["behind"] - s["first"] for s in r["spans"])


def test_repeated_rows_and_empty(spark):
    text = words(random.Random(1), 30)
    out = substrings.remove_repeats(_docs(spark, [text, text, None], ids=[3, 3, None]), length=50, gram=16).collect()
    assert sorted((r["n_bytes"], r["n_removed"]) for r in out) == [(0, 0)] + [(len(text), len(text))] * 2
    assert substrings.remove_repeats(_docs(spark, [])).count() == 0


def test_texts_that_share_an_id_at_the_real_lengths(spark, monkeypatch):
    """Null ids throughout, 200 bytes and 48-byte grams, long texts in slices: documents are
    told apart by their whole text."""
    rng = random.Random(8)
    monkeypatch.setattr(substrings, "SLICE", 700)
    passage = words(rng, 70)
    texts = [words(rng, rng.randint(20, 200)) + rng.choice([passage, passage[:230], ""]) + words(rng, 90) for _ in range(25)]
    texts += [texts[0], passage * 6, None, ""]
    want = Counter(_removed(texts, 200).values())
    out = substrings.remove_repeats(_docs(spark, texts, ids=[None] * len(texts)))
    assert Counter(tuple(r)[1:5] for r in out.collect()) == want


def test_workers_without_the_package(tmp_path):
    """Task functions carry what they need: the workers' path holds no copy of the package."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from flowmetrics.session import build_session
from flowmetrics.llm import alignment, packing, periodic_runs, token_counts
spark = build_session("local[2]", 2, extra={{"spark.executorEnv.PYTHONPATH": ""}})
df = spark.createDataFrame([(1, "hello world hello"), (2, None)], "doc_id long, text string")
assert packing.pack(df).count() == 2 and token_counts.count_tokens(df).count() == 2
assert periodic_runs.find_runs(df).count() == 2 and alignment.alignment_totals(df).count() == 2
def has(batches):
    import importlib.util
    import pyarrow as pa
    for b in batches:
        found = importlib.util.find_spec("flowmetrics") is not None
        yield pa.RecordBatch.from_arrays([pa.array([found] * len(b))], names=["found"])
print("package found by workers:", df.select("doc_id").mapInArrow(has, "found boolean").first().found)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2_000:]
    assert "package found by workers: False" in done.stdout


def test_index_against_counts():
    rng = random.Random(1)
    for _ in range(40):
        contexts = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(1, 60))) for _ in range(12)]
        counts = np.array([rng.choice([1, 1, 2]) for _ in contexts])
        seen = Counter()
        for c, k in zip(contexts, counts):
            for i in range(len(c) - 3):
                seen[c[i:i + 4]] += int(k)
        got = substrings.repeated_windows(contexts, counts, 4)
        assert [g.tolist() for g in got] == [[seen[c[i:i + 4]] > 1 for i in range(len(c) - 3)] for c in contexts]


# ---------------------------------------------------------------- packing
def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    texts = awkward_texts() + ["It's  dON'T　stop\x0b\x85 ΟΔΟΣ ½ é"] * 40
    out = packing.pack(_docs(spark, texts)).collect()
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in enumerate(texts)}
    found = Counter()
    for r in out:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["length"] > 0
        assert r["ids_crc32"] == zlib.crc32(own[r["start"]:r["start"] + r["length"]].tobytes())
        found.update((r["doc_id"], k) for k in range(r["start"], r["start"] + r["length"]))
    assert found == Counter((i, k) for i, own in ids.items() for k in range(len(own)))
    sequences = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(sequences.values()) <= packing.CAPACITY and sorted(sequences) == list(range(len(sequences)))
    assert len(sequences) <= -(-sum(map(len, ids.values())) // packing.CAPACITY) + 2
    assert packing.pack(_docs(spark, [])).count() == 0


def test_encoder_equals_the_tokenizer():
    import public_tokenizers
    path = public_tokenizers.path(packing.TOKENIZER)
    encode, rng = packing.Encoder(path), random.Random(4)
    parts = ["a", "It", "'S", "'d", "''s", "!'ve", "9", "é", "́", "İ", "ΟΔΟΣ", "<", "|", "<|endoftext|>", "<|x",
             " ", "  ", "\n", "\t", "\x0b", "\x0c", "\x1c", "\x1f", "\x00", "\x7f", "\x85", "\xa0", "　", "½"]
    texts = ["", "é" + "a" * 50_000, "<|" * 20_000] + ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(3_000)]
    for text in texts * 2:                       # the second time from the table
        want = encode.tokenizer.encode(text, add_special_tokens=False).ids
        assert encode(text) == np.array(want, "<u4").tobytes(), text[:200]


def test_patterns_hold_every_piece():
    rng = random.Random(3)
    for _ in range(4):
        histogram = {s: rng.randint(0, 400) for s in rng.sample(range(1, 257), 60)}
        held = Counter()
        patterns = packing.cut_patterns(histogram)
        for copies, pattern in patterns:
            assert sum(s * n for s, n in pattern.items()) <= packing.BINS
            held.update({s: copies * n for s, n in pattern.items()})
        assert held == Counter({s: n for s, n in histogram.items() if n})
        # two pieces over half a sequence never share one
        least = max(sum(s * n for s, n in histogram.items()) / packing.BINS,
                    sum(n for s, n in histogram.items() if 2 * s > packing.BINS))
        assert sum(c for c, _ in patterns) <= least * 1.05 + 3


# ---------------------------------------------------------------- WARC
PAGES = "page_id long, url string, html string"


def test_warc_round_trip(spark):
    rng = random.Random(2)
    html = [None, "", "<p>é</p>\r\n\r\nWARC/1.1", "x" * 400_000, *(words(rng, 200) for _ in range(30))]
    table = [(i, f"http://a/{i}\n" if i % 3 else None, html[i % len(html)]) for i in range(100)]
    df = spark.createDataFrame(table, PAGES).selectExpr("*", "1 AS copy", "'x' AS sha1")
    bundles = warc.write_bundles(df)
    out = warc.read_bundles(bundles).collect()
    first = {}
    for i, _, h in table:
        first.setdefault(h or "", i)
    want = {(i, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(),
             "response" if first[h or ""] == i else "revisit", None if first[h or ""] == i else first[h or ""]) for i, _, h in table}
    assert {tuple(r) for r in out} == want and len(out) == 100
    for b in bundles.collect():                       # any Zstandard reader unpacks a bundle whole
        with zstandard.ZstdDecompressor().stream_reader(bytes(b["content"]), read_across_frames=True) as z:
            raw = z.read()
        assert raw.count(b"WARC/1.1\r\nWARC-Type") == len(b["records"])


def test_warc_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(5, "u", "a"), (5, "u", "a"), (5, "u", "b"), (None, "u", "b")], PAGES)
    out = warc.read_bundles(warc.write_bundles(df)).collect()
    assert sorted(((r["page_id"] or 0), r["record_type"], r["refers_to"]) for r in out if r["payload_digest"] == base64.b32encode(
        hashlib.sha1(b"a").digest()).decode()) == [(5, "response", None), (5, "revisit", 5)]
    assert sum(r["record_type"] == "response" for r in out) == 2
    assert warc.read_bundles(warc.write_bundles(spark.createDataFrame([], PAGES))).count() == 0


def test_warc_one_html_per_digest(spark):
    """One html per digest stays with a record; revisits carry none and name the response."""
    rng = random.Random(5)
    df = spark.createDataFrame([(i, "u", words(rng, 50) + str(i)) for i in range(60)] + [(100 + i, "v", "hot page") for i in range(40)],
                               PAGES)
    out = warc.with_references(df)
    single = out.filter("ref_page IS NULL").collect()
    assert sum(r["html"] is not None for r in out.collect()) == 61 == len(single)
    assert {(r["ref_page"], r["ref_tag"].split("-")[0]) for r in out.filter("ref_page IS NOT NULL").collect()} == {
        (100, hashlib.sha1(b"hot page").hexdigest().upper())}
    tags = [(r["page_id"], r["tag"]) for r in out.collect()]
    assert len(set(tags)) == len(tags) == 100


def test_bundle_seeks():
    writer = warc.BundleWriter("p")
    records = [(warc.record_id(i, "1"), warc.build_record(warc.record_id(i, "1"), "u", bytes([i]) * 90_000, 90_000, "D", None)) for i in range(20)]
    for identifier, record in records:
        writer.add(identifier, record)
    done = writer.close()
    reader = warc.BundleReader(done["content"])
    assert len(reader.frames) > 3
    for entry, (identifier, record) in reversed(list(zip(done["records"], records))):
        assert entry["record_id"] == identifier
        assert reader.record(entry["frame"], entry["position"], entry["length"]) == record
