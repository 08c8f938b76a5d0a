"""Sharding, line rules and exact dedup against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
import xxhash

from flowmetrics.llm import exact_dedup, line_rules, sharding

from .helpers import DOCS, awkward_texts, rows

A_TO_Z = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _docs(spark, texts=None, extra=False, **kw):
    df = spark.createDataFrame(rows(awkward_texts() if texts is None else texts, **kw), DOCS)
    if extra:
        for c in ("sha", "row_id", "block", "n", "kept", "shard", "slot", "row_number", "_hash", "bitmap", "row"):
            df = df.selectExpr("*", f"'x' AS {c}")
    return df


# ---------------------------------------------------------------- exact dedup
def _copies(texts, ids):
    groups = {}
    for i, t in zip(ids, texts):
        groups.setdefault((t or "").translate(A_TO_Z), []).append(i)
    return {i: (max(g), len(g), i == max(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for i in g}


@pytest.mark.parametrize("max_bits", [exact_dedup.MAX_BITS, exact_dedup.BLOCK_BITS])
def test_exact_copies(spark, max_bits):
    texts = awkward_texts() + ["hot copy"] * 60
    got = {r["doc_id"]: tuple(r)[1:] for r in exact_dedup.exact_copies(_docs(spark, texts, extra=True), max_bits).collect()}
    assert got == _copies(texts, range(len(texts)))


def test_exact_filter_beyond_the_bound(spark):
    """Rows past what one broadcast holds are tested part by part, as selectively as below it."""
    texts = [f"text {i // 2 if i % 5 == 0 else i}" for i in range(9_000)]
    want = _copies(texts, range(len(texts)))
    out = exact_dedup.exact_copies(_docs(spark, texts), exact_dedup.BLOCK_BITS).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in out} == want
    hashed = _docs(spark, texts).select("doc_id", exact_dedup.digest().alias("sha"))
    for most in (exact_dedup.BLOCK_BITS, 3 * exact_dedup.BLOCK_BITS, exact_dedup.MAX_BITS):
        moved = {r["doc_id"] for r in exact_dedup._flagged(hashed, most).filter("maybe_repeated").collect()}
        repeated = {i for i, v in want.items() if v[1] > 1}
        assert repeated <= moved and len(moved - repeated) < 0.1 * (len(texts) - len(repeated))
    kept = exact_dedup.drop_exact_copies(_docs(spark, texts), exact_dedup.BLOCK_BITS).collect()     # saturated
    assert {r["doc_id"] for r in kept} == {i for i, v in want.items() if v[2]}


def test_exact_repeated_rows_and_null_ids(spark):
    df = _docs(spark, ["same", "same", "SAME", None, ""], ids=[7, 7, None, 3, 2])
    out = exact_dedup.exact_copies(df).collect()
    same = [r for r in out if r["group_size"] == 3]
    assert len(same) == 3 and sum(r["kept"] for r in same) == 1 and {r["keep_id"] for r in same} == {7}
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in out if r["group_size"] == 2) == [(2, 3, False), (3, 3, True)]
    kept = exact_dedup.drop_exact_copies(df).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept if r["text"]) == [(7, "same")] and len(kept) == 2


def test_exact_drop_keeps_columns(spark):
    texts = awkward_texts()
    df = _docs(spark, texts, extra=True)
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns
    want = {i for i, v in _copies(texts, range(len(texts))).items() if v[2]}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_exact_empty(spark):
    df = _docs(spark, [])
    assert exact_dedup.exact_copies(df).count() == 0 and exact_dedup.drop_exact_copies(df).count() == 0


# ---------------------------------------------------------------- sharding
def _xx(*values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(int(v).to_bytes(8, "little", signed=True), h)
    return h


def _feistel(x, bits, seed):
    lb, rb = bits // 2, bits - bits // 2
    left, right = x >> rb, x & ((1 << rb) - 1)
    for i in range(sharding.ROUNDS):
        left, right = right, left ^ (_xx(right, seed * 1000 + i) & ((1 << lb) - 1))
        lb, rb = rb, lb
    return (left << rb) | right


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 8, 17, 1000, 1025])
def test_permutation(spark, n):
    got = [r[0] for r in spark.range(n).select(sharding.permute(__import__("pyspark").sql.functions.col("id"), n, 42)).collect()]
    assert sorted(got) == list(range(n))
    if n > 2:
        bits = max(2, (n - 1).bit_length())
        for x, place in enumerate(got):
            y = _feistel(x, bits, 42)
            while y >= n:
                y = _feistel(y, bits, 42)
            assert y == place


def test_shards(spark):
    from pyspark.sql import functions as F
    df = _docs(spark, awkward_texts() + ["copy"] * 3_000, extra=True, ids=[None, 5, 5] + list(range(3, 3_053)))
    df = df.drop("shard", "slot", "row_number", "_hash")
    keyed = df.withColumn("crc", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    out = sharding.shard_rows(keyed, ["doc_id", "crc"], 8).collect()
    again = sharding.shard_rows(keyed.repartition(5), ["doc_id", "crc"], 8).collect()
    n = len(out)
    assert n == 3_053 and sorted(r["row_number"] for r in out) == list(range(n))
    sizes = Counter(r["shard"] for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(8):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sizes[s]))
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["crc"], r["shard"], r["slot"])
    assert sorted(map(key, out)) == sorted(map(key, again))
    assert all(r["crc"] == zlib.crc32((r["text"] or "").encode()) for r in out)


def test_shards_empty(spark):
    assert sharding.shard_rows(_docs(spark, []), ["doc_id"], 8).count() == 0


# ---------------------------------------------------------------- line rules
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = r"[\x20\x09-\x0D]"


def _line_fails(line):
    n = len(WORD.findall(line))
    ends = re.search(r"[.!?:;…\"'”’»)\]][\x20\x09-\x0D]*\Z", line)
    clutter = len(re.findall(r"[#*$%&|<>!?]{2,}", line)) * 2 >= n
    bare = sum(bool(re.fullmatch("[|>»·]+", w)) for w in WORD.findall(line)) * 5 >= n
    menu = n <= 4 and re.search(rf"(^|{SPACE})({'|'.join(line_rules.MENU)})([.:!?]?)({SPACE}|\Z)", line, re.I)
    return bool(not ends or clutter or bare or menu or any(p in line.lower() for p in line_rules.BOILERPLATE))


def _judge(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    lost = sum(len(WORD.findall(x)) for x in lines if _line_fails(x))
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), lost, failed, not failed and 100 * lost <= 50 * len(words))


LINES = ["Home | About us | Contact us", "Accept cookies to go on, dear reader of pages.", "A fine sentence, with eleven words in it, ends right here.",
         "no closing mark here at all", "Next: ", "SHOUT!! SHOUT!! SHOUT!! AGAIN!!", "a b c d e a b c d e f g.", "»  » |  | x.",
         "He said \"yes.\"", "e e e\x0be e\x0ce. \r", "\x1cword\x1f \x85 end."]


def test_line_rules(spark):
    rng = random.Random(3)
    texts = awkward_texts() + ["\n".join(rng.choice(LINES) for _ in range(rng.randint(1, 12))) for _ in range(150)]
    got = {r["doc_id"]: tuple(r)[1:] for r in line_rules.judge(_docs(spark, texts, extra=True)).collect()}
    assert got == {i: _judge(t) for i, t in enumerate(texts)}


def test_clean_lines(spark):
    text = "A fine sentence, with a few words.\n\nHome | About us\nThe end."
    out = line_rules.clean_lines(_docs(spark, [text, None, ""], extra=True)).orderBy("doc_id").collect()
    assert [r["text"] for r in out] == ["A fine sentence, with a few words.\n\nThe end.", None, ""]
    assert line_rules.judge(_docs(spark, [])).count() == 0
