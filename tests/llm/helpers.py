"""Small document tables with the awkward cases every operator must define."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows(texts, sources=None, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    sources = [f"src{i % 3}" for i in range(len(texts))] if sources is None else sources
    return [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def awkward_texts(seed: int = 1) -> list:
    """Nulls, empties, blanks, copies, near copies, case changes, long texts, odd code points."""
    rng = random.Random(seed)
    base = words(rng, 120)
    edited = base.split(" ")
    edited[60] = "changed"
    out = [None, "", " \n\t ", "A", "a", base, base, base.upper(), " ".join(edited), words(rng, 4_000),
           "Ünïcode ÄÖ text\x00 with nbsp \U0001f600 and É.", "x" * 5_000, "the end. " * 300]
    out += [words(rng, rng.randint(1, 80)) + "." for _ in range(40)]
    return out
