"""The byte-level tokenizer's files, as the token operators need them in a worker."""

from __future__ import annotations

import base64
import json
import re

#: Blocks whose letters and digits are settled across Unicode versions. The splitting pattern of the
#: ``regex`` module and that of the tokenizers library agree on them; a text with any other character
#: is split by the library.
SETTLED = (r"\x00-ԯ‐-⁤₠-₿℀-↋←-⯿　-〿ぁ-鿯"
           r"가-힣︀-️＀-￯�\U0001f300-\U0001f64f\U0001f680-\U0001f6ff")
UNSETTLED = re.compile(f"[^{SETTLED}]")


def byte_signs() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable Latin-1
    signs are their own byte, the other bytes follow from U+0100 on in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_json(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def rank_file(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
