"""Token ids of whole texts by a byte-level BPE vocabulary file.

The ids are those of ``tokenizers`` (``Tokenizer.from_file(path).encode(text,
add_special_tokens=False).ids``). Texts of plain Latin script go through tiktoken over the same
vocabulary and merges, which yields the same ids several times faster; every other text goes through
the tokenizers library itself, because the two libraries carry different Unicode tables.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

END = 0
#: Characters on which both libraries split alike; a test compares them one by one.
_SAFE = re.compile("[\\x00-\\x1b\\x20-\\x7e\\xa1-\\u024f\\u2010-\\u2027]*")
#: How byte-level vocabularies write the bytes that are not printable: in order, from U+0100.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Fixed value: the pattern that splits text before the merges of this kind of vocabulary.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(2)
def _encoders(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    rest = [b for b in range(256) if b not in set(_PRINTED)]
    byte = {chr(b): b for b in _PRINTED} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
    exact = Tokenizer.from_file(path)
    exact.no_truncation()
    exact.no_padding()
    return tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special), exact


def encode(text: str | None, path: str) -> np.ndarray:
    """The ids (little-endian unsigned 32 bits) of a whole text; none for null or empty."""
    if not text:
        return np.empty(0, "<u4")
    fast, exact = _encoders(path)
    if _SAFE.fullmatch(text):
        return np.array(fast.encode(text, allowed_special="all"), "<u4")
    return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4")
