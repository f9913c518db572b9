"""Byte-level BPE ids of whole texts, from a vocabulary file in the tokenizers format."""

from __future__ import annotations

import json
import re
from functools import lru_cache

# The public splitting pattern of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_WORD = re.compile(r"\S{2000}|\s{2000}")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def letter_bytes() -> dict[str, int]:
    """The byte that each letter of the vocabulary file stands for: printable Latin-1 bytes stand for
    themselves, the others follow from 256 in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=1)
def encoder(path: str):
    """A function from a text to its ids, equal to ``Tokenizer.from_file(path).encode(text,
    add_special_tokens=False).ids``.

    The same merges run in tiktoken, several times as fast; texts with very long unbroken runs, on which it
    is slow, go to tokenizers. A process keeps the last one, so that its tasks do not each read the vocabulary.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    as_byte = letter_bytes()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(as_byte[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
    fast = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
    slow = []

    def encode(text: str) -> list[int]:
        if LONG_WORD.search(text):
            if not slow:
                from tokenizers import Tokenizer
                slow.append(Tokenizer.from_file(path))
            return slow[0].encode(text, add_special_tokens=False).ids
        return fast.encode(text, allowed_special="all")

    return encode
