"""Token ids by a public byte-level BPE vocabulary, word by word from a cache.

A pre-token of this vocabulary's pattern that holds a character other than white space
has white space as its first character only, and that is one space.  So a text in which
every space follows a character that is no white space can be cut at its spaces, and each
part's ids looked up; other texts are encoded whole.  ``ids`` takes an added token's string
(``<|endoftext|>``) as ordinary text, ``ids_added`` gives its id as the ``tokenizers`` library
does by default.  tests/llm holds both against that library's.
"""

from __future__ import annotations

import array
import base64
import json
import re

import public_tokenizers
import tiktoken

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
ADDED = public_tokenizers.path("byte_bpe_50k.json")  # where the added tokens are listed
END = 50256
_MOST, _LONGEST = 250_000, 48
_RUN = re.compile(r"\s ")
_LOADED: dict[str, WordIds] = {}


class _Parts(dict):
    def __init__(self, encode, lead: str):
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, part: str) -> bytes:
        ids = array.array("I", self.encode(self.lead + part)).tobytes()
        if len(part) <= _LONGEST:
            if len(self) >= _MOST:
                self.clear()
            self[part] = ids
        return ids


class WordIds:
    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.first, self.spaced = _Parts(self.encode, ""), _Parts(self.encode, " ")
        with open(ADDED, encoding="utf-8") as f:
            self.added = {t["content"]: array.array("I", [t["id"]]).tobytes() for t in json.load(f)["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def ids(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if _RUN.search(text):
            return array.array("I", self.encode(text)).tobytes()
        parts = text.split(" ")
        return self.first[parts[0]] + b"".join(map(self.spaced.__getitem__, parts[1:]))

    def ids_added(self, text: str | None) -> bytes:
        """The same, with added tokens: the texts between them are encoded on their own."""
        if not text or not self.cut.search(text):
            return self.ids(text)
        return b"".join(self.added[x] if k % 2 else self.ids(x) for k, x in enumerate(self.cut.split(text)))


def word_ids(path: str = VOCABULARY) -> WordIds:
    """Loaded once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
