"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Words are the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` of the text with A-Z
lower-cased (ASCII letters, digits and everything beyond ASCII).  The patterns are the
``window``-word windows of each benchmark item (an item of fewer words is one window).
Patterns of one length share a table: the shift of a two-word block is how far the search
may move before that block can end a pattern, blocks with shift 0 lead by the suffix to a
bucket of patterns, and a direct comparison of the words confirms an occurrence.

The benchmark is cut into pieces of at most PIECE_WORDS words that overlap by a window less
one word, and the pieces are spread by a hash over blocks of about BLOCK_CHARS characters.
A block's tables are integer arrays (some 30 bytes a word) and a dictionary of its distinct
words; they are broadcast alone, all documents are searched against them, and the result is
written as a table before the next block's turn.  So no task holds more than one block's
tables, however large the benchmark is (tests/llm measures one).

Defined results: null, empty or wordless text: no words, not contaminated.  Null or wordless
items have no windows.  Items with a null id count as one item, written as an empty string;
rows that repeat an item_id count once.  Repeated document rows each get a row.  Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickrate.llm.common import map_rows, stored, table

BLOCK_CHARS, PIECE_WORDS = 4_000_000, 10_000
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_KEEP).split() if text else []


_A, _B, _P, _M32, _M64 = 0x9E3779B1, 0x85EBCA6B, 0x9E3779B97F4A7C15, (1 << 32) - 1, (1 << 64) - 1


class WuManber:
    """Tables for the patterns of one length, given as places in an array of word numbers.

    ``shift`` has one byte for each slot that a block of two words hashes to.  ``place`` has
    the patterns by the slot of their last block (``bucket``: where each slot begins) and
    within it by a hash of the whole pattern; its words are compared before it counts."""

    def __init__(self, length: int, ids: np.ndarray, place: np.ndarray, owner: np.ndarray):
        self.length, self.block = length, min(2, length)
        bits = max(8, min(24, int(2 * len(place)).bit_length()))
        self.down = 32 - bits
        wide = ids.astype(np.uint64)
        before = np.concatenate([[np.uint64(0)], wide[:-1]]) if self.block == 2 else np.zeros_like(wide)
        slots = (((before * np.uint64(_A) + wide * np.uint64(_B)) & np.uint64(_M32)) >> np.uint64(self.down)).astype(np.int32)
        shift = np.full(1 << bits, min(255, length - self.block + 1), np.uint8)
        for end in range(self.block, length + 1):  # later ends have the smaller shifts
            shift[slots[place + end - 1]] = min(255, length - end)
        whole = np.zeros(len(place), np.uint64)
        for j in range(length):
            whole = whole * np.uint64(_P) + wide[place + j]
        last = slots[place + length - 1]
        order = np.lexsort((owner, whole, last))
        place, owner, whole, last = place[order], owner[order], whole[order], last[order]
        again = np.zeros(len(place), bool)  # the same pattern of the same item
        again[1:] = (owner[1:] == owner[:-1]) & (whole[1:] == whole[:-1])
        for j in range(length):
            again[1:] &= ids[place[1:] + j] == ids[place[:-1] + j]
        self.ids, self.place, self.owner, self.whole = ids, place[~again], owner[~again], whole[~again]
        self.bucket = np.searchsorted(last[~again], np.arange((1 << bits) + 1)).astype(np.int32)
        self.shift = shift.tobytes()

    def find(self, words: list[bytes], numbers: dict[bytes, int]):
        """(start, item numbers) of every occurrence."""
        m, b, n, down = self.length, self.block, len(words), self.down
        shift, number, at = self.shift, numbers.get, m
        while at <= n:
            q = number(words[at - 1])
            if q is None:  # no pattern has this word
                at += m
                continue
            p = 0
            if b == 2 and (p := number(words[at - 2])) is None:
                at += m - 1
                continue
            slot = (p * _A + q * _B & _M32) >> down
            if step := shift[slot]:
                at += step
                continue
            lo, hi = int(self.bucket[slot]), int(self.bucket[slot + 1])
            window = [number(x) for x in words[at - m : at]] if lo < hi else [None]
            if None not in window:
                whole = 0
                for x in window:
                    whole = (whole * _P + x) & _M64
                part = self.whole[lo:hi]
                first, past = (lo + int(np.searchsorted(part, np.uint64(whole), side)) for side in ("left", "right"))
                items = {int(self.owner[k]) for k in range(first, past) if self.ids[self.place[k] : self.place[k] + m].tolist() == window}
                if items:
                    yield at - m, items
            at += 1


class Tables:
    """Word numbers, item names and one WuManber for each pattern length of a block of (item, text) pieces."""

    def __init__(self, pieces: list[tuple], window: int):
        self.numbers: dict[bytes, int] = {}
        self.names = sorted({"" if item is None else str(item) for item, _ in pieces})
        name = {x: i for i, x in enumerate(self.names)}
        ids, place, owner, size = {}, {}, {}, {}
        for item, text in pieces:
            w = [self.numbers.setdefault(x, len(self.numbers)) for x in words_of(text)]
            m = min(window, len(w))
            if m:
                base = size.get(m, 0)
                ids.setdefault(m, []).append(np.array(w, np.int32))
                place.setdefault(m, []).append(np.arange(base, base + len(w) - m + 1, dtype=np.int32))
                owner.setdefault(m, []).append(np.full(len(w) - m + 1, name["" if item is None else str(item)], np.int32))
                size[m] = base + len(w)
        self.searches = [WuManber(m, *(np.concatenate(x[m]) for x in (ids, place, owner))) for m in sorted(ids)]

    def find(self, words: list[bytes]):
        """(start, end, item names) of every occurrence."""
        for search in self.searches:
            for start, items in search.find(words, self.numbers):
                yield start, start + search.length, {self.names[i] for i in items}


def pieces_of(spark: SparkSession, benchmark: DataFrame, window: int) -> DataFrame:
    """item_id, piece, text: the words of every item in overlapping pieces, so that each window lies in one."""

    def make():
        def fn(cols):
            out = {"item_id": [], "piece": [], "text": []}
            for item, text in zip(cols["item_id"], cols["text"]):
                w = words_of(text)
                for k, i in enumerate(range(0, max(1, len(w) - window + 1), PIECE_WORDS) if w else ()):
                    out["item_id"].append(None if item is None else str(item))
                    out["piece"].append(k)
                    out["text"].append(b" ".join(w[i : i + PIECE_WORDS + window - 1]).decode())
            return out

        return fn

    return stored(spark, map_rows(benchmark.select("item_id", "text"), make, "item_id string, piece long, text string", ["item_id", "text"]), "benchmark-pieces")


def _spans(found: bytes) -> np.ndarray:
    return np.frombuffer(found, np.int32).reshape(-1, 2)


def _verdict(n_words: int, hits: bytes, items: list[str]) -> dict:
    far = hit = 0
    for a, b in sorted(map(tuple, _spans(hits).tolist())):
        hit += max(0, b - max(a, far))
        far = max(far, b)
    return {"n_hit": hit, "n_items": len(items), "items_sha256": hashlib.sha256(",".join(items).encode()).hexdigest(),
            "contaminated": hit > 0 and 20 * hit >= n_words}


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = 13, carry: list[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` of every document with n_words, hits (packed int32 pairs: first
    word and end of each occurrence), items (their ids, sorted as strings), n_hit (words in
    an occurrence), n_items, items_sha256, contaminated (a twentieth of the words hit, or more)."""
    pieces = pieces_of(spark, benchmark, window)
    total = pieces.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_CHARS) or 1
    found = docs
    for k in range(blocks):
        rows = pieces.filter(F.pmod(F.xxhash64("item_id", "piece", "text"), F.lit(blocks)) == k).select("item_id", "text").collect()  # about BLOCK_CHARS
        tables = spark.sparkContext.broadcast(Tables([tuple(r) for r in rows], window))
        first, final = k == 0, k == blocks - 1

        def make(tables=tables, first=first, final=final):
            def fn(cols):
                out = {"hits": [], "items": [], "n_words": []}
                for i, text in enumerate(cols["text"]):
                    w = words_of(text)
                    got, at = (set(), []) if first else (set(cols["items"][i]), [_spans(cols["hits"][i])])
                    for start, end, names in tables.value.find(w):
                        got |= names
                        at.append(np.array([[start, end]], np.int32))
                    out["hits"].append(np.concatenate(at).tobytes() if at else b"")
                    out["items"].append(sorted(got))
                    out["n_words"].append(len(w))
                if final:
                    said = [_verdict(*x) for x in zip(out["n_words"], out["hits"], out["items"])]
                    out |= {c: [x[c] for x in said] for c in ("n_hit", "n_items", "items_sha256", "contaminated")}
                return out

            return fn

        adds = "n_words long, hits binary, items array<string>" + ", n_hit long, n_items long, items_sha256 string, contaminated boolean" * final
        kept = list(carry) if final else list(dict.fromkeys(["text", *carry]))
        found = map_rows(found, make, adds, ["text"] + ["hits", "items"] * (not first), kept)
        if not final:
            found = stored(spark, found, "decontaminated")
    return found


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13-word windows of all ``benchmark`` items, searched in all of ``documents``."""
    found = contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS g
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
m AS (SELECT DISTINCT m FROM p),
v AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
      FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, m WHERE len(w) >= m)),
h AS (SELECT v.doc_id, v.i, v.m, p.item_id FROM v JOIN p ON p.m = v.m AND p.g = v.g),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS k FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
