"""Quality rules on repetition inside a text, from suffix arrays.

Words are the runs of characters outside ``\\x20\\x09-\\x0D``.  The suffix array over the
words of a text (prefix doubling in numpy, many texts at once, each sorted by itself) gives
the longest common prefix of neighbouring suffixes; a common prefix that cannot be made
longer is a maximal repeated substring, at both places.  The union of these spans is what
repeats.  A text fails if too much of it is covered by repeats of ``cover_words`` words or
more, or if its longest repeat has more than ``longest`` words.

Defined results: null or empty text: no words, base_failed (fewer than 20 words).  Repeated
rows and null ids each get a row.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from clickrate.llm.common import map_rows, table

WINDOW, COVER_WORDS, COVERED_PERCENT, LONGEST, BATCH_WORDS = 8, 5, 40, 100, 120_000
_SYMBOLS, _WORD = "#*$%&|<>", re.compile(r"[^\x20\x09-\x0D]")


def longest_common_prefixes(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each place, the words of the longest repeat that begins there.  ``ids``: word
    numbers, each text closed by a number of its own; ``doc``: the number of its text."""
    n = len(ids)
    key = doc * (int(ids.max()) + 1) + ids
    order = np.argsort(key, kind="stable")
    new = np.r_[True, key[order][1:] != key[order][:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, width = [rank.copy()], 1
    sub = order[~(new & np.r_[new[1:], True])]  # places that share their rank
    while len(sub):
        key = rank[sub] * (n + 1) + rank[sub + width]
        o = np.argsort(key, kind="stable")
        s, k = sub[o], key[o]
        r, at = rank[s], np.arange(len(s))
        new = np.r_[True, k[1:] != k[:-1]]
        group = np.maximum.accumulate(np.where(np.r_[True, r[1:] != r[:-1]], at, 0))
        rank[s] = r + np.maximum.accumulate(np.where(new, at, 0)) - group
        levels.append(rank.copy())
        sub = s[~(new & np.r_[new[1:], True])]
        width *= 2
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    a, b = array[:-1], array[1:]
    same = levels[0][a] == levels[0][b]
    a, b = a[same], b[same]
    common = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        common += np.where(levels[k][a + common] == levels[k][b + common], 1 << k, 0)
    longest = np.zeros(n, np.int64)
    longest[a] = common
    longest[b] = np.maximum(longest[b], common)
    return longest


def repeats(texts: list[list], thresholds: tuple[int, ...]) -> list[tuple]:
    """For each list of words: the longest repeat, and the words that repeats of at least so many words cover."""
    number: dict = {}
    ids, sizes = [], []
    for words in texts:
        ids.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)))
        sizes.append(len(words) + 1)
    flat = np.concatenate([np.r_[x, 0] for x in ids])
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    flat[np.cumsum(sizes) - 1] = len(number) + np.arange(len(texts))
    long = longest_common_prefixes(flat, np.repeat(np.arange(len(texts)), sizes))
    at = np.arange(len(flat))
    cover = [np.add.reduceat((np.maximum.accumulate(np.where(long >= t, at + long, 0)) > at).astype(np.int64), starts) for t in thresholds]
    return list(zip(np.maximum.reduceat(long, starts).tolist(), *(c.tolist() for c in cover)))


def repetition(docs: DataFrame, carry: list[str] = ("doc_id",), covered_percent: int = COVERED_PERCENT, longest: int = LONGEST) -> DataFrame:
    """The columns ``carry`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    longest_repeat, n_covered, base_failed, kept."""

    def make():
        def fn(cols):
            out = {c: [] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines")}
            found, batch, size = [], [], 0
            for text in cols["text"]:
                text = text or ""
                words = text.encode().split()  # at exactly \x20 and \x09-\x0D
                out["n_words"].append(len(words))
                out["word_chars"].append(len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")))
                out["n_symbols"].append(sum(map(text.count, _SYMBOLS)))
                lines = [x for x in text.split("\n") if _WORD.search(x)]
                out["n_dup_lines"].append(len(lines) - len(set(lines)))
                batch.append(words)
                size += len(words)
                if size >= BATCH_WORDS:
                    found += repeats(batch, (WINDOW, COVER_WORDS))
                    batch, size = [], 0
            if batch:
                found += repeats(batch, (WINDOW, COVER_WORDS))
            out |= {c: [x[k] for x in found] for k, c in enumerate(("longest_repeat", "n_repeat_words", "n_covered"))}
            out["base_failed"] = [n < 20 or 100 * r > 30 * n for n, r in zip(out["n_words"], out["n_repeat_words"])]
            out["kept"] = [not f and 100 * c <= covered_percent * n and l <= longest
                           for f, c, n, l in zip(out["base_failed"], out["n_covered"], out["n_words"], out["longest_repeat"])]
            return out

        return fn

    return map_rows(docs, make, "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                    "longest_repeat long, n_covered long, base_failed boolean, kept boolean", ["text"], list(carry))


def op5_suffix_array_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole texts of ``documents``."""
    found = repetition(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP5_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
z AS (SELECT unnest([{WINDOW}, {COVER_WORDS}, {LONGEST + 1}]) AS m),
v AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, z WHERE len(w) >= m)),
r AS (SELECT doc_id, m, i FROM v QUALIFY count(*) OVER (PARTITION BY doc_id, m, g) > 1),
c AS (SELECT doc_id, count(DISTINCT CASE WHEN m = {WINDOW} THEN k END) AS n_repeat, count(DISTINCT CASE WHEN m = {COVER_WORDS} THEN k END) AS n_cover, bool_or(m = {LONGEST + 1}) AS too_long
      FROM (SELECT doc_id, m, unnest(range(i, i + m)) AS k FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d),
n AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
x AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
        coalesce(n_repeat, 0) AS n_repeat_words, coalesce(n_cover, 0) AS n_cover, coalesce(too_long, false) AS too_long
      FROM d LEFT JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM x)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_cover <= {COVERED_PERCENT} * n_words AND NOT too_long AS kept FROM f
"""
