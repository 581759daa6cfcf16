"""Ranked lexical search by the Best Position Algorithm over impact lists.

Every document row is cut into terms once and stored with its term counts.  From that table
come N, L and the document frequencies (aggregates over all documents), and the postings of
the terms that some item holds.  A posting's impact is the integer that its term adds to the
document's score, so an item's score is the sum of its terms' impacts.

Postings are dealt by a hash of the document over shards of about ``SHARD_POSTINGS`` postings,
whatever the size of the corpus: no list of a frequent term is ever whole in one task, and a
document's postings are all in one shard.  The items come to each shard in blocks of
``ITEM_BLOCK``.  In a shard each term has a list sorted by falling impact, and the same postings
sorted by document for direct access.

For one item the algorithm reads every list at its best position, the end of the contiguous run
of positions seen so far, and looks up each document it meets in all other lists (a direct
access by binary search), which marks that document's positions there as seen too, so a list's
best position may jump past places it never read in order.  No unseen document can score more
than the sum of the impacts right behind the best positions.  The search stops when that sum
is strictly below the item's k-th score in the shard, so documents that tie with the k-th are
always found; with fewer than k documents it reads the lists to their ends.  The shards' best
k are merged by score, then doc_id.

Defined results: null and empty texts hold no term and are not counted in N.  Rows that share
a doc_id are documents of their own, each ranked; null doc_ids come last among equal scores.
Items without terms, or whose terms occur in no document, give no rows; rows that share an
item_id are one item with all their terms.  Empty tables give no rows.  Further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickrate.llm.common import map_rows, stored, table

K = 50
SHARD_POSTINGS, ITEM_BLOCK = 1_000_000, 1_000
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text, in order.  Bytes from 0x80 on are those of characters from
    U+0080 on, and lowering bytes changes A-Z alone."""
    return _TERM.findall(text.encode().lower()) if text else []


def term_counts(texts: DataFrame, key: str) -> DataFrame:
    """``key``, n (terms with repeats), terms and counts (its distinct terms) of every row."""
    def make():
        def rows(data):
            out = {"n": [], "terms": [], "counts": []}
            for text in data["text"]:
                found: dict[bytes, int] = {}
                for t in terms_of(text):
                    found[t] = found.get(t, 0) + 1
                out["n"].append(sum(found.values()))
                out["terms"].append([t.decode() for t in found])
                out["counts"].append(list(found.values()))
            return out
        return rows
    return map_rows(texts, make, "n long, terms array<string>, counts array<int>", ["text"], carry=[key])


class Lists:
    """One shard's impact lists: by term, sorted by falling impact, and by document."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.terms, starts = np.unique(term[order], return_index=True)
        self.starts = np.append(starts, len(order))
        self.by_doc = np.lexsort((self.doc, term[order]))  # within a term, places in its list by document
        self.sorted_doc = self.doc[self.by_doc]

    def of(self, term: int):
        """(docs, impacts) by falling impact, (docs, places) by document; None where the shard has no such term."""
        i = int(np.searchsorted(self.terms, term))
        if i == len(self.terms) or self.terms[i] != term:
            return None
        a, b = int(self.starts[i]), int(self.starts[i + 1])
        return self.doc[a:b], self.impact[a:b], self.sorted_doc[a:b], self.by_doc[a:b] - a


def best_positions(lists: list, k: int, first_step: int = 16, most_step: int = 4096) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents and scores of all that were met until every document that belongs to the k
    best of ``lists`` (as ``Lists.of`` gives), ties with the k-th included, was among them,
    and the number of positions that were seen."""
    seen = [np.zeros(len(x[0]), dtype=bool) for x in lists]
    best = [0] * len(lists)
    docs, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    step = first_step
    while True:
        bound = sum(int(x[1][b]) for x, b in zip(lists, best) if b < len(x[0]))
        if bound == 0 or (len(scores) >= k and bound < np.partition(scores, len(scores) - k)[len(scores) - k]):
            return docs, scores, int(sum(s.sum() for s in seen))
        new = []
        for x, s, b in zip(lists, seen, best):
            at = b + np.flatnonzero(~s[b:b + step])
            new.append(x[0][at])
        met = np.unique(np.concatenate(new))
        score = np.zeros(len(met), np.int64)
        for i, (x, s) in enumerate(zip(lists, seen)):
            at = np.searchsorted(x[2], met)
            at[at == len(x[2])] = 0
            hit = x[2][at] == met
            place = x[3][at[hit]]
            score[hit] += x[1][place]
            s[place] = True
            left = s[best[i]:]
            best[i] += len(left) if left.all() else int(np.argmin(left))
        docs, scores = np.concatenate([docs, met]), np.concatenate([scores, score])
        step = min(2 * step, most_step)


def best_of(scores: np.ndarray, docs: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, equal scores by document."""
    return np.lexsort((docs, -scores))[:k]


def _search(k: int):
    def search(postings: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
        found = {"item": [], "doc_id": [], "score": []}
        if len(postings) and len(items):
            # numbered in the order in which equal scores are ranked
            uid, doc_id = postings["uid"].to_numpy(), postings["doc_id"].astype("Int64")
            absent, value = doc_id.isna().to_numpy(), doc_id.fillna(0).to_numpy(np.int64)
            rows = np.unique(uid, return_index=True)[1]
            rows = rows[np.lexsort((uid[rows], value[rows], absent[rows]))]
            number = np.empty(len(rows), np.int64)
            number[np.searchsorted(np.sort(uid[rows]), uid[rows])] = np.arange(len(rows))
            shard = Lists(number[np.searchsorted(np.sort(uid[rows]), uid)], postings["term_id"].to_numpy(), postings["impact"].to_numpy())
            ids = doc_id.array[rows]
            for item, terms in zip(items["item"], items["term_ids"]):
                lists = [x for x in map(shard.of, terms) if x]
                docs, scores, _ = best_positions(lists, k)
                keep = best_of(scores, docs, k)
                found["item"].append(np.full(len(keep), item, np.int64))
                found["doc_id"].append(ids[docs[keep]])
                found["score"].append(scores[keep])
        if not found["item"]:
            return pd.DataFrame({"item": pd.Series(dtype="int64"), "doc_id": pd.Series(dtype="Int64"), "score": pd.Series(dtype="int64")})
        return pd.DataFrame({"item": np.concatenate(found["item"]), "doc_id": pd.concat([pd.Series(x) for x in found["doc_id"]], ignore_index=True), "score": np.concatenate(found["score"])})
    return search


def weighted_terms(spark: SparkSession, counted: DataFrame, vocabulary: DataFrame, n_docs: int) -> DataFrame:
    """term, term_id, df and w of the vocabulary's terms that some document holds."""
    held = counted.select(F.explode("terms").alias("term")).join(vocabulary, "term")
    df = held.groupBy("term", "term_id").agg(F.count(F.lit(1)).alias("df"))
    ratio = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    return stored(spark, df.withColumn("w", F.floor(1000 * F.ln(ratio)).cast("long")), "lexical-weights")


def impacts(counted: DataFrame, weights: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """uid, doc_id, term_id, impact: what each term adds to its documents' scores, above 0."""
    each = counted.filter("n > 0").select("uid", "doc_id", "n", F.explode(F.arrays_zip("terms", "counts")).alias("p")).select("uid", "doc_id", "n", F.col("p.terms").alias("term"), F.col("p.counts").cast("long").alias("tf"))
    m = f"(50 + (50 * n * {n_docs}L) div {max(1, n_terms)}L)"
    return (each.join(weights.select("term", "term_id", "w"), "term")
            .select("uid", "doc_id", "term_id", F.expr(f"w * ((1000000000 * tf) div (1000 * tf + 20 * {m}))").alias("impact")).filter("impact > 0"))


def ranked(spark: SparkSession, documents: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best of ``documents`` (doc_id, text) for every
    one of ``items`` (item_id, text)."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = stored(spark, term_counts(texts, "doc_id").withColumn("uid", F.monotonically_increasing_id()), "lexical-terms")
    n_docs, n_terms = (int(x or 0) for x in counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first())
    asked = term_counts(items.select("item_id", "text"), "item_id").select("item_id", F.explode("terms").alias("term")).distinct()
    asked = stored(spark, asked, "lexical-asked")
    vocabulary = stored(spark, asked.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id()), "lexical-vocabulary")
    weights = weighted_terms(spark, counted, vocabulary, n_docs)
    total = weights.agg(F.sum("df")).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_POSTINGS))

    by_item = asked.join(weights, "term").groupBy("item_id").agg(F.sort_array(F.collect_list("term_id")).alias("term_ids"))
    by_item = stored(spark, by_item.withColumn("item", F.monotonically_increasing_id()), "lexical-items")
    blocks = max(1, -(-by_item.count() // ITEM_BLOCK))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")
    asking = by_item.select("item", "term_ids", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    held = impacts(counted, weights, n_docs, n_terms).withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int"))
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))) if blocks > 1 else F.lit(0))
    local = (held.groupBy("shard", "block").cogroup(asking.groupBy("shard", "block"))
             .applyInPandas(_search(k), "item long, doc_id long, score long"))
    place = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = local.withColumn("rank", place).filter(F.col("rank") <= k)
    return best.join(by_item.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best of all ``documents`` for every ``benchmark`` item."""
    return ranked(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
OP13_SQL = f"""
WITH t AS (SELECT row_id, doc_id, {_WORDS} AS term FROM (SELECT row_number() OVER () AS row_id, doc_id, text FROM documents) d),
tf AS (SELECT row_id, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT row_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY row_id),
c AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS l FROM n),
q AS (SELECT DISTINCT item_id, {_WORDS} AS term FROM benchmark),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM q) GROUP BY term), c),
s AS (SELECT item_id, row_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // l)))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN n USING (row_id), c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= {K}
"""
