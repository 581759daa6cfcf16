"""Circulant MinHash near-duplicate groups.

A document's words are the runs of characters outside ``\\x20\\x09-\\x0D`` of its text
with A-Z lower-cased; its set holds the distinct ``shingle``-word shingles (fewer words:
the whole sequence as one).  Two 32-bit permutations, sigma and pi, give all signature
coordinates: coordinate k is the minimum over the set of pi(sigma(x) + k mod 2^32), so pi
is shifted circularly by k and never drawn anew.

1. Documents with the same set are one class (a groupBy on the set's digest).
2. Signatures are cut into bands; every class is compared with one pivot of each of its
   buckets, on full sets.  That is linear in the number of classes.
3. Links give components (large-star / small-star).
4. Buckets that still hold several components: the members outside a bucket's largest
   component are held against its members in other components.  In buckets of up to SMALL
   members a join lists those pairs (at most SMALL for a member) that a 1-bit sketch does
   not rule out, and they are confirmed on full sets.  The larger buckets of one component
   become one crowd, dealt into blocks; each pair of blocks counts the shared shingles of its
   full sets in one task, and only links leave it, one for a document and component.

Bands have a chance below 1e-6 to miss a pair at the threshold, the sketch's cut lies six
standard deviations out; nothing else is lost and no bucket has a cap.

Defined results: null or empty text, or text without words: n_shingles 0, a component of
its own.  Null doc_id: takes part like any document; a component's id is its smallest
non-null doc_id (null if none has one).  Repeated rows share a class.  Other columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickrate.llm.common import WordHash, map_rows, stored

K = 192
SMALL, BLOCK_X, BLOCK_Y = 32, 256, 512
MISS = 1e-6
_C = np.uint64(0x9E3779B97F4A7C15)
_D = np.uint64(0xD6E8FEB86659FD93)


def bands_for(threshold: float) -> tuple[int, int]:
    """(bands, rows): the most rows whose chance to miss a pair at the threshold stays under MISS."""
    rows = max((r for r in range(1, 13) if (1 - threshold**r) ** (K // r) <= MISS), default=1)
    return K // rows, rows


def sketch_limit(threshold: float) -> int:
    p = (1 - threshold) / 2
    return int(np.ceil(K * p + 6 * np.sqrt(K * p * (1 - p))))


def _mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _D
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, width: int, words: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes; bytes.split() splits at exactly \\x20 and \\x09-\\x0D."""
    tokens = text.encode().lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    w = words.of(tokens)
    n = max(1, len(w) - width + 1)
    h = _mix64(w[:n])
    for j in range(1, min(width, len(w))):
        h = _mix64(h * _C + w[j : j + n])
    return np.unique(h)


def _sigma(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x21F0AAAD)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x735A2D97)
    return x ^ (x >> np.uint32(15))


class Signer:
    """Signature coordinates, band keys and 1-bit sketch of a set."""

    def __init__(self, bands: int, rows: int, block: int = 256):
        self.bands, self.rows, self.block = bands, rows, block
        self.shift = np.arange(K, dtype=np.uint32)[None, :]
        self.z, self.t = np.empty((block, K), np.uint32), np.empty((block, K), np.uint32)
        self.salt = _mix64(np.arange(1, bands + 1, dtype=np.uint64) * _C)

    def coordinates(self, shingles: np.ndarray) -> np.ndarray:
        x = _sigma((shingles ^ (shingles >> np.uint64(32))).astype(np.uint32))
        low = np.full(K, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(x), self.block):
            part = x[at : at + self.block, None]
            z, t = self.z[: len(part)], self.t[: len(part)]
            np.add(part, self.shift, out=z)  # the circular shift; then pi, in place
            np.right_shift(z, 16, out=t)
            z ^= t
            z *= np.uint32(0x7FEB352D)
            np.right_shift(z, 15, out=t)
            z ^= t
            z *= np.uint32(0x846CA68B)
            np.minimum(low, z.min(axis=0), out=low)
        return low

    def band_keys(self, low: np.ndarray) -> np.ndarray:
        c = low[: self.bands * self.rows].reshape(self.bands, self.rows).astype(np.uint64)
        h = self.salt.copy()
        for j in range(self.rows):
            h = _mix64(h * _C + c[:, j])
        return h.view(np.int64)

    @staticmethod
    def sketch(low: np.ndarray) -> np.ndarray:
        return np.packbits((low >> np.uint32(16)) & np.uint32(1) != 0).view(np.int64)


def signatures(docs: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """doc_id, text_hash, n_shingles, set_key (null: empty set), sketch, bands."""
    bands, rows = bands_for(threshold)

    def make():
        words, signer = WordHash(), Signer(bands, rows)

        def fn(cols):
            out = {"n_shingles": [], "set_key": [], "sketch": [], "bands": []}
            for text in cols["text"]:
                s = shingle_set(text, shingle, words)
                out["n_shingles"].append(len(s))
                if not len(s):
                    out["set_key"].append(None), out["sketch"].append(None), out["bands"].append(None)
                    continue
                low = signer.coordinates(s)
                out["set_key"].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                out["sketch"].append(signer.sketch(low))
                out["bands"].append(signer.band_keys(low))
            return out

        return fn

    return map_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), make,
                    "n_shingles long, set_key binary, sketch array<long>, bands array<long>", ["text"], ["doc_id", "text_hash"])


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * |A & B| >= 100 t * |A | B|."""
    percent = round(100 * threshold)

    def make():
        words, last = WordHash(), {}

        def set_of(key, text):
            if key not in last:
                if len(last) > 64:
                    last.clear()
                last[key] = shingle_set(text, shingle, words)
            return last[key]

        def fn(cols):
            out = {"a": [], "b": []}
            for a, b, ta, tb in zip(cols["a"], cols["b"], cols["ta"], cols["tb"]):
                x, y = shingle_set(ta, shingle, words), set_of(b, tb)
                both = len(x) + len(y) - len(np.union1d(x, y))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    out["a"].append(a), out["b"].append(b)
            return out

        return fn

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return map_rows(pairs.join(left, "a").join(right, "b"), make, "a long, b long", ["a", "b", "ta", "tb"], slice_rows=64)


def _matcher(threshold: float):
    percent = round(100 * threshold)

    def match(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between the documents of side 0 and those of side 1 in other components."""
        x, y = rows[rows["side"] == 0], rows[rows["side"] == 1]
        sets = [np.frombuffer(b, np.uint64) for b in y["set"]]
        size = np.array([len(s) for s in sets], np.int64)
        root, node = y["root"].to_numpy(), y["node"].to_numpy()
        flat = np.concatenate([*sets, np.empty(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], np.repeat(np.arange(len(sets)), size)[order]
        out = []
        for a, ra, blob in zip(x["node"], x["root"], x["set"]):
            mine = np.frombuffer(blob, np.uint64)
            low, high = np.searchsorted(flat, mine), np.searchsorted(flat, mine, "right")
            n = high - low
            at = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(sets))
            hit = np.flatnonzero((100 * both >= percent * (len(mine) + size - both)) & (root != ra))
            out += [(a, node[k]) for k in hit[np.unique(root[hit], return_index=True)[1]]]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return match


def _crowd_links(crowd: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) inside each crowd (columns major, node, root), between documents outside
    component ``major`` and documents of other components."""
    size = crowd.groupBy("major").agg(F.ceil(F.count("*") / BLOCK_Y).alias("ny"), F.ceil(F.count_if(F.col("root") != F.col("major")) / BLOCK_X).alias("nx"))
    rows = crowd.join(size, "major").join(sets, "node")
    i, j = F.pmod(F.xxhash64("node"), F.col("nx")), F.pmod(F.xxhash64("node", F.lit(1)), F.col("ny"))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    x = rows.filter("root <> major").select("major", "node", "root", "set", F.lit(0).alias("side"), i.alias("i"), spread("ny").alias("j"))
    y = rows.select("major", "node", "root", "set", F.lit(1).alias("side"), spread("nx").alias("i"), j.alias("j"))
    return x.unionByName(y).groupBy("major", "i", "j").applyInPandas(_matcher(threshold), "a long, b long")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link.
    Alternates large-star and small-star until the links are stars."""
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    e = stored(spark, links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    before = mark(e)
    while before[0]:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(spark, small.union(low).distinct(), "stars")
        now = mark(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash (xxhash64 of the text), n_shingles,
    component_id (smallest doc_id of its group), chosen (the row is its group's one document:
    the smallest doc_id, then text_hash, null ids last; only rows that repeat both share it,
    and rows without words have no group and are not chosen), n_links (classes of other texts that were
    confirmed as linked to its own; pairs that other links had joined are not counted)."""
    docs = docs.select("doc_id", "text")
    signed = stored(spark, signatures(docs, shingle, threshold), "signatures")
    classes = stored(spark, signed.filter("set_key is not null").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("named"),
        F.first("sketch").alias("sketch"), F.first("bands").alias("bands"))
        .select(F.monotonically_increasing_id().alias("node"), "set_key", F.coalesce("named", "rep").alias("rep"), "sketch", "bands"), "classes")
    member = classes.select("node", F.explode("bands").alias("band"))
    bucket = member.groupBy("band").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).filter("n > 1")
    shared = stored(spark, member.join(bucket, "band"), "buckets")

    sketch = classes.select("node", "sketch")
    far = " + ".join(f"bit_count(sa[{i}] ^ sb[{i}])" for i in range(K // 64))
    near = F.expr(f"{far} <= {sketch_limit(threshold)}")
    first = (shared.filter("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
             .join(sketch.toDF("a", "sa"), "a").join(sketch.toDF("b", "sb"), "b").filter(near).select("a", "b"))
    pairs = stored(spark, first, "pairs")

    def texts_of(nodes: DataFrame) -> DataFrame:
        need = nodes.distinct().join(classes.select("node", "rep"), "node")
        need = need.select("node", F.col("rep.doc_id").alias("rep_id"), F.col("rep.text_hash").alias("rep_hash"))
        hashed = docs.withColumn("text_hash", F.xxhash64("text"))
        got = hashed.join(need, hashed["doc_id"].eqNullSafe(need["rep_id"]) & (hashed["text_hash"] == need["rep_hash"]))
        return stored(spark, got.groupBy("node").agg(F.first("text").alias("text")), "texts")

    def confirm(p: DataFrame, texts: DataFrame) -> DataFrame:
        return stored(spark, _confirmed(p, texts, shingle, threshold), "confirmed")

    ends = lambda p: p.select(F.col("a").alias("node")).union(p.select("b"))
    links = confirm(pairs, texts_of(ends(pairs)))
    roots = stored(spark, components(spark, links), "roots")

    rooted = (shared.filter("n > 2").select("band", "node", "n").join(roots, "node", "left")
              .select("band", "node", "n", F.coalesce("root", "node").alias("root")))
    mixed = (rooted.groupBy("band", "root").agg(F.count("*").alias("share")).groupBy("band")
             .agg(F.max_by("root", F.struct("share", "root")).alias("major"), F.count("*").alias("roots")).filter("roots > 1"))
    open_ = stored(spark, rooted.join(mixed.select("band", "major"), "band"), "open")
    few = open_.filter(f"n <= {SMALL}").join(sketch, "node")
    x = few.filter("root <> major").select("band", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("sketch").alias("sa"))
    y = few.select("band", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("sketch").alias("sb"), "major")
    across = (x.join(y, "band").filter((F.col("ra") != F.col("rb")) & ((F.col("rb") == F.col("major")) | (F.col("a") < F.col("b"))) & near)
              .select("a", "b").distinct())
    more = stored(spark, across.join(pairs.union(pairs.select("b", "a")), ["a", "b"], "left_anti"), "across")
    crowd = stored(spark, open_.filter(f"n > {SMALL}").select("major", "node", "root").distinct(), "crowds")
    texts = texts_of(ends(more).union(crowd.select("node")))

    def sets():
        words = WordHash()
        return lambda cols: {"set": [shingle_set(t, shingle, words).tobytes() for t in cols["text"]]}

    full = map_rows(texts.join(crowd.select("node").distinct(), "node"), sets, "set binary", ["text"], ["node"])
    found = confirm(more, texts).union(stored(spark, _crowd_links(crowd, full, threshold), "crowd-links"))
    if found.take(1):
        links = links.union(found)
        roots = stored(spark, components(spark, links), "roots")

    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count("*").alias("n_links"))
    named = (classes.select("node", "set_key", "rep").join(roots, "node", "left").join(degree, "node", "left")
             .select("set_key", "rep", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    lowest = named.groupBy("root").agg(F.min(F.struct(F.col("rep.doc_id").isNull().alias("unnamed"), F.col("rep.doc_id").alias("doc_id"), F.col("rep.text_hash").alias("text_hash"))).alias("one"))
    found = named.join(lowest, "root").select("set_key", "one", "n_links")
    chosen = F.col("doc_id").eqNullSafe(F.col("one.doc_id")) & (F.col("text_hash") == F.col("one.text_hash"))
    return (signed.select("doc_id", "text_hash", "n_shingles", "set_key").join(found, "set_key", "left")
            .select("doc_id", "text_hash", "n_shingles", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("one.doc_id")).alias("component_id"),
                    (F.col("set_key").isNotNull() & F.coalesce(chosen, F.lit(False))).alias("chosen"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3-word shingles, similarity of 85 per cent or more, over all of ``documents``."""
    found = near_duplicates(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, threshold=0.85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+2], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM both_ JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, e.y FROM r JOIN e ON e.x = r.b),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN c ON c.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
