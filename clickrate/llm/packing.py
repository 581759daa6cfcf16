"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

A document's ids end with the separator id 0.  Documents longer than the sequence length are
cut into whole pieces of that length after a first piece that holds the rest.  Pieces are
dealt into shards of about SHARD pieces; a shard is packed on its own, which costs at most one
sequence a shard against packing all of them together.

For each shard, several islands evolve solutions (which piece lies in which bin).  Crossover
injects whole well-filled bins of one parent into the other, removes the bins of the other
that hold the same pieces, and puts the displaced pieces back longest first, each where it
leaves the least room (best fit).  The islands start from best-fit packings in disturbed orders;
the first one also has best-fit decreasing, so no shard ends above that.  After an epoch each
island sends its elite to the next island of its shard.  An island stops after a generation
whose best has as many bins as the lower bound, the shard's tokens over the length, rounded up.

With ``added`` (``op9`` and the pipeline) an added token's string in a text, ``<|endoftext|>``,
is that token's one id, as the ``tokenizers`` library gives it by default; without, it is
ordinary text.

Defined results: null or empty text: one piece with the separator alone.  Repeated rows and
null ids are packed like any others.  An empty table gives no rows.  Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickrate.llm.common import map_rows, stored, table
from clickrate.llm.tokens import VOCABULARY, word_ids

LENGTH, SHARD, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 2048, 16_000, 3, 2, 8, 6
DISTURBED = 0.3  # share by which a first solution's order departs from falling lengths
_SEPARATOR = b"\0\0\0\0"
_ELITE = "shard int, island int, bins long, crossovers int, place binary"


def pieces(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, added: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    def make():
        words = word_ids(vocabulary)
        encode = words.ids_added if added else words.ids

        def fn(cols):
            out = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc_id, text in zip(cols["doc_id"], cols["text"]):
                ids = encode(text) + _SEPARATOR
                n = len(ids) // 4
                cuts = [0, *range((n - 1) % length + 1, n + 1, length)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    for c, v in zip(out, (doc_id, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b]))):
                        out[c].append(v)
            return out

        return fn

    return map_rows(docs, make, "doc_id long, piece int, start long, length long, ids_crc32 long", ["doc_id", "text"])


def best_fit(order: np.ndarray, lengths: np.ndarray, place: np.ndarray, free: list[int], length: int) -> None:
    """Put the pieces of ``order`` into ``place``: each into the bin it fills best, or a new one."""
    stacks: list[list[int]] = [[] for _ in range(length + 1)]
    open_ = 0  # bit c: there is a bin with room c
    for b, c in enumerate(free):
        stacks[c].append(b)
        open_ |= 1 << c
    for i, n in zip(order.tolist(), lengths[order].tolist()):
        fits = open_ >> n
        if fits:
            c = n + (fits & -fits).bit_length() - 1
            b = stacks[c].pop()
            if not stacks[c]:
                open_ ^= 1 << c
        else:
            c, b = length, len(free)
            free.append(c)
        place[i] = b
        c -= n
        free[b] = c
        stacks[c].append(b)
        open_ |= 1 << c


def _worth(place: np.ndarray, lengths: np.ndarray) -> tuple:
    fill = np.bincount(place, lengths)
    return len(fill), -float((fill**2).sum())


def _built(lengths: np.ndarray, noise: np.ndarray, length: int) -> np.ndarray:
    place = np.empty(len(lengths), np.int32)
    best_fit(np.argsort(-lengths * noise, kind="stable"), lengths, place, [], length)
    return place


def crossover(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, length: int, rng) -> np.ndarray:
    fill = np.bincount(b, lengths)
    chosen = (fill >= np.quantile(fill, 0.5)) & (rng.random(len(fill)) < 0.5)
    injected = chosen[b]
    broken = np.zeros(a.max() + 1, bool)
    broken[a[injected]] = True
    displaced = broken[a] & ~injected
    kept = np.cumsum(~broken) - 1
    child = np.where(injected, (~broken).sum() + (np.cumsum(chosen) - 1)[b], kept[a]).astype(np.int32)
    settled = ~displaced
    bins = int((~broken).sum() + chosen.sum())
    free = (length - np.bincount(child[settled], lengths[settled], minlength=bins)).astype(int).tolist()
    out = np.flatnonzero(displaced)
    best_fit(out[np.argsort(-lengths[out], kind="stable")], lengths, child, free, length)
    return child


def evolve(lengths: np.ndarray, elites: list[np.ndarray], seed: int, length: int, generations: int, population: int,
           plain: bool = True) -> tuple[np.ndarray, int]:
    """The best solution found, and the number of crossovers.  The first solutions are elites and
    best-fit packings in disturbed orders, which are weaker than best-fit decreasing; ``plain``
    adds that one too.  Children replace the worst; the bound ends the search after a generation."""
    rng = np.random.default_rng(seed)
    least = -(-int(lengths.sum()) // length)
    pool = list(elites)
    while len(pool) < population:
        first = plain and not elites and not pool
        pool.append(_built(lengths, np.ones(len(lengths)) if first else rng.uniform(1 - DISTURBED, 1 + DISTURBED, len(lengths)), length))
    pool.sort(key=lambda p: _worth(p, lengths))
    crossovers = 0
    for _ in range(generations):
        for _ in range(population // 2):
            i, j = rng.permutation(len(pool))[:2]
            pool.append(crossover(pool[i], pool[j], lengths, length, rng))
            crossovers += 1
        pool.sort(key=lambda p: _worth(p, lengths))
        del pool[population:]
        if pool[0].max() + 1 == least:
            break
    return pool[0], crossovers


def _searcher(epoch: int, length: int):
    def search(key, mine: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
        if mine.empty:
            return pd.DataFrame({"shard": [], "island": [], "bins": [], "crossovers": [], "place": []})
        lengths = mine.sort_values("uid")["length"].to_numpy().astype(np.int64)
        got = [np.frombuffer(p, np.int32) for p in sent.sort_values(["bins", "origin"])["place"]]
        best, crossovers = evolve(lengths, got, 1_000_003 * int(key[0]) + 101 * int(key[1]) + epoch, length, GENERATIONS, POPULATION, plain=key[1] == 0)
        return pd.DataFrame({"shard": [key[0]], "island": [key[1]], "bins": [int(best.max()) + 1], "crossovers": [crossovers], "place": [best.astype(np.int32).tobytes()]})

    return search


def _settler(length: int):
    def settle(key, mine: pd.DataFrame, won: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values("uid", ignore_index=True)
        n, whole = mine["length"].to_numpy(), (mine["length"] == length).to_numpy()
        place = np.empty(len(mine), np.int64)
        bins = 0
        if len(won):
            place[~whole] = np.frombuffer(won["place"][0], np.int32)
            bins = int(place[~whole].max()) + 1
        place[whole] = bins + np.arange(whole.sum())
        order = np.argsort(place, kind="stable")
        ends = np.cumsum(n[order])
        first = np.r_[True, place[order][1:] != place[order][:-1]] if len(mine) else np.empty(0, bool)
        base = np.maximum.accumulate(np.where(first, ends - n[order], 0))
        offset = np.empty(len(mine), np.int64)
        offset[order] = ends - n[order] - base
        return mine[["doc_id", "piece", "start", "length", "ids_crc32"]].assign(sequence_id=(int(key[0]) << 32) + place, offset=offset)

    return settle


def evolved(spark: SparkSession, small: DataFrame, length: int) -> list[DataFrame]:
    """The islands' elites after each epoch; ``small`` has shard, uid and length of the pieces."""
    isles = stored(spark, small.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))), "islands")
    epochs = [spark.createDataFrame([], _ELITE)]
    for epoch in range(EPOCHS):
        sent = epochs[-1].select("shard", F.col("island").alias("origin"), F.explode(F.array("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int"))).alias("island"), "bins", "place")
        epochs.append(stored(spark, isles.groupBy("shard", "island").cogroup(sent.groupBy("shard", "island")).applyInPandas(_searcher(epoch, length), _ELITE), f"elites-{epoch}"))
    return epochs[1:]


def pack(spark: SparkSession, docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY, shard: int = SHARD, added: bool = False) -> DataFrame:
    """The pieces with sequence_id and offset."""
    cut = stored(spark, pieces(docs, length, vocabulary, added).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-cut.count() // shard))
    cut = cut.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int"))
    # a piece of the whole length is a sequence already: it takes no part in the search
    small = cut.filter(F.col("length") < length).select("shard", "uid", F.col("length").cast("int").alias("length"))
    elites = evolved(spark, small, length)[-1]

    best = elites.groupBy("shard").agg(F.min_by("place", F.struct("bins", "island")).alias("place"))

    return cut.groupBy("shard").cogroup(best.groupBy("shard")).applyInPandas(
        _settler(length), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in sequences of 2048 tokens."""
    return pack(spark, table(spark, sf_dir, "documents"), added=True)
