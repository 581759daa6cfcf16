"""Quality classifier by positive-unlabelled learning.

A text becomes FEATURES numbers: how often each class of byte follows each other (letters,
digits, spaces, line ends, marks, symbols, bytes beyond ASCII), and rates of words and lines
(repeated neighbours, distinct words and triples, lengths, repeated lines).  A linear scorer
on them is trained with trusted positives (``labels.quality`` = 1) and unlabelled text only,
by the non-negative unbiased risk

    prior * E_P[loss(+)] + max(0, E_U[loss(-)] - prior * E_P[loss(-)])

with the sigmoid loss; where the second term turns negative a step goes against it.  The
class prior is estimated from the same two sides: a first scorer of positives against
unlabelled text, trained with half of the positives, orders the rest, and the least ratio of unlabelled to positive shares over its
upper tails bounds the share of positives in the web text.  Last, a logistic map turns the
scorer into a probability of label 1, fitted on the labels of the training rows.

The features of all documents are stored once.  The labelled side is at most SAMPLE rows (the
documented bound), chosen by a hash of doc_id, and lies on the driver.  The unlabelled side is
every document whose crc32(doc_id) mod 5 is not 0, however many: its part of each gradient, of
the curvature and of the shares above the cuts is a sum over all its rows, which tasks form
from the stored features and Spark adds up; the driver sees the sums alone.

Defined results: null or empty text: all features 0, a score like any other's.  No positive
to learn from: every score is 0.5.  Several labels for a document: each counts.  Repeated
rows and null ids each get a row (held_out is false for a null id; such rows are never
learnt from).  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickrate.llm.common import bounded_sample, held_out, map_rows, stored, table

SAMPLE, CLIP = 4000, 5.0
NEWTON, STEPS, RIDGE = 5, 10, 1e-3  # passes over the unlabelled rows
_KIND = np.array([0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3 if c in b" \t\r\x0b\x0c" else 4 if c == 10
                  else 5 if c in b".,;:'\"()-" else 7 if c >= 128 else 6 for c in range(256)], np.uint8)
FEATURES = 64 + 8
_BLOCK = 1 << 20


def features(text: str | None) -> np.ndarray:
    data = (text or "").encode()
    words = data.split()
    if not words:
        return np.zeros(FEATURES)
    pairs = np.zeros(64)
    for at in range(0, len(data), _BLOCK):  # blocks overlap by one byte, so every pair counts once
        kind = _KIND[np.frombuffer(data, np.uint8, min(_BLOCK + 1, len(data) - at), at)]
        pairs += np.bincount(kind[:-1] * np.uint8(8) + kind[1:], minlength=64)
    n, lines = len(words), data.split(b"\n")
    triples = max(1, n - 2)
    size = len(data) - data.count(b" ")
    rates = [sum(map(bytes.__eq__, words, words[1:])) / n, len(set(words)) / n**0.9, len(set(zip(words, words[1:], words[2:]))) / triples if n > 2 else 1.0,
             size / n / 10, max(map(len, words)) ** 0.5 / 10, np.log1p(n) / 10, len(set(lines)) / len(lines), min(1.0, len(lines) / n)]
    return np.concatenate([np.sqrt(pairs / max(1.0, pairs.sum())), rates])


def featured(docs: DataFrame, carry: list[str]) -> DataFrame:
    return map_rows(docs, lambda: lambda cols: {"x": [features(t) for t in cols["text"]]}, "x array<double>", ["text"], carry)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    prior: float = 0.5

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -CLIP, CLIP)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.margin(x) + self.shift)


#: Sums of a function's rows (an array of values) over all unlabelled rows.
Totals = Callable[[Callable[[np.ndarray], np.ndarray], int], np.ndarray]


def prior_cuts(positive: np.ndarray) -> np.ndarray:
    return np.quantile(positive, np.linspace(0, 0.95, 60))


def estimated_prior(positive: np.ndarray, cuts: np.ndarray, above: np.ndarray) -> float:
    """Least ratio, over the cuts, of the shares of unlabelled (``above``) and of positive scores
    at or above them, each ratio first raised by two standard errors of the share of positives:
    the least of noisy ratios would lie too low.  Below some ten thousand unlabelled rows the scorer
    fits their positives as negatives, and the estimate is still low (tests: 0.43 for 0.5 at 4,000)."""
    share = np.array([max((positive >= c).mean(), 1e-9) for c in cuts])
    noise = np.sqrt((1 - share) / (share * len(positive)))
    return float(np.clip((above / share * (1 + 2 * noise)).min(), 0.05, 0.98))


def _one(x: np.ndarray) -> np.ndarray:
    return np.c_[x, np.ones(len(x))]


def _curved(x: np.ndarray, w: np.ndarray, y: float) -> np.ndarray:
    """Gradient and curvature sums of the logistic loss of rows of class ``y``."""
    d, q = _one(x), _sigmoid(_one(x) @ w)
    return np.r_[d.T @ (q - y), ((d * (q * (1 - q))[:, None]).T @ d).ravel()]


def separator(p: np.ndarray, totals: Totals, n: float, standard: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Logistic scorer of positives against all unlabelled rows, each side weighted as a half, by
    damped Newton steps; and the curvature at its end."""
    width = p.shape[1] + 1
    w = np.zeros(width)
    for _ in range(NEWTON):
        both = 0.5 * _curved(p, w, 1.0) / len(p) + 0.5 * totals(lambda x, w=w: _curved(standard(x), w, 0.0), width + width * width) / n
        curve = both[width:].reshape(width, width) + RIDGE * np.eye(width)
        step = np.linalg.solve(curve, both[:width] + RIDGE * w)
        w = w - step * min(1.0, 3.0 / max(np.abs(step).max(), 1e-12))
    return w, curve


def unlabelled_loss(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums over rows of the loss as negatives, sigmoid(score), and of its gradient."""
    q = _sigmoid(_one(x) @ w)
    return np.r_[q.sum(), _one(x).T @ (q * (1 - q))]


def non_negative_step(prior: float, positive: np.ndarray, unlabelled: np.ndarray) -> tuple[float, np.ndarray]:
    """The non-negative risk and the direction to go against, from both sides' means of (loss as
    negatives, its gradient).  loss(+) is 1 - loss(-), so its gradient is the opposite one."""
    negative, slope = unlabelled[0] - prior * positive[0], unlabelled[1:] - prior * positive[1:]
    risk = prior * (1 - positive[0]) + max(0.0, negative)
    return risk, (slope - prior * positive[1:] if negative >= 0 else -slope)


def minimised(p: np.ndarray, totals: Totals, n: float, prior: float, start: np.ndarray, curve: np.ndarray, standard: Callable) -> np.ndarray:
    """Weights that minimise the non-negative risk, from ``start``: steps in the metric of ``curve``
    over all rows, halved where the risk rises; the best weights met are kept."""
    w, best, rate = start.copy(), (np.inf, start), 1.0
    for _ in range(STEPS):
        risk, step = non_negative_step(prior, unlabelled_loss(p, w) / len(p), totals(lambda x, w=w: unlabelled_loss(standard(x), w), len(w) + 1) / n)
        if risk < best[0]:
            best = (risk, w)
        else:
            rate /= 2
            w = best[1]
        move = np.linalg.solve(curve, step + 1e-4 * np.r_[w[:-1], 0])
        w = w - rate * move * min(1.0, 0.5 * np.linalg.norm(w) / max(np.linalg.norm(move), 1e-12))
    return best[1]


def train(labelled: np.ndarray, quality: np.ndarray, totals: Totals) -> Model | None:
    positive = labelled[quality == 1]
    n = float(totals(lambda x: np.array([float(len(x))]), 1)[0])
    if not len(positive) or not n:
        return None
    mean, scale = positive.mean(axis=0), np.maximum(positive.std(axis=0), 0.01)
    model = Model(mean, scale, np.zeros(FEATURES), 0.0)
    p = model.standard(positive)
    # the scorer knows one half of the positives, the cuts come from the other
    known, other = (p[::2], p[1::2]) if len(p) > 1 else (p, p)
    first, _ = separator(known, totals, n, model.standard)
    cuts = prior_cuts(_one(other) @ first)
    above = totals(lambda x: (_one(model.standard(x)) @ first >= cuts[:, None]).sum(axis=1).astype(float), len(cuts)) / n
    model.prior = estimated_prior(_one(other) @ first, cuts, above)
    start, curve = separator(p, totals, n, model.standard)
    w = minimised(p, totals, n, model.prior, start, curve, model.standard)
    model.weights, model.bias = w[:-1], float(w[-1])
    z = model.margin(labelled)
    unit = max(float(z.std()), 1e-6)
    a = np.array([1.0, 0.0])
    for _ in range(50):  # Newton steps of a ridge logistic fit on (margin, 1)
        design = np.c_[z / unit, np.ones(len(z))]
        q = _sigmoid(design @ a)
        h = (design * (q * (1 - q))[:, None]).T @ design + 1e-2 * np.eye(2)
        a -= np.linalg.solve(h, design.T @ (q - quality) + 1e-2 * (a - [1.0, 0.0]))
    model.slope, model.shift = float(a[0] / unit), float(a[1])
    return model


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)


def totals_of(feats: DataFrame) -> Totals:
    """Sums over the rows of ``feats`` (x): one array a task, added up by place."""
    def totals(fn: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width)
            for batch in batches:
                if batch.num_rows:
                    total = total + fn(_rows(batch))
            yield pa.RecordBatch.from_arrays([pa.array([total], type=pa.list_(pa.float64()))], ["total"])

        parts = feats.select("x").mapInArrow(run, "total array<double>")
        out = np.zeros(width)
        for r in parts.select(F.posexplode("total").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect():
            out[r["i"]] = r["v"]
        return out
    return totals


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Model | None:
    """``docs`` has doc_id and text, or doc_id and the stored features x."""
    feats = docs if "x" in docs.columns and "text" not in docs.columns else stored(docs.sparkSession, featured(docs.select("doc_id", "text"), ["doc_id"]), "quality-features")
    ours = held_out(F.col("doc_id"), 5) != 0
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(ours & F.col("quality").isin(0, 1))
    chosen = bounded_sample(known, "doc_id", rows)  # at most ``rows`` rows: small enough to send to every executor
    marked = feats.join(F.broadcast(chosen), "doc_id").select("x", "quality").toPandas()
    if marked.empty:
        return None
    return train(np.stack(marked["x"]), marked["quality"].to_numpy(), totals_of(feats.filter(ours)))


def scored_features(feats: DataFrame, model: Model | None, carry: list[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` of stored features with score."""
    def make():
        return lambda cols: {"score": [0.5] * len(cols["x"]) if model is None else model.score(np.array(cols["x"]))}

    return map_rows(feats, make, "score double", ["x"], list(carry))


def scored(spark: SparkSession, docs: DataFrame, model: Model | None, carry: list[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` with score."""
    sent = spark.sparkContext.broadcast(model)

    def make():
        m = sent.value

        def fn(cols):
            if m is None:
                return {"score": [0.5] * len(cols["text"])}
            return {"score": m.score(np.stack([features(t) for t in cols["text"]]))}

        return fn

    return map_rows(docs, make, "score double", ["text"], list(carry))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All whole texts of ``documents``, learnt from ``labels``."""
    feats = stored(spark, featured(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"]), "quality-features")
    found = scored_features(feats, learn(feats, table(spark, sf_dir, "labels")))
    return found.select("doc_id", F.coalesce(held_out(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
