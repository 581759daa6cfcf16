"""Whitening of embeddings from an incremental eigendecomposition.

An entry c becomes the integer x = floor(1024 * c) + 100000.  Each partition keeps a spectrum:
the row count, the exact integer sums, the mean, and the eigenpairs of its centred scatter.  A
row moves the mean and adds ``n / (n + 1) * y y'`` to the scatter, y being the row less the old
mean.  In the eigenbasis that is a diagonal matrix plus a rank-one term: entries of y without
weight and equal eigenvalues are deflated (the latter by rotating one of the two entries to
zero), the other eigenvalues are the roots of the secular equation, found between the old ones
in coordinates shifted to the nearer pole, and the eigenvectors come from the roots by the
weights for which these roots are exact, which keeps them orthogonal.  Two spectra are combined
in the same way: the scatter of one takes the other's eigenpairs and the distance of the means
as successive rank-one updates.  Spectra are combined in rounds of ``FAN_IN``, so no task and
not the driver holds more than that many of them, however many partitions there are.

The basis found so is refined by Rayleigh-Ritz steps over all rows: in a basis Q, the rows are
centred by the exact sums, projected and multiplied; the small eigenproblem turns Q.  Steps
end when Q is orthonormal and the largest entry off the diagonal is rounding.  So the components
have double precision whatever the many updates lost.

Defined results: rows whose vector is null, or holds null or non-finite entries, are left out.
Vectors of another length than the most frequent one (the longer of two equally frequent) are
left out too, and empty vectors.  ``floor(1024 * c)`` is held within 2^51 either side.
Components whose eigenvalue is not above 1e-13 of the largest have no whitened values and are
left out: with fewer than 8 dimensions, or in rows that lie in fewer, a row has fewer components,
and none if all rows are equal.  ``deviation`` is null where it doesn't fit 64 bits.  Repeated
rows and ids count and are given each; an empty table gives no rows.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickrate.llm.common import stored, table

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
FAN_IN, MOST_STEPS, FLOOR = 16, 4, 1e-13
_EPS = np.finfo(float).eps
_WIDEST = float(2 ** 51)


# -- eigenvalues and eigenvectors of diag(d) + rho z z' ---------------------------------------

def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> np.ndarray:
    """The roots of 1 + rho * sum(z2 / (d - t)), for d strictly rising, z2 and rho above 0, as
    the matrix of differences d[j] - root[i].  Root i lies between d[i] and d[i+1] (the last
    one below d[-1] + rho * sum(z2)).

    Each root is sought as its distance from the nearer pole.  The two sides of the sum are
    replaced by rational functions that agree in value and slope with them and have the two
    poles around the root; the next guess is that function's root, held inside a bracket that
    every step narrows."""
    m = len(d)
    upper = np.append(d[1:], d[-1] + rho * z2.sum())
    gap = upper - d
    at_middle = 1 + rho * (z2 / (d - (d + gap / 2)[:, None])).sum(1)
    above = at_middle <= 0  # the root is in the upper half
    lo, hi = np.where(above, gap / 2, 0.0), np.where(above, gap, gap / 2)
    origin = np.where(above, upper, d)
    origin[-1] = d[-1]  # above the last root is no pole
    from_upper = above.copy()
    from_upper[-1] = False
    lo, hi = lo - gap * from_upper, hi - gap * from_upper
    delta = d - origin[:, None]  # the poles as seen from each root's origin
    low_pole, high_pole = d - origin, upper - origin
    t = (lo + hi) / 2
    left = np.tril(np.ones((m, m)))
    right = 1 - left
    with np.errstate(all="ignore"):
        for _ in range(80):
            gone = delta - t[:, None]
            term = z2 / gone
            slope = term / gone
            psi, phi = np.einsum("ij,ij->i", term, left), np.einsum("ij,ij->i", term, right)
            value = 1 + rho * (psi + phi)
            noise = 8 * _EPS * m * (1 + rho * (np.abs(psi) + np.abs(phi)))
            lo, hi = np.where(value < 0, t, lo), np.where(value > 0, t, hi)
            done = (np.abs(value) <= noise) | (hi - lo <= 2 * _EPS * np.maximum(np.abs(lo), np.abs(hi)))
            if done.all():
                break
            # in u, the step: a + s / (a1 - u) + q / (a2 - u) = 0
            a1, a2 = low_pole - t, high_pole - t
            s = rho * np.einsum("ij,ij->i", slope, left) * a1 * a1
            q = rho * np.einsum("ij,ij->i", slope, right) * a2 * a2
            a = value - s / a1 - q / a2
            b, c = a * (a1 + a2) + s + q, value * a1 * a2
            root = np.sqrt(np.maximum(b * b - 4 * a * c, 0.0))
            u = np.where(b > 0, 2 * c / (b + root), (b - root) / (2 * a))
            u[-1] = a1[-1] + s[-1] / (value[-1] - s[-1] / a1[-1])
            guess = t + u
            inside = (guess > lo) & (guess < hi)  # false where it is not finite
            t = np.where(done, t, np.where(inside, guess, (lo + hi) / 2))
    return delta - t[:, None]


def rank_one(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Rising eigenvalues and the eigenvectors (columns) of diag(d) + rho z z' (rho >= 0)."""
    order = np.argsort(d, kind="stable")
    turn = np.eye(len(d))[:, order]
    d, z = d[order].copy(), z[order].copy()
    size = max(np.abs(d).max(initial=0.0), rho * (z @ z))
    if rho <= 0 or size == 0:
        return d, turn
    tol = 8 * _EPS * size
    live = rho * np.abs(z) * np.sqrt(z @ z) > tol
    keep = np.flatnonzero(live)
    kept = []
    for j in keep:  # of two nearly equal eigenvalues, the lower one's weight is rotated to zero
        if kept and d[j] - d[kept[-1]] <= tol:
            i = kept.pop()
            r = np.hypot(z[i], z[j])
            c, s = z[j] / r, z[i] / r
            z[i], z[j] = 0.0, r
            turn[:, [i, j]] = turn[:, [i, j]] @ np.array([[c, s], [-s, c]])
            d[i], d[j] = c * c * d[i] + s * s * d[j], s * s * d[i] + c * c * d[j]
        kept.append(int(j))
    kept = np.array(kept, dtype=int)
    if not len(kept):
        return d, turn
    dk, zk = d[kept], z[kept]
    differ = secular_roots(dk, zk * zk, rho)  # [i, j]: d[j] - root i
    m = len(kept)
    near = np.argmin(np.abs(differ), axis=1)
    d[kept] = dk[near] - differ[np.arange(m), near]
    # the weights for which the computed roots are the exact ones
    apart = dk - dk[:, None]
    np.fill_diagonal(apart, -1.0)
    with np.errstate(all="ignore"):
        vectors = np.sign(zk) * np.sqrt(np.abs(np.prod(differ / apart, axis=0))) / differ
    vectors = vectors.T / np.linalg.norm(vectors, axis=1)
    turn[:, kept] = turn[:, kept] @ vectors
    order = np.argsort(d, kind="stable")
    return d[order], turn[:, order]


# -- spectra ------------------------------------------------------------------------------------

@dataclass
class Spectrum:
    """Count, exact sums, mean, and the eigenpairs (columns of ``basis``) of the centred scatter of some rows."""
    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, [0] * dim, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def update(self, y: np.ndarray, rho: float) -> None:
        """The scatter takes ``rho * y y'``."""
        self.values, turn = rank_one(self.values, self.basis.T @ y, rho)
        self.basis = self.basis @ turn

    def add(self, x: np.ndarray) -> None:
        """One row."""
        y = x - self.mean
        if self.n:
            self.update(y, self.n / (self.n + 1))
        self.n += 1
        self.mean = self.mean + y / self.n

    def add_rows(self, rows: np.ndarray) -> None:
        for x in rows.astype(float):
            self.add(x)
        self.sums = [a + int(b) for a, b in zip(self.sums, exact_sum(rows))]

    def combine(self, other: Spectrum) -> None:
        if not other.n:
            return
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.update(vector, float(value))
        both = self.n + other.n
        apart = other.mean - self.mean
        self.update(apart, self.n * other.n / both)
        self.mean = self.mean + apart * (other.n / both)
        self.n, self.sums = both, [a + b for a, b in zip(self.sums, other.sums)]

    def row(self, part: int) -> dict:
        return {"part": part, "n": self.n, "sums": [str(s) for s in self.sums], "mean": self.mean.tolist(), "values": self.values.tolist(), "basis": self.basis.ravel().tolist()}

    @classmethod
    def of(cls, r) -> Spectrum:
        dim = len(r["sums"])
        return cls(int(r["n"]), [int(s) for s in r["sums"]], np.array(r["mean"]), np.array(r["values"]), np.array(r["basis"]).reshape(dim, dim))


SPECTRUM = "part long, n long, sums array<string>, mean array<double>, values array<double>, basis array<double>"
SUMS = "part long, total array<double>"


def exact_sum(rows: np.ndarray) -> list[int]:
    """Column sums of integers, right at any size: halves of 32 bits are summed apart."""
    high, low = rows >> 32, rows & 0xFFFFFFFF
    return [(int(h) << 32) + int(l) for h, l in zip(high.sum(0), low.sum(0))]


def integers(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the batch's usable rows, and their vectors as integers."""
    column = batch.column("embedding")
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    place = np.flatnonzero(lengths == dim)
    flat = column.take(pa.array(place)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)  # null entries: nan
    fine = np.isfinite(flat).all(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * flat[fine])
    return place[fine], np.clip(scaled, -_WIDEST, _WIDEST).astype(np.int64) + SHIFT


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: as 64-bit integers where they hold it, else as Python's."""
    most = max(int(np.abs(x).max(initial=0)) * n, *(abs(s) for s in sums))
    if most < 2 ** 62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def by_partition(rows: DataFrame, make: Callable[[], object], dim: int, add: Callable, give: Callable, ddl: str) -> DataFrame:
    """One row of ``ddl`` for each partition that has usable vectors."""
    from pyspark import TaskContext

    arrow = to_arrow_schema(T.StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, any_row = make(), False
        for batch in batches:
            x = integers(batch, dim)[1]
            if len(x):
                any_row = True
                state = add(state, x)
        if any_row:
            yield pa.RecordBatch.from_pylist([give(state, TaskContext.get().partitionId())], schema=arrow)

    return rows.select("embedding").mapInArrow(run, ddl)


def gathered(spark: SparkSession, parts: DataFrame, ddl: str, together: Callable[[list], dict]):
    """The rows of ``parts`` put together in rounds of ``FAN_IN``; None if there is none."""
    parts = stored(spark, parts, "whitening-parts")
    left = (parts.agg(F.max("part")).first()[0] or 0) + 1

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part").to_dict("records")
        return pd.DataFrame([together(rows) | {"part": rows[0]["part"] // FAN_IN}])

    while True:
        parts = parts.groupBy(F.expr(f"part div {FAN_IN}")).applyInPandas(merge, ddl)
        left = -(-left // FAN_IN)
        if left <= 1:
            return parts.first()


def _spectra_together(rows: list) -> dict:
    first = Spectrum.of(rows[0])
    for r in rows[1:]:
        first.combine(Spectrum.of(r))
    return first.row(0)


def _sums_together(rows: list) -> dict:
    return {"total": np.sum([np.array(r["total"]) for r in rows], axis=0).tolist()}


def _add(state: Spectrum, x: np.ndarray) -> Spectrum:
    state.add_rows(x)
    return state


@dataclass
class Whitening:
    """Exact count and sums, components (columns) by falling eigenvalue, and trace(V)."""
    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    def whitened(self, apart: np.ndarray) -> np.ndarray:
        """Rows of n * x - S on the first components."""
        return (apart.astype(float) / self.n) @ self.components / np.sqrt(self.values)


def products(spark: SparkSession, rows: DataFrame, dim: int, project: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all rows of p p', p being what ``project`` makes of a row."""
    def add(state, x):
        p = project(x)
        return state + (p.T @ p).ravel()

    parts = by_partition(rows, lambda: np.zeros(width * width), dim, add, lambda s, part: {"part": part, "total": s.tolist()}, SUMS)
    return np.array(gathered(spark, parts, SUMS, _sums_together)["total"]).reshape(width, width)


def dimension(rows: DataFrame) -> int:
    """The most frequent length of a vector; 0 if there is none."""
    most = rows.filter("size(embedding) > 0").groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return most["dim"] if most else 0


def fit(spark: SparkSession, rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the usable vectors of ``rows`` (embedding); None if there are none."""
    dim = dimension(rows)
    if not dim:
        return None
    parts = by_partition(rows, lambda: Spectrum.empty(dim), dim, _add, lambda s, part: s.row(part), SPECTRUM)
    found = gathered(spark, parts, SPECTRUM, _spectra_together)
    if found is None:
        return None
    spectrum = Spectrum.of(found)
    n, sums = spectrum.n, spectrum.sums
    basis = np.linalg.qr(spectrum.basis)[0]
    for _ in range(MOST_STEPS):
        h = products(spark, rows, dim, lambda x, q=basis: (centred(x, n, sums).astype(float) / n) @ q, dim) / n
        values, turn = np.linalg.eigh((h + h.T) / 2)
        basis = np.linalg.qr(basis @ turn)[0]
        if np.abs(h - np.diag(np.diagonal(h))).max() <= 4 * dim * _EPS * np.abs(values).max():
            break
    order = np.argsort(-values)[:components]
    order = order[values[order] > FLOOR * values.max()]
    out = Whitening(n, sums, values[order], basis[:, order], float(np.trace(h)))
    if len(order):
        w = products(spark, rows, dim, lambda x: out.whitened(centred(x, n, sums)), len(order)) / n
        out.identity_error = float(np.abs(w - np.eye(len(order))).max())
    return out


OUT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, by: Whitening | None) -> DataFrame:
    """vec_id and ``OUT`` of every usable row of ``rows`` (vec_id, embedding) and component."""
    schema = T.StructType([rows.schema["vec_id"], *T.StructType.fromDDL(OUT).fields])
    if by is None or not len(by.values):
        return rows.sparkSession.createDataFrame([], schema)
    arrow, width = to_arrow_schema(schema), len(by.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                place, x = integers(part, len(by.sums))
                apart = centred(x, by.n, by.sums)
                if int(np.abs(apart).max(initial=0)) ** 2 * len(by.sums) >= 2 ** 63:
                    apart = apart.astype(object)
                deviation = [int(v) if v < 2 ** 63 else None for v in (apart * apart).sum(axis=1)]
                rows = len(place)
                yield pa.RecordBatch.from_arrays([
                    part.column("vec_id").take(pa.array(np.repeat(place, width))).cast(arrow[0].type),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows)), pa.array(np.full(rows * width, by.n)),
                    pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(rows), width))),
                    pa.array(by.whitened(apart).ravel()), pa.array(np.tile(by.values / by.trace, rows)),
                    pa.array(np.full(rows * width, by.identity_error))], schema=arrow)

    return rows.select("vec_id", "embedding").mapInArrow(run, schema)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings``, whitened on their 8 first components."""
    rows = table(spark, sf_dir, "embeddings")
    return whiten(rows, fit(spark, rows))
