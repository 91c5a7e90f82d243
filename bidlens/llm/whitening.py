"""Whitening of embeddings by shifted Cholesky QR.

Vectors become whole numbers, so sums and deviations are exact. The centred rows A are
never gathered: a pass over them sums the Gram matrix of their current transform in
each task and over tasks, and the driver only sees its d * d sums.

1. R1 from the Cholesky factor of the Gram matrix of A, shifted by a multiple of its trace so that it exists.
2. The rows of A are solved against R1, which orthogonalises them roughly; their Gram
   matrix gives R2. Solved against R1 and then R2, a third pass gives R3 and they are orthogonal to working precision.
3. A = Q (R3 R2 R1). The singular value decomposition of that product, a d * d matrix, has A's
   singular values and directions: components, their variances, and the whitening.

No square of A's condition reaches the result, which one eigenvalue decomposition of the covariance would suffer.

Defined cases: a vector that is null, or holds null, NaN or infinite entries, is dropped; so is
one whose entries leave ``LARGEST``, where sums could leave exact range, and one of another
length than most vectors (of equally common lengths the longest counts); null ids and repeated vectors are rows like any
other; where vectors do not vary in as many directions, the components left over have a null
whitened value; a deviation beyond 64 bits is null; extra columns are not read; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidlens.llm.ship import shipped
from bidlens.session import cut_lineage

SCALE, OFFSET = 1024, 100000
LARGEST = float(1 << 40)  # entries, after scaling
COMPONENTS = 8
SLICE_ROWS = 8192
FLAT = 1e-11  # singular values below this share of the largest count as none
UNIT = np.finfo(np.float64).eps / 2


def whole_rows(vectors: pa.Array, dims: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their entries as whole numbers) of the usable vectors, one length at a time."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    sizes = pa.compute.fill_null(pa.compute.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    for size in ([dims] if dims is not None else np.unique(sizes[sizes >= 0]).tolist()):
        rows = np.flatnonzero(sizes == size)
        for at in range(0, len(rows), SLICE_ROWS):
            part = rows[at:at + SLICE_ROWS]
            flat = vectors.take(pa.array(part)).flatten()
            c = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(part), size)  # null becomes NaN
            x = np.floor(SCALE * c) + OFFSET
            fits = (np.abs(x) <= LARGEST).all(axis=1)
            yield part[fits], x[fits].astype(np.int64)


@dataclass(frozen=True)
class Centre:
    """Number of rows and their sums, as quotient and rest by that number."""

    n: int
    quotient: np.ndarray
    rest: np.ndarray

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, the whole part exactly."""
        return (x - self.quotient) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n * x - S) ** 2, exactly; null beyond 64 bits."""
        y = x - self.quotient
        most = float(np.abs(y).max(initial=0)) + 1
        if most * most * x.shape[1] * self.n * self.n < 2.0 ** 62:
            return pa.array(((self.n * y - self.rest) ** 2).sum(axis=1))
        square, cross = y.astype(object) ** 2, y.astype(object) * self.rest.astype(object)
        own = sum(int(r) ** 2 for r in self.rest)
        exact = [self.n * self.n * int(a) - 2 * self.n * int(b) + own for a, b in zip(square.sum(axis=1), cross.sum(axis=1))]
        return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangular matrix, by substitution."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def _vectors(df: DataFrame, vector: str) -> DataFrame:
    return shipped(df.select(F.col(vector).cast("array<double>").alias("v")))


def centre(df: DataFrame, vector: str) -> Centre | None:
    """Centre of the usable vectors of the most common length; None without any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for rows, x in whole_rows(batch.column(0)):
                if len(rows):
                    held = totals.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
                    held[0] += len(rows)
                    held[1] = held[1] + x.sum(axis=0)
        for dims, (n, sums) in totals.items():
            yield pa.RecordBatch.from_pydict({
                "dims": pa.array([dims] * (dims + 1), pa.int32()), "at": pa.array(np.arange(-1, dims), pa.int32()),
                "total": pa.array([str(n), *map(str, sums)])})

    parts = _vectors(df, vector).mapInArrow(run, "dims int, at int, total string")
    sums = cut_lineage(parts.groupBy("dims", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")), "sums")
    top = sums.filter("at = -1").orderBy(F.desc("total"), F.desc("dims")).head()
    if top is None:
        return None
    n = int(top["total"])
    rows = sums.filter((F.col("dims") == top["dims"]) & (F.col("at") >= 0)).orderBy("at").collect()
    both = [divmod(int(r["total"]), n) for r in rows]
    return Centre(n, np.array([q for q, _ in both], np.int64), np.array([r for _, r in both], np.int64))


def gram(df: DataFrame, vector: str, about: Centre, factors: list[np.ndarray]) -> np.ndarray:
    """Gram matrix of the centred rows after solving them against ``factors`` in turn."""
    d = len(about.quotient)
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in whole_rows(batch.column(0), d):
                q = about.rows(x)
                for r in factors:
                    q = solved(q, r)
                total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            yield pa.RecordBatch.from_pydict({"at": np.arange(len(upper[0]), dtype=np.int32), "g": total[upper]})

    sums = _vectors(df, vector).mapInArrow(run, "at int, g double").groupBy("at").agg(F.sum("g").alias("g")).collect()
    whole = np.zeros((d, d))
    for row in sums:
        a, b = upper[0][row["at"]], upper[1][row["at"]]
        whole[a, b] = whole[b, a] = row["g"]
    return whole


def shifted_factor(g: np.ndarray, n: int, always: bool) -> np.ndarray:
    """Upper triangular Cholesky factor of ``g``, shifted if it must be (or ``always``)."""
    d = len(g)
    shift = 11 * (n + d + 1) * d * UNIT * np.trace(g)
    shift = max(min(shift, 1e-9 * np.trace(g)), np.finfo(np.float64).tiny)
    if not always and (np.diag(g) > 0.5).all():
        try:
            return np.linalg.cholesky(g).T
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(g + shift * np.eye(d)).T


@dataclass(frozen=True)
class Components:
    """Directions as columns by falling variance, the variances, and the sum of all dimensions' variances."""

    centre: Centre
    directions: np.ndarray
    variances: np.ndarray
    trace: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Whitened values; NaN where a component has no variance."""
        varied = self.variances > 0
        scale = np.where(varied, 1 / np.sqrt(np.where(varied, self.variances, 1)), np.nan)
        return self.centre.rows(x) @ self.directions * scale


def fit_whitening(df: DataFrame, vector: str = "embedding", count: int = COMPONENTS) -> Components | None:
    """The first ``count`` components of the usable vectors; None without any."""
    about = centre(df, vector)
    if about is None:
        return None
    d = len(about.quotient)
    factors: list[np.ndarray] = []
    whole, trace = np.eye(d), 0.0
    for number in range(3):
        g = gram(df, vector, about, factors)
        trace = trace or float(np.trace(g)) / about.n
        if not trace:
            return Components(about, np.eye(d)[:, :count], np.zeros(min(count, d)), 0.0)
        factors.append(shifted_factor(g, about.n, always=number == 0))
        whole = factors[-1] @ whole
    _, sigma, directions = np.linalg.svd(whole)
    sigma = np.where(sigma > FLAT * sigma[0], sigma, 0.0)
    return Components(about, directions[:count].T, (sigma ** 2 / about.n)[:count], trace)


def whiten(df: DataFrame, key: str, parts: Components, vector: str = "embedding") -> DataFrame:
    """(key, deviation, whitened) of all usable rows, whitened values as an array by component."""
    d = len(parts.centre.quotient)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in whole_rows(batch.column(1), d):
                if len(rows):
                    w = parts.whiten(x)
                    flat = pa.array(w.ravel(), from_pandas=True)  # NaN becomes null
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(rows)), parts.centre.deviation(x),
                        pa.ListArray.from_arrays(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1], flat)],
                        [key, "deviation", "whitened"])

    rows = shipped(df.select(F.col(key).cast("long").alias(key), F.col(vector).cast("array<double>").alias("v")))
    return rows.mapInArrow(run, f"{key} long, deviation long, whitened array<double>")


def identity_error(white: DataFrame, count: int) -> float:
    """Largest absolute entry of the whitened values' covariance minus the identity; ``white`` is a written table."""
    if not count:
        return 0.0
    values = white.select(*[F.col("whitened")[k].alias(f"w{k}") for k in range(count)])
    means = values.agg(*[F.avg(c).alias(c) for c in values.columns]).head()
    centred = values.select(*[(F.col(c) - F.lit(means[c])).alias(c) for c in values.columns])
    pairs = [(a, b) for a in range(count) for b in range(a, count)]
    found = centred.agg(*[F.avg(F.col(f"w{a}") * F.col(f"w{b}")) for a, b in pairs]).head()
    return max(abs(v - (a == b)) for v, (a, b) in zip(found, pairs))


def whitened_rows(df: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: (key, component, n, deviation, whitened, explained, identity_error)."""
    parts = fit_whitening(df, vector, count)
    if parts is None or not len(parts.variances):
        return df.sparkSession.createDataFrame([], f"{key} long, component int, n long, deviation long, whitened double, "
                                                   "explained double, identity_error double")
    white = cut_lineage(whiten(df, key, parts, vector), "whitened")
    error = identity_error(white, int((parts.variances > 0).sum()))
    share = [float(v / parts.trace) if parts.trace else None for v in parts.variances]
    long = white.select(key, "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return long.select(
        key, (F.col("k") + 1).alias("component"), F.lit(parts.centre.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.lit(share).cast("array<double>"), F.col("k") + 1).alias("explained"),
        F.lit(error).alias("identity_error"))
