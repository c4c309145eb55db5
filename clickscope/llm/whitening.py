"""Whitening of embeddings: pivoted Cholesky of the scatter, one-sided Jacobi on its factor.

Vectors enter as integers (``floor(scale * c) + shift``).  What the components
are fitted on is every distinct integer vector once.  Sums and the scatter are
added up in tasks, centred at the integer next to the mean before anything is
multiplied, so that all terms are integers and the sums exact (up to 2^53) in
whatever order they come; only ``d x d`` numbers reach the driver.

There the scatter is factored by Cholesky with diagonal pivoting, ``P'AP = LL'``,
which stops at its rank.  Plane rotations from the right then make the columns
of ``L`` orthogonal, without ever forming a product of them again: ``L J``
has the same ``LL'``, so its column norms squared are the eigenvalues and the
normalised columns, rows put back in place, the components.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import saved, shipped

#: The scatter and its factor are on the driver; more dimensions are refused.
MOST_DIMENSIONS = 4_096
_LIMIT = float(2**63)
_ROWS = 4_096  # vectors centred at once


def usable(vector: Column) -> Column:
    """Is the vector there, without null and non-finite entries?"""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.coalesce(~F.exists(vector.cast("array<double>"), bad), F.lit(False))


def integers(vector: Column, scale: int = 64, shift: int = 1_000_000) -> Column:
    """The integer vector of a usable vector (beyond 64 bits: the nearest 64-bit integer)."""
    return F.transform(vector.cast("array<double>"), lambda c: _long(F.floor(c * F.lit(float(scale))), shift))


def _long(x: Column, shift: int) -> Column:
    return F.when(x > 2.0**62, F.lit(2**62)).when(x < -(2.0**62), F.lit(-(2**62))).otherwise(x.cast("long")) + F.lit(shift)


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of equal length from a list column."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1)


def _column_sums(vectors: DataFrame, terms: Callable[[np.ndarray], np.ndarray], width: int, exact: bool = False) -> list:
    """The sum over all rows of ``x`` of ``terms(block of rows)``, ``width`` numbers (``exact``: whole ones).

    A task adds up its rows and gives one row a number; Spark adds those.
    """
    part, total = ("long", "decimal(38,0)") if exact else ("double", "double")

    def add(batches):
        sums = None
        for batch in batches:
            x = _matrix(batch.column("x"))
            for at in range(0, len(x), _ROWS):
                more = terms(x[at: at + _ROWS])
                sums = more if sums is None else sums + more
        if sums is not None:
            own = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(sums[own])], names=["at", "part"])
    out = [0] * width
    parts = vectors.select("x").mapInArrow(add, f"at int, part {part}")
    for r in parts.groupBy("at").agg(F.sum(F.col("part").cast(total)).alias("s")).collect():  # ``width`` rows at most
        out[r["at"]] = int(r["s"]) if exact else r["s"]
    return out


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, pivots): ``a[pivots][:, pivots] = L L'`` with as many columns as ``a`` has rank."""
    a, d = a.astype(np.float64).copy(), len(a)
    order, factor = np.arange(d), np.zeros((d, d))
    least = d * np.finfo(float).eps * max(a.diagonal().max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if a[p, p] <= least:
            return factor[:, :k], order
        if p != k:
            a[[k, p]] = a[[p, k]]
            a[:, [k, p]] = a[:, [p, k]]
            factor[[k, p]] = factor[[p, k]]
            order[[k, p]] = order[[p, k]]
        factor[k, k] = a[k, k] ** 0.5
        factor[k + 1:, k] = a[k + 1:, k] / factor[k, k]
        a[k + 1:, k + 1:] -= np.outer(factor[k + 1:, k], factor[k + 1:, k])
    return factor, order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``factor``, rotated in pairs until all are orthogonal to working precision.

    A sweep is a round-robin tournament: each of its rounds rotates disjoint
    pairs together.
    """
    w, r = factor.copy(), factor.shape[1]
    seats = np.arange(r + r % 2)  # an odd number of columns: one sits out each round
    tiny = np.finfo(float).eps
    for _ in range(sweeps):
        turned = False
        for _ in range(max(1, len(seats) - 1)):
            half = len(seats) // 2
            p, q = np.minimum(seats[:half], seats[half:][::-1]), np.maximum(seats[:half], seats[half:][::-1])
            p, q = p[q < r], q[q < r]
            x, y = w[:, p], w[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            far = np.abs(xy) > tiny * len(w) ** 0.5 * np.sqrt(xx * yy)
            if far.any():
                turned = True
                zeta = (yy[far] - xx[far]) / (2 * xy[far])
                t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                w[:, p[far]], w[:, q[far]] = c * x[:, far] - c * t * y[:, far], c * t * x[:, far] + c * y[:, far]
            seats = np.concatenate((seats[:1], seats[-1:], seats[1:-1]))
        if not turned:
            break
    return w


@dataclass
class Whitening:
    """What a fit gives: sizes, the exact sums, eigenvalues and components by falling eigenvalue."""

    n: int
    sums: list[int]           # S, for each dimension
    centre: np.ndarray        # the integers next to S / n
    values: np.ndarray        # of the components kept
    components: np.ndarray    # dimension x component
    trace: float
    identity_error: float = 0.0

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace

    def _offset(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n) - int(c)) for s, c in zip(self.sums, self.centre, strict=True)])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre).astype(np.float64) - self._offset()) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n x - S)^2``, exact (None beyond 64 bits)."""
        rest = np.array([s - self.n * int(c) for s, c in zip(self.sums, self.centre, strict=True)], dtype=np.int64)
        near = self.n * (x - self.centre).astype(np.float64) - rest
        fits = (near * near).sum(axis=1) < _LIMIT * (1 - 1e-9)
        exact = ((self.n * (x - self.centre) - rest) ** 2).sum(axis=1)  # modulo 2^64, right where the sum fits
        return [v if ok else None for v, ok in zip(exact.tolist(), fits.tolist(), strict=True)]


def fit_whitening(vectors: DataFrame, components: int = 16) -> Whitening | None:
    """The whitening of the distinct vectors of column ``x`` (array<bigint>, all of one length).

    Components with an eigenvalue beyond the scatter's numerical rank can't be
    whitened and are left out; equal vectors only, or none, give no fit (None).
    Read several times: ``vectors`` is the saved table of distinct vectors.
    """
    d = vectors.select(F.max(F.size("x"))).first()[0] or 0
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} dimensions: up to {MOST_DIMENSIONS} are supported")
    n = vectors.count() if d else 0
    if not n:
        return None
    # 32 bits at a time, so that a task's sums of any 64-bit integers fit in 64 bits
    halves = _column_sums(vectors, lambda x: np.concatenate(((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))), 2 * d, exact=True)
    sums = [(high << 32) + low for high, low in zip(halves[:d], halves[d:], strict=True)]
    centre = np.array([round(Fraction(s, n)) for s in sums], dtype=np.int64)

    def products(x: np.ndarray) -> np.ndarray:
        y = (x - centre).astype(np.float64)
        return (y.T @ y).ravel()
    raw = np.array(_column_sums(vectors, products, d * d)).reshape(d, d)
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]  # at most n / 2: what the centre leaves
    left = np.array([float(Fraction(r, n)) for r in rest])
    cov = raw / n - np.outer(left, left)
    factor, order = pivoted_cholesky(cov)
    turned = one_sided_jacobi(factor)
    values = (turned * turned).sum(axis=0)
    by_size = np.argsort(-values, kind="stable")[:components]
    if not len(by_size):
        return None
    rows = np.empty_like(turned)
    rows[order] = turned
    fit = Whitening(n, sums, centre, values[by_size], rows[:, by_size] / np.sqrt(values[by_size]), float(np.trace(cov)))
    k = len(by_size)

    def moments(x: np.ndarray) -> np.ndarray:
        z = fit.whitened(x)
        return np.concatenate((z.sum(axis=0), (z.T @ z).ravel()))
    got = np.array(_column_sums(vectors, moments, k + k * k)) / n
    unit = got[k:].reshape(k, k) - np.outer(got[:k], got[:k])
    fit.identity_error = float(np.abs(unit - np.eye(k)).max())
    return fit


RESULT = "deviation bigint, whitened array<double>"


def _projector(fit_of) -> Callable[[Column], Column]:
    @F.arrow_udf(RESULT)
    def project(x: pa.Array) -> pa.Array:
        fit = fit_of()
        rows = _matrix(x)
        k = len(fit.values)
        z = fit.whitened(rows).ravel() if len(rows) else np.zeros(0)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * k, pa.int32()), pa.array(z, pa.float64()))
        return pa.StructArray.from_arrays([pa.array(fit.deviations(rows), pa.int64()), lists], names=["deviation", "whitened"])
    return project


def whiten(rows: DataFrame, vector: str = "embedding", *, components: int = 16, scale: int = 64,
           shift: int = 1_000_000) -> DataFrame:
    """One row for each usable row and component: ``rows`` without the vector, and component, n, deviation, whitened, explained, identity_error.

    Columns of those names are replaced.  Rows whose vector is null, empty or
    holds a null or non-finite entry are dropped, and so are those whose
    vector has another length than most distinct vectors have (of equally many:
    the longer).  The fit counts each distinct integer vector once, so
    repeated rows change nothing but get rows of their own.  Entries beyond 64
    bits count as the nearest 64-bit integer; a deviation beyond 64 bits is
    null.  Components without variance are left out, so a table of equal
    vectors, or an empty one, gives no rows.
    """
    new = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    own = [c for c in rows.columns if c not in (*new, vector)]
    ready = rows.where(usable(F.col(vector)) & (F.size(vector) > 0)).withColumn("__x", integers(F.col(vector), scale, shift))
    # rows are collapsed before the shuffle: a vector that a third of all rows hold is sent once a task
    distinct = saved(ready.select(F.col("__x").alias("x")).distinct(), "whitening-vectors")
    length = distinct.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).select("d").first()
    d = length[0] if length else 0
    fit = fit_whitening(distinct.where(F.size("x") == d), components) if d else None
    if fit is None:
        empty = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double"}
        return rows.where("false").select(*own, *[F.lit(None).cast(t).alias(c) for c, t in empty.items()])
    project = _projector(shipped(rows.sparkSession, fit))
    done = ready.where(F.size("__x") == d).select(*own, project(F.col("__x")).alias("__z"))
    share = F.array(*[F.lit(float(e)) for e in fit.explained])
    return (done.select(*own, F.col("__z.deviation").alias("deviation"), F.posexplode("__z.whitened").alias("__at", "whitened"))
            .select(*own, (F.col("__at") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(share, F.col("__at") + 1).alias("explained"), F.lit(fit.identity_error).alias("identity_error")))
