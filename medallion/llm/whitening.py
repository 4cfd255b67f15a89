"""Whitening of embeddings by FEAST: eigenpairs of their covariance from contour integrals over intervals.

The covariance is an exact sum over the distinct integer vectors, added up by Spark.  Inertia counts (signs of the
pivots of a symmetric indefinite factorisation of the shifted covariance) place intervals that hold the wanted
eigenvalues.  For each interval, nodes of a quadrature on a circle around it give complex shifted systems, solved as
tasks of their own; their sum projects a block of vectors onto the interval's eigenspace, from which Rayleigh-Ritz
extracts the pairs.  That repeats until the residuals vanish; an interval is done only when it has as many
eigenvalues as its inertia counts say, so none is missed.

Only numbers of the order of the dimension squared ever reach the driver.  Rows without a vector, or with a null or
non-finite entry, are left out, and so are rows of another dimension than most (the larger one of equals).  Null ids
and repeated rows stay rows of their own; other columns are ignored.  Entries beyond +-2**34 count as those bounds.
Components without variance are not returned: none for a table that holds one distinct vector only.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import begin_task, prepare, stored, table
from medallion.llm.registry import query

COMPONENTS = 16
SCALE, OFFSET, BOUND = 64.0, 1_000_000, 1 << 40
# Quadrature nodes on the upper half circle, eigenvalues that an interval should hold at most, and rounds of
# projection before the block of vectors is made larger.
NODES, WIDTH, ROUNDS = 8, 8, 12
# An eigenvalue below this share of the trace, times the dimension, counts as none.
LEAST = 2.0**-50


# ---- vectors ----------------------------------------------------------------------------------------------------

def vectors(df: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the rows that have a whole finite vector of the table's dimension."""
    whole = df.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).where(
        F.col("embedding").isNotNull() & F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    sizes = whole.groupBy(F.size("embedding").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return whole.where(F.size("embedding") == (most["size"] if most else 0)).where(F.size("embedding") > 0)


def integers(column: pa.Array) -> np.ndarray:
    """The rows' integer vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return (np.clip(np.floor(SCALE * flat), -BOUND, BOUND).astype(np.int64) + OFFSET).reshape(len(column), -1)


def distinct(df: DataFrame) -> DataFrame:
    """Each integer vector once, as ``x``, stored."""

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                x = integers(batch.column("embedding"))
                yield pa.record_batch({"x": pa.FixedSizeListArray.from_arrays(x.ravel(), x.shape[1]).cast(pa.list_(pa.int64()))})

    prepare(df.sparkSession)
    return stored(df.select("embedding").mapInArrow(work, "x array<long>").groupBy("x").agg(F.lit(1).alias("_one")).select("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(fit: DataFrame, of_batch, decimal: bool = True) -> list:
    """Element-wise sums of an array that each batch gives, a list of Python numbers; empty without rows.

    A task hands on one row for each element; the elements are summed by Spark.
    """
    kind = "decimal(38,0)" if decimal else "double"

    def work(batches):
        begin_task(__name__)
        total = None
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                found = of_batch(_matrix(batch.column("x").slice(first, 4096)))
                total = found if total is None else total + found
        if total is not None:
            value = pa.array([int(v) for v in total], pa.decimal128(38, 0)) if decimal else pa.array(total, pa.float64())
            yield pa.record_batch({"i": pa.array(np.arange(len(total))), "v": value})

    found = fit.mapInArrow(work, f"i long, v {kind}").groupBy("i").agg(F.sum("v").alias("v")).collect()
    return [int(r["v"]) if decimal else r["v"] for r in sorted(found, key=lambda r: r["i"])]


@dataclass(frozen=True)
class Moments:
    """Exact moments of the fit list: ``n`` vectors, sums ``S``, and sums of products about the integer ``centre``."""

    n: int
    sums: list[int]
    centre: np.ndarray
    covariance: np.ndarray

    @property
    def offset(self) -> np.ndarray:
        """The mean, less the centre."""
        return np.array([float(Fraction(s - self.n * int(c), self.n)) for s, c in zip(self.sums, self.centre, strict=True)])


def moments(fit: DataFrame) -> Moments | None:
    """Two passes: sums, then products about the mean's nearest integers.  Exact, whatever order Spark adds in."""
    head = _summed(fit, lambda x: np.append(x.astype(object).sum(axis=0), len(x)) if np.abs(x).max() >= 1 << 40 else
                   np.append(x.sum(axis=0), len(x)).astype(object))
    if not head:
        return None
    *sums, n = head
    centre = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    d = len(sums)
    row, col = np.triu_indices(d)

    def products(x):
        y = x - centre
        # below 2**20, products of 4,096 rows add up exactly in doubles
        held = (y.T.astype(float) @ y.astype(float)).astype(np.int64) if np.abs(y).max() < 1 << 20 else y.T.astype(object) @ y.astype(object)
        return held[row, col].astype(object)

    upper = _summed(fit, products)
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    whole = np.zeros((d, d))
    for i, j, v in zip(row, col, upper, strict=True):
        whole[i, j] = whole[j, i] = float(Fraction(n * v - rest[i] * rest[j], n * n))
    return Moments(n, sums, centre, whole)


# ---- inertia and intervals ----------------------------------------------------------------------------------------

def above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues above ``shift``: positive pivots of P (A - shift I) P' = L D L', with pivots of order 1 and 2."""
    a = matrix - shift * np.eye(len(matrix))
    found, alpha = 0, (1 + 17**0.5) / 8
    while len(a):
        if len(a) == 1:
            return found + int(a[0, 0] > 0)
        size = np.abs(np.diag(a))
        p = int(size.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        r, s = np.unravel_index(int(off.argmax()), off.shape)
        if off[r, s] == 0:
            return found + int((np.diag(a) > 0).sum())
        lead = [p] if size[p] >= alpha * off[r, s] else [r, s]
        order = lead + [i for i in range(len(a)) if i not in lead]
        a, k = a[np.ix_(order, order)], len(lead)
        pivot = a[:k, :k]
        if k == 1:
            found += int(pivot[0, 0] > 0)
        else:  # a pivot of order 2 taken here has one eigenvalue of either sign
            found += 1
        a = a[k:, k:] - a[k:, :k] @ np.linalg.solve(pivot, a[:k, k:])
        a = (a + a.T) / 2
    return found


@dataclass(frozen=True)
class Interval:
    low: float
    high: float
    count: int  # eigenvalues inside, from inertia


def intervals(matrix: np.ndarray, wanted: int) -> list[Interval]:
    """Intervals from the top down that hold the ``wanted`` largest eigenvalues, about ``WIDTH`` in each at most.

    Bisection on inertia counts places the bounds, each in the middle of a gap as wide as the search has seen;
    eigenvalues that differ by rounding only stay in one interval.
    """
    top = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-9)  # Gershgorin
    finest = top * 2.0**-40
    counts = {top: 0, -finest: len(matrix)}

    def inertia(shift):
        return counts.setdefault(shift, above(matrix, shift))

    def bound(least: int, most: int) -> float:
        """A shift with at least ``least`` eigenvalues above it, and no more than ``most`` unless they are equal."""
        low = max(s for s, c in counts.items() if c >= least)
        high = min(s for s, c in counts.items() if c < least)
        while inertia(low) > most and high - low > finest:
            middle = (low + high) / 2
            if inertia(middle) >= least:
                low = middle
            else:
                high = middle
        # move down into the gap below the last eigenvalue
        own, step = inertia(low), max(finest, (top - low) * 2.0**-12)
        while step < top and low - 2 * step > -finest and inertia(low - 2 * step) == own and step < (top - low) / 8:
            step *= 2
        return low - step if low - step > -finest and inertia(low - step) == own else low

    found, high, done = [], top, 0
    while done < wanted:
        low = bound(min(done + WIDTH, wanted), min(done + WIDTH, wanted) + 1)
        found.append(Interval(low, high, inertia(low) - done))
        high, done = low, inertia(low)
    return found


# ---- FEAST ----------------------------------------------------------------------------------------------------------

def _nodes(part: Interval) -> list[tuple[complex, complex]]:
    """Gauss-Legendre points on the upper half of the circle over an interval, and their weights."""
    x, w = np.polynomial.legendre.leggauss(NODES)
    angle = np.pi / 2 * (1 - x)
    middle, radius = (part.low + part.high) / 2, (part.high - part.low) / 2
    return [(complex(middle + radius * np.exp(1j * t)), complex(radius * np.exp(1j * t) * v / 4)) for t, v in zip(angle, w, strict=True)]


def solve_shifted(spark: SparkSession, matrix: np.ndarray, jobs: list[tuple[int, complex, complex]],
                  blocks: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """For each interval, the sum over its nodes of weight * (z - A)^-1 Y, doubled real part; a task for each node."""
    held = spark.sparkContext.broadcast((matrix, blocks))  # bound: the dimension squared, twice
    rows = [(n, k, z.real, z.imag, w.real, w.imag) for n, (k, z, w) in enumerate(jobs)]
    frame = spark.createDataFrame(rows, "n int, k int, x double, y double, u double, v double").repartition(len(rows), "n")

    def work(batches):
        a, ys = held.value
        for batch in batches:
            for r in batch.to_pylist():
                z, w = complex(r["x"], r["y"]), complex(r["u"], r["v"])
                part = 2 * (w * np.linalg.solve(z * np.eye(len(a)) - a, ys[r["k"]].astype(complex))).real
                yield pa.record_batch({"n": pa.array([r["n"]], pa.int32()), "k": pa.array([r["k"]], pa.int32()),
                                       "part": pa.array([part.tobytes()], pa.binary())})

    prepare(spark)
    found: dict[int, np.ndarray] = {}
    for r in sorted(frame.mapInArrow(work, "n int, k int, part binary").collect(), key=lambda r: r["n"]):
        part = np.frombuffer(r["part"]).reshape(blocks[r["k"]].shape)
        found[r["k"]] = found[r["k"]] + part if r["k"] in found else part
    held.unpersist()
    return found


def rayleigh_ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ritz values, falling, and vectors of the space that a block spans."""
    u, s, _ = np.linalg.svd(block, full_matrices=False)
    q = u[:, s > s[0] * 1e-13] if len(s) and s[0] > 0 else u[:, :0]
    small = q.T @ matrix @ q
    e, v = np.linalg.eigh((small + small.T) / 2)
    return e[::-1], (q @ v)[:, ::-1]


def feast(spark: SparkSession, matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit vectors, the largest entry of each positive."""
    d = len(matrix)
    parts = intervals(matrix, wanted)
    draw = np.random.default_rng(7)
    blocks = {k: draw.standard_normal((d, min(d, 2 * p.count + 4))) for k, p in enumerate(parts)}
    scale, done = float(np.abs(matrix).sum(axis=1).max()), {}
    for turn in range(1, 4 * ROUNDS + 1):
        open_ = [k for k in range(len(parts)) if k not in done]
        jobs = [(k, z, w) for k in open_ for z, w in _nodes(parts[k])]
        for k, block in solve_shifted(spark, matrix, jobs, {k: blocks[k] for k in open_}).items():
            part = parts[k]
            e, v = rayleigh_ritz(matrix, block)
            inside = (e >= part.low) & (e <= part.high)
            rest = np.linalg.norm(matrix @ v - v * e, axis=0)
            if int(inside.sum()) == part.count and rest[inside].max(initial=0) <= 4e-15 * d**0.5 * scale:
                done[k] = v[:, inside]
            elif turn % ROUNDS == 0 and v.shape[1] < d:  # too many eigenvalues close outside: a larger block
                blocks[k] = np.hstack([v, draw.standard_normal((d, min(d - v.shape[1], blocks[k].shape[1])))])
            else:
                blocks[k] = v
        if len(done) == len(parts):
            break
    else:
        raise ArithmeticError("the contour integrals did not converge")
    # the intervals' spaces together, so that vectors of neighbouring intervals are at right angles too
    e, v = rayleigh_ritz(matrix, np.hstack([done[k] for k in range(len(parts))]))
    if len(e) != sum(p.count for p in parts):
        raise ArithmeticError("eigenvalues were missed")
    e, v = e[:wanted], v[:, :wanted]
    return e, v * np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])


# ---- whitening --------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """What maps a row to its components."""

    moments: Moments
    values: np.ndarray
    vectors: np.ndarray

    def whiten(self, x: np.ndarray) -> np.ndarray:
        m = self.moments
        return ((x - m.centre).astype(float) - m.offset) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums of squares of n x - S, exact; None beyond a long."""
        m = self.moments
        y = x - m.centre
        rest = np.array([s - m.n * int(c) for s, c in zip(m.sums, m.centre, strict=True)], object)
        if (int(np.abs(y).max(initial=0)) * m.n + m.n) ** 2 * y.shape[1] < 1 << 62:
            z = m.n * y - rest.astype(np.int64)
            return (z * z).sum(axis=1).tolist()
        return [int(v) if v < 1 << 63 else None for v in ((m.n * y.astype(object) - rest) ** 2).sum(axis=1)]


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components of the distinct vectors ``x``, at most ``components``; None without any of positive variance."""
    found = moments(fit)
    if found is None:
        return None
    d, trace = len(found.covariance), float(np.trace(found.covariance))
    # eigenvalues that are rounding errors of none are left out
    wanted = min(components, above(found.covariance, trace * d * LEAST)) if trace > 0 else 0
    return Whitening(found, *feast(fit.sparkSession, found.covariance, wanted)) if wanted else None


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry, in size, of the whitened fit list's covariance minus the identity."""
    k = len(model.values)

    def products(x):
        w = model.whiten(x)
        return np.append((w.T @ w).ravel(), w.sum(axis=0))

    found = np.array(_summed(fit, products, decimal=False)) / model.moments.n
    mean = found[k * k:]
    return float(np.abs(found[:k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whitened(df: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``,
    and the component's ``eigenvalue``.  ``deviation`` is null where it does not fit a long."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double"
    rows = vectors(df)
    fit = distinct(rows)
    model = fit_whitening(fit, components)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    error, k = identity_error(fit, model), len(model.values)
    share = model.values / float(np.trace(model.moments.covariance))

    def work(batches):
        begin_task(__name__)
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                x, n = integers(part.column("embedding")), part.num_rows
                yield pa.record_batch({
                    "vec_id": part.column("vec_id").take(pa.array(np.repeat(np.arange(n), k))),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                    "n": pa.array(np.full(n * k, model.moments.n)),
                    "deviation": pa.array(model.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(n), k))),
                    "whitened": pa.array(model.whiten(x).ravel()), "explained": pa.array(np.tile(share, n)),
                    "identity_error": pa.array(np.full(n * k, error)), "eigenvalue": pa.array(np.tile(model.values, n))})

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(work, schema)


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
