"""Embedding whitening, its eigenvectors refined from single to higher precision.

1. Components of a vector become integers (``floor(scale * c) + shift``), so a
   table's sums can be exact and repeat whatever the partitioning.
2. Number, sums and products are computed by tasks and added up by Spark as
   DECIMAL(38, 0). Products are taken of values centred at the whole number
   below each mean, in float64 matrix products cut into digit slices so small
   that every sum of a block is exact; the rest of the centring, below one
   unit, is corrected in whole numbers on the driver. So the covariance has one
   rounding an entry. The driver gets d(d + 1)/2 numbers, whatever the rows.
3. The driver takes eigenvectors of the covariance in float32 and refines them
   by Ogita and Aishima's iteration, four matrix products a round, in extended
   precision. Where eigenvalues stand too near for the current vectors to tell
   them apart, the cluster's vectors span the right space but are any basis of
   it: the cluster's own small problem, shifted by its mean so that the gaps
   are not lost, is solved and the basis turned.
4. Every row is projected on the leading components and divided by the root of
   their eigenvalue; the covariance of the result is measured, not assumed.

Defined cases. Vectors that are null, hold a null or non-finite entry or one
too large for an exact whole number (|scale * c| >= 2**52) are left out, and so
are vectors of another length than most vectors (of lengths equally frequent,
the longest). A null key is kept; repeated rows count and return as often as
they stand. A table without vectors gives no rows. A component without variance
(its eigenvalue is below 1e-12 of the trace, as with one row or equal rows) has
a null ``whitened`` and no part in ``identity_error``, which is null if no
component has any. Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, ship_package, written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LIMIT = 2**52
SLICE = 20  # bits of a digit slice: 2**12 products of two slices add up exactly in a float64
BLOCK = 1 << 12
FLAT = 1e-12  # share of the trace below which a component has no variance
MAX_DIMENSION = 4096
ROUNDS = 40
_LONG = "decimal(38,0)"


# ---- higher precision eigenvectors ------------------------------------------------------------


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Groups of two or more eigenvalues with no step above ``gap`` inside."""
    order = np.argsort(values, kind="stable")
    cut = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [g for g in np.split(order, cut) if len(g) > 1]


def refine(a: np.ndarray, x: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, int]:
    """Eigenvalues and vectors of symmetric ``a`` from approximate vectors ``x``, and the rounds taken.

    A round measures how far ``x`` is from orthonormal (R = I - X'X) and from
    diagonal (S = X'AX), in extended precision, and corrects X by X E, where
    E's entries are (s_ij + l_j r_ij) / (l_j - l_i), or r_ij / 2 where the
    eigenvalues l differ by no more than the error of S. Vectors of such a
    cluster are then turned by the eigenvectors of their own shifted block.
    Converges quadratically; ends when that error is at rounding level.
    """
    a, x = a.astype(np.longdouble), x.astype(np.longdouble)
    n = len(a)
    size = float(np.sqrt((a.astype(float) ** 2).sum()))
    exact = 4 * n * float(np.finfo(np.longdouble).eps) * size
    before = np.inf
    for k in range(1, rounds + 1):
        r = np.eye(n, dtype=np.longdouble) - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2  # else its rounding, over a small gap, would cost orthogonality
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        error = 2 * (float(np.linalg.norm(off.astype(float))) + size * float(np.linalg.norm(r.astype(float))))
        if error <= exact or before / 2 < error < 2.0**-40 * size:
            break  # at rounding level, or near it and held up by rounding over small gaps
        before = error
        gap = values[None, :] - values[:, None]
        alike = max(error, 2.0**-53 * size)  # gaps below a's own rounding mean nothing
        near = np.abs(gap) <= alike
        x = x + x @ np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
        for group in _clusters(values.astype(float), alike):
            own = x[:, group]
            mean = values[group].mean()
            block = own.T @ (a @ own) - mean * (own.T @ own)
            block = ((block + block.T) / 2).astype(float)
            scale = np.abs(block).max()
            if scale > exact:
                turn = np.linalg.eigh(block / scale)[1].astype(np.longdouble)
                x[:, group] = own @ (1.5 * turn - 0.5 * turn @ (turn.T @ turn))  # orthogonal beyond double precision
    x = x + x @ (np.eye(n, dtype=np.longdouble) - x.T @ x) / 2
    values = (x * (a @ x)).sum(0) / (x * x).sum(0)
    return values, x / np.sqrt((x * x).sum(0)), k


def eigen(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as rows: float32 first, then refined.

    The sign makes a vector's largest entry (of equal ones the first) positive.
    """
    scale = np.abs(covariance).max()
    if not scale > 0:
        return np.zeros(len(covariance)), np.eye(len(covariance))
    a = covariance / scale
    _, rough = np.linalg.eigh(a.astype(np.float32))
    values, vectors, _ = refine(a, rough)
    order = np.argsort(-values, kind="stable")
    vectors = vectors[:, order].T.astype(float)
    top = np.argmax(np.abs(vectors) > np.abs(vectors).max(1, keepdims=True) * (1 - 1e-9), axis=1)
    sign = np.where(vectors[np.arange(len(vectors)), top] < 0, -1.0, 1.0)
    return (values[order] * scale).astype(float), vectors * sign[:, None]


# ---- exact sums over Spark --------------------------------------------------------------------


def _matrix(batch: pa.RecordBatch, column: str, dims: int, kind) -> np.ndarray:
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(-1, dims).astype(kind, copy=False)


def products(y: np.ndarray) -> np.ndarray:
    """Y'Y of whole numbers (|y| < 2**53), exact, as Python integers."""
    dims = y.shape[1]
    total = np.zeros((dims, dims), object)
    for start in range(0, len(y), BLOCK):
        part = y[start : start + BLOCK]
        count = max(1, -(-int(np.abs(part).max(initial=0)).bit_length() // SLICE))
        sign, size = np.sign(part), np.abs(part)
        digits = [(sign * ((size >> (SLICE * k)) & ((1 << SLICE) - 1))).astype(float) for k in range(count)]
        for i, one in enumerate(digits):
            for j, other in enumerate(digits):
                total = total + (one.T @ other).astype(np.int64).astype(object) * (1 << SLICE * (i + j))
    return total


def _added(df: DataFrame, run, keys: str) -> DataFrame:
    """Rows ``(keys..., total)`` that tasks made, added up by key: exact and in any order the same."""
    names = [k.split()[0] for k in keys.split(",")]
    return df.mapInArrow(run, f"{keys}, part {_LONG}").groupBy(*names).agg(F.sum("part").alias("total"))


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def sums(vectors: DataFrame, dims: int) -> tuple[int, list[int]]:
    """(n, exact sum of every dimension) of ``x``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, object)
        for batch in batches:
            x = _matrix(batch, "x", dims, np.int64)
            low = (x & 0xFFFFFFFF).sum(0).astype(object)  # two halves: no batch can overflow
            total = total + low + (x >> 32).sum(0).astype(object) * (1 << 32)
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, dims, dtype=np.int32)), _decimals([n, *total])], names=["i", "part"])

    found = {r["i"]: int(r["total"]) for r in _added(vectors.select("x"), run, "i int").collect()}  # dims + 1 rows
    return found.get(-1, 0), [found.get(i, 0) for i in range(dims)]


def covariance(vectors: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """The covariance of ``x`` with divisor n, every entry rounded once."""
    dims = len(total)
    floor = [t // n for t in total]
    centre = np.array(floor, np.int64)
    upper = np.triu_indices(dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = None
        for batch in batches:
            own = products(_matrix(batch, "x", dims, np.int64) - centre)
            gram = own if gram is None else gram + own
        if gram is not None:
            i, j = (pa.array(u.astype(np.int32)) for u in upper)
            yield pa.RecordBatch.from_arrays([i, j, _decimals(gram[upper])], names=["i", "j", "part"])

    out = np.zeros((dims, dims))
    rest = [t - n * f for t, f in zip(total, floor)]  # 0 <= rest < n
    for r in _added(vectors.select("x"), run, "i int, j int").collect():  # dims (dims + 1) / 2 rows
        i, j = r["i"], r["j"]
        out[i, j] = out[j, i] = float(Fraction(n * int(r["total"]) - rest[i] * rest[j], n * n))
    return out


# ---- the operator -----------------------------------------------------------------------------


def whole_numbers(docs: DataFrame, key: str, vector: str, scale: int, shift: int) -> tuple[DataFrame, int]:
    """``(key, x)`` of the vectors that take part, and their length."""
    entry = lambda c: F.floor(c.cast("double") * scale)
    good = lambda c: c.isNotNull() & (F.abs(c.cast("double") * scale) < LIMIT)  # noqa: E731  (false for NaN: Spark holds it above all)
    rows = docs.select(col(key).alias("key"), col(vector).alias("v")).filter(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", good))
    lengths = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None:
        return rows.select("key", F.transform("v", entry).alias("x")), 0
    dims = lengths["dims"]
    if dims > MAX_DIMENSION:
        raise ValueError(f"vectors of {dims} dimensions: the driver holds a covariance of at most {MAX_DIMENSION} squared")
    return rows.filter(F.size("v") == dims).select("key", F.transform("v", lambda c: entry(c) + F.lit(shift).cast("long")).alias("x")), dims


def whiten(docs: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """Per vector: ``(key, n, deviation, whitened, explained, identity_error)``.

    ``deviation`` is the sum over dimensions of (n x - S)**2, exact, as
    DECIMAL(38, 0) (null beyond its 38 digits); ``whitened`` and ``explained``
    are arrays over the leading components, ``identity_error`` the largest
    entry of the whitened vectors' covariance less the identity.
    """
    spark = docs.sparkSession
    ship_package(spark)
    vectors, dims = whole_numbers(docs, key, vector, scale, shift)
    kind = docs.select(col(key)).schema[0].dataType.simpleString()
    shape = f"key {kind}, n bigint, deviation {_LONG}, whitened array<double>"
    n, total = sums(vectors, dims) if dims else (0, [])
    if not n:
        return spark.createDataFrame([], f"{shape}, explained array<double>, identity_error double")
    v = covariance(vectors, n, total)
    values, axes = eigen(v)
    trace = float(np.trace(v))
    keep = min(components, dims)
    values, axes = values[:keep], axes[:keep]
    solid = values > FLAT * trace
    turn = np.zeros((dims, keep))
    turn[:, solid] = axes[solid].T / np.sqrt(values[solid])
    floor = np.array([t // n for t in total], np.int64)
    rest = [t - n * int(f) for t, f in zip(total, floor)]
    part = np.array([r / n for r in rest])
    shared = spark.sparkContext.broadcast((turn, floor, part, rest))  # dims x components numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, floor, part, rest = shared.value
        for batch in batches:
            y = _matrix(batch, "x", dims, np.int64) - floor
            white = (y - part) @ turn
            values = pa.array(white.ravel(), mask=np.tile(~solid, len(white)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(np.full(len(y), n)), _deviations(y, n, rest), pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * keep), values)],
                names=["key", "n", "deviation", "whitened"],
            )

    done = written(vectors.mapInArrow(run, shape), "whitened")
    error = _identity_error(done, n, solid)
    explained = [float(e) / trace if trace > 0 else 0.0 for e in np.maximum(values, 0)]
    return done.withColumns({"explained": F.array(*map(F.lit, explained)), "identity_error": F.lit(error).cast("double")})


def _deviations(y: np.ndarray, n: int, rest: list[int]) -> pa.Array:
    """sum((n y - rest)**2) per row, exact: n^2 sum(y^2) - 2 n sum(y rest) + sum(rest^2)."""
    most = int(np.abs(y).max(initial=0))
    kind = np.int64 if max(most, 1) * max(most, n) * len(rest) < 2**62 else object
    own = y.astype(kind)
    squares = (own * own).sum(1)
    crossed = (own * np.array(rest, kind)).sum(1)
    fixed = sum(r * r for r in rest)
    found = [n * n * int(s) - 2 * n * int(c) + fixed for s, c in zip(squares, crossed)]
    return pa.array([Decimal(d) if d < 10**38 else None for d in found], pa.decimal128(38, 0))


def _identity_error(done: DataFrame, n: int, solid: np.ndarray) -> float | None:
    """Largest |covariance of the whitened vectors - identity|, from their own centred products."""
    on = [int(k) for k in np.flatnonzero(solid)]
    if not on:
        return None
    w = [F.col("whitened")[k] for k in on]
    means = done.agg(*[F.avg(c).alias(f"m{k}") for k, c in zip(on, w)]).first()
    centred = [c - F.lit(means[f"m{k}"]) for k, c in zip(on, w)]
    pairs = [(i, j) for i in range(len(on)) for j in range(i, len(on))]
    found = done.agg(*[(F.sum(centred[i] * centred[j]) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def components(done: DataFrame, key: str = "vec_id") -> DataFrame:
    """One row per vector and component, numbered from 1; a ``deviation`` beyond a long is null."""
    each = F.arrays_zip("whitened", "explained")
    deviation: Column = F.col("deviation")
    long = F.when(deviation < F.lit(2**63 - 1).cast(_LONG), deviation).cast("long")
    flat = done.select(F.col("key").alias(key), "n", long.alias("deviation"), "identity_error", F.posexplode(each).alias("at", "c"))
    return flat.select(key, (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
