"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V of a list of vectors are found without forming V. A
block of vectors Q, wider than the number of components, is multiplied by V in passes over the rows:
each task centres its rows X, adds up XᵀXQ and hands on a block as large as Q, which Spark sums up. A round
takes a Chebyshev polynomial of V, one pass for each degree by the three-term recurrence. It is bounded
by one on the unwanted part of the spectrum, from 0 to the least Ritz value of the block, and grows fast
above it. QR and Rayleigh-Ritz follow, until the residuals certify the components. The vectors
of the block beyond those wanted started at random as well; they show that no larger eigenvalue was missed.

Rows of integers are centred in integers, as n * x - S with the exact sums S, and then divided.

Defined cases: vectors that are null, hold null or non-finite entries, or have another length
than most (of equally frequent lengths the longer counts) are left out by `usable`; `fit` expects
vectors of one length and counts each row, repeated ones too. Components whose eigenvalue is zero up to rounding
are not returned, so a list of equal vectors has none, nor has an empty one. Equal eigenvalues
have any basis of their space. Columns of the input are passed on; result names that they already use
get trailing underscores (`common.appended`). Blocks of d * (3 * components) numbers go to each task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType

from gaugeline.llm.common import appended, settled

COMPONENTS = 16
#: Largest degree of a round's polynomial, and how much more the first component may grow than the
#: last wanted one in a round, so that the block keeps its digits.
DEGREE, GROWTH = 12, 1e8
#: Residuals |Vu - eu| of certified components, as a share of the largest eigenvalue; rounds go on
#: to FINE while they help.
CERTIFIED, FINE = 1e-12, 1e-14
ROUNDS = 60
#: Eigenvalues below this share of the largest are zero up to rounding.
ZERO = 1e-13


@dataclass
class Model:
    n: int
    sums: list
    trace: float
    #: Eigenvalues, falling, and unit eigenvectors in columns.
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float = 0.0
    #: Worst residual after each round.
    residuals: list[float] = field(default_factory=list)
    passes: int = 0


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def usable(frame: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows with finite vectors of the length that most of them have."""
    fine = frame.filter(finite(F.col(vector)))
    lengths = fine.groupBy(F.size(vector).alias("length")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    return fine.filter(F.size(vector) == (most["length"] if most else 0))


def _rows(batch: pa.RecordBatch, at: int) -> np.ndarray:
    """The vectors of a batch, one in each row; integers as such, other numbers as doubles."""
    column = batch.column(at)
    values = column.flatten().to_numpy(zero_copy_only=False)
    kind = np.int64 if np.issubdtype(values.dtype, np.integer) else np.float64
    return values.astype(kind, copy=False).reshape(len(column), -1)


def _centred(rows: np.ndarray, n: int, sums: list) -> np.ndarray:
    if rows.dtype == np.int64 and n * max(abs(int(rows.max())), abs(int(rows.min()))) < 1 << 62:
        return (n * rows - np.array(sums, np.int64)) / n
    return rows - np.array([float(s) / n for s in sums])


def _summed(frame: DataFrame, block, width: int) -> np.ndarray:
    """Sum over all rows of block(vectors), an array with `width` columns. A task hands on one block."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                made = block(_rows(batch, 0))
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_pydict(
                {"i": pa.array(range(len(total)), pa.int32()), "row": pa.array(list(total), pa.list_(pa.float64()))}
            )

    parts = frame.mapInArrow(run, "i int, row array<double>")
    sums = parts.groupBy("i").agg(*[F.sum(F.col("row")[j]).alias(f"c{j}") for j in range(width)])
    found = {r["i"]: r[1:] for r in sums.collect()}
    return np.array([found[i] for i in range(len(found))]).reshape(len(found), width)


def _counted(frame: DataFrame, vector: str, whole: bool) -> tuple[int, list]:
    """Number of rows and sum of each dimension, exact for integers."""
    kind = "long" if whole else "double"

    def run(batches):
        n, total = 0, None
        for batch in batches:
            if batch.num_rows:
                rows = _rows(batch, 0)
                n, total = n + len(rows), rows.sum(axis=0) + (0 if total is None else total)
        if n:
            yield pa.RecordBatch.from_pydict(
                {"i": pa.array(range(len(total)), pa.int32()), "n": pa.array([n] * len(total), pa.int64()), "s": total}
            )

    parts = frame.select(vector).mapInArrow(run, f"i int, n long, s {kind}")
    exact = F.col("s").cast("decimal(38,0)") if whole else F.col("s")
    got = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(exact).alias("s")).orderBy("i").collect()
    return (got[0]["n"], [int(r["s"]) if whole else r["s"] for r in got]) if got else (0, [])


def _degree(first: float, last: float, bound: float) -> int:
    """The largest degree at which the first value grows at most GROWTH times more than the last."""
    grow = [np.arccosh(max(2 * value / bound - 1, 1.0)) for value in (first, last)]
    return int(np.clip(np.log(GROWTH) / max(grow[0] - grow[1], 1e-9), 2, DEGREE))


def fit(
    vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS, seed: int = 7
) -> Model:
    """Leading components of the covariance (divisor n) of all rows of `vectors`. The vectors are written to
    the shared folder once and read in each pass."""
    kind = vectors.schema[vector].dataType
    whole = isinstance(kind, ArrayType) and isinstance(kind.elementType, IntegralType)
    held = settled(vectors.select(vector))
    n, sums = _counted(held, vector, whole)
    d, passes = len(sums), 1
    if d == 0:
        return Model(n, sums, 0.0, np.zeros(0), np.zeros((0, 0)))

    def times(q: np.ndarray) -> np.ndarray:
        """V q, in one pass."""
        nonlocal passes
        passes += 1

        def block(rows):
            x = _centred(rows, n, sums)
            return x.T @ (x @ q)

        return _summed(held, block, q.shape[1]) / n

    trace = float(_summed(held, lambda rows: np.array([[(_centred(rows, n, sums) ** 2).sum()]]), 1)[0, 0]) / n
    width = min(d, max(3 * components, components + 8))
    wanted = min(components, d)
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, width)))
    residuals: list[float] = []
    for _ in range(ROUNDS):
        y = times(q)
        small = q.T @ y
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        u, vu = q @ turn, y @ turn
        top = max(float(ritz[0]), 0.0)
        if top <= 0:
            residuals.append(0.0)
            break
        off = np.linalg.norm(vu - u * ritz, axis=0)[:wanted]
        residuals.append(float(off.max()) / top)
        stuck = len(residuals) > 1 and residuals[-1] > residuals[-2] / 2
        if residuals[-1] <= FINE or (residuals[-1] <= CERTIFIED and stuck):
            break
        bound = max(float(ritz[-1]), top * ZERO)
        centre = half = bound / 2
        before, now = u, (vu - centre * u) / half
        for _ in range(_degree(top, max(float(ritz[wanted - 1]), bound), bound) - 1):
            before, now = now, 2 * (times(now) - centre * now) / half - before
            size = np.linalg.norm(now, axis=0)
            size[size == 0] = 1
            before, now = before / size, now / size
        q, _ = np.linalg.qr(now)
    else:
        raise RuntimeError(f"not certified after {ROUNDS} rounds: residuals {residuals[-3:]}")
    kept = int((ritz[:wanted] > top * ZERO * d).sum()) if top > 0 else 0
    values = ritz[:kept].copy()
    directions = u[:, :kept] / np.linalg.norm(u[:, :kept], axis=0)
    model = Model(n, sums, trace, values, directions, 0.0, residuals, passes)
    if kept:
        scaled = directions / np.sqrt(values)

        def whitened(rows):
            w = _centred(rows, n, sums) @ scaled
            return np.vstack([w.T @ w, w.sum(axis=0)])

        found = _summed(held, whitened, kept) / n
        covariance = found[:-1] - np.outer(found[-1], found[-1])
        model.identity_error = float(np.abs(covariance - np.eye(kept)).max())
        model.passes = passes + 1
    return model


def whiten(frame: DataFrame, model: Model, vector: str = "embedding") -> DataFrame:
    """`frame` with `whitened`: the centred vector projected on each component, over the root of its eigenvalue.
    Vectors that are null, not finite or not of the model's length have a null."""
    names, schema = appended(frame, {"whitened": "array<double>"})
    at, n, sums = frame.columns.index(vector), model.n, model.sums
    scaled = model.vectors / np.sqrt(model.values)
    d, k = scaled.shape

    def run(batches):
        for batch in batches:
            column = batch.column(at)
            length = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            fits = (length == d) & (k > 0)
            made: list = [None] * len(column)
            if fits.any():
                part = batch.filter(pa.array(fits))
                found = _centred(_rows(part, at), n, sums) @ scaled
                for place, row in zip(np.flatnonzero(fits), found, strict=True):
                    made[place] = row if np.isfinite(row).all() else None
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.list_(pa.float64()))], names=[*batch.schema.names, *names]
            )

    return frame.mapInArrow(run, schema)
