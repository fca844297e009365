"""Embedding whitening by polarisation.

Vectors are turned into whole numbers, so that sums are exact. Covariances come
from variances alone: with s the squared centred values of a sum, added up over
all vectors, s(a + b) - s(a) - s(b) is twice the cross term of a and b. Tasks add
up the squares of every dimension and of every sum of two dimensions; the driver
holds one number for each pair of dimensions, whatever the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

SCALE = 256  # steps of a whole unit of an entry
ROWS = 4096  # vectors that a numpy step takes at a time; no result depends on it
LIMB = 21  # bits of the parts that squares are taken of
FITS = 1 << 61  # absolute values below this are squared in 64-bit parts, larger ones as Python integers
_MASK = (1 << LIMB) - 1
_HALF = 4 * LIMB  # where totals are split into two decimals

X = f"transform(embedding, c -> CAST(floor({SCALE}D * CAST(c AS DOUBLE)) AS BIGINT) + 0L) AS x"
USABLE = "embedding IS NOT NULL AND NOT exists(embedding, c -> c IS NULL OR isnan(c) OR abs(c) = double('Infinity'))"


@dataclass(frozen=True)
class Model:
    """What a fit gives: number of different vectors, sums by dimension, and the
    eigenvalues (falling) and unit eigenvectors (columns) of their covariance.
    ``identity_error`` is measured on the whitened vectors of the fit."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    usable: np.ndarray  # components that have any variance
    identity_error: float | None = None


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, x: entries as floor(256 * entry). Rows whose vector is null or
    holds null or non-finite entries go; so do, where lengths differ, all but the
    most frequent length (ties: the longest), as they have no covariance with the
    rest. Entries beyond 64 bits become the largest number. Repeated rows stay,
    null ids too; other columns are ignored."""
    rows = embeddings.select("vec_id", "embedding").filter(USABLE).selectExpr("CAST(vec_id AS BIGINT) AS vec_id", X)
    length = rows.groupBy(F.expr("size(x) AS d")).agg(F.expr("count(1) AS k")).orderBy(F.desc("k"), F.desc("d")).first()
    return rows.filter("false" if length is None else f"size(x) = {length.d}")


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: as 64-bit integers where they fit, else Python ones."""
    bound = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, sums), default=0)
    kind = np.int64 if 2 * bound < FITS else object
    return n * x.astype(kind) - np.array(sums, kind)


def square_sums(z: np.ndarray, axis: int) -> np.ndarray:
    """Exact sums of squares along an axis, as Python integers. At most ``ROWS``
    rows at a time, so that no 64-bit sum of parts can run over."""
    if z.dtype == object:
        return (z * z).sum(axis=axis)
    a, b, c = z >> (2 * LIMB), (z >> LIMB) & _MASK, z & _MASK
    parts = ((c * c), 2 * (b * c), 2 * (a * c) + b * b, 2 * (a * b), a * a)
    return sum(p.sum(axis=axis).astype(object) << (LIMB * k) for k, p in enumerate(parts))


def pairs(d: int) -> list[tuple[int, int]]:
    """(i, i) stands for dimension i alone, (i, j) for the sum of both."""
    return [(i, j) for i in range(d) for j in range(i, d)]


def squares(fit: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """pair, total: exact sums of the squared centred values (n * x - sums) of
    each dimension and each sum of two, pairs numbered as in ``pairs``; totals as
    low + 2^84 * high."""
    d = len(sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d * (d + 1) // 2, object)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                y = centred(matrix(batch.column("x").slice(lo, ROWS)), n, sums)
                at = 0
                for i in range(d):
                    z = y[:, i:] + y[:, i : i + 1]
                    z[:, 0] = y[:, i]
                    total[at : at + d - i] += square_sums(z, 0)
                    at += d - i
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_pydict(
            {
                "pair": pa.array(range(len(total)), pa.int64()),
                "low": pa.array([Decimal(int(t) & ((1 << _HALF) - 1)) for t in total], kind),
                "high": pa.array([Decimal(int(t) >> _HALF) for t in total], kind),
            }
        )

    parts = fit.mapInArrow(add, "pair long, low decimal(38,0), high decimal(38,0)")
    return parts.groupBy("pair").agg(F.expr("sum(low) AS low"), F.expr("sum(high) AS high"))


def covariance(totals: dict[int, int], d: int, n: int) -> np.ndarray:
    """The covariance matrix (divisor n) from the totals of ``squares``; each
    entry is an exact fraction, rounded once."""
    at = {p: totals[k] for k, p in enumerate(pairs(d))}
    v = np.zeros((d, d))
    for (i, j), t in at.items():
        cross = t if i == j else (t - at[i, i] - at[j, j]) // 2
        v[i, j] = v[j, i] = cross / n**3
    return v


def whitened(x: np.ndarray, model: Model, k: int) -> np.ndarray:
    """The first k components of vectors (rows), NaN where a component has no variance."""
    scale = np.where(model.usable, model.values, np.nan)[:k]
    return (centred(x, model.n, model.sums).astype(np.float64) / model.n) @ model.vectors[:, :k] / np.sqrt(scale)


def fit_model(rows: DataFrame, components: int = 4) -> Model | None:
    """Fit on each different x of ``rows`` (see ``whole_vectors``) once. None
    without rows. Components whose eigenvalue is 0, to rounding, have no variance."""
    fit = written(rows.select("x").distinct(), "whitening-fit")
    sums = {
        r.pos: (int(r.total), r.n)
        for r in fit.select(F.posexplode("x")).groupBy("pos").agg(F.expr("sum(CAST(col AS DECIMAL(19,0))) AS total"), F.expr("count(1) AS n")).collect()
    }
    if not sums:
        return None
    d, n = len(sums), sums[0][1]
    centre = [sums[k][0] for k in range(d)]
    totals = {r.pair: int(r.low) + (int(r.high) << _HALF) for r in squares(fit, n, centre).collect()}
    v = covariance(totals, d, n)
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    # Either sign would do; the largest entry of a component is made positive.
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(d)] < 0, -1.0, 1.0)
    usable = values > d * np.finfo(float).eps * max(values[0], 0.0)
    model = Model(n, centre, values, vectors, float(np.trace(v)), usable)
    return Model(n, centre, values, vectors, model.trace, usable, identity_error(fit, model, min(components, d)))


def identity_error(fit: DataFrame, model: Model, k: int) -> float | None:
    """Largest absolute entry of the whitened covariance minus the identity, over
    the vectors of the fit and those of the first k components that have variance."""
    keep = [c for c in range(k) if model.usable[c]]
    if not keep:
        return None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, mean = np.zeros((len(keep), len(keep))), np.zeros(len(keep))
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                w = whitened(matrix(batch.column("x").slice(lo, ROWS)), model, k)[:, keep]
                total, mean = total + w.T @ w, mean + w.sum(axis=0)
        both = np.vstack([total, mean])
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(both.size), pa.int64()), "value": pa.array(both.ravel())})

    parts = fit.mapInArrow(add, "at long, value double").groupBy("at").agg(F.expr("sum(value) AS value")).collect()
    both = np.zeros(len(keep) * (len(keep) + 1))
    both[[r["at"] for r in parts]] = [r["value"] for r in parts]
    both = both.reshape(-1, len(keep)) / model.n
    return float(np.abs(both[:-1] - np.outer(both[-1], both[-1]) - np.eye(len(keep))).max())


def whiten(rows: DataFrame, model: Model, components: int | None = None) -> DataFrame:
    """vec_id, deviation (sum over dimensions of (n * x - sums)^2, exact), and
    whitened, the first ``components`` components (None: all) of every row of
    ``rows`` (see ``whole_vectors``); null where a component has no variance."""
    k = len(model.sums) if components is None else min(components, len(model.sums))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                x = matrix(part.column("x"))
                w = whitened(x, model, k)
                flat = pa.array(w.ravel(), mask=np.isnan(w).ravel())
                far = square_sums(centred(x, model.n, model.sums), 1)
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": part.column("vec_id"),
                        "deviation": pa.array([Decimal(int(t)) if t < 10**38 else None for t in far], pa.decimal128(38, 0)),
                        "whitened": pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), flat),
                    }
                )

    return rows.mapInArrow(project, "vec_id long, deviation decimal(38,0), whitened array<double>")


def report(embeddings: DataFrame, components: int = 4) -> DataFrame:
    """One row for each vector that ``whole_vectors`` keeps and each of the first
    ``components`` components (fewer, if there are fewer dimensions): vec_id,
    component (from 1), n, deviation (null beyond 64 bits), whitened and explained
    (both null without variance, as where all vectors are equal), identity_error.
    An empty table and vectors without entries give no rows."""
    rows = whole_vectors(embeddings)
    model = fit_model(rows, components)
    if model is None:
        none = "vec_id, 0 AS component, 0L AS n, 0L AS deviation, 0D AS whitened, 0D AS explained, 0D AS identity_error"
        return rows.filter("false").selectExpr(*none.split(", "))
    k = min(components, len(model.sums))
    known = model.trace > 0
    explained = ", ".join(f"{max(float(e), 0.0) / model.trace!r}D" if known else "CAST(NULL AS DOUBLE)" for e in model.values[:k])
    error = "CAST(NULL AS DOUBLE)" if model.identity_error is None else f"{model.identity_error!r}D"
    return whiten(rows, model, components).selectExpr("vec_id", "deviation", "posexplode(whitened) AS (at, whitened)").selectExpr(
        "vec_id", "at + 1 AS component", f"{model.n}L AS n", "try_cast(deviation AS BIGINT) AS deviation", "whitened",
        f"array({explained})[at] AS explained", f"{error} AS identity_error",
    )
