"""Whitening of embeddings by MLlib's computeSVD over their centred, distributed rows.

An entry c becomes the long x = floor(scale * c). The fit list holds each distinct x vector once, n in all, with per-dimension sums S. Its rows,
centred, are a distributed RowMatrix; the right singular vectors are the components, and a singular value s gives the variance e = s^2 / n. All
components are asked for, so that MLlib sums the Gram matrix on the executors (as it does below 15,000 dimensions) and takes its vectors by LAPACK to double precision,
not by an iteration with a tolerance. The total variance does not come from the singular values: it is the sum of the exact integers (n*x - S)^2 over n^3.

With q = S div n and r = S mod n a centred entry is (x - q) - r/n: the difference of longs is exact, so large means cost no digits, and n*x - S = n*(x - q) - r.

Nothing but sums per dimension (d), a d x d Gram matrix and a k x k check reach the driver, whatever the number of rows. The fit list is written to the
shared folder once, as it is read three times. Equal vectors are collapsed on the map side of the one shuffle.

Defined results: rows whose vector is null, holds a null, a NaN or an infinity, or an entry with |scale * c| >= 2^62, are dropped, and so are vectors without entries
and those of another length than most distinct vectors have (of equal counts, the longest). Repeated rows each get their result. Components without
variance (e below 1e-14 of the largest, which double precision can't tell from 0) don't exist, so fewer than k come back where the fit list has a lower rank, and
none where it has fewer than two vectors. A deviation beyond 64 bits is null; the sums that use it are exact all the same. Extra columns don't enter.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, release, written

#: Sums that may pass 64 bits travel as decimals of 38 digits, those that may pass these too in two parts.
_PART = 10**18
_EXACT = pa.decimal128(38, 0)
LARGEST = float(1 << 62)


class Whitening(NamedTuple):
    """What the fit gives: vectors in the list, q and r of their sums, components (k x d), their variances, the total variance."""

    n: int
    quotients: np.ndarray
    rests: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    total: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.quotients).astype(np.float64) - self.rests / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.variances)


def deviations(x: np.ndarray, n: int, q: np.ndarray, r: np.ndarray) -> list[int]:
    """The sums over dimensions of (n*x - S)^2, exact: in 64 bits where the largest entry proves that they fit, else in Python's integers."""
    y = x - q
    most = int(np.abs(y).max(initial=0)) + 1
    if (n * most) ** 2 * len(q) < 1 << 62:
        return ((n * y - r) ** 2).sum(axis=1).tolist()
    wide = y.astype(object) * n - r
    return (wide * wide).sum(axis=1).tolist()


def integer_vectors(rows: DataFrame, vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """The rows with a defined x, as the column x (array<long>) beside their own."""
    sound = F.forall(vec_col, lambda c: F.coalesce(F.abs(c.cast("double")) * F.lit(float(scale)) < F.lit(LARGEST), F.lit(False)))
    return rows.where(F.col(vec_col).isNotNull() & sound & (F.size(vec_col) > 0)).withColumn("x", F.transform(vec_col, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long")))


def _x(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _exact_sums(x: np.ndarray) -> np.ndarray:
    """Column sums as Python integers."""
    most = int(np.abs(x).max(initial=0))
    return x.sum(axis=0).astype(object) if most * max(1, len(x)) < 1 << 62 else x.astype(object).sum(axis=0)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """How many rows, and the sums of their x."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(d, object)
        for batch in batches:
            x = _x(batch, d)
            n, sums = n + len(x), sums + _exact_sums(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([Decimal(int(v)) for v in (n, *sums)], _EXACT)], names=["at", "v"])

    found = {r.at: int(r.v) for r in fit.select("x").mapInArrow(add, "at int, v decimal(38,0)").groupBy("at").agg(F.sum("v").alias("v")).collect()}
    return found.get(-1, 0), [found.get(j, 0) for j in range(d)]


def _total(fit: DataFrame, n: int, q: np.ndarray, r: np.ndarray) -> float:
    """The total variance of the fit list from its exact deviations."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(sum(deviations(_x(batch, len(q)), n, q, r)) for batch in batches)
        yield pa.RecordBatch.from_arrays([pa.array([Decimal(total // _PART)], _EXACT), pa.array([Decimal(total % _PART)], _EXACT)], names=["high", "low"])

    got = fit.select("x").mapInArrow(add, "high decimal(38,0), low decimal(38,0)").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).first()
    return float(Fraction(int(got.high) * _PART + int(got.low), n**3))


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    d, k = model.components.shape[1], len(model.variances)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.whitened(_x(batch, d))
            first, second = first + w.sum(axis=0), second + w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k + k * k), pa.int32()), pa.array(np.concatenate((first, second.ravel())))], names=["at", "v"])

    sums = {r.at: r.v for r in fit.select("x").mapInArrow(add, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()}
    means = np.array([sums[j] for j in range(k)]) / model.n
    second = np.array([sums[k + j] for j in range(k * k)]).reshape(k, k) / model.n
    return float(np.abs(second - np.outer(means, means) - np.eye(k)).max())


def fit_whitening(vectors: DataFrame, k: int = 4) -> tuple[Whitening, float] | None:
    """The whitening of the distinct x of integer_vectors() and its identity error; None without any variance. k: components that are kept."""
    distinct = written(vectors.select("x").distinct().withColumn("d", F.size("x")))
    try:
        lengths = distinct.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
        if not lengths:
            return None
        d = lengths[0].d
        fit = distinct.where(F.col("d") == d)
        n, sums = _sums(fit, d)
        q = np.array([s // n for s in sums], np.int64)
        r = np.array([s % n for s in sums], np.int64)
        total = _total(fit, n, q, r)
        if not total:
            return None
        shift = F.zip_with(F.zip_with("x", F.lit(q.tolist()), lambda a, b: (a - b).cast("double")), F.lit((r / n).tolist()), lambda a, b: a - b)
        rows = MLUtils.convertVectorColumnsFromML(fit.select(array_to_vector(shift).alias("v")), "v")
        found = RowMatrix(rows, n, d).computeSVD(d, computeU=False, rCond=1e-7)
        variances = found.s.toArray() ** 2 / n
        keep = min(k, len(variances))
        model = Whitening(n, q, r, np.ascontiguousarray(found.V.toArray().T[:keep]), variances[:keep], total)
        return model, _identity_error(fit, model)
    finally:
        dropped(distinct)


#: The rows of whitened(), after the id.
RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", k: int = 4, scale: int = 256) -> DataFrame:
    """One row for each row with a defined x and each component: the id, component, n, deviation, whitened, explained and identity_error."""
    vectors = integer_vectors(rows.select(id_col, vec_col), vec_col, scale).select(id_col, "x")
    schema = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, {RESULT}"
    fitted = fit_whitening(vectors, k)
    if fitted is None:
        return rows.sparkSession.createDataFrame([], schema)
    model, error = fitted
    explained = model.variances / model.total
    d, count = model.components.shape[1], len(model.variances)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, at = _x(batch, d), np.repeat(np.arange(batch.num_rows), count)
            devs = pa.array([v if v < 1 << 63 else None for v in deviations(x, model.n, model.quotients, model.rests)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(at), model.n, np.int64)),
                    devs.take(pa.array(at)),
                    pa.array(model.whitened(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(at), error)),
                ],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )
        release()

    return vectors.where(F.size("x") == d).mapInArrow(project, schema)
