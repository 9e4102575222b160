"""Embedding whitening by polarisation covariance (operator 12).

An entry c becomes the integer x = floor(256 * c); the fit list has each distinct integer vector once. Covariances
come from variances alone: for every dimension i and every pair of dimensions i < j, the squares of the centred x_i and of the
centred sum x_i + x_j are added up, and cov(i, j) = (var(x_i + x_j) - var(x_i) - var(x_j)) / 2. All of it is exact: with n
vectors, sums S and m = floor(S / n), the centred value n*x - S is n*u - R for the integer u = x - m and R = S - n*m; a task adds up
the squares of u_i + u_j in 64-bit integers, Spark adds the tasks' figures as decimals, and
sum((n*v - R)^2) = n^2 * sum(v^2) - n * R^2 for v = u_i + u_j, R = R_i + R_j, in whole numbers on the driver. Only then comes
one division. The d x d matrix goes to ``numpy.linalg.eigh``; d*(d+1)/2 numbers are all that reaches the driver.

Distinct vectors are found by one shuffle of the integers, keyed by the whole vector; equal vectors meet before it in
partial aggregates, so that a vector that makes up a third of all rows is a row for each task.

Defined results: a vector that is null, or holds a null, NaN or infinite entry, has no row. Repeated rows have a
result each and count once in the fit list. A component whose eigenvalue is zero to the precision of the largest one has whitened
null (there is nothing to scale); ``identity_error`` is over the others. There are fewer than ``top`` components where vectors are shorter. An
empty table gives an empty result. Extra columns are ignored. Vectors of different lengths are an error. ``deviation`` is exact
as a decimal; as a long it is null where it does not fit one.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, col
from .vector_codes import usable

SCALE = 256
TOP = 4
#: Rows of a batch that are taken at a time.
_ROWS = 4096
_LONG = 2**63 - 1


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of integer vectors of one length as rows."""
    widths = np.diff(column.offsets.to_numpy())
    if len(widths) and widths.min() != widths.max():
        raise ValueError("vectors of different lengths")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(widths), widths[0] if len(widths) else 0)


def _pairs(width: int) -> tuple[np.ndarray, np.ndarray]:
    """The dimensions (i = j) and the pairs (i < j), row by row."""
    return np.triu_indices(width)


def _squares(u: np.ndarray) -> list[int]:
    """Sums of (u_i)^2 and (u_i + u_j)^2 over the rows, in the order of ``_pairs``."""
    most = int(np.abs(u).max(initial=0))
    if 4 * most * most * len(u) > _LONG:
        if len(u) > 1 and 4 * most * most * 2 <= _LONG:  # fewer rows at a time
            half = len(u) // 2
            return [a + b for a, b in zip(_squares(u[:half]), _squares(u[half:]), strict=True)]
        u = u.astype(object)
    out: list[int] = []
    for i in range(u.shape[1]):
        v = u[:, i:] + u[:, i : i + 1]
        v[:, 0] = u[:, i]
        out.extend(map(int, (v * v).sum(0)))
    return out


class Whitening:
    """n, sums and the leading components of the fit list; whitens any vectors of that width."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, top: int = TOP):
        self.n, self.sums, self.covariance = n, sums, covariance
        values, vectors = np.linalg.eigh(covariance)
        self.trace = float(np.trace(covariance))
        self.values = values[::-1][:top]
        self.vectors = vectors[:, ::-1][:, :top]  # by column
        least = values[-1] * len(values) * np.finfo(float).eps if len(values) else 0.0
        self.real = self.values > max(least, 0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exact: 64-bit integers where they suffice, whole Python numbers otherwise."""
        if self.n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, self.sums), default=0) > _LONG:
            x = x.astype(object)
        return x * self.n - np.array(self.sums, x.dtype)

    def deviation(self, z: np.ndarray) -> list[int]:
        """The sum over dimensions of squares, exact."""
        most = int(np.abs(z).max(initial=0))
        if most * most * max(1, z.shape[1]) > _LONG:
            z = z.astype(object)
        return [int(v) for v in (z * z).sum(1)]

    def project(self, z: np.ndarray) -> np.ndarray:
        """The whitened components of rows; NaN where a component has no variance."""
        out = (z / self.n).astype(float) @ self.vectors
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.real, out / np.sqrt(np.where(self.real, self.values, np.nan)), np.nan)


def integers(vectors: DataFrame, vector_col: str, scale: int = SCALE) -> DataFrame:
    """The usable rows with ``x``, the floored integers of the vector."""
    given = vectors.withColumn("x", col(vector_col).cast("array<double>"))
    return given.filter(usable(F.col("x"))).withColumn("x", F.transform("x", lambda c: F.floor(c * scale).cast("long")))


def fit(fit_list: DataFrame, top: int = TOP) -> Whitening | None:
    """Fit on the distinct vectors ``x``, a stored table; None for an empty one."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            x = _matrix(batch.column(0))
            if sums is not None and x.shape[1] != len(sums):
                raise ValueError("vectors of different lengths")
            big = x.astype(object) if int(np.abs(x).max(initial=0)) * len(x) > _LONG else x
            more = [int(v) for v in big.sum(0)]
            n, sums = n + len(x), more if sums is None else [a + b for a, b in zip(sums, more, strict=True)]
        if n:
            yield _rows([n, *sums], "i", "value")

    def squared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _matrix(batch.column(0)) - shift
            for at in range(0, len(x), _ROWS):
                more = _squares(x[at : at + _ROWS])
                total = more if total is None else [a + b for a, b in zip(total, more, strict=True)]
        if total:
            yield _rows(total, "i", "value")

    def total(task) -> list[int]:
        rows = (fit_list.select("x").mapInArrow(task, "i int, value decimal(38,0)").groupBy("i")
                        .agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("tasks")).collect())
        if len({r["tasks"] for r in rows}) > 1:
            raise ValueError("vectors of different lengths")
        return [int(r["value"]) for r in sorted(rows, key=lambda r: r["i"])]

    found = total(summed)  # n, then the sum of each dimension
    if not found:
        return None
    n, sums = found[0], found[1:]
    width, shift = len(sums), np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    i, j = _pairs(width)
    spread = total(squared) if width else []
    variance = {}  # of n*x_i - S_i and of the sums, times n: whole numbers
    for a, b, q in zip(i.tolist(), j.tolist(), spread, strict=True):
        r = rest[a] + (rest[b] if a != b else 0)
        variance[a, b] = n * n * q - n * r * r
    covariance = np.zeros((width, width))
    for (a, b), v in variance.items():
        whole = Fraction(v) if a == b else Fraction(v - variance[a, a] - variance[b, b], 2)
        covariance[a, b] = covariance[b, a] = float(whole / n**3)
    return Whitening(n, sums, covariance, top)


def _rows(values: list[int], index: str, value: str) -> pa.RecordBatch:
    from decimal import Decimal

    return pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(map(Decimal, values), pa.decimal128(38, 0))], [index, value])


def whiten(rows: DataFrame, model: Whitening, id_col: str = "vec_id") -> DataFrame:
    """vec_id, deviation (exact decimal), whitened (an array of the leading components; null where there is no variance)."""
    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                piece = batch.slice(at, _ROWS)
                z = model.centred(_matrix(piece.column(1)))
                shown = model.project(z)
                flat = pa.array(shown.reshape(-1), mask=np.isnan(shown.reshape(-1)))
                offsets = pa.array(np.arange(len(z) + 1) * shown.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(map(Decimal, model.deviation(z)), pa.decimal128(38, 0)),
                                                  pa.ListArray.from_arrays(offsets, flat)], ["vec_id", "deviation", "whitened"])

    given = rows.select(col(id_col).cast("long").alias("vec_id"), "x")
    return given.mapInArrow(projected, "vec_id long, deviation decimal(38,0), whitened array<double>")


def identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity, as measured on it."""
    shown = whiten(fit_list.select(F.lit(0).alias("vec_id"), "x"), model)
    real = [int(k) for k in np.flatnonzero(model.real)]
    if not real:
        return 0.0
    pairs = [(a, b) for a in real for b in real if a <= b]
    found = shown.agg(*(F.covar_pop(F.col("whitened")[a], F.col("whitened")[b]) for a, b in pairs)).first()  # centred as it goes
    return max(abs(v - (a == b)) for (a, b), v in zip(pairs, found, strict=True))


def whitened_table(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", top: int = TOP) -> DataFrame:
    """For each usable row and leading component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    kept = integers(vectors.select(col(id_col).alias("vec_id"), col(vector_col).alias("vector")), "vector")
    scratch = Scratch(spark, "whitening")
    fit_list = scratch.stage(kept.select("x").distinct(), "fit")
    model = fit(fit_list, top)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        scratch.drop("")
        return spark.createDataFrame([], schema)
    error = identity_error(fit_list, model)
    scratch.drop("")  # the result is computed from the input itself
    explained = [float(v) / model.trace if model.trace else 0.0 for v in np.maximum(model.values, 0.0)]
    share = F.array(*map(F.lit, explained)).cast("array<double>")
    return (whiten(kept, model).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
            .select("vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                    F.expr("try_cast(deviation AS bigint)").alias("deviation"), "whitened",
                    share[F.col("place")].alias("explained"), F.lit(error).alias("identity_error")))
