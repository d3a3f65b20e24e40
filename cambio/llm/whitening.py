"""Embedding whitening: rows projected on the leading principal components, each scaled to unit variance.

Entries are made whole numbers, so sums are exact whatever the order of addition. Mean and covariance are of every
different vector once. Spark finds the different vectors and adds up their sums and products; the covariance matrix, whose
size depends on the number of dimensions alone, is decomposed on the driver by :mod:`cambio.llm.feast`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cambio.llm.common import map_rows, written
from cambio.llm.feast import leading_pairs

COMPONENTS = 16
FACTOR = 64
OFFSET = 1_000_000
#: Entries beyond this, after the factor, take it: sums of a task's rows stay within 64 bits.
EDGE = float(1 << 40)
DEVIATION = pa.decimal128(38, 0)


def whole_entries(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, x) of the rows whose vector is there and holds only finite entries: floor(FACTOR * c) + OFFSET."""

    def finite(c: Column) -> Column:
        return F.coalesce(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))

    def whole(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c * FACTOR, F.lit(EDGE)), F.lit(-EDGE))).cast("bigint") + F.lit(OFFSET)

    named = rows.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    kept = named.where(F.col("c").isNotNull() & F.forall("c", finite))
    return kept.select("vec_id", F.transform("c", whole).alias("x"))


def _filled(dims: int) -> Column:
    """Vectors of one length: a shorter one is filled up with what a zero entry becomes."""
    zeros = F.array_repeat(F.lit(OFFSET).cast("bigint"), F.lit(dims) - F.size("x"))
    return F.when(F.size("x") < dims, F.concat("x", zeros)).otherwise(F.col("x")).alias("x")


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dims)


@dataclass
class Whitening:
    """The fitted projection. ``sums`` over ``n`` different vectors, per dimension; components are columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    exact: bool  # whether deviations fit 64 bits
    identity_error: float = 0.0

    @property
    def dims(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x minus the mean: the whole part of the mean is taken off exactly."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        return (x - whole) - np.array([s % self.n / self.n for s in self.sums])

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sum over the dimensions of (n x - S) ** 2, exact."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        if self.exact:
            apart = self.n * (x - whole) - rest
            return pa.array((apart * apart).sum(axis=1)).cast(DEVIATION)
        apart = self.n * (x - whole).astype(object) - rest.astype(object)
        return pa.array([str(d) for d in (apart * apart).sum(axis=1)], pa.string()).cast(DEVIATION)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values))


def added_up(vectors: DataFrame, size: int, of: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum over all batches of a vector of ``size`` numbers, by task first; ``size`` rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += of(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["place", "value"])

    parts = map_rows(vectors.select("x"), run, "place bigint, value double")
    found = parts.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(size)
    out[found["place"].to_numpy()] = found["value"].to_numpy()
    return out


def column_sums(vectors: DataFrame, dims: int) -> tuple[int, list[tuple[int, int, int]]]:
    """Number of vectors, and per dimension (sum, least, largest) of whole numbers; one row a dimension reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, dims)
                columns = [np.arange(dims), np.full(dims, len(x)), x.sum(axis=0), x.min(axis=0), x.max(axis=0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["place", "n", "total", "least", "most"]
                )

    parts = map_rows(vectors.select("x"), run, "place bigint, n bigint, total bigint, least bigint, most bigint")
    # sums of all tasks may pass 64 bits
    whole = F.sum(F.col("total").cast("decimal(20,0)")).alias("total")
    rows = (
        parts.groupBy("place")
        .agg(F.sum("n").alias("n"), whole, F.min("least").alias("least"), F.max("most").alias("most"))
        .orderBy("place")
        .collect()
    )
    return (rows[0].n if rows else 0), [(int(r.total), r.least, r.most) for r in rows]


def _triangle(dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(dims)


def _symmetric(values: np.ndarray, dims: int) -> np.ndarray:
    out = np.zeros((dims, dims))
    out[_triangle(dims)] = values
    return out + np.triu(out, 1).T


def fit(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The projection on the leading components of all different vectors; None without vectors.

    Copies collapse in each task before the one shuffle. The driver receives sums by dimension and by pair of dimensions.
    """
    x = whole_entries(rows, vec_id, vector)
    dims = x.agg(F.max(F.size("x"))).first()[0]
    if not dims:
        return None
    different = written(x.select(_filled(dims)).distinct(), "different-vectors")
    n, columns = column_sums(different, dims)
    sums = [total for total, _, _ in columns]
    widest = max(max(abs(n * most - total), abs(n * least - total)) for total, least, most in columns)
    nothing = np.empty(0), np.empty((dims, 0))
    model = Whitening(n, sums, *nothing, 0.0, exact=dims * (widest + n) ** 2 < 1 << 62)
    pairs = dims * (dims + 1) // 2
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def products(batch: pa.RecordBatch) -> np.ndarray:
        apart = shared.value.centred(_matrix(batch, dims))
        return (apart.T @ apart)[_triangle(dims)]

    covariance = _symmetric(added_up(different, pairs, products) / n, dims)
    model.values, model.components = leading_pairs(covariance, components)
    model.trace = float(np.trace(covariance))
    model.identity_error = _identity_error(different, model)
    return model


def _identity_error(different: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    k, dims = len(model.values), model.dims
    if not k:
        return 0.0
    shared = different.sparkSession.sparkContext.broadcast(model)

    def products(batch: pa.RecordBatch) -> np.ndarray:
        w = shared.value.project(_matrix(batch, dims))
        return np.r_[w.sum(axis=0), (w.T @ w)[_triangle(k)]]

    total = added_up(different, k + k * (k + 1) // 2, products) / model.n
    covariance = _symmetric(total[k:], k) - np.outer(total[:k], total[:k])
    return float(np.abs(covariance - np.eye(k)).max())


PROJECTED_SCHEMA = "vec_id bigint, deviation decimal(38,0), whitened array<double>"


def project(rows: DataFrame, model: Whitening, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """PROJECTED_SCHEMA of every row with a usable vector: its distance from the mean, and its whitened components."""
    shared, dims = rows.sparkSession.sparkContext.broadcast(model), model.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, dims)
            w = shared.value.project(x)
            offsets = pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32())
            columns = [
                batch.column("vec_id"),
                shared.value.deviations(x),
                pa.ListArray.from_arrays(offsets, pa.array(w.ravel())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "deviation", "whitened"])

    x = whole_entries(rows, vec_id, vector)
    return map_rows(x.select("vec_id", _filled(dims)), run, PROJECTED_SCHEMA)


WHITENED_SCHEMA = (
    "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, "
    "identity_error double"
)


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """WHITENED_SCHEMA: a row for each row with a usable vector and each component, components numbered from 1.

    A null vector, or one with a null or non-finite entry, has no rows; neither has any vector if all are equal, as there
    is no component then. Directions without variance are no components, so there may be fewer than asked for. A vector
    shorter than the longest, an empty one included, counts as filled up with zeros; entries beyond EDGE / FACTOR take
    that value. Repeated rows are answered repeatedly and count once in the fit, a null id stays null, other columns are
    not read, an empty table gives no rows. Of equal eigenvalues any orthonormal basis is an answer.
    """
    model = fit(rows, vec_id, vector, components)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], WHITENED_SCHEMA)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    exploded = project(rows, model, vec_id, vector).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "w"))
    return exploded.select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        F.col("w").alias("whitened"),
        F.get(explained, F.col("k")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
