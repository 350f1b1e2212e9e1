"""Whitening of embeddings: fixed-point vectors, exact covariance, components by contour integration.

A component c of a vector becomes the whole number floor(256 c). Over the distinct whole vectors (the fit list) the sums and
the products are exact: each task adds up whole numbers around the rounded mean, and one row per pair of dimensions
and task is shuffled. The covariance is their exact quotient, so neither a far mean nor the order of rows costs digits.
What reaches the driver is bounded by the square of the dimension. ``feast`` finds the components; a pass over the fit list
measures how far the covariance of the whitened vectors is from the identity.

Distinct vectors are found by a hash aggregate, which drops copies before the shuffle: a vector held by a third of the rows costs nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.llm import feast
from tracklens.session import written

COMPONENTS = 4
SCALE = 256
LARGEST = 1 << 45
LIMB = 20


def whole(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a list column with ``size`` usable entries, and their whole vectors."""
    fits = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), size), False).to_numpy(zero_copy_only=False))
    flat = column.take(pa.array(fits)).flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False).reshape(len(fits), size)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(SCALE * values) + 0.0
        good = (np.abs(scaled) <= LARGEST).all(axis=1)  # false for NULL, NaN and infinity
    return fits[good], scaled[good].astype(np.int64)


def _packed(x: np.ndarray) -> list[bytes]:
    """Whole vectors as bytes, each in the narrowest of three widths that holds it, so that equal vectors have equal bytes."""
    most = np.abs(x).max(axis=1, initial=0)
    width = np.where(most < 1 << 15, 2, np.where(most < 1 << 31, 4, 8))
    out: list[bytes] = [b""] * len(x)
    for w in (2, 4, 8):
        rows = np.flatnonzero(width == w)
        raw, step = x[rows].astype(f"<i{w}").tobytes(), w * x.shape[1]
        for k, row in enumerate(rows.tolist()):
            out[row] = raw[k * step : (k + 1) * step]
    return out


def _unpacked(column: pa.Array, size: int) -> np.ndarray:
    values = column.to_pylist()
    out = np.empty((len(values), size), dtype=np.int64)
    lengths = np.array([len(v) for v in values])
    for w in (2, 4, 8):
        rows = np.flatnonzero(lengths == w * size)
        out[rows] = np.frombuffer(b"".join([values[r] for r in rows.tolist()]), f"<i{w}").reshape(-1, size)
    return out


def fit_list(vectors: Column, df: DataFrame) -> DataFrame:
    """``d, x``: every distinct whole vector once, with its dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            sizes = pc.unique(pc.list_value_length(column)).to_pylist()
            for size in sizes:
                if size:
                    x = _packed(whole(column, size)[1])
                    dims = pa.array([size] * len(x), pa.int32())
                    yield pa.RecordBatch.from_arrays([dims, pa.array(x, pa.binary())], names=["d", "x"])

    return df.select(vectors.cast("array<double>").alias("v")).mapInArrow(run, "d int, x binary").distinct()


def _products(y: np.ndarray) -> np.ndarray:
    """The exact sums of products of whole numbers: limbs so narrow that no sum of doubles is rounded."""
    d = y.shape[1]
    total = np.zeros((d, d), dtype=object)
    for at in range(0, len(y), 4096):
        rest, limbs = y[at : at + 4096], []
        while rest.any() and not ((rest == -1) | (rest == 0)).all():
            limbs.append((rest & ((1 << LIMB) - 1)).astype(np.float64))
            rest = rest >> LIMB
        limbs.append(rest.astype(np.float64))  # the sign: 0 or -1
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


@dataclass(frozen=True)
class Model:
    """What whitening needs: the fit list's size and sums, and the components with their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def size(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exact."""
        reach = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        if reach < 1 << 62:
            return self.n * x - np.array(self.sums, dtype=np.int64)
        return self.n * x.astype(object) - np.array(self.sums, dtype=object)

    def deviation(self, centred: np.ndarray) -> list[int]:
        most = int(np.abs(centred).max(initial=0))
        if self.size * most * most >= 1 << 63:
            centred = centred.astype(object)
        return (centred * centred).sum(axis=1).tolist()

    def project(self, centred: np.ndarray) -> np.ndarray:
        """Whitened values, one column per component."""
        return (centred / self.n).astype(np.float64) @ self.vectors / np.sqrt(self.values)


def _sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """By dimension, how many vectors the fit list has and the sums of their entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy(zero_copy_only=False)
            for size in np.unique(dims).tolist():
                x = _unpacked(batch.column(1).filter(pa.array(dims == size)), size)
                held = totals.setdefault(size, [0, np.zeros(size, dtype=object)])
                held[0] += len(x)
                held[1] = held[1] + x.sum(axis=0).astype(object)
        rows = [(d, j, Decimal(int(s))) for d, (n, sums) in totals.items() for j, s in enumerate([n, *sums])]
        yield _rows(rows, [pa.int32(), pa.int32(), pa.decimal128(38, 0)], ["d", "j", "s"])

    made = fit.mapInArrow(run, "d int, j int, s decimal(38,0)").groupBy("d", "j").agg(F.sum("s").alias("s"))
    out: dict[int, tuple[int, list[int]]] = {}
    for row in made.orderBy("d", "j").collect():  # a row per dimension and entry
        if row.j == 0:
            out[row.d] = (int(row.s), [])
        else:
            out[row.d][1].append(int(row.s))
    return out


def _rows(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names
    )


def fit(fit: DataFrame, components: int = COMPONENTS) -> Model | None:
    """The model of a fit list (``d, x``); None when it is empty.

    The dimension is that of most of its vectors, the larger one in a tie. There are fewer components where the vectors span
    fewer dimensions, none where they are all equal.
    """
    by_size = _sums(fit)
    if not by_size:
        return None
    size = max(by_size, key=lambda d: (by_size[d][0], d))
    n, sums = by_size[size]
    middle = [(2 * s + n) // (2 * n) for s in sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), dtype=object)
        around = np.array(middle, dtype=np.int64)
        for batch in batches:
            total = total + _products(_unpacked(batch.column(1), size) - around)
        rows = [(i, j, Decimal(int(total[i, j]))) for i in range(size) for j in range(i, size)]
        yield _rows(rows, [pa.int32(), pa.int32(), pa.decimal128(38, 0)], ["i", "j", "s"])

    made = fit.where(F.col("d") == size).mapInArrow(run, "i int, j int, s decimal(38,0)")
    rest = [s - n * m for s, m in zip(sums, middle, strict=True)]
    covariance, trace = np.zeros((size, size), dtype=np.longdouble), 0
    for row in made.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():  # a row per pair of dimensions
        above = n * int(row.s) - rest[row.i] * rest[row.j]
        high = above // (n * n)
        # the whole part and the fraction apart keep the digits of extended precision
        covariance[row.i, row.j] = covariance[row.j, row.i] = np.longdouble(high) + np.longdouble(
            (above - high * n * n) / (n * n)
        )
        trace += above if row.i == row.j else 0
    values, vectors = feast.largest(covariance, components)
    return Model(n, tuple(sums), values, vectors, trace / (n * n))


def identity_error(fit: DataFrame, model: Model) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.values)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.project(model.centred(_unpacked(batch.column(1), model.size)))
            sums, products = sums + w.sum(axis=0), products + w.T @ w
        rows = [(i, j, float(products[i, j])) for i in range(k) for j in range(k)]
        rows += [(i, -1, float(sums[i])) for i in range(k)]
        yield _rows(rows, [pa.int32(), pa.int32(), pa.float64()], ["i", "j", "s"])

    made = fit.where(F.col("d") == model.size).mapInArrow(run, "i int, j int, s double")
    cells = {(r.i, r.j): r.s for r in made.groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}
    mean = np.array([cells[i, -1] for i in range(k)]) / model.n  # rounding apart 0: the values are centred already
    covariance = np.array([[cells[i, j] for j in range(k)] for i in range(k)]) / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


SCHEMA = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def whiten(
    df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """One row per usable row and component: the columns of ``SCHEMA``.

    A vector takes no part if it is NULL or empty, holds an entry that is NULL, not finite or too large for fixed point (beyond
    2 to the 45th after scaling), or has another dimension than most. Repeated rows are whitened each, and count once
    in the fit list, as equal vectors of different ids do. Without usable rows, or where all vectors are equal, there are no rows. A NULL
    id stays NULL. Other columns of the input are ignored.
    """
    spark = df.sparkSession
    distinct = written(fit_list(F.col(f"`{vec_col}`"), df), "fit-list")
    model = fit(distinct, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], SCHEMA)
    error = identity_error(distinct, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        share = model.values / model.trace
        for batch in batches:
            rows, x = whole(batch.column(1), model.size)
            centred = model.centred(x)
            ids = batch.column(0).take(pa.array(np.repeat(rows, k)))
            deviation = np.repeat(np.array(model.deviation(centred), dtype=object), k)
            m = len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, dtype=np.int64)),
                    pa.array([Decimal(v) for v in deviation.tolist()], pa.decimal128(38, 0)),
                    pa.array(model.project(centred).reshape(-1)),
                    pa.array(np.tile(share, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    picked = df.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    return picked.mapInArrow(run, SCHEMA)
