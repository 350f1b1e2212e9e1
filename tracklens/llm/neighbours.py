"""Approximate nearest neighbours by stable projections and kd-trees with a chi-square stop.

Vectors are normalised, so the largest cosine is the smallest distance, and projected to ``DIMENSIONS`` by a
seeded Gaussian matrix. For two vectors at distance r the squared projected distance over r^2 follows a chi-square
law with as many degrees of freedom. A query takes vectors in the order of their projected distance and verifies
each on the original components; it stops when a vector closer than the k-th best would, with probability
``CONFIDENCE`` or more, have been met already.

The kd-tree has two levels. Its upper cuts are fitted on a bounded sample and deal all vectors to cells of about
``CELL_ROWS``; within a task each cell builds the lower levels. A query first searches its own cell, then,
with the k-th distance found there, only the cells that the chi-square test does not rule out. Copies of a
vector collapse to one entry with its smallest ids before they are dealt, so a vector held by a third of the rows is one entry.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklens.session import written

NEIGHBOURS = 5
DIMENSIONS = 8
CONFIDENCE = 0.98
SAMPLE = 20_000
CELL_ROWS = 8_192
QUERY_BLOCK = 20_000
LEAF_ROWS = 32
SEED = 11


def chi_square(x: np.ndarray, degrees: int) -> np.ndarray:
    """The chi-square distribution function for an even number of degrees of freedom."""
    half = np.minimum(np.asarray(x, dtype=np.float64) / 2, 700.0)
    term = total = np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def stop_ratio(degrees: int, confidence: float) -> float:
    """The squared ratio of projected to true distance at which the test holds."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(np.array(middle), degrees) < confidence else (low, middle)
    return high


def projection(size: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, dimensions))


def usable(vector: Column) -> Column:
    """Whether a vector is not NULL, not zero and has only finite components."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0)


def _matrix(column: pa.Array | pd.Series) -> np.ndarray:
    if isinstance(column, pd.Series):
        return np.stack(column.to_list()).astype(np.float64)
    return np.array(column.to_pylist(), dtype=np.float64).reshape(len(column), -1)


def projected(vectors: DataFrame, size: int, dimensions: int) -> DataFrame:
    """Adds ``p``, the projection of the normalised ``vec``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = projection(size, dimensions)
        for batch in batches:
            if not batch.num_rows:
                continue
            given = _matrix(batch.column(batch.num_columns - 1))
            scale = np.abs(given).max(axis=1, keepdims=True)
            unit = given / scale
            unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
            flat = pa.array((unit @ matrix).ravel())
            p = pa.ListArray.from_arrays(pa.array(np.arange(len(given) + 1) * dimensions, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns, p], names=[*batch.schema.names, "p"])

    kinds = ", ".join(f"{n} {k}" for n, k in vectors.dtypes)
    return vectors.mapInArrow(run, f"{kinds}, p array<double>")


class Cuts:
    """The upper kd-tree: medians of the sample along the widest axis, as arrays by node."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.depth = max(0, math.ceil(math.log2(max(1, cells))))
        inner = (1 << self.depth) - 1
        self.axis, self.value = np.zeros(inner, dtype=int), np.zeros(inner)
        parts = {0: sample}
        for node in range(inner):
            rows = parts.pop(node)
            if len(rows):
                self.axis[node] = int(np.argmax(rows.max(axis=0) - rows.min(axis=0)))
                self.value[node] = np.median(rows[:, self.axis[node]])
            below = rows[:, self.axis[node]] <= self.value[node] if len(rows) else np.zeros(0, dtype=bool)
            parts[2 * node + 1], parts[2 * node + 2] = rows[below], rows[~below]

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=int)
        for _ in range(self.depth):
            left = points[np.arange(len(points)), self.axis[node]] <= self.value[node]
            node = np.where(left, 2 * node + 1, 2 * node + 2)
        return node - ((1 << self.depth) - 1)

    def boxes(self, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
        low = {0: np.full(dimensions, -np.inf)}
        high = {0: np.full(dimensions, np.inf)}
        for node in range((1 << self.depth) - 1):
            a, v = self.axis[node], self.value[node]
            lo, hi = low.pop(node), high.pop(node)
            low[2 * node + 1], high[2 * node + 1] = lo, hi.copy()
            low[2 * node + 2], high[2 * node + 2] = lo.copy(), hi
            high[2 * node + 1][a] = min(hi[a], v)
            low[2 * node + 2][a] = max(lo[a], v)
        first = (1 << self.depth) - 1
        cells = range(first, first + (1 << self.depth))
        return np.array([low[c] for c in cells]), np.array([high[c] for c in cells])


class Cell:
    """The vectors of a cell: leaves of a kd-tree with their boxes."""

    def __init__(self, points: np.ndarray, vectors: np.ndarray, ids: list[list[int]]):
        self.norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        leaves: list[np.ndarray] = []
        todo = [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            spread = points[rows].max(axis=0) - points[rows].min(axis=0)
            if len(rows) <= LEAF_ROWS or not spread.max():
                leaves.append(rows)
                continue
            order = rows[np.argsort(points[rows, int(np.argmax(spread))], kind="stable")]
            todo += [order[: len(order) // 2], order[len(order) // 2 :]]
        # rows in the order of their leaves, so that a leaf is a slice
        order = np.concatenate(leaves)
        sizes = np.array([len(r) for r in leaves])
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.points, self.vectors, self.norms = points[order], vectors[order], self.norms[order]
        self.ids = [ids[i] for i in order.tolist()]
        self.low = np.array([points[r].min(axis=0) for r in leaves])
        self.high = np.array([points[r].max(axis=0) for r in leaves])

    def search(
        self, own: int, vector: np.ndarray, point: np.ndarray, k: int, ratio: float, reach: float
    ) -> list[tuple[float, int]]:
        """The ``k`` best ``(cosine, id)`` met before the test holds; ``reach`` bounds the squared k-th distance.

        Leaves open by their distance, twice as many at a time. Of the rows in open leaves those closer than any leaf
        not opened are next in projected order and are verified; the others wait.
        """
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        bound = (gap * gap).sum(axis=1)
        order = np.argsort(bound, kind="stable")
        norm = math.sqrt(float(np.einsum("i,i->", vector, vector)))
        best: list[tuple[float, int]] = []
        waiting, away = np.empty(0, dtype=np.int64), np.empty(0)
        at, step = 0, 4
        while at < len(order) or len(waiting):
            opened = order[at : at + step]
            at, step = at + len(opened), step * 2
            fresh = [np.arange(self.begins[leaf], self.ends[leaf]) for leaf in opened.tolist()]
            waiting = np.concatenate([waiting, *fresh])
            if fresh:
                away = np.concatenate([away, ((self.points[waiting[len(away) :]] - point) ** 2).sum(axis=1)])
            frontier = bound[order[at]] if at < len(order) else math.inf
            ready = (away <= frontier) & (away <= ratio * reach)
            rows = waiting[ready]
            waiting, away = waiting[~ready], away[~ready]
            if len(rows):
                cosine = np.einsum("ij,j->i", self.vectors[rows], vector) / (self.norms[rows] * norm)
                if len(rows) > k + 1:
                    top = cosine >= np.partition(cosine, -k - 1)[-k - 1]
                    rows, cosine = rows[top], cosine[top]
                for score, row in zip(cosine.tolist(), rows.tolist(), strict=True):
                    best += [(-score, i) for i in self.ids[row] if i != own]
                best = sorted(best)[:k]
                if len(best) == k:
                    reach = min(reach, 2 + 2 * best[-1][0])
            if frontier > ratio * reach or (at == len(order) and not (away <= ratio * reach).any()):
                break
        return [(-s, i) for s, i in best]


def nearest(
    vectors: DataFrame,
    queries: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
    dimensions: int = DIMENSIONS,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found of every row for which ``queries`` is true.

    Nearest first by cosine in double precision, ties to the smaller id; a query's own id is no candidate. Vectors
    that are NULL, zero or hold NULL or non-finite components take no part, nor do rows without an id. Of rows of one
    id and vector one counts; vectors of another length than most rows' are left out. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vid"),
        F.col(vector_col).cast("array<double>").alias("vec"),
        queries.alias("asks"),
    )
    common = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = common.n
    rows = rows.where(F.size("vec") == size).withColumn("h", F.xxhash64("vec"))
    # of a vector's copies only the k + 1 smallest ids can be among the k best: cut within tasks and by parts first
    part = Window.partitionBy("h", "vec", F.pmod(F.xxhash64("vid"), F.lit(16))).orderBy("vid")
    whole = Window.partitionBy("h", "vec").orderBy("vid")
    few = rows.select("h", "vec", "vid").distinct()  # repeated rows take no id's place
    few = few.withColumn("n", F.row_number().over(part)).where(F.col("n") <= k + 1)
    few = few.withColumn("n", F.row_number().over(whole)).where(F.col("n") <= k + 1)
    entries = few.groupBy("h", "vec").agg(F.array_sort(F.collect_list("vid")).alias("ids"))
    indexed = written(projected(entries.select("ids", "vec"), size, dimensions), "projected")
    asked = projected(rows.where("asks").select("vid", "vec").distinct(), size, dimensions)
    asked = written(asked, "asked")

    sample = indexed.select("p", F.xxhash64("p").alias("h")).orderBy("h").limit(SAMPLE).collect()
    total, n_asked = indexed.count(), asked.count()
    cuts = Cuts(np.array([r.p for r in sample]), -(-total // CELL_ROWS))
    ratio = stop_ratio(dimensions, confidence)
    blocks = max(1, -(-n_asked // QUERY_BLOCK))
    # 2 * dimensions numbers for each cell: thousands of times smaller than the index
    sent = spark.sparkContext.broadcast((cuts, cuts.boxes(dimensions)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = sent.value[0].cell(_matrix(batch.column(2)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], names=[*"abcd"])

    placed = indexed.mapInArrow(deal, "ids array<long>, vec array<double>, p array<double>, cell int")
    placed = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    block = F.pmod(F.xxhash64("vid"), F.lit(blocks)).cast("int")
    home = asked.mapInArrow(deal, "vid long, vec array<double>, p array<double>, cell int")
    home = home.select("vid", "vec", "p", "cell", F.lit(4.0).alias("reach"), block.alias("block"))

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            cell = Cell(_matrix(left["p"]), _matrix(left["vec"]), [list(map(int, i)) for i in left["ids"]])
            points, asking = _matrix(right["p"]), _matrix(right["vec"])
            for i, (vid, reach) in enumerate(zip(right["vid"].tolist(), right["reach"].tolist(), strict=True)):
                found = cell.search(vid, asking[i], points[i], k, ratio, reach)
                out += [(vid, other, score) for score, other in found]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    def searched(questions: DataFrame) -> DataFrame:
        return (
            placed.groupBy("cell", "block")
            .cogroup(questions.groupBy("cell", "block"))
            .applyInPandas(search, "query_id long, vec_id long, score double")
        )

    first = written(searched(home), "first-round")
    kth = first.groupBy("query_id").agg(F.min("score").alias("s"), F.count("*").alias("c"))
    reach = F.when(F.col("c") >= k, 2 - 2 * F.col("s")).otherwise(F.lit(4.0))
    again = asked.join(kth, asked.vid == kth.query_id, "left").select("vid", "vec", "p", reach.alias("reach"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (low, high) = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column(2))
            cell, reach_of = own.cell(points), batch.column(3).to_numpy(zero_copy_only=False)
            for i in range(batch.num_rows):
                gap = np.maximum(np.maximum(low - points[i], points[i] - high), 0)
                near = np.flatnonzero((gap * gap).sum(axis=1) <= ratio * reach_of[i])
                near = near[near != cell[i]]
                if len(near):
                    same = pa.array(np.full(len(near), i))
                    columns = [c.take(same) for c in batch.columns]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(near, pa.int32())], names=[*"abcde"])

    schema = "vid long, vec array<double>, p array<double>, reach double, cell int"
    further = again.select("vid", "vec", "p", "reach").mapInArrow(spread, schema)
    further = further.select("vid", "vec", "p", "cell", "reach", block.alias("block"))
    met = first.unionByName(searched(further)).distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
