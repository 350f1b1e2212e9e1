"""Substring search through an inverted trigram index.

``build`` writes two tables. ``docs`` holds the rows with a number, in folders by the task that numbered them. ``postings`` holds, per
trigram and block of at most ``BLOCK`` consecutive numbers, which documents of the block have it, as differences in
variable-length bytes. Postings lie in folders by a hash of the trigram and are sorted by it, so a query reads a few row groups.

A query of three characters or more looks up its rarest trigrams, intersects their postings block by block, and verifies what is
left with the exact rule of ``catalogue.matches_text``; a shorter one scans. Texts become trigrams in Arrow batches, since a
substring per position would cost the square of a long text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.operators.catalogue import blob, matches_text, wanted_text

GRAM = 3
BLOCK = 1 << 13
BUCKETS = 64
RAREST = 4


def varints(numbers: np.ndarray) -> bytes:
    """Ascending numbers as differences, seven bits a byte, the highest bit set where more follow."""
    gaps = np.diff(numbers, prepend=0).astype(np.uint64)
    width = np.maximum(1, (np.frexp(gaps.astype(np.float64))[1] + 6) // 7)
    ends = np.cumsum(width)
    place = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - width, width)
    out = (np.repeat(gaps, width) >> (7 * place).astype(np.uint64)) & np.uint64(127)
    more = place < np.repeat(width, width) - 1
    return (out | (more.astype(np.uint64) << np.uint64(7))).astype(np.uint8).tobytes()


def numbers_of(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    if not len(raw):
        return np.empty(0, dtype=np.int64)
    last = raw < 128
    starts = np.flatnonzero(np.concatenate([[True], last[:-1]]))
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    parts = (raw & np.uint64(127)) << (7 * place).astype(np.uint64)
    return np.cumsum(np.add.reduceat(parts, starts)).astype(np.int64)


def grams_of(text: str) -> set[str]:
    return {text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def build(df: DataFrame, root: str) -> None:
    """Write the index of a frame with ``title``, ``author`` and ``note``, and the frame itself, under ``root``."""
    spark = df.sparkSession
    numbered = df.withColumn("_number", F.monotonically_increasing_id())
    numbered = numbered.withColumn("_part", F.shiftright("_number", 33).cast("int"))
    numbered.write.partitionBy("_part").parquet(f"{root}/docs")
    docs = spark.read.parquet(f"{root}/docs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}
        block = None

        def postings() -> pa.RecordBatch:
            grams = sorted(held)
            numbers = [np.unique(held[g]) for g in grams]
            columns = [
                pa.array(grams, pa.string()),
                pa.array(np.full(len(grams), block), pa.int64()),
                pa.array([len(n) for n in numbers], pa.int32()),
                pa.array([varints(n) for n in numbers], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["gram", "block", "n", "numbers"])

        for batch in batches:
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if number // BLOCK != block:
                    if held:
                        yield postings()
                    held, block = {}, number // BLOCK
                for gram in grams_of(text.as_py()):
                    held.setdefault(gram, []).append(number % BLOCK)
        if held:
            yield postings()

    made = docs.select("_number", F.lower(blob()).alias("text")).mapInArrow(run, "gram string, block long, n int, numbers binary")
    made = made.withColumn("bucket", _bucket(F.col("gram")))
    made.repartition("bucket").sortWithinPartitions("bucket", "gram", "block").write.partitionBy("bucket").parquet(
        f"{root}/postings"
    )


def _postings(spark: SparkSession, root: str, grams: list[str]) -> DataFrame:
    """The postings of some trigrams: their folders, and in them the row groups that may hold them."""
    buckets = spark.createDataFrame([(g,) for g in grams], "gram string").select(_bucket(F.col("gram"))).distinct()
    numbers = [r[0] for r in buckets.collect()]  # at most one row per trigram of the query
    return spark.read.parquet(f"{root}/postings").filter(F.col("bucket").isin(numbers) & F.col("gram").isin(grams))


def candidates(spark: SparkSession, root: str, text: str) -> DataFrame:
    """``_part, _number`` of the documents that have the query's rarest trigrams; a superset of what matches."""
    grams = sorted(grams_of(text))
    found = _postings(spark, root, grams)
    sizes = {r.gram: r.n for r in found.groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    schema = "_part int, _number long"
    if len(sizes) < len(grams):
        return spark.createDataFrame([], schema)
    rarest = sorted(grams, key=lambda g: (sizes[g], g))[:RAREST]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                common = reduce(np.intersect1d, [numbers_of(p) for p in parts])
                rows.append(common + block * BLOCK)
            numbers = np.concatenate(rows) if rows else np.empty(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array((numbers >> 33).astype(np.int32)), pa.array(numbers)], names=["_part", "_number"]
            )

    blocks = _postings(spark, root, rarest).groupBy("block").agg(F.collect_list("numbers").alias("parts"))
    return blocks.filter(F.size("parts") == len(rarest)).select("block", "parts").mapInArrow(run, schema)


def search(spark: SparkSession, root: str, query: str) -> DataFrame:
    """As ``catalogue.search`` over the rows that were indexed."""
    docs = spark.read.parquet(f"{root}/docs")
    text = wanted_text(query)
    if len(text) >= GRAM:
        docs = docs.join(candidates(spark, root, text), ["_part", "_number"], "left_semi")
    condition = matches_text(query)
    found = docs if condition is None else docs.filter(condition)
    return found.drop("_part", "_number")
