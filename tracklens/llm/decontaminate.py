"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Words are the runs of letters and digits of the lower-cased text; shingles are five consecutive words (the whole
text where there are fewer). Benchmark items are partitioned by their number of distinct shingles. An item's
MinHash sketch is its ``m`` smallest shingle hashes, with ``m`` set by the largest size of its partition: a document
that holds at least the share ``threshold`` of the item misses fewer than ``m`` of its shingles, so it holds one of
the sketch, however long it is. That makes the search free of misses; the candidates are verified on all of the
item's shingle hashes (64 bits).

Items are the stated query set. They are searched in blocks of at most ``BLOCK_SHINGLES`` shingles, each
sent to all tasks; documents are never shuffled, and a hot source or a very long document is no special case.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.columns import NO_ID, ident, outward, row_key

WORDS = 5
THRESHOLD = 0.8
BLOCK_SHINGLES = 500_000
CACHED_WORDS = 200_000

_word = re.compile(r"[^\W_]+")


class _Words(dict):
    """Word to hash; remembers a bounded number of words."""

    def __missing__(self, word: str) -> int:
        made = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), 7)
        if len(self) < CACHED_WORDS:
            self[word] = made
        return made


_hash_of = _Words()


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """The hash of every shingle in order, repeats included; one for a text of 1 to ``words`` words."""
    found = _word.findall((text or "").lower())
    hashes = np.fromiter(map(_hash_of.__getitem__, found), dtype=np.uint64, count=len(found))
    return _rolled(hashes, min(words, len(found)))


def _rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.empty(0, dtype=np.uint64)
    n = len(hashes) - width + 1
    made = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        made = (made ^ hashes[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        made ^= made >> np.uint64(29)
    return made


def sketch_size(largest: int, threshold: float = THRESHOLD) -> int:
    """How many smallest hashes of a set of at most ``largest`` shingles cannot all be among the missing ones."""
    return int(np.floor((1 - threshold) * largest + 1e-9)) + 1


class _Block:
    """A block of items: sketch hashes to items, and each item's own shingles."""

    def __init__(self, items: list[tuple[int, list[int], int]], threshold: float):
        self.threshold = threshold
        self.ids = [i for i, _, _ in items]
        self.sets = [np.array(s, dtype=np.int64).view(np.uint64) for _, s, _ in items]
        self.short = sorted({w for _, _, w in items if w < WORDS})
        self.widths = [w for _, _, w in items]
        owners: dict[int, list[int]] = {}
        for at, hashes in enumerate(self.sets):
            partition = 1 << max(0, int(len(hashes)) - 1).bit_length()  # sizes up to the next power of two
            for h in np.sort(hashes)[: sketch_size(partition, threshold)].tolist():
                owners.setdefault(h, []).append(at)
        self.owners = owners
        self.keys = np.array(sorted(owners), dtype=np.uint64)
        # a bitmap over the low bits of the hashes turns most of a document away
        self.bits = np.zeros(1 << 22, dtype=bool)
        self.bits[(self.keys & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def found(self, text: str | None) -> list[tuple[int, int, int]]:
        """``item, shared, size`` of each item contained in the text."""
        words = _word.findall((text or "").lower())
        hashes = np.fromiter(map(_hash_of.__getitem__, words), dtype=np.uint64, count=len(words))
        out = []
        for width in [WORDS, *self.short]:
            if len(words) < width:
                continue
            made = _rolled(hashes, width)
            near = made[self.bits[(made & np.uint64((1 << 22) - 1)).astype(np.int64)]]
            if not len(near) or not len(self.keys):
                continue
            near = np.unique(near)
            at = np.minimum(np.searchsorted(self.keys, near), len(self.keys) - 1)
            met = {o for h in near[self.keys[at] == near].tolist() for o in self.owners[h]}
            for o in sorted(met):
                if self.widths[o] != width:
                    continue
                shared = int(np.isin(self.sets[o], made).sum())
                if shared >= self.threshold * len(self.sets[o]) - 1e-9:
                    out.append((self.ids[o], shared, len(self.sets[o])))
        return out


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, shingles, width, size``: distinct shingle hashes of each item that has a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, widths = [], []
            for text in batch.column(1).to_pylist():
                sets.append(np.unique(shingle_hashes(text)).view(np.int64))
                widths.append(min(WORDS, len(_word.findall((text or "").lower()))))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s.tolist() for s in sets], pa.list_(pa.int64())),
                    pa.array(widths, pa.int32()),
                    pa.array([len(s) for s in sets], pa.int64()),
                ],
                names=["item", "shingles", "width", "size"],
            )

    picked = benchmark.select(ident(id_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    made = picked.mapInArrow(run, "item long, shingles array<long>, width int, size long")
    return made.where(F.col("size") > 0).distinct()


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``doc_id, item_id, n_shared, n_item, containment`` of each document row and item at or above ``threshold``.

    Items without a word match nothing; items under five words match as a whole run of words. NULL and empty
    documents hold nothing. A repeated document row returns its pairs once per row, repeated items count once. An
    item longer than a block is a block of its own.
    """
    items = _items(benchmark, item_col, item_text_col)
    total = items.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-int(total) // block_shingles))
    picked = docs.select(ident(id_col).alias("did"), F.col(text_col).cast("string").alias("text"))
    schema = "did long, item long, n_shared long, n_item long"
    spark, found = docs.sparkSession, None
    for number in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect()
        sent = spark.sparkContext.broadcast([(r.item, list(r.shingles), r.width) for r in rows])

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            block = _Block(sent.value, threshold)
            for batch in batches:
                out = [
                    (did, *hit)
                    for did, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                    for hit in block.found(text.as_py())
                ]
                columns = list(zip(*out, strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["did", "item", "n_shared", "n_item"]
                )
            _hash_of.clear()  # the worker goes on, its next task starts afresh

        part = picked.mapInArrow(run, schema)
        found = part if found is None else found.unionByName(part)
    return found.select(
        outward("did").alias("doc_id"),
        outward("item").alias("item_id"),
        "n_shared",
        "n_item",
        (F.col("n_shared") / F.col("n_item")).alias("containment"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with all their columns."""
    keyed = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    hit = contained_items(keyed, benchmark, "key").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("dc_hit"))
    return docs.join(hit.distinct(), row_key(id_col, text_col) == F.col("dc_hit"), "left_anti")
