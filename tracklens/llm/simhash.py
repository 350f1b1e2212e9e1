"""SimHash near-dedup with pivot distance tables.

Fingerprints are made in Arrow batches and written once. Equal fingerprints collapse to one row with their
smallest document, so a group of exact copies costs one row. Each distinct fingerprint gets its Hamming distances
to ``PIVOTS`` reference fingerprints. Two fingerprints within the limit differ by no more than the limit in every
coordinate (triangle inequality), so a pair is discarded at the first coordinate that differs by more, and what
survives is verified on the bits.

Pairs are only looked at within a band: with the 64 bits in ``limit + extra`` parts, two fingerprints within
the limit agree on at least ``extra`` whole parts, so every choice of ``extra`` parts is a band and no link is lost.
A band holds fingerprints sorted by its key; a task walks the runs of equal keys, joins what links in a
disjoint-set forest and emits only links that merge two sets, never all pairs of a run. A run above ``RUN_ROWS``
is dealt out as pairs of pieces, so that no task holds it whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.columns import NO_ID, ident, outward, row_key
from tracklens.llm.graph import components
from tracklens.session import written

WORDS = 4
LIMIT = 4
EXTRA = 2
PIVOTS = 16
RUN_ROWS = 4096
SEED = 42


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The fingerprint of one text as an unsigned integer."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words)), strict=False))
    hash_of = xxhash.xxh64_intdigest
    hashes = np.fromiter((hash_of(s, SEED) for s in shingles), dtype=np.uint64)
    # bits of a block of hashes at a time: 64 counters, whatever the length of the text
    total = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65536):
        block = hashes[start : start + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``did, fp``: one row per input row, ``fp`` the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["did", "fp"])

    picked = docs.select(ident(id_col).alias("did"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "did long, fp long")


def pivots(count: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: hashes of their numbers."""
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(count)], dtype=np.uint64)


def _parts(limit: int, extra: int) -> list[int]:
    """Masks of ``limit + extra`` parts of the 64 bits."""
    edges = np.linspace(0, 64, limit + extra + 1).round().astype(int)
    return [(1 << int(b)) - (1 << int(a)) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def banded(prints: DataFrame, limit: int, extra: int) -> DataFrame:
    """``key, fp`` for every band of every distinct fingerprint; the band's number is part of the key."""
    parts = _parts(limit, extra)
    masks = [sum(chosen) for chosen in combinations(parts, extra)]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)])
    return prints.select("fp", F.explode(keys).alias("key"))


def _find(root: np.ndarray, i: int) -> int:
    while root[i] != i:
        root[i] = root[root[i]]
        i = root[i]
    return i


def _spread(root: np.ndarray) -> None:
    while True:
        up = root[root]
        if np.array_equal(up, root):
            return
        root[:] = up


def linked_in_runs(keys: np.ndarray, prints: np.ndarray, limit: int, piece: np.ndarray | None = None):
    """Index pairs that join all fingerprints of equal key within ``limit`` bits; keys are sorted.

    Compares rows at growing distance in the order, all runs at once: first by pivot coordinates, then by bits.
    With ``piece`` only rows of different pieces are compared, or all where a run has a single piece.
    """
    n = len(keys)
    table = np.bitwise_count(prints[None, :] ^ pivots()[:, None]).astype(np.int8)
    root = np.arange(n)
    links: list[tuple[int, int]] = []
    left = np.arange(n)
    for step in range(1, n):
        left = left[left + step < n]
        left = left[keys[left] == keys[left + step]]
        if not len(left):
            break
        i = left[root[left] != root[left + step]]
        if piece is not None:
            i = i[piece[i] != piece[i + step]]
        for coordinates in table:
            if not len(i):
                break
            i = i[np.abs(coordinates[i] - coordinates[i + step]) <= limit]
        i = i[np.bitwise_count(prints[i] ^ prints[i + step]) <= limit]
        for a in i.tolist():
            x, y = _find(root, a), _find(root, a + step)
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((a, a + step))
        if len(i):
            _spread(root)
    return links


def links(prints: DataFrame, limit: int = LIMIT, extra: int = EXTRA, run_rows: int = RUN_ROWS) -> DataFrame:
    """``a, b``: links among distinct fingerprints that connect all those within ``limit`` bits of each other."""
    bands = banded(prints, limit, extra)
    large = bands.groupBy("key").count().where(F.col("count") > run_rows)
    large = large.select("key", F.ceil(F.col("count") / run_rows).cast("int").alias("pieces"))
    marked = bands.join(large, "key", "left")
    own = F.pmod(F.xxhash64(F.col("fp")), F.col("pieces")).cast("int")
    # a row of a large run goes to every pair of pieces that has its own
    pairs = F.when(F.col("pieces").isNull(), F.array(F.struct(F.lit(0).alias("lo"), F.lit(0).alias("hi")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("pieces") - 1),
            lambda other: F.struct(F.least(own, other).alias("lo"), F.greatest(own, other).alias("hi")),
        )
    )
    dealt = marked.select("key", "fp", F.explode(pairs).alias("pair"))
    dealt = dealt.select(F.xxhash64("key", "pair.lo", "pair.hi").alias("key"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def emit(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            found = np.array(linked_in_runs(keys, prints.view(np.uint64), limit), dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(prints[found[:, 0]]), pa.array(prints[found[:, 1]])], names=["a", "b"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if held[0][0][0] == held[-1][0][-1]:
                continue  # one run goes on through the batch
            keys, prints = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            cut = int(np.searchsorted(keys, keys[-1]))
            yield emit(keys[:cut], prints[:cut])
            held = [(keys[cut:], prints[cut:])]
        if held:
            yield emit(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))

    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    limit: int = LIMIT,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits, ``component_id`` the smallest id reachable over fingerprints that
    differ in at most ``limit`` bits. NULL, empty and blank texts have fingerprint zero and link like any
    other. Repeated rows stay; rows without an id count as the smallest id and return NULL. Other columns of the input
    are ignored.
    """
    prints = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("did").alias("least")), "distinct-fingerprints")
    joined = components(links(distinct.select("fp"), limit))
    labelled = distinct.join(joined, distinct.fp == joined.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    named = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_print = labelled.join(named, "component").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        outward("did").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        outward("component_id").alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near copies, the one of the smallest id, with all its columns.

    Rows without an id, or of one id, are rows of their own unless their texts are near copies. Of rows that share the
    smallest id the one whose text has the smallest hash stays.
    """
    keyed = docs.withColumn("sh_key", row_key(id_col, text_col))
    groups = near_duplicates(keyed.select("sh_key", F.col(text_col).alias("text")), "sh_key", "text").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("sh_key"), F.coalesce("component_id", F.lit(NO_ID)).alias("component")
    )
    ids = keyed.select("sh_key", ident(id_col).alias("did")).distinct()
    first = ids.join(groups.distinct(), "sh_key").groupBy("component").agg(F.min(F.struct("did", "sh_key")).alias("first"))
    kept = first.select(F.col("first.sh_key").alias("sh_kept"))
    keyed = keyed.dropDuplicates(["sh_key"])
    return keyed.join(kept, keyed.sh_key == F.col("sh_kept"), "left_semi").drop("sh_key")
