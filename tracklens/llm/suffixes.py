"""Repeated byte strings by sparse prefix doubling.

Plain prefix doubling sorts every position of every text several times, which is many times the input on disk. Here
the positions that enter the first round are chosen by content: of the 25-byte strings inside a 50-byte window, the one
with the smallest hash (ties to the left). Equal windows choose equal positions, so no repeat is lost and about
one position in fourteen remains. Then ranks are paired at growing offsets, and what is unique drops out:

1. positions rank by their 25-byte string; those whose rank one document alone has are done;
2. positions rank by the pair of ranks at the ends of the stretch of windows that chose them (50 to 75 bytes). A
   stretch that a smaller document also has is repeated as a whole and past the threshold;
3. stretches that only share their 25 bytes and 13 more on one side (a byte of hash tells) go to single windows of
   that side, ranked by the pair of 25-byte ranks at offset 25.

Ranks are 64-bit hashes and a decision always rests on a pair of them. Chosen positions travel as packed arrays per bucket of
ranks, field by field; within a batch only the smallest document of a stretch is sent on, the others are known to be
repeats at once. The texts are shuffled once, and that shuffle is read by round 3 and the removal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.columns import ident, outward
from tracklens.session import written

LENGTH = 50
HALF = LENGTH // 2
PIECE = 1 << 19
BATCH_BYTES = 16 << 20

#: ``side``: how many bytes the stretch's position is behind its start, and a byte of hash of the 13 bytes left and right.
FIELDS = [
    ("rank", "<u8"), ("stretch", "<u8"), ("did", "<i8"), ("text", "<i8"), ("start", "<u4"), ("count", "u1"), ("side", "u1"),
    ("left", "u1"), ("right", "u1"),
]
RECORD = np.dtype(FIELDS)
SPAN = np.dtype([("start", "<u4"), ("count", "u1")])
MARKED = [("did", "<i8"), ("text", "<i8"), ("start", "<u4"), ("count", "u1")]
#: Text a bucket stands for, of ranks as of documents: a batch sends at most one row of a kind to each.
BUCKET_BYTES = 2 << 20
SIDE = 13
RECORDS, SPANS, LOOK = 0, 1, 2

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mixed(value: np.ndarray) -> np.ndarray:
    value = value ^ (value >> np.uint64(32))
    value = value * _M2
    return value ^ (value >> np.uint64(29))


def half_ranks(data: bytes) -> np.ndarray:
    """A 64-bit rank of each 25-byte string of ``data``."""
    n = len(data) - HALF + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    value = _mixed(lanes[:n] * _M1)
    for at in (8, 16, HALF - 8):
        value = _mixed((value ^ lanes[at : at + n]) * _M1)
    return value


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    reach, out = 1, values
    while reach * 2 <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    extra = width - reach
    return np.minimum(out[: len(out) - extra], out[extra:]) if extra else out


def stretches(pieces: list[tuple[int, int, bytes]]) -> np.ndarray:
    """Records of all stretches of windows in the pieces (``did, offset in its document, bytes``), under 1 MB in sum.

    ``did`` may be any number that tells the documents apart.
    """
    data = b"".join(p for _, _, p in pieces)
    if len(data) < LENGTH:
        return np.empty(0, RECORD)
    sizes = np.array([len(p) for _, _, p in pieces])
    begins = np.cumsum(sizes) - sizes
    ranks = half_ranks(data)
    low = np.uint64((1 << 20) - 1)
    chosen = _sliding_min((ranks & ~low) | np.arange(len(ranks), dtype=np.uint64), HALF + 1) & low
    n = len(chosen)
    owner = np.repeat(np.arange(len(pieces)), sizes)[:n]
    valid = np.arange(n) + LENGTH <= (begins + sizes)[owner]
    change = np.ones(n, dtype=bool)
    change[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1]) | (valid[1:] != valid[:-1])
    first = np.flatnonzero(change)
    last = np.append(first[1:], n) - 1
    keep = valid[first]
    first, last = first[keep], last[keep]
    anchor = chosen[first].astype(np.int64)
    out = np.zeros(len(first), RECORD)
    stretch = _mixed(ranks[first] * _M1 + ranks[first + HALF] * _M3)
    stretch = _mixed((stretch ^ ranks[last]) * _M1 + ranks[last + HALF] * _M3)
    shape = ((last - first) * 64 + (anchor - first)).astype(np.uint64)
    out["stretch"] = _mixed((stretch ^ shape) * _M1)
    out["rank"] = ranks[anchor]
    out["did"] = np.array([d for d, _, _ in pieces], dtype=np.int64)[owner[first]]
    offset = np.array([o for _, o, _ in pieces], dtype=np.int64)[owner[first]]
    out["start"] = first - begins[owner[first]] + offset
    out["count"] = last - first + 1
    out["side"] = anchor - first
    lanes = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    last_lane = len(lanes) - 1
    # windows that begin 13 bytes or more before the position hold the 13 bytes left of it, the others those right of it
    at = np.maximum(anchor - SIDE, 0)
    out["left"] = _mixed((_mixed(lanes[at] * _M1) ^ lanes[np.minimum(at + SIDE - 8, last_lane)]) * _M3)
    at = np.minimum(anchor + HALF, last_lane)
    out["right"] = _mixed((_mixed(lanes[at] * _M1) ^ lanes[np.minimum(at + SIDE - 8, last_lane)]) * _M3)
    return out


def _packed(records: np.ndarray, fields: list[tuple[str, str]] = FIELDS) -> bytes:
    """Field after field, in the order of the documents: ids and places compress in a shuffle, hashes do not."""
    records = records[np.lexsort((records["start"], records["text"], records["did"]))]
    return b"".join(records[name].astype(kind).tobytes() for name, kind in fields)


def _unpacked(data: bytes, fields: list[tuple[str, str]] = FIELDS) -> np.ndarray:
    kinds = np.dtype(fields)
    out = np.empty(len(data) // kinds.itemsize, kinds)
    at = 0
    for name, kind in fields:
        out[name] = np.frombuffer(data, kind, len(out), at)
        at += len(out) * np.dtype(kind).itemsize
    return out


def _dealt(records: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """A batch's records by bucket of ranks; those a smaller document of the batch repeats go as spans by document."""
    records, _, repeat = _smallest(records)
    yield _spans(records[repeat], SPANS, buckets)
    records = records[~repeat]
    bucket = (records["rank"] >> np.uint64(40)).astype(np.int64) % buckets
    yield _by_bucket(records, bucket, RECORDS, FIELDS)


def _by_bucket(records: np.ndarray, bucket: np.ndarray, kind: int, fields: list[tuple[str, str]]) -> pa.RecordBatch:
    """One row per bucket, whatever the number of documents."""
    order = np.argsort(bucket, kind="stable")
    records, bucket = records[order], bucket[order]
    found, at = np.unique(bucket, return_index=True)
    parts = [_packed(p, fields) for p in np.split(records, at[1:])] if len(found) else []
    kinds = np.full(len(found), kind)
    return pa.RecordBatch.from_arrays(
        [pa.array(found, pa.int32()), pa.array(kinds, pa.int32()), pa.array(parts, pa.binary())],
        names=["bucket", "kind", "data"],
    )


def _smallest(records: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Records sorted by rank, stretch and document; where a stretch begins; whether a smaller document has it."""
    records = records[np.lexsort((records["did"], records["stretch"], records["rank"]))]
    new = np.ones(len(records), dtype=bool)
    new[1:] = (records["rank"][1:] != records["rank"][:-1]) | (records["stretch"][1:] != records["stretch"][:-1])
    least = records["did"][np.flatnonzero(new)][np.cumsum(new) - 1]
    return records, new, records["did"] > least


def _spans(records: np.ndarray, kind: int, buckets: int) -> pa.RecordBatch:
    """The stretches' places by bucket of documents."""
    mixed = _mixed(records["did"].view(np.uint64) * _M1 + records["text"].view(np.uint64) * _M3)
    return _by_bucket(records, (mixed >> np.uint64(40)).astype(np.int64) % buckets, kind, MARKED)


def spans_by_document(parts: DataFrame, kind: int) -> DataFrame:
    """``did, text_key, spans``: one row per document from the parts of a kind, gathered by bucket of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = [_unpacked(v.as_py(), MARKED) for batch in batches for v in batch.column(0)]
        if not gathered:
            return
        marks = np.concatenate(gathered)
        marks = marks[np.lexsort((marks["start"], marks["text"], marks["did"]))]
        new = np.ones(len(marks), dtype=bool)
        new[1:] = (marks["did"][1:] != marks["did"][:-1]) | (marks["text"][1:] != marks["text"][:-1])
        first = np.flatnonzero(new)
        spans = np.empty(len(marks), SPAN)
        spans["start"], spans["count"] = marks["start"], marks["count"]
        raw, ends = spans.tobytes(), [*(first[1:] * SPAN.itemsize).tolist(), len(marks) * SPAN.itemsize]
        parts = [raw[a:b] for a, b in zip((first * SPAN.itemsize).tolist(), ends, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(marks["did"][first]), pa.array(marks["text"][first]), pa.array(parts, pa.binary())],
            names=["did", "text_key", "spans"],
        )

    chosen = parts.where(F.col("kind") == kind).select("data", "bucket").repartition("bucket").select("data")
    return chosen.mapInArrow(run, "did long, text_key long, spans binary")


def _pieces(did: int, data: bytes) -> Iterator[tuple[int, int, bytes]]:
    for at in range(0, max(1, len(data) - LENGTH + 1), PIECE):
        yield did, at, data[at : at + PIECE + LENGTH - 1]


def _bytes(text) -> bytes:
    return (text.as_py() or "").encode("utf-8", "surrogatepass")


PARTS = "bucket int, kind int, data binary"


def chosen_positions(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, kind, data`` from ``did, text_key, text``: records by bucket of ranks, and spans already known to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[np.ndarray] = []
        some: list[tuple[int, int, bytes]] = []
        owners: list[tuple[int, int]] = []
        size = total = 0

        def dealt() -> Iterator[pa.RecordBatch]:
            records = np.concatenate([*gathered, stretches(some)])
            local, known = records["did"].copy(), np.array(owners, dtype=np.int64).reshape(-1, 2)
            records["did"], records["text"] = known[local, 0], known[local, 1]
            yield from _dealt(records, buckets)

        for batch in batches:
            for did, key, text in zip(*(batch.column(k).to_pylist() for k in (0, 1)), batch.column(2), strict=True):
                owners.append((did, key))
                for piece in _pieces(len(owners) - 1, _bytes(text)):
                    if size + len(piece[2]) > 1 << 20 and some:
                        gathered.append(stretches(some))
                        some, size = [], 0
                    some.append(piece)
                    size += len(piece[2])
                    total += len(piece[2])
                if total > BATCH_BYTES:
                    yield from dealt()
                    gathered, some, owners, size, total = [], [], [], 0, 0
        yield from dealt()

    return docs.select("did", "text_key", "text").mapInArrow(run, PARTS)


def _shared(keys: tuple[np.ndarray, ...], dids: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Whether, among the rows ``where`` holds, two documents have the key of a row."""
    out = np.zeros(len(dids), dtype=bool)
    rows = np.flatnonzero(where)
    if not len(rows):
        return out
    rows = rows[np.lexsort(tuple(k[rows] for k in keys))]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = np.any([k[rows][1:] != k[rows][:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    mixed = np.minimum.reduceat(dids[rows], at) != np.maximum.reduceat(dids[rows], at)
    out[rows] = mixed[np.cumsum(new) - 1]
    return out


def shared_stretches(positions: DataFrame, buckets: int) -> DataFrame:
    """``bucket, kind, data``: spans that repeat as a whole (1) and spans whose windows must be looked at (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = []
        for batch in batches:
            known = batch.filter(pa.compute.equal(batch.column(1), SPANS))
            if known.num_rows:
                yield pa.RecordBatch.from_arrays(known.columns, names=["bucket", "kind", "data"])
            gathered += [
                _unpacked(v.as_py())
                for kind, v in zip(batch.column(1).to_pylist(), batch.column(2), strict=True)
                if kind != SPANS
            ]
        if not gathered:
            return
        records, _, repeat = _smallest(np.concatenate(gathered))
        yield _spans(records[repeat], SPANS, buckets)
        records = records[~repeat]
        last = records["side"].astype(np.int64) - records["count"] + 1  # of the last window's start
        left = _shared((records["left"], records["rank"]), records["did"], records["side"] >= SIDE)
        right = _shared((records["right"], records["rank"]), records["did"], last < SIDE)
        side, count = records["side"].astype(np.int64), records["count"].astype(np.int64)
        skipped = np.where(left, 0, np.maximum(side - SIDE + 1, 0))
        taken = np.where(right, count, np.minimum(count, side - SIDE + 1)) - skipped
        look = (left | right) & (taken > 0)
        records = records[look]
        records["start"] += skipped[look].astype(np.uint32)
        records["count"] = taken[look]
        yield _spans(records, LOOK, buckets)

    return positions.repartition("bucket").mapInArrow(run, PARTS)


def single_windows(joined: DataFrame, buckets: int) -> DataFrame:
    """Every window of the spans to look at, as packed records by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for batch in batches:
            for did, key, text, raw in zip(*batch.columns, strict=True):
                spans = np.frombuffer(raw.as_py(), SPAN)
                ranks = half_ranks(_bytes(text))
                counts = spans["count"].astype(np.int64)
                steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                at = np.unique(np.repeat(spans["start"].astype(np.int64), counts) + steps)
                at = at[at + HALF < len(ranks)]
                made = np.zeros(len(at), RECORD)
                made["rank"], made["stretch"] = ranks[at], ranks[at + HALF]
                made["did"], made["text"], made["start"], made["count"] = did.as_py(), key.as_py(), at, 1
                gathered.append(made)
                size += len(made)
                if size > 500_000:
                    yield from _dealt(np.concatenate(gathered), buckets)
                    gathered, size = [], 0
        if gathered:
            yield from _dealt(np.concatenate(gathered), buckets)

    return joined.mapInArrow(run, PARTS)


def repeated_windows(windows: DataFrame, buckets: int) -> DataFrame:
    """The windows that a smaller document has, as spans by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = []
        for batch in batches:
            known = batch.filter(pa.compute.equal(batch.column(1), SPANS))
            if known.num_rows:
                yield pa.RecordBatch.from_arrays(known.columns, names=["bucket", "kind", "data"])
            gathered += [
                _unpacked(v.as_py())
                for kind, v in zip(batch.column(1).to_pylist(), batch.column(2), strict=True)
                if kind != SPANS
            ]
        if gathered:
            records, _, repeat = _smallest(np.concatenate(gathered))
            yield _spans(records[repeat], SPANS, buckets)

    return windows.repartition("bucket").mapInArrow(run, PARTS)


def _covered(size: int, spans: np.ndarray) -> np.ndarray:
    start = spans["start"].astype(np.int64)
    begins = np.bincount(np.minimum(start, size), minlength=size + 1)
    ends = np.bincount(np.minimum(start + spans["count"] - 1 + LENGTH, size), minlength=size + 1)
    return np.cumsum(begins - ends)[:-1] > 0


def bucket_count(texts: DataFrame) -> int:
    """One bucket for each ``BUCKET_BYTES`` of text, however many tasks there are."""
    total = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0]
    return max(1, -(-(total or 0) // BUCKET_BYTES))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` for every row of ``docs``.

    A byte goes when a 50-byte string over it also starts in a document of smaller id; strings are judged on the
    input. NULL texts are empty, texts under 50 bytes never change. Rows of one id are one document: they do
    not repeat each other, and each text of an id is cut by itself. Rows without an id are the smallest document. ``kept`` is binary, as a cut may fall inside a character. Other columns are ignored.
    """
    texts = docs.select(ident(id_col).alias("did"), F.col(text_col).cast("string").alias("text"))
    texts = texts.select("did", F.xxhash64("text").alias("text_key"), "text")  # of an id's texts
    document = ["did", "text_key"]
    buckets = bucket_count(texts)
    spans = written(shared_stretches(chosen_positions(texts, buckets), buckets), "stretches")
    spread = texts.repartition(*document)
    look = spread.join(spans_by_document(spans, LOOK), document).select(*document, "text", "spans")
    windows = repeated_windows(single_windows(look, buckets), buckets)
    joined = spread.join(spans_by_document(spans.unionByName(windows), SPANS), document, "left")
    joined = joined.select("did", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for did, text, raw in zip(*batch.columns, strict=True):
                data = _bytes(text)
                gone = _covered(len(data), np.frombuffer(raw.as_py() or b"", SPAN))
                runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                rows.append((did.as_py(), len(data), int(gone.sum()), runs, kept))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["did", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    made = joined.mapInArrow(run, "did long, n_bytes long, n_removed long, n_spans long, kept binary")
    return made.select(outward("did").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")


def brute_force(rows: list[tuple[int, bytes]]) -> dict[int, tuple[int, int, str]]:
    """``did -> removed, spans, hash`` by a dictionary of all strings, for tests."""
    first: dict[bytes, int] = {}
    for did, data in rows:
        for at in range(len(data) - LENGTH + 1):
            key = data[at : at + LENGTH]
            first[key] = min(first.get(key, did), did)
    out = {}
    for did, data in rows:
        gone = np.zeros(len(data), dtype=bool)
        for at in range(len(data) - LENGTH + 1):
            if first[data[at : at + LENGTH]] < did:
                gone[at : at + LENGTH] = True
        runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
        out[did] = (int(gone.sum()), runs, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest())
    return out
