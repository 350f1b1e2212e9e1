"""Packing by lexical retrieval.

Documents become token ids in Arrow batches, written once. Whole windows of a long document are sequences of their
own; what is left of each document is packed: a seed opens a window, a BM25 inverted index returns its most
similar unused neighbours, and they fill the window greedily. The piece that no longer fits is cut, and its rest stays
in the index as a document to go on with, so only the last window of a shard can be short; that one is cut into powers of
two, which need no padding.

The index is sharded. Documents are dealt to shards in the order of a small MinHash over their rarest tokens, so that
similar ones meet in a shard, by range partitions of even size, whatever repeats. Document frequencies are
counted over the whole corpus (one row per vocabulary entry, so its broadcast is bounded by the vocabulary). A
shard holds about ``SHARD_TOKENS`` ids and is one task's work.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.chunks import (
    PIECE,
    PLAIN,
    encoded,
    grouped,
    interleaved,
    lettered,
    pieces_of,
    pooled,
    spelled,
    text_slices,
    tokenizers_of,
)
from tracklens.llm.columns import ident, outward
from tracklens.session import written

WINDOW = 2048
END = 1
SHARD_TOKENS = 2_000_000
QUERY_TERMS = 12
NEIGHBOURS = 24
K1, B = 1.2, 0.75
VOCABULARY = 65_536
KIND = np.dtype("<u2")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Texts to ids of the word-level BPE, each distinct chunk of a slice and each distinct word of its chunks encoded once.

    No token of this vocabulary crosses white space, so chunks can be encoded alone. Chunks of ASCII and Latin letters are cut
    into words here; words go to the merges many at a time and are told apart by their last tokens. Any other chunk goes
    through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.whole, self.model = tokenizers_of(path)
        vocabulary = self.whole.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.end = pa.scalar(END.to_bytes(2, "little"), pa.binary())

    def _words(self, words: pa.Array) -> pa.Array:
        mapped = [w if w.isascii() else lettered(w) for w in words.to_pylist()]
        return spelled(self.model, mapped, KIND, lambda ids, _: np.flatnonzero(self.closing[ids]))

    def _chunks(self, chunks: pa.Array) -> pa.Array:
        plain = pc.and_not(pc.match_substring_regex(chunks, PLAIN), pc.match_substring(chunks, "<|"))
        edges, words = pieces_of(pc.utf8_lower(chunks.filter(plain)), PIECE % "")
        other = encoded(self.whole, chunks.filter(pc.invert(plain)).to_pylist(), KIND)
        return interleaved(np.asarray(plain), grouped(edges, pooled(words, self._words)), other)

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of each text, a NULL being empty, as little-endian unsigned 16-bit values with the end id."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        edges, chunks = np.array(lists.offsets), lists.flatten()
        del lists
        ids = pooled(chunks, self._chunks)
        del chunks
        return pc.binary_join_element_wise(grouped(edges, ids), self.end, b"")


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``did, ids, n``: the ids of every row as little-endian 16-bit values in a binary column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path).encode
        for batch in batches:
            for part in text_slices(batch, 1):
                ids = encode(part.column(1))
                n = pc.divide(pc.binary_length(ids), KIND.itemsize).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), ids, n], names=["did", "ids", "n"])

    picked = docs.select(ident(id_col).alias("did"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "did long, ids binary, n long")


def _distinct(ids: np.ndarray) -> np.ndarray:
    """The distinct ids in order; 16-bit values sort by radix."""
    ordered = np.sort(ids, kind="stable")
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return ordered[new]


def document_frequencies(ids: DataFrame) -> DataFrame:
    """``token, df``: in how many documents each token is; combined within a task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(VOCABULARY, dtype=np.int64)
        for batch in batches:
            for row in batch.column(0):
                counts[_distinct(np.frombuffer(row.as_py(), "<u2"))] += 1
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["token", "df"])

    made = ids.select("ids").mapInArrow(run, "token long, df long")
    return made.groupBy("token").agg(F.sum("df").alias("df"))


def _rarest(ids: np.ndarray, rarity: np.ndarray, count: int) -> np.ndarray:
    found = _distinct(ids)
    if len(found) <= count:
        return found
    least = np.partition(rarity[found], -count)[-count]
    found = found[rarity[found] >= least]  # with ties, the smaller ids first
    return found[np.argsort(-rarity[found], kind="stable")[:count]]


class _Index:
    """BM25 over one shard: postings sorted by token, with the corpus's rarities."""

    def __init__(self, docs: list[np.ndarray], rarity: np.ndarray):
        self.rarity = rarity
        sizes = np.array([len(d) for d in docs])
        owner = np.repeat(np.arange(len(docs)), sizes)
        pairs, counts = np.unique((np.concatenate(docs).astype(np.int64) << 32) | owner, return_counts=True)
        self.owner, token = (pairs & 0xFFFFFFFF).astype(np.int64), pairs >> 32
        norm = K1 * (1 - B + B * sizes[self.owner] / max(1.0, sizes.mean()))
        self.weight = rarity[token] * counts * (K1 + 1) / (counts + norm)
        self.first = np.searchsorted(token, np.arange(VOCABULARY + 1))
        self.free = np.ones(len(docs), dtype=bool)

    def neighbours(self, seed: np.ndarray) -> list[int]:
        """Unused documents by falling score, ties to the first; only those that share a term."""
        spans = [(self.first[t], self.first[t + 1]) for t in _rarest(seed, self.rarity, QUERY_TERMS).tolist()]
        at = np.concatenate([np.arange(a, b) for a, b in spans])
        at = at[self.free[self.owner[at]]]
        if not len(at):
            return []
        found, where = np.unique(self.owner[at], return_inverse=True)
        scores = np.bincount(where, weights=self.weight[at])
        return found[np.lexsort((found, -scores))[:NEIGHBOURS]].tolist()


def _powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack_shard(docs: list[np.ndarray], rarity: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """``document, start, length, sequence, offset`` of every piece, documents and sequences numbered from 0."""
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    start = [0] * len(docs)
    for d, ids in enumerate(docs):
        while len(ids) - start[d] >= WINDOW:
            pieces.append((d, start[d], WINDOW, sequence, 0))
            start[d] += WINDOW
            sequence += 1
    rest = [ids[start[d] :] for d, ids in enumerate(docs)]
    open_docs = [d for d, ids in enumerate(rest) if len(ids)]
    if not open_docs:
        return pieces
    index = _Index(rest, rarity)
    index.free[[d for d, ids in enumerate(rest) if not len(ids)]] = False
    window: list[tuple[int, int, int]] = []
    room, going, cursor = WINDOW, None, 0
    while True:
        if going is None:
            while cursor < len(docs) and not index.free[cursor]:
                cursor += 1
            if cursor == len(docs):
                break
            going = cursor
        index.free[going] = False
        queue, seed = [going], rest[going]
        queue += index.neighbours(seed)
        going = None
        for d in queue:
            index.free[d] = False
            length = min(room, len(docs[d]) - start[d])
            window.append((d, start[d], length))
            start[d] += length
            room -= length
            if not room:
                offset = 0
                for w, s, n in window:
                    pieces.append((w, s, n, sequence, offset))
                    offset += n
                window, room, sequence = [], WINDOW, sequence + 1
                if start[d] < len(docs[d]):
                    going = d
                break
    # the last window of the shard: powers of two
    sizes = _powers(sum(n for _, _, n in window))
    offset = 0
    for d, s, n in window:
        while n:
            take = min(n, sizes[0] - offset)
            pieces.append((d, s, take, sequence, offset))
            s, n, offset = s + take, n - take, offset + take
            if offset == sizes[0]:
                sizes, offset, sequence = sizes[1:], 0, sequence + 1
    return pieces


SCHEMA = "did long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset`` of every piece of every sequence.

    ``ids`` are little-endian unsigned 16-bit values. A NULL or empty text is its end id alone. Repeated rows are
    packed each; an empty table gives no rows. Other columns of the input are ignored.
    """
    path = path or tokenizer_path()
    spark = docs.sparkSession
    made = written(tokens(docs, path, id_col, text_col), "tokens")
    size = made.agg(F.count("*").alias("docs"), F.sum("n").alias("ids")).first()
    total, shards = size.docs, max(1, -(-int(size.ids or 0) // shard_tokens))
    frequency = np.zeros(VOCABULARY, dtype=np.int64)
    for row in document_frequencies(made).collect():  # at most one row per vocabulary entry
        frequency[row.token] = row.df
    rarity = np.log1p((total - frequency + 0.5) / (frequency + 0.5)).astype(np.float32)
    sent = spark.sparkContext.broadcast(rarity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for row in batch.column(1):
                rare = _rarest(np.frombuffer(row.as_py(), "<u2"), sent.value, QUERY_TERMS).astype(np.uint64)
                marks.append(int((rare * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).min()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.int64())], names=[*"abcd"])

    placed = made.select("did", "ids", "n").mapInArrow(place, "did long, ids binary, n long, mark long")
    placed = placed.withColumn("tie", F.xxhash64("did", "ids")).repartitionByRange(shards, "mark", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        rows = []
        for batch in batches:
            rows += zip(*(batch.column(k).to_pylist() for k in (3, 4, 0, 1)), strict=True)
        if not rows:
            return
        rows.sort()
        ids = [np.frombuffer(r[3], "<u2") for r in rows]
        pieces = pack_shard(ids, sent.value)
        for at in range(0, len(pieces), 5000):
            part = pieces[at : at + 5000]
            columns = [
                [rows[d][2] for d, *_ in part],
                [s for _, s, *_ in part],
                [n for _, _, n, _, _ in part],
                [ids[d][s : s + n].tobytes() for d, s, n, _, _ in part],
                [len(ids[d]) for d, *_ in part],
                [base + q for *_, q, _ in part],
                [o for *_, o in part],
            ]
            kinds = [pa.binary() if k == 3 else pa.int64() for k in range(7)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["did", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    packed = placed.mapInArrow(run, SCHEMA)
    return packed.withColumn("doc_id", outward("did")).drop("did")


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids as unsigned 32-bit values in place of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [zlib.crc32(np.frombuffer(v.as_py(), "<u2").astype("<u4").tobytes()) for v in batch.column(3)]
            columns = [*batch.columns]
            columns[3] = pa.array(sums, pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names=[*"abcdefg"])

    picked = pieces.select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return picked.mapInArrow(run, schema)
