"""Token ids in binary files: canonical length-limited Huffman codes from global counts, in independent blocks.

A folder of token files holds

* ``blocks``: one row per block of at most ``BLOCK_IDS`` consecutive ids, with its bits, its checkpoints, and which stretches
  of which documents it holds; file k holds the k-th range of documents in ascending order, its blocks in order;
* ``codes``: the length of each id's code, from which the canonical codes follow;
* ``parts``: how many ids the files before each file hold, at most ``MAX_FILES`` rows.

Any block can be read alone, from any checkpoint. Spark's own writer commits the files, so a lost task leaves nothing behind.
Ids are counted over the whole corpus, one row per vocabulary entry and task; the code lengths are bounded by the vocabulary.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracklens.llm.chunks import (
    LATIN,
    PIECE,
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
from tracklens.llm.huffman import LIMIT, Coder, code_lengths
from tracklens.session import shared_folder

END = 0
BLOCK_IDS = 65_536
FILE_IDS = 4_000_000
MAX_FILES = 20_000
#: Plain chunks, some of them joined by single line ends.
PLAIN_LINES = f"^[!-&(-~{LATIN}][!-~{LATIN}]*(\n[!-~{LATIN}]+)*\n?$"
POLYNOMIAL = 0xEDB88320


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class ChunkEncoder:
    """Texts to ids of a byte-level BPE, each distinct chunk of a slice and each distinct piece of its chunks encoded once.

    A space before a visible character always begins a new piece of this pre-tokenizer, so what lies between two such
    spaces can be encoded alone. Chunks of ASCII and Latin letters are cut into their pieces here; pieces
    go to the model many at a time, without the pre-tokenizer, and are told apart by their lengths in bytes. Any other chunk goes
    through the whole tokenizer, and so does a whole text that holds an added token's string.
    """

    def __init__(self, path: str, end: int):
        self.tokenizer, self.model = tokenizers_of(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        vocabulary = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = re.compile("|".join(re.escape(a.content) for a in added)) if added else None
        self.end = pa.scalar(np.array([end], self.kind).tobytes(), pa.binary())
        self.blank = lettered(" ")
        self.blank_next = re.compile(r" (?:\s|\Z)")
        self.before_visible = re.compile(r" (?=\S)")

    def _whole(self, texts: list[str]) -> pa.Array:
        return encoded(self.tokenizer, texts, self.kind)

    def _ends(self, ids: np.ndarray, words: list[str]) -> np.ndarray:
        """Where the letters of the tokens add up to those of the words."""
        reached, wanted = np.cumsum(self.sizes[ids]), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        stops = np.searchsorted(reached, wanted)
        return stops if len(ids) and stops[-1] < len(ids) and (reached[stops] == wanted).all() else stops[:0]

    def _words(self, words: pa.Array) -> pa.Array:
        mapped = [w.replace(" ", self.blank) if w.isascii() and w != "\n" else lettered(w) for w in words.to_pylist()]
        return spelled(self.model, mapped, self.kind, self._ends)

    def _chunks(self, chunks: pa.Array) -> pa.Array:
        # after its space, a chunk that begins like a contraction is none; a line end is a piece unless it is next to another
        plain = pc.match_substring_regex(chunks, PLAIN_LINES)
        edges, pieces = pieces_of(chunks.filter(plain), PIECE % "+", " ")
        other = self._whole([" " + c for c in chunks.filter(pc.invert(plain)).to_pylist()])
        return interleaved(np.asarray(plain), grouped(edges, pooled(pieces, self._words)), other)

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of each text, a NULL being empty, as little-endian values with the end id."""
        texts = pc.fill_null(texts, "")
        lone = [bool(self.added and self.added.search(t)) or self.blank_next.search(t) is not None for t in texts.to_pylist()]
        usual = ~np.array(lone, bool)
        lists = pc.split_pattern(texts.filter(pa.array(usual)), " ")
        if not usual.all():
            rest = texts.filter(pa.array(~usual)).to_pylist()
            split = [[t] if self.added and self.added.search(t) else self.before_visible.split(t) for t in rest]
            lists = interleaved(usual, lists, pa.array(split, lists.type))
        first, values = np.asarray(lists.offsets), lists.flatten()
        follows = np.ones(len(values), bool)
        follows[first[:-1]] = False
        heads = values.take(pa.array(first[:-1])).to_pylist()
        values = values.filter(pa.array(follows))
        del lists, texts
        ids = pooled(values, self._chunks)
        del values
        heads = self._whole(heads)
        return pc.binary_join_element_wise(heads, grouped(first - np.arange(len(first)), ids), self.end, b"")


@lru_cache(maxsize=2)
def _encoder(path: str, end: int) -> ChunkEncoder:
    return ChunkEncoder(path, end)


def token_ids(
    docs: DataFrame, path: str, end: int = END, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``did, ids, n``: every row's ids with the end id, as little-endian values of 16 bits (32 for a larger vocabulary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, end)
        for batch in batches:
            for part in text_slices(batch, 1):
                ids = encoder.encode(part.column(1))
                n = pc.divide(pc.binary_length(ids), encoder.kind.itemsize).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), ids, n], names=["did", "ids", "n"])

    picked = docs.select(ident(id_col).alias("did"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, "did long, ids binary, n long")


def id_counts(ids: DataFrame, size: int, kind: str) -> np.ndarray:
    """How often each id occurs in the whole corpus: one row per id and task, at most ``size`` rows to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                raw = b"".join(batch.column(0).slice(at, 2000).to_pylist())
                counts += np.bincount(np.frombuffer(raw, kind), minlength=size)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["id", "n"])

    total = np.zeros(size, dtype=np.int64)
    for row in ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        total[row.id] = row.n
    return total


BLOCKS = (
    "part int, block long, start long, n_ids int, checkpoints binary, bits binary, "
    "docs array<struct<did: long, start: long, n_tokens: long, at: long, length: int>>"
)
_DOCS = pa.list_(
    pa.struct([(k, pa.int64()) for k in ("did", "start", "n_tokens", "at")] + [("length", pa.int32())])
)


def write_ids(
    docs: DataFrame, folder: str, path: str | None = None, end: int = END, id_col: str = "doc_id",
    text_col: str = "text", limit: int = LIMIT, block_ids: int = BLOCK_IDS,
) -> None:
    """Tokenise every whole text and write all ids in ascending order of the id column to token files in ``folder``.

    NULL ids come first; rows of one id follow a hash of their ids. A NULL or empty text is the end id alone. Repeated rows are
    written each. An empty table writes no block. Other columns of the input are ignored.
    """
    path = path or tokenizer_path()
    size = tokenizers_of(path)[0].get_vocab_size()
    kind = "<u2" if size <= 1 << 16 else "<u4"
    spark = docs.sparkSession
    # the row's number splits even repeated rows between files
    rows = token_ids(docs, path, end, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    place = shared_folder(spark, "token-ids")
    rows.write.option("compression", "zstd").parquet(place)
    made = spark.read.schema(rows.schema).parquet(place)
    counts = id_counts(made, size, kind)
    lengths = code_lengths(counts, limit)
    files = int(min(MAX_FILES, max(1, -(-int(counts.sum()) // FILE_IDS))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, part = Coder(lengths), TaskContext.get().partitionId()
        held, stretches, n, place, number = [], [], 0, 0, 0
        rows: list[tuple] = []

        def block() -> tuple:
            bits, checkpoints = coder.encode(np.concatenate(held).astype(np.int64))
            return part, number, place - n, n, checkpoints.tobytes(), bits, stretches

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), _DOCS]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in BLOCKS.split(", ", 6)])

        for batch in batches:
            for did, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, at, begin = np.frombuffer(raw.as_py(), kind), 0, place
                while at < len(ids):
                    take = min(block_ids - n, len(ids) - at)
                    held.append(ids[at : at + take])
                    stretches.append({"did": did, "start": begin, "n_tokens": len(ids), "at": at, "length": take})
                    n, at, place = n + take, at + take, place + take
                    if n == block_ids:
                        rows.append(block())
                        held, stretches, n, number = [], [], 0, number + 1
                    if len(rows) == 16:
                        yield batch_of(rows)
                        rows = []
        if n:
            rows.append(block())
        if rows:
            yield batch_of(rows)

    order = ["did", F.xxhash64("ids"), "row"]
    ranged = made.select("did", "ids", "row").repartitionByRange(files, *order).sortWithinPartitions(*order)
    blocks = ranged.select("did", "ids").mapInArrow(run, BLOCKS)
    blocks.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    codes = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(codes, "id long, length int").coalesce(1).write.parquet(f"{folder}/codes")
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts.select("part", before.alias("before")).coalesce(1).write.parquet(f"{folder}/parts")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, at, ids`` of every stretch of every document in token files.

    ``start`` counts the ids of all documents before; ``at`` those of the document before the stretch. ``ids`` are little-endian
    unsigned 32-bit values. A document within one block has one stretch.
    """
    pairs = spark.read.parquet(f"{folder}/codes").collect()  # at most one row per vocabulary entry
    lengths = np.zeros(max([p.id for p in pairs], default=0) + 1, dtype=np.uint8)
    for p in pairs:
        lengths[p.id] = p.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(lengths)
        for whole in batches:
            for at in range(0, whole.num_rows, 16):
                batch = whole.slice(at, 16)
                given = [
                    (b, np.frombuffer(c, "<u4"), n)
                    for b, c, n in zip(*(batch.column(k).to_pylist() for k in (2, 1, 0)), strict=True)
                ]
                columns: list[list] = [[], [], [], [], []]
                for ids, before, held in zip(coder.decode(given), *(batch.column(k) for k in (3, 4)), strict=True):
                    raw, place, base = ids.astype("<u4").tobytes(), 0, before.as_py()
                    for d in held.as_py():
                        end = place + 4 * d["length"]
                        values = (d["did"], base + d["start"], d["n_tokens"], d["at"], raw[place:end])
                        for column, value in zip(columns, values, strict=True):
                            column.append(value)
                        place = end
                kinds = [pa.int64()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["did", "start", "n_tokens", "at", "ids"],
                )

    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    parts = F.broadcast(spark.read.parquet(f"{folder}/parts"))  # at most MAX_FILES rows
    read = blocks.join(parts, "part").select("n_ids", "checkpoints", "bits", "before", "docs")
    read = read.mapInArrow(run, "did long, start long, n_tokens long, at long, ids binary")
    return read.select(outward("did").alias("doc_id"), "start", "n_tokens", "at", "ids")


def _product(a: int, b: int) -> int:
    """The product of two bit-reversed polynomials modulo that of CRC-32."""
    made = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            made ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return made


def joined_crc(pieces: list[tuple[int, int]]) -> int:
    """The CRC-32 of bytes known by the (CRC-32, length) of their consecutive pieces."""
    total = 0
    for crc, length in pieces:
        power, square, bits = 1 << 31, 1 << 30, 8 * length  # x to the power of bits, by squaring
        while bits:
            if bits & 1:
                power = _product(power, square)
            square, bits = _product(square, square), bits >> 1
        total = _product(power, total) ^ crc
    return total


def digest(stretches: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, start, n_tokens, ids_crc32``, from the CRC-32 of its stretches."""
    piece = F.struct("at", (F.octet_length("ids")).cast("long").alias("length"), F.crc32("ids").alias("crc"))
    grouped = stretches.groupBy("doc_id", "start", "n_tokens").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = [
                p[0]["crc"] if len(p) == 1 else joined_crc([(x["crc"], x["length"]) for x in p])
                for p in batch.column(3).to_pylist()
            ]
            columns = [*batch.columns[:3], pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return grouped.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write the ids of ``docs`` to token files in the shared folder and read their digest back."""
    folder = shared_folder(docs.sparkSession, "token-files")
    write_ids(docs, folder, **options)
    return digest(read_ids(docs.sparkSession, folder))
