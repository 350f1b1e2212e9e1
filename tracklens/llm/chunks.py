"""What the tokenisers of this subpackage share: columns in which each distinct string is encoded once, and a model fed with
many words at a time."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 32_000_000
WORDS_AT_ONCE = 100
LIBRARY_CHARS = 300_000
#: Latin letters beyond ASCII that no normal form changes and that have one lower-case letter each.
LATIN = "\xc0-\xd6\xd8-\xf6\xf8-įĲ-ž"
_LETTERS, _MARK = f"[A-Za-z{LATIN}]+", r"[!-/:-@\[-`{-~]+"
WORD = f"^{_LETTERS}$"
#: Chunks made of ASCII and those letters, and the pieces that byte-level pre-tokenizers cut them into.
PLAIN = f"^[!-~{LATIN}]+$"
PIECE = f"('s|'t|'re|'ve|'m|'ll|'d|{_LETTERS}|[0-9]%s|{_MARK}|\n)"


@lru_cache(maxsize=2)
def tokenizers_of(path: str):
    """The tokenizer, and its model with line ends between words in place of the pre-tokenizer.

    Kept by the worker process, since making one again for each task would leak; one thread, as Spark has the cores.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    whole = Tokenizer.from_file(path)
    model = Tokenizer(whole.model)
    model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
    return whole, model


@lru_cache(maxsize=1)
def byte_alphabet() -> dict[int, str]:
    """The letters of byte-level models: visible bytes stand for themselves, the others follow from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in visible)}
    return {b: hidden.get(b, chr(b)) for b in range(256)}  # none is missing, which would be slow to look up


def lettered(word: str) -> str:
    """A word in the letters of a byte-level model."""
    return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(byte_alphabet())


def _offsets(ids: pa.Array) -> np.ndarray:
    return np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1, 4 * ids.offset) if len(ids) else np.zeros(1, np.int32)


def pooled(values: pa.Array, made: Callable[[pa.Array], pa.Array]) -> pa.Array:
    """``made(values)``, called with the distinct values only."""
    coded = values.dictionary_encode()
    return made(coded.dictionary).take(coded.indices)


def grouped(edges: np.ndarray, ids: pa.Array) -> pa.Array:
    """The binary values from each edge to the next as one."""
    at = _offsets(ids)[edges].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(at), ids.buffers()[2]])


def interleaved(mask: np.ndarray, yes: pa.Array, no: pa.Array) -> pa.Array:
    """One array with the values of ``yes`` where the mask is set and of ``no`` elsewhere, each in its order."""
    order = np.empty(len(mask), np.int64)
    order[mask], order[~mask] = np.arange(len(yes)), len(yes) + np.arange(len(no))
    return pa.concat_arrays([yes, no]).take(pa.array(order))


def pieces_of(chunks: pa.Array, piece: str, before: str = "") -> tuple[np.ndarray, pa.Array]:
    """The pieces of all chunks, the first of each after ``before``, and the edges between chunks."""
    more = pc.invert(pc.match_substring_regex(chunks, WORD))
    cut = pc.utf8_rtrim(pc.replace_substring_regex(chunks.filter(more), piece, "\\1\0"), "\0")
    lists = pc.split_pattern(pc.binary_join_element_wise(before, pc.replace_with_mask(chunks, more, cut), ""), "\0")
    return np.asarray(lists.offsets), lists.flatten()


def spelled(model, words: list[str], kind: np.dtype, ends) -> pa.Array:
    """The ids of each word, ``WORDS_AT_ONCE`` at a time; ``ends(ids, words)`` says at which ids the words end."""
    raw, stops, base = [], [np.zeros(1, np.int64)], 0
    for at in range(0, len(words), WORDS_AT_ONCE):
        part = words[at : at + WORDS_AT_ONCE]
        ids = np.array(model.encode_batch_fast(["\n".join(part)], add_special_tokens=False)[0].ids, kind)
        found = ends(ids, part)
        if len(found) != len(part) or found[-1] + 1 != len(ids):
            raise ValueError("the model's tokens do not cover the words given to it")
        raw.append(ids.tobytes())
        stops.append(base + found + 1)
        base += len(ids)
    at = (np.concatenate(stops) * kind.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(at), pa.py_buffer(b"".join(raw))])


def encoded(tokenizer, texts: list[str], kind: np.dtype) -> pa.Array:
    """The ids of each text by the whole tokenizer, some ``LIBRARY_CHARS`` at a time: the library's results are many times larger."""
    out: list[bytes] = []
    first = size = 0
    for at, text in enumerate(texts, 1):
        size += len(text) + 20
        if size >= LIBRARY_CHARS or at == len(texts):
            made = tokenizer.encode_batch_fast(texts[first:at], add_special_tokens=False)
            out += [np.array(e.ids, kind).tobytes() for e in made]
            first, size = at, 0
    return pa.array(out, pa.binary())


def text_slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with some ``SLICE_BYTES`` of text each, one row at least."""
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64))
    cuts = np.flatnonzero(np.diff(sizes // SLICE_BYTES)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)
            pa.default_memory_pool().release_unused()  # of what the slice before took
