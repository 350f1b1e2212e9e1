"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence scores ``sigmoid(bias + sum of its word weights)`` and the document
``1 - product(1 - sentence score)`` (noisy-or), so one bad sentence is enough and many clean ones do no harm. Only
documents have labels; the weights are fitted to them by gradient descent through the noisy-or, and the sentences that
make a document toxic come out as a by-product.

A word has a weight for itself and one for each of its first ``PREFIXES`` letters, so that inflected forms share what their
stem is worth; all are hashed to ``2**BITS`` weights. Training takes at most ``SAMPLE`` labelled documents of each
label, those with the smallest hash of their id, and ends a label's sample with the document that brings it to
``SAMPLE_CHARS`` characters; no document is left out or cut for its length. Scoring covers every word of every document
in Arrow batches without a shuffle.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.llm.columns import NO_ID, ident, outward, row_key
from tracklens.session import written

BITS = 18
PREFIXES = (4, 5, 6)
WIDTH = 1 + len(PREFIXES)
SAMPLE = 3000
SAMPLE_CHARS = 8_000_000
ROUNDS = 150
RATE = 4.0
BIAS_RATE = 0.4
MOMENTUM = 0.9
DECAY = 0.2
THRESHOLD = 0.3
#: The bias of a model that has not seen both labels: 1e-17 a sentence, so no number of sentences reaches the threshold.
NOTHING_LEARNT = -40.0
CACHED_WORDS = 200_000

_sentence_end = re.compile(r"(?<=[.!?])\s+|\n+")
_word = re.compile(r"[^\W\d_]+")


class _Slots(dict):
    """Word to its weight slots as packed 32-bit values; remembers a bounded number of words."""

    def __missing__(self, word: str) -> bytes:
        parts = [word, *[f"{n}:{word[:n]}" for n in PREFIXES]]
        slots = [xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass"), 3) & ((1 << BITS) - 1) for p in parts]
        made = array("i", slots).tobytes()
        if len(self) < CACHED_WORDS:
            self[word] = made
        return made


_slot_of = _Slots()


def sentences(text: str | None) -> list[str]:
    """The sentences of a text, without empty ones."""
    return [s for s in _sentence_end.split(text or "") if s.strip()]


def slots(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Weight slots of the words in order, and where each sentence with a word starts in them."""
    packed: list[bytes] = []
    starts: list[int] = []
    for sentence in sentences(text):
        words = dict.fromkeys(_word.findall(sentence.lower()))  # a word repeated in its sentence says no more
        if words:
            starts.append(len(packed) * WIDTH)
            packed.extend(map(_slot_of.__getitem__, words))
    return np.frombuffer(b"".join(packed), dtype=np.int32), np.array(starts, dtype=np.int64)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Model:
    """Weights by slot and the bias of a sentence."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def sentence_scores(self, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.empty(0)
        return _sigmoid(self.bias + np.add.reduceat(self.weights[flat].astype(np.float64), starts))

    def score(self, text: str | None) -> tuple[float, int]:
        """Noisy-or of the sentence scores (0 for a text without words) and the worst sentence's number, from 0."""
        flat, starts = slots(text)
        each = self.sentence_scores(flat, starts)
        if not len(each):
            return 0.0, -1
        return float(-np.expm1(np.log1p(-np.minimum(each, 1 - 1e-12)).sum())), int(each.argmax())


def fit(
    bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rounds: int = ROUNDS, share: float = 0.5
) -> Model:
    """Gradient descent with momentum of the cross-entropy of the noisy-or; toxic documents weigh ``share`` in sum.

    Steps follow the gradient's size, so a word that many toxic documents share moves first and words of one document hardly.
    """
    bags_at = [i for i, (_, starts) in enumerate(bags) if len(starts)]
    size = 1 << BITS
    weights = np.zeros(size)
    if not bags_at or len(set(labels[bags_at].tolist())) < 2:
        return Model(weights, NOTHING_LEARNT)
    y = labels[bags_at].astype(np.float64)
    flat = np.concatenate([bags[i][0] for i in bags_at])
    counts = np.array([len(bags[i][1]) for i in bags_at])
    bias = min(-4.0, -float(np.log(counts.mean())))  # long documents do not start out as toxic
    offsets = np.cumsum([0] + [len(bags[i][0]) for i in bags_at[:-1]])
    starts = np.concatenate([bags[i][1] + o for i, o in zip(bags_at, offsets, strict=True)])
    lengths = np.diff(np.append(starts, len(flat)))
    of_doc = np.repeat(np.arange(len(y)), counts)
    first = np.cumsum(np.append(0, counts[:-1]))
    importance = np.where(y == 1, share / max(1, y.sum()), (1 - share) / max(1, (1 - y).sum()))
    speed, bias_speed, decay = np.zeros(size), 0.0, DECAY / len(y)  # the fewer documents, the less a word may grow
    for _ in range(rounds):
        p = _sigmoid(bias + np.add.reduceat(weights[flat], starts))
        clean = np.log1p(-np.minimum(p, 1 - 1e-9))
        none = np.add.reduceat(clean, first)  # logarithm of the probability that no sentence is toxic
        none, doc = np.exp(none), np.maximum(-np.expm1(none), 1e-300)
        # d loss / d logit of a sentence: p for a clean document, -p * none / doc for a toxic one
        # no document pulls with more than 1 in sum, or one with thousands of sentences would throw the bias out of reach
        grad = p * np.where(y == 1, -none / doc, 1 / np.maximum(1, np.add.reduceat(p, first)))[of_doc] * importance[of_doc]
        by_word = np.bincount(flat, weights=np.repeat(grad, lengths), minlength=size) + decay * weights
        speed = MOMENTUM * speed - RATE * by_word
        bias_speed = MOMENTUM * bias_speed - BIAS_RATE * grad.sum()
        weights += speed
        bias += bias_speed
    return Model(weights, bias)


def held_out(id_col: Column) -> Column:
    """Whether a document is kept away from training."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_chars: int = SAMPLE_CHARS) -> Model:
    """A model from the documents that have a label and are not held out.

    Rows without an id or label are not used. An id with several rows or labels is used once: with the largest label
    and the text of smallest hash. With one label only, or none, the model calls every document clean.
    """
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("did"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("did").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy("did")
        .agg(F.max("toxic").alias("toxic"))
        .where(~held_out(F.col("did")))
    )
    chosen = None
    for label in (0, 1):
        part = marked.where(F.col("toxic") == label).orderBy(F.xxhash64("did"), "did").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = written(chosen, "toxicity-sample")
    picked = docs.select(F.col("doc_id").cast("long").alias("did"), F.col("text").cast("string").alias("text"))
    picked = picked.withColumn("mark", F.xxhash64("text"))
    # at most twice the sample, a few bytes a row
    sizes = picked.select("did", "mark", F.coalesce(F.char_length("text"), F.lit(0)).alias("n"))
    sizes = sizes.join(F.broadcast(chosen), "did").groupBy("did", "toxic")
    sizes = sizes.agg(F.min(F.struct("mark", "n")).alias("first"), F.xxhash64("did").alias("place"))
    kept, chars = [], {0: 0, 1: 0}
    for row in sorted(sizes.collect(), key=lambda r: (r.place, r.did)):
        if chars[row.toxic] < sample_chars:
            chars[row.toxic] += row.first.n
            kept.append((row.did, row.first.mark, row.toxic))
    wanted = docs.sparkSession.createDataFrame(kept, "did long, mark long, toxic int")
    texts = picked.join(F.broadcast(wanted), ["did", "mark"]).groupBy("did", "mark", "toxic")
    texts = texts.agg(F.min("text").alias("text")).select("did", "toxic", "text")  # a repeated row once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [slots(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([flat.tobytes() for flat, _ in made], pa.binary()),
                    pa.array([starts.astype(np.int32).tobytes() for _, starts in made], pa.binary()),
                ],
                names=["did", "toxic", "flat", "starts"],
            )
        _slot_of.clear()  # the worker goes on, its next task starts afresh

    made = texts.mapInArrow(run, "did long, toxic int, flat binary, starts binary")
    once = {row.did: (bytes(row.flat), bytes(row.starts), row.toxic) for row in made.toLocalIterator()}
    rows = [once[k] for k in sorted(once)]
    bags = [(np.frombuffer(f, np.int32), np.frombuffer(s, np.int32).astype(np.int64)) for f, s, _ in rows]
    count = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    share = count.get(1, 0) / max(1, sum(count.values()))  # as frequent as among all labels, whatever was sampled
    return fit(bags, np.array([t for *_, t in rows], dtype=np.int64), share=share)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, worst`` for every row: the document's score and its worst sentence ('' without words).

    NULL, empty and wordless texts score 0. Repeated rows stay. Other columns of the input are ignored.
    """
    # 2**BITS weights, whatever the data
    sent = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), float(model.bias)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*sent.value)
        for batch in batches:
            scores, worst = [], []
            for text in batch.column(1):
                found, at = own.score(text := text.as_py())
                with_words = [s for s in sentences(text) if _word.search(s)] if found >= THRESHOLD else []
                scores.append(found)
                worst.append(with_words[at] if with_words else "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(worst, pa.string())],
                names=["did", "score", "worst"],
            )
        _slot_of.clear()

    picked = docs.select(ident(id_col).alias("did"), F.col(text_col).cast("string").alias("text"))
    made = picked.mapInArrow(run, "did long, score double, worst string")
    return made.select(outward("did").alias("doc_id"), "score", "worst")


def reject(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` scoring under the threshold, all columns kept; each row goes by its own text."""
    keyed = docs.select(row_key("doc_id", "text").alias("doc_id"), "text")
    scored = score(keyed, train(docs, labels)).where(F.col("score") >= threshold)
    bad = scored.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("tx_bad")).distinct()
    return docs.join(bad, row_key("doc_id", "text") == F.col("tx_bad"), "left_anti")
