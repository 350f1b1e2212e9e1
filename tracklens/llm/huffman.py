"""Canonical, length-limited Huffman codes over token ids, coded and decoded with numpy.

A stream of ids is cut into blocks. A block's bits start at a byte of its own, and every ``STEP`` ids a checkpoint holds
the bit at which they begin, so that all stretches of a block are decoded side by side: one table look-up per id, in
lanes. The table has ``2 ** LIMIT`` entries, which the limit on code lengths makes small.
"""

from __future__ import annotations

import numpy as np

LIMIT = 18
STEP = 256


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """The bits of each id's code, 0 for an id that never occurs: the least total length with no code over ``limit``.

    Package-merge: at each of ``limit`` levels the ids and the pairs of the level before are merged by weight. The
    cheapest ``2n - 2`` entries of the last level say how many of the lightest ids take part at each level; an id's
    length is the number of levels it takes part in. Ties go to the smaller id.
    """
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} ids need codes of over {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    is_leaf, weights = [np.ones(n, dtype=bool)], leaves
    for _ in range(limit - 1):
        pairs = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        order = np.argsort(both, kind="stable")
        weights = both[order]
        is_leaf.append(order < n)
    taken = 2 * n - 2
    for level in reversed(is_leaf):
        own = int(level[:taken].sum())
        lengths[used[:own]] += 1
        taken = 2 * (taken - own)
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids by (length, id) and each one's code: codes count up, and move left where they get longer."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.argsort(lengths[ids], kind="stable")]
    sizes = lengths[ids].astype(np.int64)
    if not len(ids):
        return ids, sizes
    # aligned to the longest code, each code starts where the one before ends
    spans = np.int64(1) << (sizes[-1] - sizes)
    first = np.cumsum(spans) - spans
    return ids, first >> (sizes[-1] - sizes)


class Coder:
    """Both directions for one table of code lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        ids, codes = canonical(lengths)
        self.codes = np.zeros(len(lengths), dtype=np.uint64)
        self.codes[ids] = codes.astype(np.uint64)
        self.width = max(1, int(lengths.max(initial=0)))
        if self.width > 25:
            raise ValueError("codes of over 25 bits do not fit the 32-bit window of the decoder")
        spans = 1 << (self.width - self.lengths[ids])
        self.symbol = np.zeros(1 << self.width, dtype=np.uint32)
        self.size = np.ones(1 << self.width, dtype=np.int64)
        end = int(spans.sum())
        self.symbol[:end] = np.repeat(ids, spans)
        self.size[:end] = np.repeat(self.lengths[ids], spans)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of a block, and the bit at which every ``STEP``-th id begins."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        starts = ends - sizes
        word = starts >> 5
        room = (64 - (starts & 31) - sizes).astype(np.uint64)
        shifted = self.codes[ids] << room
        first = np.flatnonzero(np.diff(word, prepend=-1))
        # codes of one word have no bit in common, so their sum holds them all
        sums = np.add.reduceat(shifted, first)
        out = np.zeros(int(ends[-1] >> 5) + 2, dtype=np.uint32)
        at = word[first]
        out[at] |= (sums >> np.uint64(32)).astype(np.uint32)
        out[at + 1] |= (sums & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return out.astype(">u4").tobytes()[: int(ends[-1] + 7) // 8], starts[::STEP].astype("<u4")

    def decode(self, blocks: list[tuple[bytes, np.ndarray, int]]) -> list[np.ndarray]:
        """The ids of several blocks of (bits, checkpoints, number of ids), all lanes at once."""
        base, at = [], 0
        for bits, _, _ in blocks:
            base.append(at)
            at += len(bits)
        tail = STEP * self.width // 8 + 8  # short lanes run on to the full number of steps
        raw = np.frombuffer(b"".join([b for b, _, _ in blocks]) + bytes(tail), np.uint8).astype(np.uint32)
        window = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
        place = np.concatenate([c.astype(np.int64) + 8 * b for b, (_, c, _) in zip(base, blocks, strict=True)])
        out = np.empty((STEP, len(place)), dtype=np.uint32)
        drop = np.uint32(32 - self.width)
        for step in range(STEP):
            key = (window[place >> 3] << (place & 7).astype(np.uint32)) >> drop
            out[step] = self.symbol[key]
            place += self.size[key]
        lanes, made, lane = out.T, [], 0
        for _, checkpoints, n in blocks:
            made.append(lanes[lane : lane + len(checkpoints)].reshape(-1)[:n])
            lane += len(checkpoints)
        return made
