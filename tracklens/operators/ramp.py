"""The ramp limit: a command that follows its target by at most ``rate`` per second.

``cmd += clamp(want - cmd, -rate * dt, +rate * dt)``, starting from 0, is a recursion over one series:
no window frame says it, so Spark shuffles and sorts the series and Arrow batches stream through it
with a command and a time in hand; no series is ever held whole.

A series too large for one task is cut into slices, and each slice becomes a transfer map: the command it ends with for
every command it could start from. A step never reverses two commands, and moves all those out of reach of the target by the same
amount, so a map is where the lowest start leads and the stretches of starts that still lead to different ends (``Rising``).
Maps are found in parallel, applied in slice order, one number in hand, and each slice is then followed from its own start: as
many tasks as slices, however slow the ramp is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tracklens.operators.ordered import _PARTS, SLICE, SLICE_ROWS, slices

_CHUNK = 4096


def step(cmd: float, want: float, limit: float) -> float:
    """One step: towards ``want`` by at most ``limit``."""
    gap = want - cmd
    if gap > limit:
        return cmd + limit
    return cmd - limit if gap < -limit else cmd + gap


def _in_order(df: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """Each group whole in one partition, its rows together and in order."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *groups).sortWithinPartitions(*groups, *order)


def _key(batch: pa.RecordBatch, names: list[str], row: int) -> tuple:
    return tuple(batch.column(n)[row].as_py() for n in names)


def _stretches(batch: pa.RecordBatch, names: list[str], last: tuple | None) -> list[tuple[int, int, bool]]:
    """The rows of each group in a sorted batch as (from, to, new group?); the first may go on from the batch before."""
    n = batch.num_rows
    changed = np.zeros(n, dtype=bool)
    for name in names:
        here, before = batch.column(name).slice(1), batch.column(name).slice(0, n - 1)
        one_missing = pc.xor(pc.is_null(here), pc.is_null(before))
        differs = pc.or_(one_missing, pc.fill_null(pc.not_equal(here, before), False))
        changed[1:] |= differs.to_numpy(zero_copy_only=False)
    new = _key(batch, names, 0) != last
    cuts = [0, *np.flatnonzero(changed).tolist(), n]
    return [(i, j, new or i > 0) for i, j in zip(cuts, cuts[1:])]  # noqa: B905


class _Steps:
    """The targets and limits of a batch's rows; a row that cannot move (no target, no elapsed time) has limit 0."""

    def __init__(self, batch: pa.RecordBatch, rate: float):
        us, want = batch.column("_us"), batch.column("_want")
        self.rate = rate
        self.timed = pc.is_valid(us).to_numpy(zero_copy_only=False)
        self.wanted = pc.is_valid(want).to_numpy(zero_copy_only=False)
        self.us = pc.fill_null(us, 0).to_numpy(zero_copy_only=False)
        limits = np.zeros(batch.num_rows)
        limits[1:] = rate * (np.diff(self.us) / 1_000_000.0)
        moves = self.wanted & self.timed
        moves[1:] &= self.timed[:-1]
        self.limits = np.where(moves, limits, 0.0).tolist()
        self.wants = pc.fill_null(want, 0.0).to_numpy(zero_copy_only=False).tolist()

    def begin(self, row: int, before: int | None) -> None:
        """Set the first row of a stretch against the time before it, which the batch may not hold."""
        known = before is not None and self.timed[row] and self.wanted[row]
        self.limits[row] = self.rate * ((int(self.us[row]) - before) / 1_000_000.0) if known else 0.0

    def time(self, row: int) -> int | None:
        return int(self.us[row]) if self.timed[row] else None


def _same(left: list[str], right: DataFrame):
    cond = F.lit(True)
    for k in left:
        cond = cond & F.col(k).eqNullSafe(right[f"_r_{k}"])
    return cond


class Rising:
    """Which starts of a slice still lead to different ends: stretches of starts along which the end rises one for one.

    Between two stretches all starts lead to the same end. A step with target w and limit L makes one end of all ends within L
    of w, which takes the stretches with those ends out; all other differences stay as they are. So nothing is ever
    shifted, and a step changes only what it takes out. Stretches lie in blocks with their lengths added up, so one that
    concerns few of them passes over the rest by blocks.
    """

    BLOCK = 512

    def __init__(self, low: float, high: float):
        self.blocks: list[list[tuple[float, float]]] = [[(low, high - low)]]
        self.sums = [high - low]

    def take(self, begin: float, end: float) -> None:
        """Take out what lies between two lengths, measured along the stretches from the lowest start."""
        place, k = 0.0, 0
        while k < len(self.blocks) and place < end:
            size = self.sums[k]
            if place + size <= begin:
                place, k = place + size, k + 1
                continue
            if begin <= place and place + size <= end:
                del self.blocks[k], self.sums[k]
                place += size
                continue
            kept = []
            for start, length in self.blocks[k]:
                if place < begin:
                    kept.append((start, min(length, begin - place)))
                if place + length > end:
                    cut = max(0.0, end - place)
                    kept.append((start + cut, length - cut))
                place += length
            parts = [kept[i : i + self.BLOCK] for i in range(0, len(kept), self.BLOCK)]
            self.blocks[k : k + 1] = parts
            self.sums[k : k + 1] = [sum(n for _, n in p) for p in parts]
            k += len(parts)

    def clear(self) -> None:
        self.blocks, self.sums = [], []

    def stretches(self) -> list[tuple[float, float]]:
        return [s for block in self.blocks for s in block]


def ramp_limit(
    df: DataFrame,
    rate: float,
    keys: tuple[str, ...] = ("device",),
    want: str = "sp",
    order: tuple[str, ...] = ("ts", "event_id"),
    out: str = "cmd",
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add the ramped command; the first order column is the time.

    The first row of a series has no elapsed time, so it starts at 0. A row without a target holds the
    command. ``rate <= 0`` disables the limit. With slices, a start that comes from a map may differ from that of the recursion by
    rounding, some 1e-16 of the range; where a slice forgets its start the end is the very same.
    """
    if rate <= 0:
        return df.withColumn(out, F.col(want).cast("double"))
    keys, order, given = list(keys), list(order), df.columns
    slice_keys = [*keys, SLICE]
    sliced = slices(df, keys, order, rows).withColumns(
        {"_us": F.unix_micros(F.col(order[0]).cast("timestamp")), "_want": F.col(want).cast("double")}
    )
    key_fields = [sliced.schema[k] for k in slice_keys]
    fields = [
        T.StructField("_chunk", T.IntegerType()),
        T.StructField("_first_us", T.LongType()),
        T.StructField("_first_want", T.DoubleType()),
        T.StructField("_last_us", T.LongType()),
        T.StructField("_low", T.DoubleType()),
        T.StructField("_high", T.DoubleType()),
        T.StructField("_starts", T.ArrayType(T.DoubleType())),
        T.StructField("_lengths", T.ArrayType(T.DoubleType())),
    ]
    map_schema = T.StructType([*key_fields, *fields])
    map_arrow = to_arrow_schema(map_schema)

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per slice its map from the command after its first row, whose elapsed time the slice before decides."""
        group, first, before, low, high, rising = None, None, None, 0.0, 0.0, None

        def made() -> list[tuple]:
            held = rising.stretches()
            return [
                (*group, at // _CHUNK, *first, before, low, high, *_columns(held[at : at + _CHUNK]))
                for at in range(0, max(1, len(held)), _CHUNK)
            ]

        for batch in batches:
            if batch.num_rows == 0:
                continue
            steps, done = _Steps(batch, rate), []
            for i, j, new in _stretches(batch, slice_keys, group):
                if new:
                    done += made() if group is not None else []
                    group, before = _key(batch, slice_keys, i), None
                    first = (steps.time(i), steps.wants[i] if steps.wanted[i] else None)
                    low, high = batch.column("_least")[i].as_py(), batch.column("_most")[i].as_py()
                    rising = Rising(low, high)
                steps.begin(i, before)
                for w, limit in zip(steps.wants[i:j], steps.limits[i:j], strict=True):
                    if low == high:
                        low = high = step(low, w, limit)
                        continue
                    if limit > 0.0 and w + limit > low and w - limit < high:
                        rising.take(w - limit - low, w + limit - low)
                    low, high = step(low, w, limit), step(high, w, limit)
                    if low == high:
                        rising.clear()
                before = steps.time(j - 1)
            yield _batch(done, map_arrow)
        if group is not None:
            yield _batch(made(), map_arrow)

    start_schema = T.StructType(
        [*key_fields, T.StructField("_start", T.DoubleType()), T.StructField("_start_us", T.LongType())]
    )
    start_arrow = to_arrow_schema(start_schema)

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What each slice starts with: the maps of a series applied in slice order, a chunk of one at a time."""
        series, number, cmd, last, at, low, high, rise = None, None, 0.0, None, 0.0, 0.0, 0.0, 0.0

        def end() -> float:
            return low if low == high else min(high, low + rise)

        for batch in batches:
            done = []
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                if key != series:
                    series, number, cmd, last = key, None, 0.0, None
                if row[SLICE] != number:
                    if number is not None:
                        cmd, last = end(), row_last
                    number, rise, low, high, row_last = row[SLICE], 0.0, row["_low"], row["_high"], row["_last_us"]
                    done.append((*key, number, cmd, last))
                    moves = last is not None and row["_first_us"] is not None and row["_first_want"] is not None
                    limit = rate * ((row["_first_us"] - last) / 1_000_000.0) if moves else 0.0
                    at = step(cmd, row["_first_want"], limit) if moves else cmd
                if row["_starts"]:
                    begins = np.array(row["_starts"])
                    rise += float(np.clip(at - begins, 0.0, np.array(row["_lengths"])).sum())
            yield _batch(done, start_arrow)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, cmd, before = None, 0.0, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            steps, cmds = _Steps(batch, rate), []
            for i, j, new in _stretches(batch, slice_keys, group):
                if new:
                    group = _key(batch, slice_keys, i)
                    cmd, before = batch.column("_start")[i].as_py(), batch.column("_start_us")[i].as_py()
                steps.begin(i, before)
                for w, limit in zip(steps.wants[i:j], steps.limits[i:j], strict=True):
                    cmd = step(cmd, w, limit)
                    cmds.append(cmd)
                before = steps.time(j - 1)
            kept = [batch.column(n) for n in given]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(cmds, pa.float64())], names=[*given, out])

    large = sliced.filter(F.col(_PARTS) > 1).select(*slice_keys, *[c for c in order if c not in keys], "_us", "_want")
    bounds = large.groupBy(*keys).agg(
        F.least(F.coalesce(F.min("_want"), F.lit(0.0)), F.lit(0.0)).alias("_least"),
        F.greatest(F.coalesce(F.max("_want"), F.lit(0.0)), F.lit(0.0)).alias("_most"),
    )
    bounds = bounds.select(*[F.col(k).alias(f"_r_{k}") for k in keys], "_least", "_most")
    bounded = large.join(F.broadcast(bounds), _same(keys, bounds)).drop(*[f"_r_{k}" for k in keys])
    found = _in_order(bounded, slice_keys, order).mapInArrow(maps, map_schema)
    begins = _in_order(found, keys, [SLICE, "_chunk"]).mapInArrow(starts, start_schema)
    begins = begins.withColumnsRenamed({k: f"_r_{k}" for k in slice_keys})
    ready = sliced.join(F.broadcast(begins), _same(slice_keys, begins), "left").select(
        *given,
        *([] if SLICE in given else [SLICE]),
        "_us",
        "_want",
        F.coalesce("_start", F.lit(0.0)).alias("_start"),
        "_start_us",
    )
    result = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
    return _in_order(ready, slice_keys, order).mapInArrow(follow, result)


def _columns(stretches: list[tuple[float, float]]) -> tuple[list[float], list[float]]:
    return [s for s, _ in stretches], [n for _, n in stretches]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
