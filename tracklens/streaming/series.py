"""Keyed state for series read as streams: rows of a key in order of time, whatever order they arrive in.

A processor holds one value per key, rows that wait, and one timer. It works in one of two ways:

* **at once**: the rows of a micro-batch are put in order and followed; a row older than the last one followed is counted and dropped;
* **buffered** (with a lateness): rows wait in time buckets until the watermark has passed their bucket, so arrival order
  within the lateness does not matter. A row whose bucket has been followed already comes out as a row that is late.

A call of the state costs more than following a row, so a key makes few of them: one value holds everything, and a few waiting
rows travel in it. More rows are read in chunks and wait in map state, a part per chunk and span of time; spans are powers of two times a
bucket and nest, so a chunk is few entries however many buckets it touches. Spans are followed in order; one that holds many
parts is cut finer first, down to single buckets, so neither a hot key nor a large micro-batch becomes one frame. A batch of one chunk
is followed directly. Where silence matters, an event-time timer ends it: the processor says what comes out, and the key's state leaves.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import chain, groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: So many waiting rows at most travel in the value; a span of a chunk holds about as many.
FEW_ROWS = 1000
#: A span of more parts is cut into so many times finer ones before it is followed.
FEW_PARTS = 16
FINER = 64
#: Where rows without a time wait: before all others.
UNTIMED = -(2**62)


@contextmanager
def state_provider(spark: SparkSession):
    """The store that map state and timers need, set while a query starts and put back afterwards."""
    before = spark.conf.get(PROVIDER_KEY, None)
    spark.conf.set(PROVIDER_KEY, PROVIDER)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER_KEY)
        else:
            spark.conf.set(PROVIDER_KEY, before)


def micros_of(interval: str) -> int:
    """The length of a fixed interval such as ``12 hours``."""
    return int(pd.Timedelta(interval) / pd.Timedelta(microseconds=1))


def _in_order(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.sort_values(["us", "event_id"], kind="stable", na_position="first")


def _packed(frame: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


@dataclass
class _Waiting:
    """A key's waiting rows: the next part's number, the entries in map state, the first time, and rows not in map state."""

    part: int = 0
    held: int = 0
    first: int | None = None
    few: pd.DataFrame | None = None


def _span(entry: tuple[int, int, int]) -> tuple[int, int]:
    """The start and width of an entry's span."""
    first, width, _ = entry
    return first // width * width, width


def _by_span(entry: tuple[int, int, int]) -> tuple[int, int, int]:
    """Spans in order of time, a wider one before those in it."""
    start, width = _span(entry)
    return start, -width, entry[2]


class Series(StatefulProcessor):
    """Base of the processors: a subclass gives ``STATE``, ``START``, ``COLUMNS`` and :meth:`follow`.

    The state's first field is the time of the last row followed, its last one the number of late rows.
    """

    STATE: str
    START: tuple
    COLUMNS: list[str]

    def __init__(self, lateness: str | None = None, idle_s: float | None = None):
        self.width = max(1000, micros_of(lateness) // 16) if lateness is not None else None
        self.idle = int(idle_s * 1_000_000) if idle_s is not None else None

    def follow(self, key: tuple, state: tuple, rows: pd.DataFrame) -> tuple[tuple, list[tuple]]:
        """The state after ordered rows, and what comes out."""
        raise NotImplementedError

    def late(self, key: tuple, state: tuple, rows: pd.DataFrame) -> list[tuple]:
        """What comes out for rows that are late, where rows are buffered."""
        return []

    def silent(self, key: tuple, state: tuple) -> list[tuple]:
        """What comes out when a key has been silent for the idle time."""
        return []

    # ---- calls of the engine ----

    def init(self, handle) -> None:
        self.handle = handle
        self.value = handle.getValueState(
            "value", f"{self.STATE}, timer BIGINT, part BIGINT, held BIGINT, first BIGINT, few BINARY"
        )
        self.waiting = handle.getMapState("waiting", "first BIGINT, width BIGINT, part BIGINT", "rows BINARY")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state, timer, wait = self._load()
        if self.width is None:
            ahead = [c for c in (next(rows, None), next(rows, None)) if c is not None]
            if len(ahead) < 2:
                for chunk in ahead:
                    state, out = self.follow(key, state, _in_order(chunk))
                    yield self._frame(out)
            else:
                for chunk in chain(ahead, rows):
                    self._hold(chunk, wait)
                for frame in self._due(None, wait):
                    state, out = self.follow(key, state, frame)
                    yield self._frame(out)
        else:
            done = self._followed(timerValues)
            for chunk in rows:
                late, untimed = chunk["us"] < done, chunk["us"].isna()
                if late.any():
                    state = (*state[:-1], state[-1] + int(late.sum()))
                    yield self._frame(self.late(key, state, chunk[late]))
                if untimed.any():
                    state, out = self.follow(key, state, _in_order(chunk[untimed]))
                    yield self._frame(out)
                self._wait(chunk[~late & ~untimed], wait)
        self._keep(state, timer, wait, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state, _, wait = self._load()
        if self.width is not None:
            for frame in self._due(self._followed(timerValues), wait):
                state, out = self.follow(key, state, frame)
                yield self._frame(out)
        due = self._silence(state)
        if due is not None and due < timerValues.getCurrentWatermarkInMs() and wait.first is None:
            yield self._frame(self.silent(key, state))
            self.value.clear()
            return
        self._keep(state, None, wait, timerValues)

    def close(self) -> None:
        pass

    # ---- waiting rows ----

    def _followed(self, timerValues) -> int:
        """The time up to which buckets have been followed: those that the watermark has passed."""
        return timerValues.getCurrentWatermarkInMs() * 1000 // self.width * self.width

    def _load(self) -> tuple[tuple, int | None, _Waiting]:
        """The key's state, its timer, and what waits."""
        held = self.value.get()
        if held is None:
            return self.START, None, _Waiting()
        *state, timer, part, entries, first, few = held
        return tuple(state), timer, _Waiting(part, entries, first, _unpacked(bytes(few)) if few is not None else None)

    def _wait(self, chunk: pd.DataFrame, wait: _Waiting) -> None:
        """Let the rows of a chunk wait: in the value while they are few, else in parts."""
        if not len(chunk):
            return
        first = int(chunk["us"].min())
        wait.first = first if wait.first is None else min(first, wait.first)
        if wait.few is not None:
            chunk = pd.concat([wait.few, chunk], ignore_index=True)
        wait.few = chunk if len(chunk) <= FEW_ROWS else None
        if wait.few is None:
            self._hold(chunk, wait)

    def _hold(self, chunk: pd.DataFrame, wait: _Waiting) -> None:
        """Put a chunk's rows into spans about as many as they fill."""
        untimed = chunk["us"].isna()
        if untimed.any():
            self._put(UNTIMED, 1, wait.part, chunk[untimed], wait)
            chunk = chunk[~untimed]
        if len(chunk):
            width = self.width or 1
            reach = int(chunk["us"].max()) - int(chunk["us"].min())
            while width * -(-len(chunk) // FEW_ROWS) <= reach:
                width *= 2
            self._cut(chunk, width, wait.part, wait)
        wait.part += 1

    def _cut(self, rows: pd.DataFrame, width: int, part: int, wait: _Waiting) -> None:
        span = rows["us"].astype("int64") // width
        for _, own in rows.groupby(span, sort=False):
            self._put(int(own["us"].min()), width, part, own, wait)

    def _put(self, first: int, width: int, part: int, rows: pd.DataFrame, wait: _Waiting) -> None:
        self.waiting.updateValue((first, width, part), (_packed(rows),))
        wait.held += 1

    def _take(self, entries: list[tuple[int, int, int]], wait: _Waiting) -> pd.DataFrame:
        """The rows of some entries, which leave the state."""
        frames = [_unpacked(bytes(self.waiting.getValue(e)[0])) for e in entries]
        for e in entries:
            self.waiting.removeKey(e)
        wait.held -= len(entries)
        return pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0]

    def _due(self, before: int | None, wait: _Waiting) -> Iterator[pd.DataFrame]:
        """The waiting rows before a time (a bucket's start) in order, span by span, taken out as they are read."""
        if not wait.held:
            if wait.few is not None:
                due = wait.few["us"] < before
                rest = wait.few[~due]
                if due.any():
                    yield _in_order(wait.few[due])
                wait.few, wait.first = (rest, int(rest["us"].min())) if len(rest) else (None, None)
            return
        if wait.few is not None:
            self._hold(wait.few, wait)
            wait.few = None
        wait.first = None
        # later spans on top of the stack; an entry is its first time, its span's width and its part
        todo = sorted(((int(f), int(w), int(p)) for f, w, p in self.waiting.keys()), key=_by_span, reverse=True)
        while todo:
            start, width = _span(todo[-1])
            group = []
            while todo and todo[-1][0] < start + width:
                group.append(todo.pop())
            if before is not None and start >= before:
                earliest = min(f for f, _, _ in group)
                wait.first = earliest if wait.first is None else min(earliest, wait.first)
                continue
            group.sort(key=lambda e: (e[2], e[0]))
            parts = len({p for _, _, p in group})
            if width > (self.width or 1) and parts > FEW_PARTS:
                todo += sorted(self._finer(group, max(width // FINER, self.width or 1), wait), key=_by_span, reverse=True)
                continue
            rows = self._take(group, wait)
            if before is not None and start + width > before:
                later = rows["us"] >= before
                if later.any():
                    rest = rows[later]
                    self._cut(rest, width, group[0][2], wait)
                    earliest = int(rest["us"].min())
                    wait.first = earliest if wait.first is None else min(earliest, wait.first)
                    rows = rows[~later]
            if len(rows):
                yield _in_order(rows)

    def _finer(self, group: list[tuple[int, int, int]], width: int, wait: _Waiting) -> list[tuple[int, int, int]]:
        """The entries of a span cut into spans of a smaller width, some parts at a time; narrower ones stay."""
        made = dict.fromkeys(e for e in group if e[1] <= width)
        wide = groupby((e for e in group if e[1] > width), key=lambda e: e[2])
        parts = [list(entries) for _, entries in wide]
        for at in range(0, len(parts), FEW_PARTS):
            entries = list(chain.from_iterable(parts[at : at + FEW_PARTS]))
            rows, part = self._take(entries, wait), entries[0][2]
            for _, own in rows.groupby(rows["us"].astype("int64") // width, sort=False):
                entry = (int(own["us"].min()), width, part)
                if entry in made:
                    own = pd.concat([self._take([entry], wait), own], ignore_index=True)
                self._put(*entry, own, wait)
                made[entry] = None
        return list(made)

    def _silence(self, state: tuple) -> int | None:
        return None if self.idle is None or state[0] is None else (int(state[0]) + self.idle) // 1000

    def _keep(self, state: tuple, timer: int | None, wait: _Waiting, timerValues) -> None:
        """Store the state and set the key's one timer: for its first waiting bucket, else for its silence."""
        wanted = self._silence(state)
        if self.width is not None and wait.first is not None:
            wanted = -(-(wait.first // self.width * self.width + self.width) // 1000)
        if wanted is not None:
            wanted = max(wanted, timerValues.getCurrentWatermarkInMs() + 1)
        if timer is not None and timer != wanted:
            self.handle.deleteTimer(timer)
        if wanted is not None and timer != wanted:
            self.handle.registerTimer(wanted)
        few = _packed(wait.few) if wait.few is not None else None
        self.value.update((*state, wanted, wait.part, wait.held, wait.first, few))

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=self.COLUMNS)


def by_series(rows: DataFrame, processor: Series, schema: str, lateness: str | None, key: str = "device") -> DataFrame:
    """Run a processor per key over ``key, us, event_id`` and more columns made from a stream with a ``ts`` column.

    The time reaches the processor as a plain number: a column that carries the watermark would lose its late rows on the way.
    """
    mode = "none" if lateness is None else "eventtime"
    return rows.groupBy(key).transformWithStateInPandas(processor, schema, "append", mode)


def watermarked(sdf: DataFrame, lateness: str | None) -> DataFrame:
    if lateness is None:
        return sdf
    return sdf.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
