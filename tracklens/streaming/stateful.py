"""Streams with state of their own per series: ramp limit, stuck-device cap, heartbeat alarm.

Each keeps a few numbers per series, by :mod:`tracklens.streaming.series`. Without a ``lateness`` a micro-batch is followed
at once: a row older than the last one followed is dropped and counted in ``late``. With one, rows wait until the watermark has
passed them, so the result is that of the batch operator whatever the order of arrival within the lateness; a row that comes later
still is a row of the result with ``is_late`` and no value. A row without a time holds what is known, and a missing target
holds the command. With ``idle_s`` the state of a series that has been silent so long leaves; if it comes back it starts anew.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.operators.ramp import step
from tracklens.operators.telemetry import controllable, micros
from tracklens.streaming.series import Series, by_series, watermarked


class Ramp(Series):
    STATE = "last BIGINT, cmd DOUBLE, late BIGINT"
    START = (None, 0.0, 0)
    COLUMNS = ["device", "us", "event_id", "cmd", "late", "is_late"]

    def __init__(self, rate: float, lateness: str | None, idle_s: float | None):
        super().__init__(lateness, idle_s)
        self.rate = rate

    def follow(self, key, state, rows):
        last, cmd, late = state
        out = []
        for r in rows.itertuples(index=False):
            timed = not pd.isna(r.us)
            if timed and last is not None and r.us < last:
                late += 1
                continue
            limit = self.rate * ((r.us - last) / 1_000_000.0) if timed and last is not None else 0.0
            if not pd.isna(r.want):
                cmd = step(cmd, r.want, limit) if self.rate > 0 else r.want
            last = int(r.us) if timed else last
            out.append((key[0], r.us if timed else None, r.event_id, cmd, late, False))
        return (last, float(cmd), late), out

    def late(self, key, state, rows):
        return [(key[0], r.us, r.event_id, None, state[-1], True) for r in rows.itertuples(index=False)]


class Adaptive(Series):
    STATE = "last BIGINT, since BIGINT, late BIGINT"
    START = (None, None, 0)
    COLUMNS = ["device", "us", "event_id", "clamped", "adaptive", "late", "is_late"]

    def __init__(self, delay: float, factor: float, lateness: str | None, idle_s: float | None):
        super().__init__(lateness, idle_s)
        self.delay, self.factor = delay, factor

    def follow(self, key, state, rows):
        last, since, late = state
        out = []
        for r in rows.itertuples(index=False):
            if pd.isna(r.us):
                out.append((key[0], None, r.event_id, False, None, late, False))
                continue
            if last is not None and r.us < last:
                late += 1
                continue
            last = int(r.us)
            clamped = False
            if r.counts and r.responsive:
                since = None
            elif r.counts:
                since = last if since is None else since
                clamped = (r.us - since) / 1_000_000.0 >= self.delay
            out.append((key[0], r.us, r.event_id, clamped, r.out * self.factor if clamped else None, late, False))
        return (last, since, late), out

    def late(self, key, state, rows):
        return [(key[0], r.us, r.event_id, None, None, state[-1], True) for r in rows.itertuples(index=False)]


class Heartbeat(Series):
    STATE = "last BIGINT, late BIGINT"
    START = (None, 0)
    COLUMNS = ["device", "since_us", "seen_us", "missed", "late"]

    def __init__(self, period_s: float):
        super().__init__(None, 2 * period_s)
        self.period = int(period_s * 1_000_000)

    def follow(self, key, state, rows):
        last, late = state
        out = []
        for r in rows.itertuples(index=False):
            if pd.isna(r.us):
                continue
            if last is not None and r.us < last:
                late += 1
                continue
            if last is not None and (r.us - last) // self.period - 1 > 0:
                out.append((key[0], last, r.us, (r.us - last) // self.period - 1, late))
            last = int(r.us)
        return (last, late), out

    def silent(self, key, state):
        return [(key[0], state[0], None, 1, state[-1])]


def stream_ramp(
    sdf: DataFrame, rate: float, want: str = "sp", lateness: str | None = None, idle_s: float | None = None
) -> DataFrame:
    """The ramped command per device: state is the command, the last time, and the late rows so far."""
    rows = watermarked(sdf, lateness).select(
        "device", micros(F.col("ts")).alias("us"), "event_id", F.col(want).cast("double").alias("want")
    )
    schema = "device BIGINT, us BIGINT, event_id BIGINT, cmd DOUBLE, late BIGINT, is_late BOOLEAN"
    return _as_time(by_series(rows, Ramp(rate, lateness, idle_s), schema, lateness))


def stream_adaptive(
    sdf: DataFrame, delay: float, factor: float = 1.15, lateness: str | None = None, idle_s: float | None = None
) -> DataFrame:
    """The stuck-device cap per device: state is when it stopped responding, the last time, and the late rows so far."""
    rows = watermarked(sdf, lateness).select(
        "device", micros(F.col("ts")).alias("us"), "event_id", "out", "responsive", controllable().alias("counts")
    )
    schema = "device BIGINT, us BIGINT, event_id BIGINT, clamped BOOLEAN, adaptive DOUBLE, late BIGINT, is_late BOOLEAN"
    return _as_time(by_series(rows, Adaptive(delay, factor, lateness, idle_s), schema, lateness))


def stream_heartbeat(sdf: DataFrame, period_s: float, lateness: str) -> DataFrame:
    """Missed heartbeats: one row per gap that swallowed arrivals, and one when a device falls silent.

    ``seen`` is NULL while the device is still silent: that row comes from the event-time timer, and the device's state leaves.
    ``late`` counts the rows that came after a later one and were passed over.
    """
    rows = watermarked(sdf, lateness).select("device", micros(F.col("ts")).alias("us"), "event_id")
    schema = "device BIGINT, since_us BIGINT, seen_us BIGINT, missed BIGINT, late BIGINT"
    return by_series(rows, Heartbeat(period_s), schema, lateness).select(
        "device",
        F.timestamp_micros("since_us").alias("since"),
        F.timestamp_micros("seen_us").alias("seen"),
        "missed",
        "late",
    )


def _as_time(sdf: DataFrame) -> DataFrame:
    return sdf.withColumn("ts", F.timestamp_micros("us")).drop("us")
