"""Waiting rows of a series, with the engine's state played by dictionaries that count calls."""

from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest

from tracklens.streaming import series

HOURS = 3_600_000_000


class Kept:
    def __init__(self, calls):
        self.calls, self.held, self.map = calls, None, {}

    def get(self):
        self.calls.append("get")
        return self.held

    def update(self, value):
        self.calls.append("update")
        self.held = value

    def updateValue(self, key, value):
        self.calls.append("put")
        assert key not in self.map
        self.map[key] = value

    def getValue(self, key):
        self.calls.append("read")
        return self.map[key]

    def removeKey(self, key):
        self.calls.append("remove")
        del self.map[key]

    def keys(self):
        self.calls.append("keys")
        return iter(list(self.map))


class Order(series.Series):
    """What comes out is the rows in the order they were followed."""

    STATE, START, COLUMNS = "last BIGINT, late BIGINT", (None, 0), ["us", "event_id"]

    def follow(self, key, state, rows):
        self.frames.append(len(rows))
        return state, list(rows[["us", "event_id"]].itertuples(index=False, name=None))

    def late(self, key, state, rows):
        raise AssertionError("no row is late")


class Feed:
    def __init__(self, lateness):
        self.calls, self.timer, self.out = [], None, []
        self.run = Order(lateness)
        self.run.frames = []
        self.run.init(
            SimpleNamespace(
                getValueState=lambda *_: Kept(self.calls), getMapState=lambda *_: Kept(self.calls),
                registerTimer=lambda t: setattr(self, "timer", t), deleteTimer=lambda t: setattr(self, "timer", None),
            )
        )

    def clock(self, ms):
        return SimpleNamespace(getCurrentWatermarkInMs=lambda: ms)

    def rows(self, chunks, ms=0):
        for frame in self.run.handleInputRows((1,), iter(chunks), self.clock(ms)):
            self.out += frame.itertuples(index=False, name=None)

    def advance(self, ms):
        while self.timer is not None and self.timer <= ms:
            self.timer = None
            for frame in self.run.handleExpiredTimer((1,), self.clock(ms), None):
                self.out += frame.itertuples(index=False, name=None)


def frame(us, first=0):
    return pd.DataFrame({"us": np.array(us, dtype="int64"), "event_id": np.arange(first, first + len(us))})


def test_a_quiet_key_makes_few_calls():
    """A row in every tenth hour: each in a bucket of its own, and none needs calls of its own."""
    feed = Feed("12 hours")
    feed.rows([frame([10 * HOURS * k for k in range(67)])])
    feed.advance(10 * 3_600_000 * 60)
    assert [e for _, e in feed.out] == list(range(60))
    assert len(feed.calls) <= 6
    feed.advance(10 * 3_600_000 * 70)
    assert [e for _, e in feed.out] == list(range(67))


@pytest.mark.parametrize("lateness", ["16 milliseconds", None])
def test_many_parts_come_out_in_order(monkeypatch, lateness):
    for name, value in (("FEW_ROWS", 5), ("FEW_PARTS", 2), ("FINER", 4)):
        monkeypatch.setattr(series, name, value)
    random = np.random.default_rng(3)
    feed, given = Feed(lateness), []
    at, mark = 0, 0
    for _ in range(6):
        chunks = []
        for _ in range(9):
            size = int(random.integers(1, 40))
            chunks.append(frame(mark * 1000 + random.integers(0, 60_000, size) // 50 * 50, at))
            at += size
            given += chunks[-1].itertuples(index=False, name=None)
        feed.rows(chunks, mark)
        if lateness:
            mark += 17
            feed.advance(mark)
        else:
            assert sorted(feed.out) == sorted(given)
            assert [u for u, _ in feed.out] == sorted(u for u, _ in feed.out)
            feed.out, given = [], []
    if lateness:
        feed.advance(10_000)
        assert feed.out == sorted(given)
        assert max(feed.run.frames) < len(given) / 4


def test_rows_without_a_time_come_first():
    feed = Feed(None)
    chunks = [frame([30, 10]), pd.DataFrame({"us": [None, 20.0], "event_id": [7, 8]}).astype({"us": "float64"})]
    feed.rows(chunks)
    assert [e for _, e in feed.out] == [7, 1, 8, 0]
