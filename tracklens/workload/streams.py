"""Stream queries: each runs the stream over the whole table to files and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklens.operators import interactions
from tracklens.session import shared_folder
from tracklens.streaming import changes, runs, stateful, store, windows
from tracklens.workload.catalogue import COLS, plain
from tracklens.workload.interactions import _CHECKLIST
from tracklens.workload.registry import query
from tracklens.workload.telemetry import _ADAPTIVE, _RAMP, _ROLLING, HOUR, TEL, r6

_CLOSED = "<= (SELECT max(ts) FROM telemetry) - INTERVAL 12 HOURS"


def written(t, stream, name):
    path = runs.append_to(stream, shared_folder(t.spark, name))
    return t.spark.read.schema(stream.schema).parquet(path)


def clockless(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


@query(
    "stream_ramp",
    _RAMP.format(key="device", want="sp", rate=0.0005, source="telemetry")
    + " SELECT key AS device, event_id, round(cmd, 6) AS cmd FROM ramp",
    TEL,
)
def _(t):
    out = written(t, stateful.stream_ramp(t.live.telemetry, rate=0.0005), "stream-ramp")
    return r6(out.select("device", "event_id", "cmd"), "cmd")


@query(
    "stream_adaptive",
    f"WITH {_ADAPTIVE} SELECT device, ts, event_id, clamped, round(CASE WHEN clamped THEN out * 1.15::DOUBLE END, 6) "
    "AS adaptive FROM flagged",
    TEL,
)
def _(t):
    out = written(t, stateful.stream_adaptive(t.live.telemetry, delay=12 * HOUR), "stream-adaptive")
    return r6(clockless(out.drop("late", "is_late"), "ts"), "adaptive")


#: With a lateness of 12 hours rows wait in buckets of a sixteenth of it, 45 minutes, until the watermark has passed their bucket.
_FOLLOWED = """epoch_us(ts) < ((SELECT epoch_us(max(ts)) // 1000 FROM telemetry) - 43200000) * 1000
    // 2700000000 * 2700000000"""


@query(
    "stream_ramp_buffered",
    _RAMP.format(key="device", want="sp", rate=0.0005, source="telemetry")
    + f""" SELECT key AS device, event_id, round(cmd, 6) AS cmd, false AS is_late
    FROM ramp WHERE event_id IN (SELECT event_id FROM telemetry WHERE {_FOLLOWED})""",
    TEL,
)
def _(t):
    """Rows that the watermark has passed: the ramp in order of time, whatever the order of arrival."""
    stream = stateful.stream_ramp(t.live.telemetry, rate=0.0005, lateness="12 hours")
    return r6(written(t, stream, "stream-ramp-buffered").select("device", "event_id", "cmd", "is_late"), "cmd")


@query(
    "stream_adaptive_buffered",
    f"WITH {_ADAPTIVE} SELECT device, ts, event_id, clamped, round(CASE WHEN clamped THEN out * 1.15::DOUBLE END, 6) "
    f"AS adaptive, false AS is_late FROM flagged WHERE {_FOLLOWED}",
    TEL,
)
def _(t):
    stream = stateful.stream_adaptive(t.live.telemetry, delay=12 * HOUR, lateness="12 hours")
    return r6(clockless(written(t, stream, "stream-adaptive-buffered").drop("late"), "ts"), "adaptive")


@query(
    "stream_evaluate",
    f"""SELECT * FROM (SELECT device, time_bucket(INTERVAL 6 HOURS, ts) AS period_start,
    arg_max(out, row(ts, event_id)) AS out, count(*) AS samples FROM telemetry GROUP BY ALL)
    WHERE period_start + INTERVAL 6 HOURS {_CLOSED}""",
    TEL,
)
def _(t):
    stream = windows.stream_evaluate(t.live.telemetry, "6 hours", lateness="12 hours")
    return clockless(written(t, stream, "stream-evaluate"), "period_start")


@query(
    "stream_trend",
    f"{_ROLLING} GROUP BY plant, w HAVING w + INTERVAL 24 HOURS {_CLOSED}",
    TEL,
)
def _(t):
    stream = windows.stream_trend(t.live.telemetry, "24 hours", "6 hours", lateness="12 hours")
    out = clockless(written(t, stream, "stream-trend"), "window_start")
    return out.withColumn("total_out", F.round("total_out", 4))


@query("stream_first_answer", "SELECT DISTINCT learner, item FROM answers", ("answers",))
def _(t):
    """One answer per pair; which one depends on arrival, so only the pairs are compared."""
    stream = windows.stream_first_answer(t.live.answers, remember="60 days")
    return written(t, stream, "stream-first-answer").select("learner", "item")


@query("stream_first_answer_exact", "SELECT learner, item, pick FROM first_answers", ("answers", "first_answers"))
def _(t):
    path = runs.update_to(windows.stream_first_answer_exact(t.live.answers), shared_folder(t.spark, "stream-first"))
    return runs.latest(t.spark, path, ["learner", "item"])


@query(
    "stream_checklist",
    _CHECKLIST + " SELECT learner, list, box, checked FROM standing",
    ("checklist_events",),
)
def _(t):
    boxes, resets = windows.stream_checklist(t.live.checklist_events)
    boxes_at = runs.update_to(boxes, shared_folder(t.spark, "stream-boxes"))
    resets_at = runs.update_to(resets, shared_folder(t.spark, "stream-resets"))
    return interactions.standing(
        runs.latest(t.spark, boxes_at, ["learner", "list", "box"]), runs.latest(t.spark, resets_at, ["learner", "list"])
    )


@query(
    "stream_changes",
    f"""SELECT {COLS} FROM last_changes WHERE op = 'upsert' UNION ALL
    SELECT {COLS} FROM books WHERE id NOT IN (SELECT id FROM last_changes)""",
    ("books", "last_changes"),
)
def _(t):
    root = shared_folder(t.spark, "stream-changes")
    changes.write_base(t.books, root)
    changes.stream_apply_changes(t.live.changes, root)
    return plain(changes.current(t.spark, root))


@query(
    "stream_store",
    f"""SELECT {COLS} FROM last_changes WHERE op = 'upsert' UNION ALL
    SELECT {COLS} FROM books WHERE id NOT IN (SELECT id FROM last_changes)""",
    ("books", "last_changes"),
)
def _(t):
    """Two feeds with a compaction between them; the second brings changes older than some that are folded already."""
    root = shared_folder(t.spark, "stream-store")
    feed = t.live.changes
    store.create(t.books, root, feed.schema["seq"].dataType.simpleString(), buckets=16)
    first = F.pmod(F.xxhash64("seq"), F.lit(2)) == 0
    store.stream_into(feed.filter(first), root, "first")
    store.compact(t.spark, root)
    store.stream_into(feed.filter(~first), root, "second")
    return plain(store.current(t.spark, root))


@query(
    "stream_heartbeat",
    """SELECT device, before AS since, ts AS seen, (epoch_us(ts) - epoch_us(before)) // 43200000000 - 1 AS missed FROM
      (SELECT *, lag(ts) OVER (PARTITION BY device ORDER BY ts, event_id) AS before FROM telemetry)
      WHERE (epoch_us(ts) - epoch_us(before)) // 43200000000 - 1 > 0
    UNION ALL SELECT device, max(ts), NULL, 1 FROM telemetry GROUP BY device
      HAVING epoch_us(max(ts)) // 1000 + 86400000 < (SELECT epoch_us(max(ts)) // 1000 FROM telemetry) - 3600000""",
    TEL,
)
def _(t):
    stream = stateful.stream_heartbeat(t.live.telemetry, period_s=12 * HOUR, lateness="1 hour")
    return clockless(written(t, stream, "stream-heartbeat").drop("late"), "since", "seen")
