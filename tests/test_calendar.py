import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tracklens.functions import text
from tracklens.operators import calendar as K
from tracklens.operators.intervals import dyadic, range_join
from tracklens.sources.icalendar import read_events

# Five weekly rules (start, end, days) until 2026-12-21 07:59:59 UTC.
RULES = [
    ("20260928T193000", "20260928T203000", "MO,TU,WE"),
    ("20261001T193000", "20261001T203000", "TH"),
    ("20261003T103000", "20261003T130000", "SA"),
    ("20260927T213000", "20260927T220000", "SU,MO,TU,WE,TH,FR"),
    ("20261004T170000", "20261004T173000", "SU"),
]


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("calendar")
    body = "BEGIN:VCALENDAR\r\nVERSION:2.0\r\n"
    for i, (start, end, days) in enumerate(RULES):
        body += (
            f"BEGIN:VEVENT\r\nUID:rule-{i}\r\nDTSTAMP:20260927T032245Z\r\n"
            f"DTSTART;TZID=America/Los_Angeles:{start}\r\nDTEND;TZID=America/Los_Angeles:{end}\r\n"
            f"RRULE:FREQ=WEEKLY;BYDAY={days};UNTIL=20261221T075959Z\r\nSUMMARY:Rule {i}\r\n"
            f"DESCRIPTION:A line that is\r\n  folded\r\nEND:VEVENT\r\n"
        )
    (folder / "block.ics").write_bytes((body + "END:VCALENDAR\r\n").encode())
    return read_events(spark, str(folder))


def test_read(events):
    rows = {r.uid: r for r in events.collect()}
    assert len(rows) == 5
    r = rows["rule-0"]
    assert (r.tz, r.freq, r.byday, r.summary) == ("America/Los_Angeles", "WEEKLY", ["MO", "TU", "WE"], "Rule 0")
    assert r.start_local == dt.datetime(2026, 9, 28, 19, 30) and r.until_utc == dt.datetime(2026, 12, 21, 7, 59, 59)
    assert r.description == "A line that is folded"


def test_occurrences_and_daylight_saving(events):
    rows = K.expand_rules(events)
    per_rule = {r.uid: r["count"] for r in rows.groupBy("uid").count().collect()}
    assert [per_rule[f"rule-{i}"] for i in range(5)] == [36, 12, 12, 73, 12]
    utc = {r.occurs_local: r.occurs_utc for r in rows.filter(F.col("uid") == "rule-0").collect()}
    assert utc[dt.datetime(2026, 10, 28, 19, 30)] == dt.datetime(2026, 10, 29, 2, 30)
    assert utc[dt.datetime(2026, 11, 2, 19, 30)] == dt.datetime(2026, 11, 3, 3, 30)


def test_weekly_hours(events):
    assert K.weekly_hours(events, ["uid"]).agg(F.sum("hours")).first()[0] == 10.0


def test_until_cuts_the_last_day_by_the_instant(spark, events):
    base = events.filter(F.col("uid") == "rule-0")
    before = base.withColumn("until_utc", F.lit("2026-09-29 02:29:59").cast("timestamp_ntz"))
    exact = base.withColumn("until_utc", F.lit("2026-09-29 02:30:00").cast("timestamp_ntz"))
    assert (K.expand_rules(before).count(), K.expand_rules(exact).count()) == (0, 1)


def test_session_lengths(spark):
    rows = spark.createDataFrame([(15.77, 140.05), (10.50, 106.65), (14.60, 106.82)], "start_min DOUBLE, end_min DOUBLE")
    got = [(round(r.minutes, 2), r.label) for r in K.session_duration(rows).collect()]
    assert got == [(124.28, "2h 04m"), (96.15, "1h 36m"), (92.22, "1h 32m")]


def test_clock_rounds_before_it_splits(spark):
    rows = spark.createDataFrame([(0.0,), (9.6,), (150.0,)], "m DOUBLE")
    assert [r[0] for r in rows.select(text.clock(F.col("m"))).collect()] == ["06:50", "07:00", "09:20"]


def test_blocks_and_gaps(spark):
    starts = [dt.date(2026, 9, 28) + dt.timedelta(days=91 * i) for i in range(4)]
    blocks = spark.createDataFrame(
        [(i, s, s + dt.timedelta(days=83)) for i, s in enumerate(starts)], "block INT, block_start DATE, block_end DATE"
    )
    gaps = sorted((r.gap_start, r.gap_end, r.days) for r in K.block_gaps(blocks).collect())
    assert gaps == [
        (dt.date(2026, 12, 21), dt.date(2026, 12, 27), 7),
        (dt.date(2027, 3, 22), dt.date(2027, 3, 28), 7),
        (dt.date(2027, 6, 21), dt.date(2027, 6, 27), 7),
    ]
    days = spark.createDataFrame([(dt.date(2026, 9, 27),), (dt.date(2026, 12, 20),), (dt.date(2026, 12, 21),), (dt.date(2026, 12, 28),)], "d DATE")
    assert [r.block for r in K.assign_block(days, "d", blocks).orderBy("d").collect()] == [None, 0, None, 1]


def test_tick_tolerance(spark):
    ticks = spark.createDataFrame([(1, 14.0), (1, 14.77), (1, 141.05), (1, 141.1), (2, 20.0)], "day INT, m DOUBLE")
    sessions = spark.createDataFrame([(1, "s", 15.77, 140.05)], "day INT, name STRING, start_min DOUBLE, end_min DOUBLE")
    assert [r.name for r in K.assign_tick(ticks, sessions).orderBy("day", "m").collect()] == [None, "s", "s", None, None]


def brute_range(points, intervals):
    out = []
    for day, m in points:
        hits = [(day, m, n) for d, n, lo, hi in intervals if d == day and lo <= m <= hi]
        out += hits or [(day, m, None)]
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [1.0, 7.5, 1000.0])
def test_intervals_of_any_length(spark, width):
    rng = random.Random(8)
    intervals = [(d, f"i{d}{k}", lo, lo + rng.choice([0.0, 3.0, 90.0, 4000.0])) for d in (1, 2) for k, lo in enumerate(rng.uniform(-3000, 3000) for _ in range(30))]
    intervals += [(1, "all", -1e6, 1e6), (2, "empty", 5.0, 4.0)]
    points = [(rng.choice([1, 2, 3]), round(rng.uniform(-3500, 3500), 2)) for _ in range(300)] + [(1, intervals[0][2]), (2, 2e6)]
    a = spark.createDataFrame(points, "day INT, m DOUBLE")
    b = spark.createDataFrame(intervals, "day INT, name STRING, lo DOUBLE, hi DOUBLE")
    got = range_join(a, b, F.col("m"), F.col("lo"), F.col("hi"), width, keys=("day",))
    assert sorted([(r.day, r.m, r.name) for r in got.collect()], key=str) == brute_range(points, intervals)
    inner = range_join(a, b, F.col("m"), F.col("lo"), F.col("hi"), width, keys=("day",), how="inner")
    assert sorted([(r.day, r.m, r.name) for r in inner.collect()], key=str) == [x for x in brute_range(points, intervals) if x[2]]


def test_a_long_interval_is_few_pieces(spark):
    """4,000 years in days: under 100 rows, aligned, without gap or overlap."""
    df = spark.createDataFrame([(-700_001, 761_234), (5, 5), (0, 4), (-8, 7)], "a LONG, b LONG")
    rows = df.select("a", "b", dyadic(F.col("a"), F.col("b")).alias("p")).collect()
    assert len(rows[0].p) < 100 and len(rows[1].p) == 1 and len(rows[3].p) == 2
    for r in rows:
        spans = sorted((p.bucket << p.level, (p.bucket + 1) << p.level) for p in r.p)
        assert spans[0][0] == r.a and spans[-1][1] == r.b + 1
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_ends_in_every_form(spark, tmp_path):
    """A date, a local time and a UTC time end a rule; what is no time is rejected with a reason, and nothing aborts."""
    event = "BEGIN:VEVENT\nUID:{}\nDTSTAMP:{}\nDTSTART;TZID={}:20261102T193000\nDTEND;TZID={}:20261102T203000\nRRULE:FREQ=WEEKLY;BYDAY=MO;UNTIL={}\nEND:VEVENT\n"
    zone = "America/Los_Angeles"
    cases = [("date", zone, "20261116"), ("local", zone, "20261116T193000"), ("utc", zone, "20261117T033000Z"), ("short", zone, "20261117T032959Z"),
             ("none", zone, "20260931T250000"), ("word", zone, "soon"), ("nowhere", "Mars/Base", "20261116"), ("leap", zone, "20270229")]
    path = tmp_path / "c.ics"
    path.write_text("BEGIN:VCALENDAR\n" + "".join(event.format(u, "20260927" if u == "date" else "20260927T032245Z", z, z, e) for u, z, e in cases) + "END:VCALENDAR\n")
    events = read_events(spark, str(path))
    days = {}
    for r in K.expand_rules(events).collect():
        days.setdefault(r.uid, []).append(r.occurs_local.day)
    assert {k: sorted(v) for k, v in days.items()} == {"date": [2, 9, 16], "local": [2, 9, 16], "utc": [2, 9, 16], "short": [2, 9]}
    reasons = {r.uid: r.reason for r in K.rejected_rules(events).collect()}
    assert reasons == {"none": "no end", "word": "no end", "leap": "no end", "nowhere": "zone"}
    assert events.filter("dtstamp IS NULL").count() == 0


def test_adherence(spark):
    plan = spark.createDataFrame([("deep", dt.date(2026, 9, 28), dt.date(2026, 10, 12))], "lane STRING, first_week DATE, last_week DATE")
    log = spark.createDataFrame([("deep", dt.date(2026, 10, 5), 2)], "lane STRING, week_of DATE, entries BIGINT")
    rows = [(r.week_of.day, r.entries, r.posted) for r in K.adherence(plan, log, ["lane"]).orderBy("week_of").collect()]
    assert rows == [(28, 0, False), (5, 2, True), (12, 0, False)]


def test_single_events_intervals_and_rejected_rules(spark):
    rows = [
        ("once", None, None, None),
        ("every", "FREQ=WEEKLY;BYDAY=MO,TH", ["MO", "TH"], "2024-01-31 00:00:00"),
        ("other", "FREQ=WEEKLY;INTERVAL=2;BYDAY=MO,TH", ["MO", "TH"], "2024-01-31 00:00:00"),
        ("daily", "FREQ=DAILY;UNTIL=20240131T000000Z", None, "2024-01-31 00:00:00"),
        ("count", "FREQ=WEEKLY;COUNT=3;BYDAY=MO", ["MO"], None),
        ("second", "FREQ=WEEKLY;BYDAY=2TU", ["2TU"], "2024-01-31 00:00:00"),
        ("endless", "FREQ=WEEKLY;BYDAY=MO", ["MO"], None),
    ]
    df = spark.createDataFrame(rows, "uid STRING, rule STRING, byday ARRAY<STRING>, until STRING").selectExpr(
        "uid", "rule", "byday", "CAST(until AS TIMESTAMP_NTZ) AS until_utc", "'' AS tz",
        "TIMESTAMP_NTZ '2024-01-03 09:00:00' AS start_local", "TIMESTAMP_NTZ '2024-01-03 10:00:00' AS end_local",
    )
    got = {}
    for r in K.expand_rules(df).collect():
        got.setdefault(r.uid, []).append(r.occurs_local.day)
    assert {k: sorted(v) for k, v in got.items()} == {
        "once": [3], "every": [4, 8, 11, 15, 18, 22, 25, 29], "other": [4, 15, 18, 29]
    }
    reasons = {r.uid: r.reason for r in K.rejected_rules(df).collect()}
    assert reasons == {"daily": "frequency", "count": "unsupported part", "second": "weekday", "endless": "no end"}
