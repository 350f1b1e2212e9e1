"""Calendar queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklens.functions import text
from tracklens.operators import calendar as K
from tracklens.session import shared_folder
from tracklens.sources.icalendar import read_events
from tracklens.workload.registry import query

_OCCURRENCES = """
  WITH days AS (SELECT *, unnest(byday) AS d FROM rules),
  dates AS (SELECT uid, tz, start_local, end_local, until_utc, d,
    unnest(range(CAST(start_local AS DATE), CAST(until_utc AS DATE) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS dd FROM days),
  hits AS (SELECT uid, tz, until_utc, end_local - start_local AS span,
    CAST(dd AS TIMESTAMP) + (start_local - date_trunc('day', start_local)) AS occurs_local
    FROM dates WHERE upper(substr(strftime(dd, '%a'), 1, 2)) = d),
  occ AS (SELECT uid, occurs_local, occurs_local + span AS ends_local,
    (occurs_local AT TIME ZONE tz) AT TIME ZONE 'UTC' AS occurs_utc, until_utc FROM hits)
"""


@query(
    "recur_expand",
    _OCCURRENCES + "SELECT uid, occurs_local, ends_local FROM occ WHERE occurs_utc <= until_utc",
    ("rules",),
)
def _(t):
    return K.expand_rules(t.rules).select("uid", "occurs_local", "ends_local")


@query(
    "recur_utc",
    _OCCURRENCES + """SELECT uid, occurs_utc, CAST(datediff('minute', occurs_local, occurs_utc) AS BIGINT) AS offset_minutes
    FROM occ WHERE occurs_utc <= until_utc""",
    ("rules",),
)
def _(t):
    return K.expand_rules(t.rules).select(
        "uid", "occurs_utc", K.minutes_between(F.col("occurs_local"), F.col("occurs_utc")).alias("offset_minutes")
    )


@query(
    "calendar_rejects",
    """SELECT uid, CASE WHEN uid % 5 = 0 THEN 'frequency' WHEN uid % 5 = 1 THEN 'unsupported part'
    ELSE 'no end' END AS reason FROM rules WHERE uid % 5 < 3""",
    ("rules",),
)
def _(t):
    """Rules that are not weekly, use other parts, or never end, with the reason each is not expanded."""
    kind = F.col("uid") % 5
    rule = F.when(kind == 0, "FREQ=DAILY").when(kind == 1, "FREQ=WEEKLY;COUNT=3").otherwise("FREQ=WEEKLY;INTERVAL=2")
    endless = F.when(kind != 2, F.col("until_utc"))
    return K.rejected_rules(t.rules.withColumns({"rule": rule, "until_utc": endless})).select("uid", "reason")


@query(
    "weekly_hours",
    "SELECT owner, lane, sum(len(byday) * minutes) / 60.0::DOUBLE AS hours FROM rules GROUP BY ALL",
    ("rules",),
)
def _(t):
    return K.weekly_hours(t.rules, ["owner", "lane"])


@query(
    "calendar_scan",
    """SELECT 'order-' || uid AS uid, tz, start_local, end_local, array_to_string(byday, ',') AS byday, until_utc,
    'WEEKLY' AS freq, lane AS summary, 'customer ' || owner AS description FROM rules""",
    ("rules",),
)
def _(t):
    """Rules written as calendar text by Spark, one calendar per record, then read back."""
    stamp = lambda c: F.date_format(F.col(c).cast("timestamp"), "yyyyMMdd'T'HHmmss")
    lines = F.concat_ws(
        "\r\n",
        F.lit("BEGIN:VCALENDAR"),
        F.lit("VERSION:2.0"),
        F.lit("BEGIN:VEVENT"),
        F.concat(F.lit("UID:order-"), F.col("uid").cast("string")),
        F.lit("DTSTAMP:20260927T032245Z"),
        F.concat(F.lit("DTSTART;TZID="), "tz", F.lit(":"), stamp("start_local")),
        F.concat(F.lit("DTEND;TZID="), "tz", F.lit(":"), stamp("end_local")),
        F.concat(
            F.lit("RRULE:FREQ=WEEKLY;BYDAY="), F.array_join("byday", ","), F.lit(";UNTIL="), stamp("until_utc"), F.lit("Z")
        ),
        F.concat(F.lit("SUMMARY:"), "lane"),
        F.concat(F.lit("DESCRIPTION:cust"), F.lit("\r\n omer "), F.col("owner").cast("string")),
        F.lit("END:VEVENT"),
        F.lit("END:VCALENDAR"),
    )
    path = shared_folder(t.spark, "calendar")
    t.rules.select(lines.alias("value")).write.text(path)
    return read_events(t.spark, path).drop("dtstamp", "rule").withColumn("byday", F.array_join("byday", ","))


@query(
    "session_clock",
    """SELECT event_id, printf('%02d:%02d', CAST(floor(total / 60) AS BIGINT), CAST(total % 60 AS BIGINT)) AS clock FROM
    (SELECT event_id, CAST(floor(m + 410 + 0.5) AS BIGINT) AS total FROM ticks)""",
    ("ticks",),
)
def _(t):
    return t.ticks.select("event_id", text.clock(F.col("m")).alias("clock"))


@query(
    "session_duration",
    """SELECT day, stretch, round(end_min - start_min, 6) AS minutes,
    printf('%dh %02dm', CAST(floor(total / 60) AS BIGINT), CAST(total % 60 AS BIGINT)) AS label FROM
    (SELECT *, CAST(floor(end_min - start_min + 0.5) AS BIGINT) AS total FROM sessions)""",
    ("sessions",),
)
def _(t):
    return K.session_duration(t.sessions).select("day", "stretch", F.round("minutes", 6).alias("minutes"), "label")


@query(
    "tick_assign",
    """SELECT event_id, t.day, stretch FROM ticks t LEFT JOIN sessions s
    ON t.day = s.day AND m BETWEEN start_min - 1 AND end_min + 1""",
    ("ticks", "sessions"),
)
def _(t):
    return K.assign_tick(t.ticks, t.sessions).select("event_id", "day", "stretch")


@query(
    "block_assign",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(block AS INTEGER) AS block FROM orders
    LEFT JOIN blocks ON CAST(o_orderdate AS DATE) BETWEEN block_start AND block_end""",
    ("blocks",),
)
def _(t):
    dated = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return K.assign_block(dated, "day", t.blocks)


@query(
    "block_gaps",
    """SELECT CAST(a.block AS INTEGER) AS block, CAST(a.block_end + 1 AS DATE) AS gap_start,
    CAST(b.block_start - 1 AS DATE) AS gap_end, CAST(b.block_start - a.block_end - 1 AS INTEGER) AS days
    FROM blocks a JOIN blocks b ON b.block = a.block + 1""",
    ("blocks",),
)
def _(t):
    return K.block_gaps(t.blocks)


@query(
    "week_adherence",
    """WITH plan AS (SELECT lane, date_trunc('week', min(start_local)) AS a, date_trunc('week', max(start_local)) AS b
      FROM rules GROUP BY lane),
    weeks AS (SELECT lane, CAST(unnest(range(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 7 DAY)) AS DATE)
      AS week_of FROM plan),
    log AS (SELECT lane, CAST(date_trunc('week', start_local) AS DATE) AS week_of, count(*) AS entries FROM rules
      WHERE uid IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY ALL)
    SELECT lane, week_of, coalesce(entries, 0) AS entries, coalesce(entries, 0) > 0 AS posted
    FROM weeks LEFT JOIN log USING (lane, week_of)""",
    ("rules",),
)
def _(t):
    week = F.date_trunc("week", F.col("o_orderdate").cast("timestamp")).cast("date")
    dated = t.orders.select(F.substring("o_orderpriority", 1, 1).alias("_p"), week.alias("week_of"), "o_orderstatus")
    lane = F.col("_p")
    for digit, name in zip("12345", ("Deep", "Algorithms", "Build", "Light", "Review"), strict=True):
        lane = F.when(F.col("_p") == digit, name).otherwise(lane)
    dated = dated.withColumn("lane", lane)
    plan = dated.groupBy("lane").agg(F.min("week_of").alias("first_week"), F.max("week_of").alias("last_week"))
    log = dated.filter(F.col("o_orderstatus") == "F").groupBy("lane", "week_of").agg(F.count("*").alias("entries"))
    return K.adherence(plan, log, ["lane"])
