"""Interaction queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklens.operators import interactions as I
from tracklens.workload.registry import query

_SCORED = """WITH scored AS (SELECT learner, CAST(sum(ok) AS BIGINT) AS "right", count(*) AS answered,
  (SELECT count(DISTINCT item) FROM answers) AS items FROM first_answers GROUP BY learner)"""


@query(
    "quiz_score",
    _SCORED + """ SELECT *, CASE WHEN answered = items THEN CASE WHEN "right" = items THEN 'clean sweep'
    WHEN "right" >= items - 1 THEN 'solid' ELSE 'worth a re-read' END END AS band FROM scored""",
    ("answers", "first_answers"),
)
def _(t):
    return I.quiz_score(t.answers, t.answer_key)


@query(
    "sorter_score",
    _SCORED + " SELECT *, answered = items AS all_sorted FROM scored",
    ("answers", "first_answers"),
)
def _(t):
    return I.sorter_score(t.answers, t.answer_key)


_CHECKLIST = """WITH resets AS (SELECT learner, list, max(row(ts, event_id)) AS reset_at FROM checklist_events
    WHERE kind = 'reset' GROUP BY ALL),
  boxes AS (SELECT learner, list, box, arg_max(checked, row(ts, event_id)) AS checked, max(row(ts, event_id)) AS set_at
    FROM checklist_events WHERE kind = 'set' GROUP BY ALL),
  standing AS (SELECT b.learner, b.list, box, checked AND (reset_at IS NULL OR reset_at < set_at) AS checked
    FROM boxes b LEFT JOIN resets r ON b.learner = r.learner AND b.list = r.list)"""


@query(
    "checklist_done",
    _CHECKLIST + """ SELECT learner, s.list, done, total, round(done / total * 100, 6) AS pct
  FROM (SELECT learner, list, count(*) FILTER (checked) AS done FROM standing GROUP BY ALL) s
  JOIN (SELECT list, count(DISTINCT box) AS total FROM checklist_events GROUP BY list) t ON s.list = t.list""",
    ("checklist_events",),
)
def _(t):
    boxes = t.checklist_events.select("list", "box").distinct()
    return I.checklist(t.checklist_events, boxes).withColumn("pct", F.round("pct", 6))


@query(
    "learner_seen",
    """SELECT learner, array_to_string(list_sort(list(DISTINCT slide)), ',') AS slides, count(DISTINCT slide) AS n_seen,
    arg_max(slide, row(ts, event_id)) AS at FROM slide_visits GROUP BY learner""",
    ("slide_visits",),
)
def _(t):
    found = I.seen(t.slide_visits)
    return found.withColumn("slides", F.array_join(F.col("slides").cast("array<string>"), ","))


@query(
    "learner_progress",
    """SELECT learner, visits, "at", round(coalesce("at" / nullif(15 - 1, 0) * 100, 0), 6) AS pct FROM (
      SELECT learner, visits, CASE WHEN visits BETWEEN 1 AND 15 THEN visits - 1 ELSE least(saved, 14) END AS "at" FROM (
        SELECT learner, count(*) AS visits, arg_max(slide, row(ts, event_id)) AS saved FROM slide_visits GROUP BY learner))""",
    ("slide_visits",),
)
def _(t):
    state = t.slide_visits.groupBy("learner").agg(
        F.count("*").alias("hash_slide"), F.max_by("slide", F.struct("ts", "event_id")).alias("saved")
    )
    found = I.progress(state.withColumn("slides", F.lit(15)))
    return found.select("learner", F.col("hash_slide").alias("visits"), "at", F.round("pct", 6).alias("pct"))
