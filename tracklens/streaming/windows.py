"""Streams that built-in event-time operators cover."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.operators import interactions, telemetry


def event_time(sdf: DataFrame) -> DataFrame:
    """Event time as an instant, which watermarks need."""
    return sdf.withColumn("ts", F.col("ts").cast("timestamp"))


def stream_evaluate(sdf: DataFrame, period: str, lateness: str) -> DataFrame:
    """The latest sample of each evaluation period, emitted once the watermark passes its end; later rows are dropped."""
    return telemetry.periodic_eval(event_time(sdf).withWatermark("ts", lateness), period)


def stream_trend(sdf: DataFrame, window: str, slide: str, lateness: str) -> DataFrame:
    """Sliding plant figures, emitted after the watermark."""
    return telemetry.rolling_kpis(event_time(sdf).withWatermark("ts", lateness), window, slide)


def stream_first_answer(sdf: DataFrame, remember: str) -> DataFrame:
    """The first answer to arrive per learner and item, remembered for ``remember`` of event time.

    Arrival decides, not event time; use ``stream_first_answer_exact`` where events come out of order.
    """
    return event_time(sdf).withWatermark("ts", remember).dropDuplicatesWithinWatermark(["learner", "item"])


def stream_first_answer_exact(sdf: DataFrame) -> DataFrame:
    """The earliest answer per learner and item by event time (update mode): state is one row per pair."""
    return interactions.first_answers(sdf)


def stream_checklist(sdf: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Box states and list resets, both in update mode; ``interactions.standing`` joins them when they are read.

    State grows with distinct boxes and lists, not with events.
    """
    return interactions.box_states(sdf), interactions.list_resets(sdf)
