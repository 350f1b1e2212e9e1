"""Scores and progress from interaction events. Every rule is an aggregate, so repeats combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARRIVAL = ("ts", "event_id")


def first_answers(answers: DataFrame, arrival: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """The first pick per learner and item counts; later ones do not."""
    return answers.groupBy("learner", "item").agg(F.min_by("pick", F.struct(*arrival)).alias("pick"))


def _scored(answers: DataFrame, key: DataFrame) -> DataFrame:
    items = key.agg(F.count("*")).scalar()
    return (
        first_answers(answers)
        .join(key.select("item", "ans"), "item")
        .groupBy("learner")
        .agg(F.count_if(F.col("pick") == F.col("ans")).alias("right"), F.count("*").alias("answered"))
        .withColumn("items", items)
    )


def quiz_score(answers: DataFrame, key: DataFrame) -> DataFrame:
    """Right and answered per learner; the band appears only once every question is answered."""
    band = (
        F.when(F.col("right") == F.col("items"), "clean sweep")
        .when(F.col("right") >= F.col("items") - 1, "solid")
        .otherwise("worth a re-read")
    )
    return _scored(answers, key).withColumn("band", F.when(F.col("answered") == F.col("items"), band))


def sorter_score(answers: DataFrame, key: DataFrame) -> DataFrame:
    """``right of answered`` and whether everything is sorted."""
    return _scored(answers, key).withColumn("all_sorted", F.col("answered") == F.col("items"))


def box_states(events: DataFrame, arrival: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """The last state per learner, list and box."""
    when = F.struct(*arrival)
    return (
        events.filter(F.col("kind") == "set")
        .groupBy("learner", "list", "box")
        .agg(F.max_by("checked", when).alias("checked"), F.max(when).alias("set_at"))
    )


def list_resets(events: DataFrame, arrival: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """The last reset per learner and list."""
    return (
        events.filter(F.col("kind") == "reset").groupBy("learner", "list").agg(F.max(F.struct(*arrival)).alias("reset_at"))
    )


def standing(boxes: DataFrame, resets: DataFrame) -> DataFrame:
    """Box states with resets applied: a box set before its list's last reset is unchecked."""
    cleared = F.coalesce(F.col("reset_at") >= F.col("set_at"), F.lit(False))
    return boxes.join(resets, ["learner", "list"], "left").select(
        "learner", "list", "box", (F.col("checked") & ~cleared).alias("checked")
    )


def checklist(events: DataFrame, boxes: DataFrame) -> DataFrame:
    """Completion per learner and list against the boxes a list has."""
    totals = boxes.groupBy("list").agg(F.count("*").alias("total"))
    return (
        standing(box_states(events), list_resets(events))
        .groupBy("learner", "list")
        .agg(F.count_if("checked").alias("done"))
        .join(totals, "list")
        .withColumn("pct", F.col("done") / F.col("total") * 100)
    )


def seen(visits: DataFrame, arrival: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """The distinct slides each learner saw (as many as the deck has at most) and where they are."""
    found = visits.groupBy("learner").agg(
        F.array_sort(F.collect_set("slide")).alias("slides"), F.max_by("slide", F.struct(*arrival)).alias("at")
    )
    return found.withColumn("n_seen", F.size("slides").cast("long"))


def resume_at(hash_slide: Column, saved: Column, slides: Column) -> Column:
    """Where a deck opens: a valid 1-based hash wins, else the saved place, kept inside the deck."""
    return F.when(hash_slide.between(1, slides), hash_slide - 1).otherwise(
        F.greatest(F.least(F.coalesce(saved, F.lit(0)), slides - 1), F.lit(0))
    )


def progress_pct(at: Column, slides: Column) -> Column:
    """Share of the deck behind the reader; a one-slide deck is at 0."""
    return F.coalesce(at / F.nullif(slides - 1, F.lit(0)) * 100, F.lit(0.0))


def progress(df: DataFrame) -> DataFrame:
    """Adds ``at`` and ``pct`` from ``hash_slide``, ``saved`` and ``slides``."""
    at = resume_at(F.col("hash_slide"), F.col("saved"), F.col("slides"))
    return df.withColumns({"at": at}).withColumn("pct", progress_pct(F.col("at"), F.col("slides")))
