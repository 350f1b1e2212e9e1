"""A plan held against its own declarations, and against the source it was made from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.operators import calendar, digests, plan


def audit(
    entries: DataFrame,
    declared_tracks: DataFrame,
    declared_roles: DataFrame,
    rules: DataFrame,
    declared_minutes: DataFrame,
    source: DataFrame | None = None,
    declared_track_roles: DataFrame | None = None,
) -> DataFrame:
    """One long report of (check, key, declared, actual, agrees).

    Checks: entries per track, per role, and per ``track / role`` where those are declared; minutes a week; weekday labels. With a
    ``source`` of entries (track, role, title) each track that differs from it is a row of the check ``source``: how many
    entries only the source has, and how many only the plan.
    """
    tracks = plan.reconcile(declared_tracks, entries.groupBy("track").agg(F.count("*").alias("actual")), ["track"])
    roles = plan.reconcile(declared_roles, entries.groupBy("role").agg(F.count("*").alias("actual")), ["role"])
    hours = calendar.weekly_hours(rules, ["owner"])
    minutes = plan.reconcile(
        declared_minutes, hours.select("owner", F.round(F.col("hours") * 60).cast("long").alias("actual")), ["owner"]
    )
    weekday = rules.select(
        F.col("uid").alias("key"),
        F.initcap(F.col("byday")[0]).alias("declared"),
        F.substring(F.date_format("start_local", "E"), 1, 2).alias("actual"),
    ).withColumn("agrees", F.col("declared") == F.col("actual"))

    def report(df: DataFrame, check: str, key: str) -> DataFrame:
        return df.select(
            F.lit(check).alias("check"),
            F.col(key).cast("string").alias("key"),
            F.col("declared").cast("string").alias("declared"),
            F.col("actual").cast("string").alias("actual"),
            "agrees",
        )

    parts = [
        report(tracks, "track", "track"),
        report(roles, "role", "role"),
        report(minutes, "minutes", "owner"),
        report(weekday, "weekday", "key"),
    ]
    if declared_track_roles is not None:
        counted = plan.track_summary(entries).filter("level = 0").select("track", "role", F.col("entries").alias("actual"))
        pairs = plan.reconcile(declared_track_roles, counted, ["track", "role"])
        parts.append(report(pairs.withColumn("pair", F.concat_ws(" / ", "track", "role")), "track role", "pair"))
    if source is not None:
        columns = ["track", "role", "title"]
        unlike = digests.tree_diff(entries.select(*columns), source.select(*columns), ["track"])
        copies = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("copies"))), F.lit(0))
        per_track = unlike.groupBy("track").agg(copies("right").alias("declared"), copies("left").alias("actual"))
        parts.append(report(per_track.withColumn("agrees", F.lit(False)), "source", "track"))
    return reduce(DataFrame.unionByName, parts)
