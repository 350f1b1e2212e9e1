"""Calendar files with weekly rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.functions.clock import clock_time, known_zone

def _property(name: str, group: int = 1, params: str = "") -> Column:
    found = F.regexp_extract("_event", rf"(?m)^{name}{params}:(.*?)\r?$", group)
    return F.when(found != "", found)


def _local(name: str) -> Column:
    """The clock time of a property in date, local, zoned or UTC form; anything else is missing, not an error."""
    return clock_time(_property(name, 1, r"(?:;[^:]*)?"))


def until(text: Column, tz: Column) -> Column:
    """The end of a rule as a zone-less UTC time: a UTC time as it stands, a local time or the last second of a date in ``tz``.

    Without a zone a local time counts as UTC; with an unknown one the end is missing.
    """
    stated = F.coalesce(F.nullif(tz, F.lit("")), F.lit("UTC"))
    zone = F.when(known_zone(stated), stated)
    return F.when(F.endswith(text, F.lit("Z")), clock_time(text)).otherwise(
        F.convert_timezone(zone, F.lit("UTC"), clock_time(text, day_ends=True))
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """One row per event: ids, local start and end with their zone, the weekly rule with its own text, and the other texts.

    The reader cuts the files where an event begins, so a calendar of any length splits across tasks.
    """
    unfolded = F.regexp_replace("value", r"\r?\n[ \t]", "")
    rule = F.str_to_map(F.col("_rule"), F.lit(";"), F.lit("="))
    return (
        spark.read.option("lineSep", "BEGIN:VEVENT").text(path)
        .select(unfolded.alias("_event"))
        .filter(F.contains("_event", F.lit("END:VEVENT")))
        .select(
            _property("UID").alias("uid"),
            clock_time(_property("DTSTAMP")).alias("dtstamp"),
            F.when(_property("DTSTART").endswith("Z"), "UTC")
            .otherwise(F.regexp_extract("_event", r"(?m)^DTSTART;TZID=([^:]*):", 1))
            .alias("tz"),
            _local("DTSTART").alias("start_local"),
            _local("DTEND").alias("end_local"),
            _property("RRULE").alias("_rule"),
            _property("SUMMARY").alias("summary"),
            _property("DESCRIPTION").alias("description"),
        )
        .withColumns(
            {
                "freq": F.try_element_at(rule, F.lit("FREQ")),
                "byday": F.split(F.try_element_at(rule, F.lit("BYDAY")), ","),
                "until_utc": until(F.try_element_at(rule, F.lit("UNTIL")), F.col("tz")),
            }
        )
        .withColumnRenamed("_rule", "rule")
    )
