"""Recurring events, study blocks, sessions and adherence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.functions import text
from tracklens.functions.clock import known_zone
from tracklens.operators.intervals import range_join


def to_instant(local: Column, tz: Column) -> Column:
    """A local clock time in its zone as a zone-less UTC time."""
    return F.convert_timezone(tz, F.lit("UTC"), local)


def expand_rules(rules: DataFrame, keep: tuple[str, ...] = ("uid",)) -> DataFrame:
    """Weekly rules to occurrences at their local clock time, from the start through ``until_utc``.

    Each weekday steps by its interval of weeks from the start's week, so hardly a day is generated and thrown away.
    Only the last two dates can pass the end, so only they are compared as instants. An event without a rule
    occurs once; a clock time without a zone counts as UTC; ``rejected_rules`` returns what is not expanded.
    """
    once = _rule(rules).isNull() & F.col("byday").isNull()
    own_day = F.array(F.upper(F.substring(F.date_format("start_local", "E"), 1, 2)))
    weeks = F.greatest(F.coalesce(_part(rules, "INTERVAL").try_cast("int"), F.lit(1)), F.lit(1))
    rules = (
        rules.filter(rule_problem(rules).isNull())
        .withColumns({"tz": F.coalesce(F.nullif("tz", F.lit("")), F.lit("UTC")), "_weeks": weeks, "_once": once})
        .withColumns(
            {
                "byday": F.coalesce("byday", own_day),
                "until_utc": F.when(F.col("_once"), to_instant(F.col("start_local"), F.col("tz"))).otherwise(
                    F.col("until_utc")
                ),
            }
        )
    )
    day = F.explode(F.array_distinct("byday")).alias("_day")
    last = F.convert_timezone(F.lit("UTC"), F.col("tz"), F.col("until_utc")).cast("date")
    first = F.expr("next_day(date_sub(next_day(date_sub(cast(start_local AS DATE), 7), 'MO'), 1), _day)")
    dates = F.when(F.col("_first") <= F.col("_last"), F.expr("sequence(_first, _last, make_interval(0, 0, _weeks))"))
    starts = F.col("_date").cast("timestamp_ntz") + (
        F.col("start_local") - F.col("start_local").cast("date").cast("timestamp_ntz")
    )
    return (
        rules.withColumns({"_last": last, "_length": F.col("end_local") - F.col("start_local")})
        .select(*keep, "tz", "start_local", "until_utc", "_last", "_length", "_weeks", day)
        .withColumn("_first", first)
        .withColumn("_date", F.explode(dates))
        .withColumn("occurs_local", starts)
        .withColumn("occurs_utc", to_instant(F.col("occurs_local"), F.col("tz")))
        .filter(F.col("occurs_local") >= F.col("start_local"))
        .filter((F.col("_date") < F.date_sub("_last", 1)) | (F.col("occurs_utc") <= F.col("until_utc")))
        .select(*keep, "occurs_local", (F.col("occurs_local") + F.col("_length")).alias("ends_local"), "occurs_utc")
    )


def _rule(rules: DataFrame) -> Column:
    return F.col("rule") if "rule" in rules.columns else F.lit(None).cast("string")


def _part(rules: DataFrame, name: str) -> Column:
    return F.try_element_at(F.str_to_map(_rule(rules), F.lit(";"), F.lit("=")), F.lit(name))


def rule_problem(rules: DataFrame) -> Column:
    """Why a rule is not expanded; NULL for a weekly rule with an end, and for an event without a rule.

    The parts of the rule are looked up in its text, ``rule``, where the frame has one.
    """
    parts = F.transform(F.split(_rule(rules), ";"), lambda p: F.split(p, "=")[0])
    known = F.array(*[F.lit(n) for n in ("FREQ", "INTERVAL", "BYDAY", "UNTIL", "WKST")])
    week_start = _part(rules, "WKST")
    has_rule = _rule(rules).isNotNull() | F.col("byday").isNotNull()
    return (
        F.when(F.col("start_local").isNull(), "no start")
        .when(~known_zone(F.coalesce(F.nullif("tz", F.lit("")), F.lit("UTC"))), "zone")
        .when(_part(rules, "FREQ") != "WEEKLY", "frequency")
        .when((F.size(F.array_except(parts, known)) > 0) | (week_start != "MO"), "unsupported part")
        .when(F.exists("byday", lambda d: ~d.isin("MO", "TU", "WE", "TH", "FR", "SA", "SU")), "weekday")
        .when(has_rule & F.col("until_utc").isNull(), "no end")
    )


def rejected_rules(rules: DataFrame) -> DataFrame:
    """The rules that ``expand_rules`` leaves out, each with its ``reason``."""
    return rules.withColumn("reason", rule_problem(rules)).filter(F.col("reason").isNotNull())


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def weekly_hours(rules: DataFrame, keys: list[str]) -> DataFrame:
    """Planned hours per week: days times length, summed per key."""
    minutes = F.size("byday") * minutes_between(F.col("start_local"), F.col("end_local"))
    return rules.groupBy(*keys).agg((F.sum(minutes) / 60.0).alias("hours"))


def session_duration(df: DataFrame) -> DataFrame:
    minutes = F.col("end_min") - F.col("start_min")
    return df.withColumns({"minutes": minutes, "label": text.duration(minutes)})


def assign_block(df: DataFrame, date: str, blocks: DataFrame) -> DataFrame:
    """The block whose days hold the date; a recess date has none."""
    return range_join(
        df,
        blocks.select("block", "block_start", "block_end"),
        F.unix_date(F.col(date).cast("date")),
        F.unix_date("block_start"),
        F.unix_date("block_end"),
        width=91,
    ).drop("block_start", "block_end")


def assign_tick(ticks: DataFrame, sessions: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Each tick with the sessions of its day that hold it, give or take ``tolerance`` minutes."""
    return range_join(
        ticks,
        sessions,
        F.col("m"),
        F.col("start_min") - tolerance,
        F.col("end_min") + tolerance,
        width=240,
        keys=("day",),
    )


def plan_weeks(plan: DataFrame, keys: list[str]) -> DataFrame:
    """Every week from ``first_week`` through ``last_week``."""
    weeks = F.expr("sequence(first_week, last_week, INTERVAL 7 DAYS)")
    return plan.select(*keys, F.explode(F.when(F.col("first_week") <= F.col("last_week"), weeks)).alias("week_of"))


def adherence(plan: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    """Planned weeks against the log: a week with no entry counts 0 and is not posted."""
    joined = plan_weeks(plan, keys).join(log, [*keys, "week_of"], "left")
    entries = F.coalesce("entries", F.lit(0))
    return joined.withColumns({"entries": entries, "posted": entries > 0})


def block_gaps(blocks: DataFrame) -> DataFrame:
    """Days off between each block and the next, matched by number."""
    following = blocks.select((F.col("block") - 1).alias("block"), F.col("block_start").alias("next_start"))
    return blocks.join(following, "block").select(
        "block",
        F.date_add("block_end", 1).alias("gap_start"),
        F.date_sub("next_start", 1).alias("gap_end"),
        (F.datediff("next_start", "block_end") - 1).alias("days"),
    )
