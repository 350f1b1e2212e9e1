"""Control telemetry in batch: deadbands, dispatch, limits, trends, gaps and responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklens import dims
from tracklens.functions.numeric import bounded
from tracklens.functions.text import half_up
from tracklens.operators.ordered import SLICE_ROWS, drop_slices, running, slices

ORDER = ["ts", "event_id"]


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / 1_000_000.0


def bucket(ts: Column, period: str) -> Column:
    """The start of the period a time falls in, on the clock."""
    return F.window(ts, period)["start"]


# ---- per row ----


def deadband(df: DataFrame, db: float, bad: float = 4000.0) -> DataFrame:
    """Whether the controller acts (the error reaches the deadband) and the band shown for the error."""
    size = F.abs(F.col("err"))
    return df.withColumns(
        {"acts": size >= db, "band": F.when(size <= db, "ok").when(size > bad, "bad").otherwise("caution")}
    )


def bias(df: DataFrame) -> DataFrame:
    """Command against measurement: the gap, the gap as a percent of the measurement, and whether they agree."""
    gap = F.col("command") - F.col("measured")
    pct = F.when(F.col("measured") > 0, gap / F.col("measured") * 100).otherwise(0.0)
    return df.withColumns({"gap": gap, "pct": pct, "agree": F.abs(gap) < 0.01})


def frequency_delta(hz: Column, db_hz: float, droop: float, rating: float = dims.PFR_RATING_MW) -> Column:
    """The power change a frequency asks for: nothing inside the deadband, droop on what lies beyond it."""
    dev = hz - dims.NOMINAL_HZ
    beyond = F.when(F.abs(dev) > db_hz, dev - F.signum(dev) * db_hz).otherwise(0.0)
    return -(beyond / dims.NOMINAL_HZ) / droop * rating


def freq_response(df: DataFrame, db_hz: float, droop: float, rating: float = dims.PFR_RATING_MW) -> DataFrame:
    delta = frequency_delta(F.col("hz"), db_hz, droop, rating)
    state = F.when(F.abs(delta) < 0.05, "neutral").when(delta > 0, "up").otherwise("down")
    return df.withColumns({"delta": delta, "state": state})


def recommend_deadband(df: DataFrame) -> DataFrame:
    """A tenth of the plant (MW) times the clamping percent, in kW, and rounded up to the next 50."""
    kw = F.col("mw") * 0.10 * F.col("clamp_pct") / 100 * 1000
    return df.withColumns({"kw": kw, "deadband_kw": F.ceil(kw / 50) * 50})


def clamp(df: DataFrame) -> DataFrame:
    """The setpoint under its limit, and the value kept within 0 and the rating for display."""
    return df.withColumns(
        {
            "final": F.least("setpoint", "limit"),
            "shown": bounded(F.col("value"), F.lit(0.0), F.col("rating")),
        }
    )


def alarm(df: DataFrame) -> DataFrame:
    """One alarm per row by priority: clamped, then stuck, then low irradiance, then normal."""
    return df.withColumn(
        "alarm",
        F.when(F.col("clamped") > 0, "clamped")
        .when(F.col("stuck") > 0, "stuck")
        .when(F.col("irradiance") < 0.98, "irradiance")
        .otherwise("normal"),
    )


def controllable() -> Column:
    return ~(F.col("offline") | F.col("fault") | ~F.col("included"))


def device_state(df: DataFrame) -> DataFrame:
    """Percent of rating (NULL without one) and the state shown for a device."""
    return df.withColumns(
        {
            "pct": half_up(F.col("out") / F.nullif(F.col("rating"), F.lit(0.0)) * 100),
            "state": F.when(F.col("clamped"), "bad").when(~F.col("responsive"), "caution").otherwise(""),
        }
    )


# ---- aggregates ----


def latest_samples(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per group and device: the named columns of its latest sample, and how many samples it had.

    Plant figures add devices up, so they start from this; a denser sampling changes nothing in them.
    """
    return (
        df.groupBy(*keys, "device")
        .agg(F.max_by(F.struct(*columns), F.struct(*ORDER)).alias("_last"), F.count("*").alias("samples"))
        .select(*keys, "device", "_last.*", "samples")
    )


def available(df: DataFrame, keys: list[str]) -> DataFrame:
    """Controllable rating, and the constant output of everything that cannot be controlled, over each group's devices."""
    states = latest_samples(df, keys, ["rating", "out", "offline", "fault", "included"])
    return states.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(controllable(), F.col("rating"))), F.lit(0.0)).alias("available"),
        F.coalesce(F.sum(F.when(~controllable(), F.col("out"))), F.lit(0.0)).alias("constant"),
    )


def share_of(cmd: Column) -> Column:
    """The part of each rating to ask for; it may exceed 1 and is not capped."""
    return F.when(F.col("available") > 0, F.greatest(F.lit(0.0), cmd - F.col("constant")) / F.col("available")).otherwise(
        0.0
    )


def dispatch(df: DataFrame, keys: list[str], cmd: str = "cmd", sums: DataFrame | None = None) -> DataFrame:
    """Each controllable row's share of the command, in proportion to its rating.

    The group sums count each device once, by its latest sample; they are combined before the shuffle and joined back; Spark broadcasts them when they are
    small and splits a skewed group when they are not. Where the command is costly to compute, pass
    ``sums`` made from the frame without it.
    """
    joined = df.join(available(df, keys) if sums is None else sums, keys)
    return joined.withColumn("limit", F.when(controllable(), F.col("rating") * share_of(F.col(cmd)))).drop(
        "available", "constant"
    )


def plant_kpis(df: DataFrame, keys: list[str], db: float, bad: float = 4000.0) -> DataFrame:
    """Output, setpoint, error with its band, and clamped devices per group, each device by its latest sample."""
    totals = latest_samples(df, keys, ["out", "sp", "clamped", *ORDER]).groupBy(*keys).agg(
        F.sum("out").alias("total_out"),
        F.max_by("sp", F.struct(*ORDER)).alias("setpoint"),
        F.count_if("clamped").alias("clamped"),
    )
    return deadband(totals.withColumn("err", F.col("setpoint") - F.col("total_out")), db, bad).drop("acts")


def response_metrics(df: DataFrame, keys: list[str]) -> DataFrame:
    """Peak, overshoot over 100 %, final value and the bands they fall in, per trace."""
    over = F.greatest(F.lit(0.0), F.col("peak") - 100)
    return (
        df.groupBy(*keys)
        .agg(F.max("y").alias("peak"), F.max_by("y", F.struct(*ORDER)).alias("final"))
        .withColumn("overshoot", over)
        .withColumns(
            {
                "overshoot_band": F.when(F.col("overshoot") < 0.5, "none")
                .when(F.col("overshoot") < 8, "ok")
                .when(F.col("overshoot") > 20, "bad")
                .otherwise(""),
                "settled": F.col("final") > 95,
            }
        )
    )


# ---- over time, per device ----


def adaptive_limit(
    df: DataFrame, delay: float, factor: float = 1.15, keys: tuple[str, ...] = ("device",), rows: int = SLICE_ROWS
) -> DataFrame:
    """Flag devices that ignored their limit for ``delay`` seconds and cap them at ``factor`` times their output.

    Rows that are offline, faulted or excluded pass through unflagged and leave a run as it was; a
    responsive row ends it. ``limit``, where there is one, is lowered to the cap.
    """
    keys = list(keys)
    sliced = slices(df, keys, ORDER, rows).withColumn("_counts", controllable())
    state = F.when(F.col("_counts"), F.col("responsive"))
    lagged = running(sliced, keys, ORDER, {"_was": ("last_before", state)}, rows)
    stuck = F.col("_counts") & ~F.col("responsive")
    begins = F.when(stuck & F.coalesce("_was", F.lit(True)), F.col("ts"))
    runs = running(lagged.withColumn("_begins", begins), keys, ORDER, {"_since": ("last", F.col("_begins"))}, rows)
    clamped = stuck & (seconds_between(F.col("_since"), F.col("ts")) >= delay)
    cap = F.when(clamped, F.col("out") * factor)
    added = {
        "stuck_since": F.when(stuck, F.col("_since")),
        "clamped": clamped,
        "adaptive": cap,
    }
    if "limit" in df.columns:
        added["limit"] = F.least("limit", cap)
    flagged = runs.withColumns(added)
    return drop_slices(flagged.drop("_counts", "_was", "_begins", "_since"))


def trend(df: DataFrame, window_s: float = dims.TREND_SECONDS, keys: tuple[str, ...] = ("device",)) -> DataFrame:
    """The rows of each series within ``window_s`` seconds of its latest one."""
    keys = list(keys)
    latest = df.groupBy(*keys).agg(F.max("ts").alias("_latest"))
    span = F.make_dt_interval(secs=F.lit(float(window_s)))
    return df.join(latest, keys).filter(F.col("ts") >= F.col("_latest") - span).drop("_latest")


def downsample(
    df: DataFrame,
    period: str,
    values: list[str],
    keep: int | None = None,
    keys: tuple[str, ...] = ("device",),
) -> DataFrame:
    """The last sample of each clock period: all of them, or the newest ``keep`` per series (the history cap)."""
    keys = list(keys)
    newest = W.partitionBy(*keys).orderBy(F.desc("period_start"))
    found = df.groupBy(*keys, bucket(F.col("ts"), period).alias("period_start")).agg(
        F.max_by(F.struct("ts", *values), F.struct(*ORDER)).alias("_last")
    )
    if keep is not None:
        found = found.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= keep)
    return found.select(*keys, "period_start", "_last.*")


def missed(df: DataFrame, period_s: float, keys: tuple[str, ...] = ("device",), rows: int = SLICE_ROWS) -> DataFrame:
    """Seconds since the row before, and how many expected arrivals that gap swallowed."""
    timed = running(df, list(keys), ORDER, {"_before": ("previous", F.col("ts"))}, rows)
    gap = seconds_between(F.col("_before"), F.col("ts"))
    return timed.withColumns(
        {"gap_s": gap, "missed": F.greatest(F.floor(F.coalesce(gap, F.lit(0.0)) / period_s) - 1, F.lit(0))}
    ).drop("_before")


def error_integral(
    df: DataFrame, db: float, keys: tuple[str, ...] = ("device",), rows: int = SLICE_ROWS
) -> DataFrame:
    """Running sum of error times elapsed seconds, counted only outside the deadband; added exactly, rounded once."""
    keys = list(keys)
    timed = running(slices(df, keys, ORDER, rows), keys, ORDER, {"_before": ("previous", F.col("ts"))}, rows)
    dt = F.coalesce(seconds_between(F.col("_before"), F.col("ts")), F.lit(0.0))
    part = F.when(F.abs("err") >= db, F.col("err") * dt).otherwise(0.0)
    summed = running(timed.withColumn("_part", part), keys, ORDER, {"integral": ("exact_total", F.col("_part"))}, rows)
    return drop_slices(summed.drop("_before", "_part"))


def active_source(df: DataFrame, active: str) -> DataFrame:
    """Only the active source supplies the setpoint."""
    return df.filter(F.col("source") == active)


def source_changes(df: DataFrame, keys: tuple[str, ...] = ("device",), rows: int = SLICE_ROWS) -> DataFrame:
    """The rows where a series' source differs from the row before; its first row counts."""
    lagged = running(df, list(keys), ORDER, {"from_source": ("previous", F.col("source"))}, rows)
    return lagged.filter(~F.col("from_source").eqNullSafe(F.col("source")))


def hold_last(df: DataFrame, keys: tuple[str, ...] = ("device",), rows: int = SLICE_ROWS) -> DataFrame:
    """The last value of good quality up to each row."""
    return running(df, list(keys), ORDER, {"held": ("last", F.when(F.col("quality"), F.col("out")))}, rows)


def align(
    command: DataFrame,
    feedback: DataFrame,
    tolerance_s: float,
    keys: tuple[str, ...] = ("device",),
    rows: int = SLICE_ROWS,
    keep_slices: bool = False,
) -> DataFrame:
    """Each feedback row with the latest command at or before it, unless that is older than the tolerance.

    ``command`` holds (keys, ts, command), ``feedback`` (keys, ts, event_id, feedback). One union and one
    carried value: no join, so no pairing of rows.
    """
    keys = list(keys)
    both = command.select(
        *keys,
        "ts",
        F.lit(0).alias("_side"),
        F.lit(None).cast("long").alias("event_id"),
        "command",
        F.lit(None).cast("double").alias("feedback"),
    ).unionByName(
        feedback.select(
            *keys, "ts", F.lit(1).alias("_side"), "event_id", F.lit(None).cast("double").alias("command"), "feedback"
        )
    )
    given = F.when(F.col("_side") == 0, F.struct("ts", "command"))
    order = ["ts", "_side", "event_id", "command"]
    carried = running(slices(both, keys, order, rows), keys, order, {"_cmd": ("last", given)}, rows)
    fresh = seconds_between(F.col("_cmd.ts"), F.col("ts")) <= tolerance_s
    found = carried.filter(F.col("_side") == 1).withColumns(
        {
            "command_ts": F.when(fresh, F.col("_cmd.ts")),
            "command": F.when(fresh, F.col("_cmd.command")),
        }
    ).drop("_side", "_cmd")
    return found if keep_slices else drop_slices(found)


def response_ok(
    df: DataFrame,
    limit_s: float,
    low: float,
    high: float,
    keys: tuple[str, ...] = ("device",),
    rows: int = SLICE_ROWS,
) -> DataFrame:
    """Setpoint steps from at most ``low`` to at least ``high``, and whether the output reached the new setpoint in time.

    Every row carries the step it follows, so a step ends where the next begins and one aggregate decides.
    """
    keys = list(keys)
    lagged = running(slices(df, keys, ORDER, rows), keys, ORDER, {"_sp": ("previous", F.col("sp"))}, rows)
    is_step = (F.col("_sp") <= low) & (F.col("sp") >= high)
    step = F.when(is_step, F.struct(F.col("ts").alias("step_ts"), F.col("sp").alias("target")))
    carried = drop_slices(running(lagged, keys, ORDER, {"_step": ("last", step)}, rows))
    in_time = seconds_between(F.col("step_ts"), F.col("ts")) <= limit_s
    return (
        carried.filter(F.col("_step").isNotNull())
        .select(*keys, "ts", "out", "_step.*")
        .groupBy(*keys, "step_ts", "target")
        .agg(F.min(F.when(in_time & (F.col("out") >= F.col("target")), F.col("ts"))).alias("reached_ts"))
        .withColumn("ok", F.col("reached_ts").isNotNull())
    )


# ---- windows on the clock ----


def periodic_eval(df: DataFrame, period: str, keys: tuple[str, ...] = ("device",)) -> DataFrame:
    """The latest sample of each evaluation period."""
    return (
        df.groupBy(*keys, F.window("ts", period).alias("_w"))
        .agg(F.max_by("out", F.struct(*ORDER)).alias("out"), F.count("*").alias("samples"))
        .select(*keys, F.col("_w.start").alias("period_start"), "out", "samples")
    )


def rolling_kpis(df: DataFrame, window: str, slide: str, keys: tuple[str, ...] = ("plant",)) -> DataFrame:
    """Output of all devices by their latest sample, samples and last setpoint over a sliding window."""
    return (
        df.groupBy(*keys, "device", F.window("ts", window, slide).alias("_w"))
        .agg(F.max_by(F.struct("out", "sp", *ORDER), F.struct(*ORDER)).alias("_last"), F.count("*").alias("samples"))
        .groupBy(*keys, "_w")
        .agg(
            F.sum("_last.out").alias("total_out"),
            F.sum("samples").alias("samples"),
            F.max_by("_last.sp", F.struct("_last.ts", "_last.event_id")).alias("setpoint"),
        )
        .select(*keys, F.col("_w.start").alias("window_start"), "total_out", "samples", "setpoint")
    )


# ---- lookups ----


def timing_budget(ramps: DataFrame) -> DataFrame:
    """Each ramp (seconds) against each meter protocol: the meter and loop periods it needs, and whether the protocol fits.

    A command-path protocol gets no verdict. The protocols are a fixed short list, exploded on the row.
    """
    protocols = F.array(
        *[
            F.struct(F.lit(n).alias("protocol"), F.lit(ms).alias("ms"), F.lit(c).alias("command_path"))
            for n, ms, c in dims.PROTOCOLS
        ]
    )
    meter = F.col("ramp_s") * 1000 / 10
    return (
        ramps.withColumns({"meter_ms": meter, "pid_ms": F.col("ramp_s") * 1000 / 5, "_p": F.explode(protocols)})
        .select(*ramps.columns, "meter_ms", "pid_ms", "_p.*")
        .withColumn("fits", F.when(~F.col("command_path"), F.col("ms") <= F.col("meter_ms")))
    )


def with_channel(df: DataFrame, ref: DataFrame) -> DataFrame:
    """A picked signal's tag and unit, and its line in the recording's specification."""
    line = F.concat(
        F.lit("channel "),
        F.format_string("%02d", F.col("ord")),
        F.lit("   : "),
        F.rpad("tag", 32, " "),
        F.lit(" ["),
        "unit",
        F.lit("]   "),
        "signal",
    )
    return df.join(ref, "signal", "left").withColumn("line", line)
