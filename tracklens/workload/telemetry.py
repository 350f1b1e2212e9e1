"""Telemetry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklens import dims
from tracklens.operators import telemetry as T
from tracklens.operators.ramp import ramp_limit
from tracklens.plans import recording
from tracklens.plans.setpoint_chain import ChainParams, setpoint_chain
from tracklens.session import shared_folder, written
from tracklens.sources.recording import write_recording
from tracklens.workload.registry import query

TEL = ("telemetry",)
HOUR = 3600
_CAN = "NOT (offline OR fault OR NOT included)"
_W = "PARTITION BY device ORDER BY ts, event_id"
_HZ = "60 + (sp - 75) / 500.0::DOUBLE"


def r6(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


def hz():
    return 60 + (F.col("sp") - 75) / 500.0


def deadband_errors(t):
    return t.telemetry.withColumn("err", F.col("sp") - F.col("out"))


@query(
    "deadband_state",
    """SELECT event_id, round(sp - out, 6) AS err, abs(sp - out) >= 20 AS acts, CASE WHEN abs(sp - out) <= 20 THEN 'ok'
    WHEN abs(sp - out) > 40 THEN 'bad' ELSE 'caution' END AS band FROM telemetry""",
    TEL,
)
def _(t):
    return r6(T.deadband(deadband_errors(t).select("event_id", "err"), 20, bad=40), "err")


@query(
    "command_bias",
    """SELECT event_id, round(sp - out, 6) AS gap, round(CASE WHEN out > 0 THEN (sp - out) / out * 100 ELSE 0 END, 6) AS pct,
    abs(sp - out) < 0.01 AS agree FROM telemetry""",
    TEL,
)
def _(t):
    pairs = t.telemetry.select("event_id", F.col("sp").alias("command"), F.col("out").alias("measured"))
    return r6(T.bias(pairs), "gap", "pct").drop("command", "measured")


_DELTA = """(-((CASE WHEN abs(hz - 60) > 0.036 THEN hz - 60 - sign(hz - 60) * 0.036 ELSE 0 END) / 60.0::DOUBLE)
  / 0.05::DOUBLE * 50)"""


@query(
    "freq_response",
    f"""SELECT event_id, round(delta, 6) AS delta, CASE WHEN abs(delta) < 0.05 THEN 'neutral' WHEN delta > 0 THEN 'up'
    ELSE 'down' END AS state FROM (SELECT event_id, {_DELTA} AS delta FROM (SELECT event_id, {_HZ} AS hz FROM telemetry))""",
    TEL,
)
def _(t):
    rows = t.telemetry.select("event_id", hz().alias("hz"))
    return r6(T.freq_response(rows, 0.036, 0.05), "delta").drop("hz")


@query(
    "deadband_reco",
    """SELECT p_partkey, round(kw, 6) AS kw, CAST(ceil(kw / 50) * 50 AS BIGINT) AS deadband_kw FROM
    (SELECT p_partkey, p_size * 0.10::DOUBLE * (p_partkey % 20 + 1) / 100 * 1000 AS kw FROM part)""",
)
def _(t):
    plants = t.part.select("p_partkey", F.col("p_size").alias("mw"), (F.col("p_partkey") % 20 + 1).alias("clamp_pct"))
    return r6(T.recommend_deadband(plants), "kw").drop("mw", "clamp_pct")


@query(
    "limit_clamp",
    """SELECT event_id, least(sp, 80) AS final, greatest(0, least(rating, out)) AS shown FROM telemetry""",
    TEL,
)
def _(t):
    rows = t.telemetry.select(
        "event_id", F.col("sp").alias("setpoint"), F.lit(80.0).alias("limit"), F.col("out").alias("value"), "rating"
    )
    return T.clamp(rows).select("event_id", "final", "shown")


_ADAPTIVE = f"""state AS (SELECT *, {_CAN} AS counts FROM telemetry),
  runs AS (SELECT *, count(*) FILTER (counts AND responsive) OVER ({_W}) AS run FROM state),
  since AS (SELECT *, min(ts) FILTER (counts AND NOT responsive) OVER (PARTITION BY device, run ORDER BY ts, event_id)
    AS began FROM runs),
  flagged AS (SELECT *, CASE WHEN counts AND NOT responsive THEN began END AS stuck_since,
    counts AND NOT responsive AND coalesce((epoch_us(ts) - epoch_us(began)) / 1000000.0::DOUBLE >= 43200, false)
    AS clamped FROM since)"""


@query(
    "adaptive_limit",
    f"WITH {_ADAPTIVE} SELECT device, ts, event_id, stuck_since, clamped, round(CASE WHEN clamped THEN out * 1.15::DOUBLE END, 6) "
    "AS adaptive FROM flagged",
    TEL,
)
def _(t):
    found = T.adaptive_limit(t.telemetry, delay=12 * HOUR)
    return r6(found.select("device", "ts", "event_id", "stuck_since", "clamped", "adaptive"), "adaptive")


@query(
    "plant_alarm",
    f"""WITH {_ADAPTIVE} SELECT plant, day, clamped, stuck, round(irradiance, 6) AS irradiance,
    CASE WHEN clamped > 0 THEN 'clamped' WHEN stuck > 0 THEN 'stuck' WHEN irradiance < 0.98 THEN 'irradiance' ELSE 'normal' END
    AS alarm FROM (SELECT plant, day, count(*) FILTER (clamped) AS clamped,
      count(*) FILTER (NOT responsive) AS stuck, CAST(sum(CAST(least(1, out / 50.0::DOUBLE) AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS irradiance
      FROM (SELECT *, date_trunc('day', ts) AS day, row_number() OVER (PARTITION BY device, date_trunc('day', ts)
        ORDER BY ts DESC, event_id DESC) AS rn FROM flagged) WHERE rn = 1 GROUP BY ALL)""",
    TEL,
)
def _(t):
    """Alarms per plant and day, from the devices' last states of the day."""
    flagged = T.adaptive_limit(t.telemetry, delay=12 * HOUR).withColumn("day", T.bucket(F.col("ts"), "1 day"))
    states = T.latest_samples(flagged, ["plant", "day"], ["clamped", "responsive", "out"])
    daily = states.groupBy("plant", "day").agg(
        F.count_if("clamped").alias("clamped"),
        F.count_if(~F.col("responsive")).alias("stuck"),
        (F.sum(F.least(F.lit(1.0), F.col("out") / 50.0).cast("decimal(18,4)")).cast("double") / F.count("*")).alias(
            "irradiance"
        ),
    )
    return r6(T.alarm(daily).withColumn("day", F.col("day").cast("timestamp_ntz")), "irradiance")


@query(
    "device_state",
    f"""WITH {_ADAPTIVE} SELECT event_id, CAST(floor(out / nullif(rating, 0) * 100 + 0.5) AS BIGINT) AS pct,
    CASE WHEN clamped THEN 'bad' WHEN NOT responsive THEN 'caution' ELSE '' END AS state FROM flagged""",
    TEL,
)
def _(t):
    flagged = T.adaptive_limit(t.telemetry, delay=12 * HOUR)
    return T.device_state(flagged).select("event_id", "pct", "state")


@query(
    "plant_kpis",
    f"""WITH {_ADAPTIVE} SELECT plant, day, round(total_out, 4) AS total_out, setpoint, round(setpoint - total_out, 4) AS err,
    CASE WHEN abs(setpoint - total_out) <= 500 THEN 'ok' WHEN abs(setpoint - total_out) > 4000 THEN 'bad' ELSE 'caution' END
    AS band, clamped FROM (SELECT plant, day, sum(out) FILTER (rn = 1) AS total_out,
      arg_max(sp, row(ts, event_id)) AS setpoint, count(*) FILTER (clamped AND rn = 1) AS clamped
      FROM (SELECT *, date_trunc('day', ts) AS day, row_number() OVER (PARTITION BY device, date_trunc('day', ts)
        ORDER BY ts DESC, event_id DESC) AS rn FROM flagged) GROUP BY ALL)""",
    TEL,
)
def _(t):
    flagged = T.adaptive_limit(t.telemetry, delay=12 * HOUR).withColumn("day", T.bucket(F.col("ts"), "1 day"))
    kpis = T.plant_kpis(flagged, ["plant", "day"], db=500)
    return kpis.withColumns({n: F.round(n, 4) for n in ("total_out", "err")})


_AVAILABLE = f"""sums AS (SELECT plant, time_bucket(INTERVAL 6 HOURS, ts) AS period,
  coalesce(sum(CASE WHEN {_CAN} THEN rating END), 0) AS available,
  coalesce(sum(CASE WHEN NOT ({_CAN}) THEN out END), 0) AS constant FROM (SELECT *, row_number() OVER (PARTITION BY device,
    time_bucket(INTERVAL 6 HOURS, ts) ORDER BY ts DESC, event_id DESC) AS rn FROM telemetry) WHERE rn = 1 GROUP BY ALL)"""


@query(
    "available_rating",
    f"WITH {_AVAILABLE} SELECT plant, period, available, round(constant, 4) AS constant FROM sums",
    TEL,
)
def _(t):
    sums = T.available(t.telemetry.withColumn("period", T.bucket(F.col("ts"), "6 hours")), ["plant", "period"])
    return sums.withColumn("constant", F.round("constant", 4))


@query(
    "dispatch",
    f"""WITH {_AVAILABLE} SELECT event_id, t.plant, period, round(CASE WHEN {_CAN} THEN rating *
    CASE WHEN available > 0 THEN greatest(0, sp - constant) / available ELSE 0 END END, 6) AS "limit"
    FROM telemetry t JOIN sums s ON t.plant = s.plant AND time_bucket(INTERVAL 6 HOURS, ts) = period""",
    TEL,
)
def _(t):
    rows = t.telemetry.withColumns({"period": T.bucket(F.col("ts"), "6 hours"), "cmd": F.col("sp")})
    return r6(T.dispatch(rows, ["plant", "period"]).select("event_id", "plant", "period", "limit"), "limit")


_RAMP = """WITH RECURSIVE steps AS (SELECT {key} AS key, event_id, {want} AS want,
    row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS rn,
    {rate}::DOUBLE * coalesce((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY {key} ORDER BY ts, event_id)))
      / 1000000.0::DOUBLE, 0) AS lim FROM {source}),
  ramp AS (SELECT key, event_id, rn, greatest(-lim, least(lim, want)) AS cmd FROM steps WHERE rn = 1
    UNION ALL SELECT s.key, s.event_id, s.rn, r.cmd + greatest(-s.lim, least(s.lim, s.want - r.cmd))
    FROM ramp r JOIN steps s ON s.key = r.key AND s.rn = r.rn + 1)"""


@query(
    "ramp_limit",
    _RAMP.format(key="device", want="sp", rate=0.0005, source="telemetry")
    + " SELECT key AS device, event_id, round(cmd, 6) AS cmd FROM ramp",
    TEL,
)
def _(t):
    rows = t.telemetry.select("device", "ts", "event_id", "sp")
    return r6(ramp_limit(rows, rate=0.0005).select("device", "event_id", "cmd"), "cmd")


@query(
    "trend_window",
    """SELECT device, ts, out FROM telemetry t JOIN (SELECT device, max(ts) AS latest FROM telemetry GROUP BY device) m
    USING (device) WHERE ts >= latest - INTERVAL 7 DAYS""",
    TEL,
)
def _(t):
    return T.trend(t.telemetry.select("device", "ts", "out"), window_s=7 * 24 * HOUR)


@query(
    "downsample",
    """SELECT device, period_start, ts, out FROM (SELECT *, row_number() OVER (PARTITION BY device ORDER BY period_start DESC)
    AS newest FROM (SELECT device, time_bucket(INTERVAL 6 HOURS, ts) AS period_start, ts, out, row_number() OVER
      (PARTITION BY device, time_bucket(INTERVAL 6 HOURS, ts) ORDER BY ts DESC, event_id DESC) AS rn FROM telemetry)
      WHERE rn = 1) WHERE newest <= 48""",
    TEL,
)
def _(t):
    return T.downsample(t.telemetry, "6 hours", ["out"], keep=48)


@query(
    "downsample_all",
    """SELECT device, period_start, ts, out FROM (SELECT device, time_bucket(INTERVAL 6 HOURS, ts) AS period_start, ts, out,
      row_number() OVER (PARTITION BY device, time_bucket(INTERVAL 6 HOURS, ts) ORDER BY ts DESC, event_id DESC) AS rn
      FROM telemetry) WHERE rn = 1""",
    TEL,
)
def _(t):
    return T.downsample(t.telemetry, "6 hours", ["out"])


@query(
    "missed_frames",
    f"""SELECT device, event_id, round(gap, 6) AS gap_s, CAST(greatest(floor(coalesce(gap, 0) / 7200) - 1, 0) AS BIGINT)
    AS missed FROM (SELECT device, event_id, (epoch_us(ts) - epoch_us(lag(ts) OVER ({_W}))) / 1000000.0::DOUBLE AS gap
    FROM telemetry)""",
    TEL,
)
def _(t):
    found = T.missed(t.telemetry.select("device", "ts", "event_id"), 2 * HOUR)
    return r6(found.drop("ts"), "gap_s")


@query(
    "error_integral",
    f"""SELECT device, event_id, round(sum(part) OVER ({_W} ROWS UNBOUNDED PRECEDING), 3) AS integral FROM
    (SELECT *, CASE WHEN abs(sp - out) >= 20 THEN (sp - out) * coalesce((epoch_us(ts) - epoch_us(lag(ts) OVER ({_W})))
    / 1000000.0::DOUBLE, 0) ELSE 0 END AS part FROM telemetry)""",
    TEL,
)
def _(t):
    found = T.error_integral(deadband_errors(t).select("device", "ts", "event_id", "err"), 20)
    return found.select("device", "event_id", F.round("integral", 3).alias("integral"))


@query("active_source", "SELECT device, ts, sp FROM telemetry WHERE source = 'purchase'", TEL)
def _(t):
    return T.active_source(t.telemetry, "purchase").select("device", "ts", "sp")


@query(
    "source_changes",
    f"""SELECT device, event_id, source, from_source FROM (SELECT *, lag(source) OVER ({_W}) AS from_source FROM telemetry)
    WHERE from_source IS DISTINCT FROM source""",
    TEL,
)
def _(t):
    return T.source_changes(t.telemetry.select("device", "ts", "event_id", "source")).drop("ts")


@query(
    "hold_last",
    f"""SELECT device, event_id, last_value(CASE WHEN quality THEN out END IGNORE NULLS)
    OVER ({_W} ROWS UNBOUNDED PRECEDING) AS held FROM telemetry""",
    TEL,
)
def _(t):
    return T.hold_last(t.telemetry.select("device", "ts", "event_id", "quality", "out")).select("device", "event_id", "held")


@query(
    "align_asof",
    """SELECT f.device, f.ts, f.event_id, f.out AS feedback, CASE WHEN fresh THEN cts END AS command_ts,
    CASE WHEN fresh THEN csp END AS command FROM (SELECT f.*, c.ts AS cts, c.sp AS csp,
      (epoch_us(f.ts) - epoch_us(c.ts)) / 1000000.0::DOUBLE <= 86400 AS fresh
      FROM (SELECT * FROM telemetry WHERE source <> 'purchase') f
      ASOF LEFT JOIN (SELECT * FROM telemetry WHERE source = 'purchase') c ON f.device = c.device AND f.ts >= c.ts) f""",
    TEL,
)
def _(t):
    given = F.col("source") == "purchase"
    command = t.telemetry.filter(given).select("device", "ts", F.col("sp").alias("command"))
    feedback = t.telemetry.filter(~given).select("device", "ts", "event_id", F.col("out").alias("feedback"))
    return T.align(command, feedback, 24 * HOUR)


def _response(source: str) -> str:
    return f"""lagged AS (SELECT *, lag(sp) OVER ({_W}) AS before FROM {source}),
  steps AS (SELECT device, ts AS step_ts, sp AS target, lead(ts) OVER (PARTITION BY device ORDER BY ts, event_id) AS next_ts
    FROM lagged WHERE before <= 70 AND sp >= 80),
  reached AS (SELECT s.device, step_ts, target, min(CASE WHEN out >= target AND (epoch_us(l.ts) - epoch_us(step_ts))
      / 1000000.0::DOUBLE <= 172800 THEN l.ts END) AS reached_ts
    FROM steps s JOIN {source} l ON l.device = s.device AND l.ts >= step_ts AND (next_ts IS NULL OR l.ts < next_ts)
    GROUP BY ALL)"""


@query(
    "response_ok",
    f"WITH {_response('telemetry')} SELECT *, reached_ts IS NOT NULL AS ok FROM reached",
    TEL,
)
def _(t):
    return T.response_ok(t.telemetry.select("device", "ts", "event_id", "sp", "out"), 48 * HOUR, 70, 80)


@query(
    "response_metrics",
    """SELECT device, day, peak, final, round(greatest(0, peak - 100), 6) AS overshoot,
    CASE WHEN greatest(0, peak - 100) < 0.5 THEN 'none' WHEN greatest(0, peak - 100) < 8 THEN 'ok'
    WHEN greatest(0, peak - 100) > 20 THEN 'bad' ELSE '' END AS overshoot_band, final > 95 AS settled
    FROM (SELECT device, CAST(ts AS DATE) AS day, max(out) AS peak, arg_max(out, row(ts, event_id)) AS final
    FROM telemetry GROUP BY ALL)""",
    TEL,
)
def _(t):
    traces = t.telemetry.withColumns({"day": F.col("ts").cast("date"), "y": F.col("out")})
    return r6(T.response_metrics(traces, ["device", "day"]), "overshoot")


@query(
    "periodic_eval",
    """SELECT device, time_bucket(INTERVAL 6 HOURS, ts) AS period_start, arg_max(out, row(ts, event_id)) AS out,
    count(*) AS samples FROM telemetry GROUP BY ALL""",
    TEL,
)
def _(t):
    return T.periodic_eval(t.telemetry, "6 hours")


_ROLLING = """SELECT plant, w AS window_start, round(sum(out) FILTER (rn = 1), 4) AS total_out, count(*) AS samples,
    arg_max(sp, row(ts, event_id)) AS setpoint FROM (SELECT *, row_number() OVER (PARTITION BY device, w
      ORDER BY ts DESC, event_id DESC) AS rn FROM (SELECT *, unnest([time_bucket(INTERVAL 6 HOURS, ts),
      time_bucket(INTERVAL 6 HOURS, ts) - INTERVAL 6 HOURS, time_bucket(INTERVAL 6 HOURS, ts) - INTERVAL 12 HOURS,
      time_bucket(INTERVAL 6 HOURS, ts) - INTERVAL 18 HOURS]) AS w FROM telemetry))"""


@query(
    "rolling_kpis",
    f"{_ROLLING} GROUP BY plant, w",
    TEL,
)
def _(t):
    return T.rolling_kpis(t.telemetry, "24 hours", "6 hours").withColumn("total_out", F.round("total_out", 4))


_PROTOCOL_ROWS = ", ".join(f"('{n}', {ms}::DOUBLE, {str(c).lower()})" for n, ms, c in dims.PROTOCOLS)


@query(
    "timing_budget",
    f"""SELECT event_id, round(value * 1000 / 10, 6) AS meter_ms, round(value * 1000 / 5, 6) AS pid_ms, protocol, ms,
    command_path, CASE WHEN NOT command_path THEN ms <= value * 1000 / 10 END AS fits
    FROM events, (VALUES {_PROTOCOL_ROWS}) p(protocol, ms, command_path)""",
)
def _(t):
    budget = T.timing_budget(t.events.select("event_id", F.col("value").alias("ramp_s")))
    return r6(budget, "meter_ms", "pid_ms").drop("ramp_s")


_SIGNALS = [name for name, _, _ in dims.CHANNELS]
_SIGNAL_SQL = "CASE source WHEN 'purchase' THEN 'Plant setpoint' WHEN 'signup' THEN 'Plant setpoint' WHEN 'click' THEN 'Q at POI' ELSE 'P at POI' END"
_RECORDED = f"""recorded AS (SELECT device, ts, event_id, {_SIGNAL_SQL} AS signal,
  CASE WHEN source IN ('purchase', 'signup') THEN sp ELSE out END AS value FROM telemetry)"""


def recorded(t):
    source = F.col("source")
    given = source.isin("purchase", "signup")
    signal = F.when(given, "Plant setpoint").when(source == "click", "Q at POI").otherwise("P at POI")
    return t.telemetry.select(
        "device", "ts", "event_id", signal.alias("signal"), F.when(given, F.col("sp")).otherwise(F.col("out")).alias("value")
    )


@query(
    "channel_spec",
    f"""SELECT event_id, signal, tag, unit, 'channel ' || printf('%02d', event_id) || '   : ' || rpad(tag, 32, ' ') || ' [' || unit
    || ']   ' || signal AS line FROM (SELECT event_id, ({str(_SIGNALS)} || ['Unknown'])[event_id % 7 + 1] AS signal
    FROM events) LEFT JOIN (VALUES {", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in dims.CHANNELS)}) c(signal, tag, unit) USING (signal)""",
)
def _(t):
    names = F.array(*[F.lit(s) for s in [*_SIGNALS, "Unknown"]])
    picks = t.events.select("event_id", F.element_at(names, (F.col("event_id") % 7 + 1).cast("int")).alias("signal"))
    spec = T.with_channel(picks.withColumn("ord", F.col("event_id")), F.broadcast(dims.channel_dim(t.spark)))
    return spec.drop("ord")


_SAMPLED = """sampled AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY device, signal ORDER BY period_start DESC)
    AS newest FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS period_start, row_number() OVER
      (PARTITION BY device, signal, time_bucket(INTERVAL 1 HOUR, ts) ORDER BY ts DESC, event_id DESC) AS rn
      FROM recorded WHERE signal IN ('P at POI', 'Plant setpoint')) WHERE rn = 1)),
  aligned AS (SELECT f.device, f.ts, f.event_id, f.value AS out,
      CASE WHEN (epoch_us(f.ts) - epoch_us(c.ts)) / 1000000.0::DOUBLE <= 172800 THEN c.value END AS sp
    FROM (SELECT * FROM sampled WHERE signal = 'P at POI') f
    ASOF LEFT JOIN (SELECT * FROM sampled WHERE signal = 'Plant setpoint') c ON f.device = c.device AND f.ts >= c.ts)"""
_PAIR = ["P at POI", "Plant setpoint"]


@query(
    "recording",
    f"WITH {_RECORDED}, {_SAMPLED}, {_response('aligned')} SELECT *, reached_ts IS NOT NULL AS ok FROM reached",
    TEL,
)
def _(t):
    samples = written(recording.resampled(recorded(t), _PAIR, "1 hour"), "recording")
    return recording.compliance(samples, 48 * HOUR, 48 * HOUR, 70, 80)


@query(
    "recording_write",
    f"WITH {_RECORDED}, {_SAMPLED} SELECT device, signal, event_id, value FROM sampled",
    TEL,
)
def _(t):
    rows = recording.resampled(recorded(t), _PAIR, "1 hour").select("device", "signal", "event_id", "value")
    path = write_recording(rows, shared_folder(t.spark, "recording"))
    return t.spark.read.schema("device BIGINT, signal STRING, event_id BIGINT, value DOUBLE").option("header", True).csv(path)


_CHAIN = ChainParams(active="purchase", db_hz=0.036, droop=0.05, limit=90.0, rate=0.001, delay=12 * HOUR, period="6 hours")


@query(
    "setpoint_chain",
    _RAMP.format(key="plant", want="final", rate=0.001, source="chained").replace(
        "WITH RECURSIVE ",
        f"""WITH RECURSIVE {_ADAPTIVE}, {_AVAILABLE},
  chained AS (SELECT *, least(coalesce(last_value(CASE WHEN source = 'purchase' THEN sp END IGNORE NULLS) OVER
    (PARTITION BY plant ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 0) + {_DELTA}, 90) AS final
    FROM (SELECT *, {_HZ} AS hz FROM flagged)), """,
    )
    + f""" SELECT c.event_id, c.plant, c.device, round(c.final, 6) AS final, round(r.cmd, 6) AS cmd, c.clamped,
    round(CASE WHEN {_CAN} THEN least(rating * CASE WHEN available > 0 THEN greatest(0, r.cmd - constant) / available ELSE 0 END,
      CASE WHEN c.clamped THEN c.out * 1.15::DOUBLE ELSE 'infinity'::DOUBLE END) END, 6) AS "limit"
    FROM chained c JOIN ramp r ON c.event_id = r.event_id JOIN sums s ON c.plant = s.plant
      AND time_bucket(INTERVAL 6 HOURS, c.ts) = s.period""",
    TEL,
)
def _(t):
    chain = setpoint_chain(t.telemetry.withColumn("hz", hz()), _CHAIN)
    return r6(chain.select("event_id", "plant", "device", "final", "cmd", "clamped", "limit"), "final", "cmd", "limit")
