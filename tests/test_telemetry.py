import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklens import dims
from tracklens.operators import telemetry as T
from tracklens.operators.ordered import SLICE, running, slices
from tracklens.operators.ramp import Rising, ramp_limit, step
from tracklens.plans import recording
from tracklens.plans.setpoint_chain import setpoint_chain
from tracklens.workload import telemetry as WT

T0 = dt.datetime(2024, 1, 1)
HOUR = 3600


def at(s):
    return T0 + dt.timedelta(seconds=s)


def same(a, b, digits=6):
    def rows(df):
        return sorted(
            str([round(v, digits) + 0.0 if isinstance(v, float) else v for v in (r[c] for c in sorted(df.columns))])
            for r in df.collect()
        )

    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)


@pytest.fixture(scope="module")
def skewed(spark, tables):
    """A third of all rows on one device, some of them at one instant, some without a time."""
    hot = F.col("event_id") % 3 == 0
    return tables.telemetry.withColumns(
        {
            "device": F.when(hot, 1).otherwise(F.col("device")),
            "ts": F.when(F.col("event_id") % 30 == 0, T0)
            .when(F.col("event_id") == 7, None)
            .otherwise(F.col("ts"))
            .cast("timestamp_ntz"),
        }
    )


def specs():
    return {
        "total": ("total", F.col("v")),
        "before": ("total_before", F.lit(1)),
        "last": ("last", F.col("v")),
        "last_before": ("last_before", F.col("v")),
        "previous": ("previous", F.col("v")),
    }


@pytest.mark.parametrize("rows", [1_000_000, 50, 4])
def test_running_equals_plain_windows(skewed, rows):
    df = skewed.select("device", "ts", "event_id", F.when(F.col("quality"), F.col("out")).alias("v"))
    w = W.partitionBy("device").orderBy("ts", "event_id")
    upto, earlier = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(W.unboundedPreceding, -1)
    plain = df.withColumns(
        {
            "total": F.sum("v").over(upto),
            "before": F.coalesce(F.sum(F.lit(1)).over(earlier), F.lit(0)),
            "last": F.last("v", True).over(upto),
            "last_before": F.last("v", True).over(earlier),
            "previous": F.lag("v").over(w),
        }
    )
    same(running(df, ["device"], ["ts", "event_id"], specs(), rows), plain)


def test_running_cuts_a_hot_key_into_slices(skewed):
    cut = slices(skewed, ["device"], T.ORDER, rows=60)
    sizes = {(r.device, r[SLICE]): r["count"] for r in cut.groupBy("device", SLICE).count().collect()}
    hot = [n for (device, _), n in sizes.items() if device == 1]
    assert len(hot) > 4 and max(hot) == 60  # rows of one instant are cut by their ids
    small = {r.device for r in skewed.groupBy("device").count().filter("count <= 60").collect()}
    assert small and all(number == 0 for device, number in sizes if device in small)


@pytest.mark.parametrize("rows, most", [(60, 60), (200, 400)])
@pytest.mark.parametrize("same_time", [False, True])
def test_a_burst_is_cut_by_counts(spark, rows, most, same_time):
    """2,000 rows of which 1,990 lie within two seconds, or at one instant; by samples where a slice has many rows."""
    seconds = F.lit(0.0) if same_time else F.when(F.col("id") < 1990, F.col("id") / 1000).otherwise(F.col("id") * 1000)
    burst = spark.range(2000).select(
        F.lit(1).alias("device"), F.timestamp_seconds(seconds).alias("ts"), F.col("id").alias("event_id")
    )
    sizes = slices(burst, ["device"], T.ORDER, rows).groupBy(SLICE).count()
    counted = sizes.agg(F.max("count").alias("most"), F.count("*").alias("n")).first()
    assert counted.most <= most and counted.n >= 2000 // most
    total = running(burst, ["device"], T.ORDER, {"n": ("total", F.lit(1))}, rows)
    assert total.filter(F.col("n") != F.col("event_id") + 1).count() == 0


def test_exact_totals_do_not_depend_on_slices(skewed):
    """Bit for bit, with values that a plain sum rounds, and with infinities."""
    v = F.col("sp") / 7 * F.pow(F.lit(10.0), F.col("event_id") % 15 - 7) * F.when(F.col("event_id") % 2 == 0, -1).otherwise(1)
    df = skewed.select("device", "ts", "event_id", v.alias("v"))

    def totals(df, rows):
        out = running(df, ["device"], T.ORDER, {"t": ("exact_total", F.col("v"))}, rows)
        return {r.event_id: r.t for r in out.select("event_id", "t").collect()}

    whole = totals(df, 1_000_000)
    assert totals(df, 10) == totals(df, 1000) == whole
    series = {}
    for r in sorted(df.collect(), key=lambda r: (r.ts is not None, r.ts or T0, r.event_id)):
        series.setdefault(r.device, []).append(r)
    for rows in series.values():
        upto = [r.v for r in rows]
        for k in (0, len(rows) // 2, len(rows) - 1):
            assert whole[rows[k].event_id] == pytest.approx(math.fsum(upto[: k + 1]), rel=4e-16, abs=1e-25)
    odd = df.withColumn("v", F.when(F.col("event_id") % 40 == 5, F.lit(float("inf"))).when(F.col("event_id") % 50 != 1, F.col("v")))
    plain = running(odd, ["device"], T.ORDER, {"t": ("total", F.col("v"))})
    expected = {r.event_id: r.t for r in plain.collect()}
    got = totals(odd, 15)
    assert all(got[i] == (pytest.approx(t, rel=1e-9) if t is not None else None) for i, t in expected.items())


def test_error_integral_is_the_same_bits_for_any_slices(skewed):
    df = skewed.select("device", "ts", "event_id", ((F.col("sp") - F.col("out")) / 3).alias("err"))

    def integral(rows):
        return {r.event_id: r.integral for r in T.error_integral(df, 20, rows=rows).collect()}

    assert integral(10) == integral(1000) == integral(1_000_000)


@pytest.mark.parametrize(
    "op",
    [
        lambda d, n: T.adaptive_limit(d, 12 * HOUR, rows=n).select("event_id", "stuck_since", "clamped", "adaptive"),
        lambda d, n: T.missed(d.select("device", "ts", "event_id"), 2 * HOUR, rows=n),
        lambda d, n: T.error_integral(d.select("device", "ts", "event_id", (F.col("sp") - F.col("out")).alias("err")), 20, rows=n),
        lambda d, n: T.source_changes(d.select("device", "ts", "event_id", "source"), rows=n),
        lambda d, n: T.hold_last(d.select("device", "ts", "event_id", "quality", "out"), rows=n),
        lambda d, n: T.response_ok(d.select("device", "ts", "event_id", "sp", "out"), 48 * HOUR, 70, 80, rows=n),
        lambda d, n: T.align(
            d.filter("source = 'purchase'").select("device", "ts", F.col("sp").alias("command")),
            d.filter("source = 'view'").select("device", "ts", "event_id", F.col("out").alias("feedback")),
            24 * HOUR,
            rows=n,
        ),
        lambda d, n: ramp_limit(d.filter("ts IS NOT NULL").select("device", "ts", "event_id", "sp"), 0.0005, rows=n),
        lambda d, n: setpoint_chain(d.filter("ts IS NOT NULL").withColumn("hz", WT.hz()), WT._CHAIN, rows=n).select(
            "event_id", "final", "cmd", "limit", "clamped"
        ),
    ],
    ids=["adaptive", "missed", "integral", "sources", "hold", "response", "align", "ramp", "chain"],
)
def test_slices_do_not_change_results(skewed, op):
    same(op(skewed, 1_000_000), op(skewed, 15), digits=4)


def test_recording_is_the_same_in_slices(tables):
    samples = recording.resampled(WT.recorded(tables), WT._PAIR, "1 hour")
    args = (48 * HOUR, 48 * HOUR, 70, 80)
    same(recording.compliance(samples, *args), recording.compliance(samples, *args, rows=9))


@pytest.mark.parametrize("rate", [1e-6, 0.0005, 0.1])
@pytest.mark.parametrize("rows", [10, 60])
def test_ramp_in_slices_equals_one_recursion(skewed, rate, rows):
    """From a ramp that never forgets its start within a slice to one that always does."""
    series = skewed.filter("ts IS NOT NULL").select("device", "ts", "event_id", "sp").orderBy("device", "ts", "event_id")
    expected, state = {}, {}
    for r in series.collect():
        cmd, before = state.get(r.device, (0.0, r.ts))
        cmd = step(cmd, r.sp, rate * (r.ts - before).total_seconds())
        state[r.device] = cmd, r.ts
        expected[r.event_id] = cmd
    got = {r.event_id: r.cmd for r in ramp_limit(series, rate, rows=rows).collect()}
    assert got == pytest.approx(expected, abs=1e-9)


def test_a_dense_slow_ramp_runs_in_slices(spark):
    """No slice forgets its start: the target crosses the command all the time, in steps far below the range."""
    df = spark.range(4000).select(
        F.lit(1).alias("device"),
        F.timestamp_micros(F.col("id") * 1000).alias("ts"),
        F.col("id").alias("event_id"),
        (50 + 50 * F.sin(F.col("id") * 1.7) * F.sin(F.col("id") * 0.013)).alias("sp"),
    )
    cmd, expected = 0.0, []
    for k, r in enumerate(df.orderBy("event_id").collect()):
        cmd = step(cmd, r.sp, 2.0 * 0.001 if k else 0.0)
        expected.append(cmd)
    made = ramp_limit(df, 2.0, rows=200)
    assert [r.cmd for r in made.orderBy("event_id").collect()] == pytest.approx(expected, abs=1e-9)
    assert slices(df, ["device"], T.ORDER, 200).select(SLICE).distinct().count() >= 10


def test_transfer_maps():
    rng = random.Random(3)
    for high in (10.0, 100.0) * 20:
        map_, low, top = Rising(0.0, high), 0.0, high
        map_.BLOCK = 4
        starts = [high * k / 50 for k in range(51)]
        ends = list(starts)
        for _ in range(rng.choice([5, 50, 300])):
            want, limit = rng.uniform(0, high), rng.choice([0.0, rng.uniform(0, 0.05), rng.uniform(0, 1)])
            if limit and low != top and want + limit > low and want - limit < top:
                map_.take(want - limit - low, want + limit - low)
            low, top = step(low, want, limit), step(top, want, limit)
            ends = [step(e, want, limit) for e in ends]
        got = [low + sum(min(max(x - s, 0), n) for s, n in map_.stretches()) for x in starts]
        assert got == pytest.approx(ends, abs=1e-9)


def test_ramp_never_exceeds_its_rate(tables):
    rate = 0.0003
    out = ramp_limit(tables.telemetry.select("device", "ts", "event_id", "sp"), rate)
    w = W.partitionBy("device").orderBy("ts", "event_id")
    moved = F.abs(F.col("cmd") - F.coalesce(F.lag("cmd").over(w), F.lit(0.0)))
    room = rate * F.coalesce(T.seconds_between(F.lag("ts").over(w), F.col("ts")), F.lit(0.0))
    assert out.withColumn("bad", moved > room + 1e-9).filter("bad").count() == 0
    off = ramp_limit(tables.telemetry.select("device", "ts", "event_id", "sp"), 0)
    assert off.filter("cmd <> sp").count() == 0


def rows_of(spark, *rows):
    names = ["device", "ts", "event_id", "out", "responsive", "fault", "offline", "included"]
    return spark.createDataFrame(
        [(1, at(s), i, 10.0, *flags) for i, (s, *flags) in enumerate(rows)],
        ", ".join(f"{n} {t}" for n, t in zip(names, ["INT", "TIMESTAMP_NTZ", "BIGINT", "DOUBLE", *["BOOLEAN"] * 4], strict=True)),
    )


def test_stuck_limit_edges(spark):
    ok, stuck = (True, False, False, True), (False, False, False, True)
    offline, faulted, out = (False, False, True, True), (True, True, False, True), (True, False, False, False)
    df = rows_of(
        spark, (0, *ok), (10, *stuck), (20, *offline), (22, *faulted), (24, *out), (24.9, *stuck), (25, *stuck), (30, *ok), (40, *stuck), (60, *stuck)
    )
    rows = T.adaptive_limit(df, delay=15).orderBy("ts").collect()
    assert [r.clamped for r in rows] == [False, False, False, False, False, False, True, False, False, True]
    assert rows[6].stuck_since == at(10) and rows[6].adaptive == pytest.approx(11.5)
    assert rows[8].stuck_since == at(40)
    lowered = T.adaptive_limit(df.withColumn("limit", F.lit(5.0)), delay=15).orderBy("ts").collect()
    assert lowered[6].limit == 5.0
    lowered = T.adaptive_limit(df.withColumn("limit", F.lit(50.0)), delay=15).orderBy("ts").collect()
    assert lowered[6].limit == pytest.approx(11.5) and lowered[0].limit == 50.0


def test_dispatch_shares_the_whole_command(spark):
    rows = [
        (1, 60.0, 5.0, False, False, True, 70.0),
        (1, 40.0, 5.0, False, False, True, 70.0),
        (1, 50.0, 8.0, True, False, True, 70.0),
        (2, 50.0, 9.0, False, False, False, 5.0),
        (2, 50.0, 0.0, False, False, True, 5.0),
        (3, 0.0, 1.0, False, False, True, 9.0),
    ]
    named = [(i, at(0), i, *r) for i, r in enumerate(rows)]
    schema = "device INT, ts TIMESTAMP_NTZ, event_id INT, plant INT, rating DOUBLE, out DOUBLE, fault BOOLEAN, offline BOOLEAN, included BOOLEAN, cmd DOUBLE"
    df = spark.createDataFrame(named, schema)
    got = T.dispatch(df, ["plant"]).groupBy("plant").agg(F.sum("limit").alias("s"))
    assert {r.plant: round(r.s, 9) for r in got.collect()} == {1: 62.0, 2: 0.0, 3: 0.0}


def test_deadband_bias_frequency_and_clamp(spark):
    err = spark.createDataFrame([(500.0,), (-499.9,), (4000.0,), (4000.1,)], "err DOUBLE")
    got = [(r.acts, r.band) for r in T.deadband(err, 500).collect()]
    assert got == [(True, "ok"), (False, "ok"), (True, "caution"), (True, "bad")]
    pairs = spark.createDataFrame([(10.0, 8.0), (5.0, 0.0), (3.005, 3.0)], "command DOUBLE, measured DOUBLE")
    assert [(round(r.pct, 3), r.agree) for r in T.bias(pairs).collect()] == [(25.0, False), (0.0, False), (0.167, True)]
    hz = spark.createDataFrame([(59.9,), (60.1,), (60.03,), (60.0,)], "hz DOUBLE")
    got = [(round(r.delta, 4) + 0.0, r.state) for r in T.freq_response(hz, 0.036, 0.05).collect()]
    assert got == [(1.0667, "up"), (-1.0667, "down"), (0.0, "neutral"), (0.0, "neutral")]
    plants = spark.createDataFrame([(56, 5)], "mw INT, clamp_pct INT")
    assert [(round(r.kw, 6), r.deadband_kw) for r in T.recommend_deadband(plants).collect()] == [(280.0, 300)]


def test_timing_budget(spark):
    rows = {r.protocol[:4]: (r.meter_ms, r.pid_ms, r.fits) for r in T.timing_budget(spark.createDataFrame([(1.0,)], "ramp_s DOUBLE")).collect()}
    assert rows == {"C37.": (100.0, 200.0, True), "DNP3": (100.0, 200.0, False), "Inve": (100.0, 200.0, None)}


def test_alarm_priority_and_device_state(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (0, 1, 0.5), (0, 0, 0.97), (0, 0, 0.98)], "clamped INT, stuck INT, irradiance DOUBLE")
    assert [r.alarm for r in T.alarm(df).collect()] == ["clamped", "stuck", "irradiance", "normal"]
    devices = spark.createDataFrame([(50.5, 100.0, False, True), (1.0, 0.0, True, False), (1.0, 8.0, False, False)], "out DOUBLE, rating DOUBLE, clamped BOOLEAN, responsive BOOLEAN")
    assert [(r.pct, r.state) for r in T.device_state(devices).collect()] == [(51, ""), (None, "bad"), (13, "caution")]


def test_response_bands(spark):
    rows = [("a", [50.0, 99.0]), ("b", [107.0, 96.0]), ("c", [115.0, 90.0]), ("d", [121.0, 95.0])]
    df = spark.createDataFrame([(t, at(i), i, y) for t, ys in rows for i, y in enumerate(ys)], "trace STRING, ts TIMESTAMP_NTZ, event_id INT, y DOUBLE")
    got = {r.trace: (r.overshoot_band, r.settled) for r in T.response_metrics(df, ["trace"]).collect()}
    assert got == {"a": ("none", True), "b": ("ok", True), "c": ("", False), "d": ("bad", False)}


def test_downsample_keeps_the_newest(spark):
    df = spark.createDataFrame([(1, at(s), s, float(s)) for s in range(0, 100, 3)], "device INT, ts TIMESTAMP_NTZ, event_id INT, v DOUBLE")
    rows = T.downsample(df, "10 seconds", ["v"], keep=3).orderBy("period_start").collect()
    assert [r.v for r in rows] == [78.0, 87.0, 99.0]


def test_trend_window(spark):
    df = spark.createDataFrame([(1, at(s)) for s in (0, 10, 100)] + [(2, at(5))], "device INT, ts TIMESTAMP_NTZ")
    assert sorted((r.device, r.ts) for r in T.trend(df, 90).collect()) == [(1, at(10)), (1, at(100)), (2, at(5))]


def test_recording_rules():
    assert recording.warnings(["P at POI", "Plant setpoint"], 100) == []
    assert len(recording.warnings(["P at POI"], 250)) == 2


def test_channel_lines(spark):
    picks = spark.createDataFrame([(1, "P at POI")], "ord INT, signal STRING")
    line = T.with_channel(picks, dims.channel_dim(spark)).first().line
    assert line == "channel 01   : " + "POI.PRG.main.P_MW".ljust(32) + " [MW]   P at POI"
    with pytest.raises(ValueError):
        recording.picked(picks, ["nothing"])


def test_downsample_keeps_all_unless_told(spark):
    df = spark.range(1000).selectExpr(
        "0 AS device", "id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, id) AS ts", "id * 1.0D AS v"
    )
    assert T.downsample(df, "1 hour", ["v"]).count() == 1000
    assert T.downsample(df, "1 hour", ["v"], keep=480).count() == 480


def test_denser_sampling_changes_no_plant_figure(spark):
    """Plant figures add devices, not samples."""
    schema = "plant INT, device INT, ts TIMESTAMP_NTZ, event_id INT, rating DOUBLE, out DOUBLE, fault BOOLEAN, offline BOOLEAN, included BOOLEAN, sp DOUBLE, clamped BOOLEAN"

    def figures(step):
        rows = [(1, d, at(s), d * 1000 + s, 100.0, 40.0 + d, d == 3, False, True, 150.0, d == 2) for d in (1, 2, 3) for s in range(0, 60, step)]
        df = spark.createDataFrame(rows, schema)
        sums = T.available(df, ["plant"]).first()
        kpis = T.plant_kpis(df, ["plant"], 500).first()
        rolling = T.rolling_kpis(df, "1 hour", "1 hour").first()
        shares = T.dispatch(df, ["plant"], cmd="sp").groupBy("device").agg(F.max("limit").alias("limit"))
        total = shares.agg(F.sum("limit")).first()[0]
        return sums.available, sums.constant, kpis.total_out, kpis.clamped, rolling.total_out, round(total, 9)

    assert figures(20) == figures(5) == figures(1) == (200.0, 43.0, 126.0, 1, 126.0, 107.0)
