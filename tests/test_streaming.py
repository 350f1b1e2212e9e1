"""Streams in several micro-batches against their batch twins."""

import pytest
from pyspark.sql import functions as F
from test_telemetry import HOUR, same

from tracklens.operators import catalogue as C
from tracklens.operators import interactions as I
from tracklens.operators import telemetry as T
from tracklens.operators.ramp import ramp_limit
from tracklens.session import shared_folder
from tracklens.streaming import changes, runs, stateful, store, windows


def as_stream(spark, df, order, batches=5):
    """The rows as files in ``order``, read one file per micro-batch."""
    path = shared_folder(spark, "feed")
    bounds = df.approxQuantile(order, [i / batches for i in range(1, batches)], 0.0)
    slot = sum((F.col(order) >= b).cast("int") for b in bounds)
    for i in range(batches):
        df.filter(slot == i).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture(scope="module")
def tel(spark, tables):
    return tables.telemetry.persist()


def read(spark, stream):
    return spark.read.schema(stream.schema).parquet(runs.append_to(stream, shared_folder(spark, "sink")))


def ntz(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def test_ramp_equals_batch(spark, tel):
    out = read(spark, stateful.stream_ramp(as_stream(spark, tel, "event_id"), 0.0005))
    same(out.select("device", "event_id", "cmd"), ramp_limit(tel, 0.0005).select("device", "event_id", "cmd"))
    assert out.agg(F.max("late")).first()[0] == 0


def test_adaptive_equals_batch(spark, tel):
    out = read(spark, stateful.stream_adaptive(as_stream(spark, tel, "event_id"), 12 * HOUR))
    twin = T.adaptive_limit(tel, 12 * HOUR)
    cols = ["device", "event_id", "clamped", "adaptive"]
    same(out.select(cols), twin.select(cols))


def test_late_rows_are_dropped_and_counted(spark, tel):
    shuffled = tel.withColumn("arrival", (F.xxhash64("event_id") % 1000).cast("double"))
    out = read(spark, stateful.stream_ramp(as_stream(spark, shuffled, "arrival", batches=3).drop("arrival"), 0.0005))
    dropped = tel.count() - out.count()
    counted = out.groupBy("device").agg(F.max("late").alias("late")).agg(F.sum("late")).first()[0]
    assert 0 < counted <= dropped


def followed(tel, lateness="12 hours"):
    """The rows whose bucket the last watermark has passed."""
    from tracklens.streaming.series import micros_of

    late = micros_of(lateness)
    latest = tel.agg(F.max(T.micros(F.col("ts")))).first()[0]
    end = (latest // 1000 - late // 1000) * 1000 // (late // 16) * (late // 16)
    return tel.filter(F.col("ts").isNotNull() & (T.micros(F.col("ts")) < end))


@pytest.mark.parametrize("chunk", [10_000, 7])
def test_rows_within_the_lateness_are_put_in_order(spark, tel, chunk):
    """Shuffled over micro-batches by up to a day: the same as the batch operators, whatever the chunks rows are read in."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", chunk)
    try:
        moved = tel.withColumn("arrival", (T.micros(F.col("ts")) + F.xxhash64("event_id") % 43_200_000_000).cast("double"))
        stream = as_stream(spark, moved, "arrival", batches=4).drop("arrival")
        out = read(spark, stateful.stream_ramp(stream, 0.0005, lateness="1 day"))
        twin = ramp_limit(tel, 0.0005).join(followed(tel, "1 day").select("event_id"), "event_id", "left_semi")
        same(out.select("device", "event_id", "cmd"), twin.select("device", "event_id", "cmd"))
        assert out.filter("is_late").count() == 0
        out = read(spark, stateful.stream_adaptive(stream, 12 * HOUR, lateness="1 day"))
        cols = ["device", "event_id", "clamped", "adaptive"]
        twin = T.adaptive_limit(tel, 12 * HOUR).join(followed(tel, "1 day").select("event_id"), "event_id", "left_semi")
        same(out.select(cols), twin.select(cols))
        # at once, a batch of many chunks waits in state and is followed bucket by bucket
        out = read(spark, stateful.stream_ramp(as_stream(spark, tel, "event_id", batches=2), 0.0005))
        same(out.select("device", "event_id", "cmd"), ramp_limit(tel, 0.0005).select("device", "event_id", "cmd"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_late_rows_come_out_as_rows(spark, tel):
    held = tel.withColumn("late_one", F.col("event_id") % 25 == 0)
    arrival = F.when(F.col("late_one"), F.lit(float(2**60))).otherwise(T.micros(F.col("ts")).cast("double"))
    stream = as_stream(spark, held.withColumn("arrival", arrival), "arrival", batches=4).drop("arrival", "late_one")
    out = read(spark, stateful.stream_ramp(stream, 0.0005, lateness="12 hours")).persist()
    late = {r.event_id for r in out.filter("is_late").collect()}
    assert late and all(i % 25 == 0 for i in late)
    assert out.filter("is_late AND cmd IS NOT NULL").count() == 0
    counted = out.groupBy("device").agg(F.max("late").alias("late")).agg(F.sum("late")).first()[0]
    assert counted == len(late) and out.count() == out.select("event_id").distinct().count()
    rest = tel.filter(~F.col("event_id").isin(list(late)))
    twin = ramp_limit(rest, 0.0005).join(followed(tel).select("event_id"), "event_id", "left_semi")
    same(out.filter("NOT is_late").select("device", "event_id", "cmd"), twin.select("device", "event_id", "cmd"))


def test_the_state_of_a_silent_device_leaves(spark):
    """Device 1 is silent for long enough while device 2 moves the watermark on; back again, it starts at 0."""
    rows = [(1, i, i) for i in range(3)] + [(2, 10 + i, 100 * i) for i in range(20)] + [(1, 50 + i, 5000 + i) for i in range(3)]
    rows += [(2, 60, 9000)]
    df = spark.createDataFrame(rows, "device LONG, event_id LONG, s LONG").selectExpr(
        "device", "event_id", "100.0D AS sp", "CAST(timestamp_seconds(1704067200 + s) AS TIMESTAMP_NTZ) AS ts", "s"
    )
    stream = as_stream(spark, df, "s", batches=6).drop("s")
    kept = read(spark, stateful.stream_ramp(stream, 1.0, lateness="10 seconds"))
    gone = read(spark, stateful.stream_ramp(stream, 1.0, lateness="10 seconds", idle_s=300))

    def commands(out):
        return [r.cmd for r in out.filter("device = 1 AND event_id >= 50").orderBy("event_id").collect()]

    assert commands(kept) == [100.0, 100.0, 100.0] and commands(gone) == [0.0, 1.0, 2.0]


def test_windows_equal_batch_once_closed(spark, tel):
    latest = tel.agg(F.max("ts")).first()[0]
    closed = F.lit(latest).cast("timestamp_ntz") - F.expr("INTERVAL 12 HOURS")
    out = ntz(read(spark, windows.stream_evaluate(as_stream(spark, tel, "event_id"), "6 hours", "12 hours")), "period_start")
    twin = T.periodic_eval(tel, "6 hours").filter(F.col("period_start") + F.expr("INTERVAL 6 HOURS") <= closed)
    same(out, twin)
    out = ntz(read(spark, windows.stream_trend(as_stream(spark, tel, "event_id"), "24 hours", "6 hours", "12 hours")), "window_start")
    twin = T.rolling_kpis(tel, "24 hours", "6 hours").filter(F.col("window_start") + F.expr("INTERVAL 24 HOURS") <= closed)
    same(out, twin)


def test_first_answers(spark, tables):
    exact = runs.update_to(
        windows.stream_first_answer_exact(as_stream(spark, tables.answers.withColumn("h", F.xxhash64("event_id") % 97), "h").drop("h")),
        shared_folder(spark, "first"),
    )
    same(runs.latest(spark, exact, ["learner", "item"]), I.first_answers(tables.answers))
    kept = read(spark, windows.stream_first_answer(as_stream(spark, tables.answers, "event_id"), "60 days"))
    assert kept.count() == tables.answers.select("learner", "item").distinct().count()
    same(kept.select("learner", "item", "pick"), I.first_answers(tables.answers))


def test_checklist(spark, tables):
    boxes, resets = windows.stream_checklist(as_stream(spark, tables.checklist_events, "event_id"))
    boxes_at = runs.update_to(boxes, shared_folder(spark, "boxes"))
    resets_at = runs.update_to(resets, shared_folder(spark, "resets"))
    now = I.standing(runs.latest(spark, boxes_at, ["learner", "list", "box"]), runs.latest(spark, resets_at, ["learner", "list"]))
    same(now, I.standing(I.box_states(tables.checklist_events), I.list_resets(tables.checklist_events)))


def test_change_feed_and_compaction(spark, tables):
    root = shared_folder(spark, "catalogue")
    changes.write_base(tables.books, root)
    same(changes.current(spark, root), tables.books)
    feed = tables.changes.withColumn("at", F.unix_date(F.col("seq.l_shipdate").cast("date")))
    changes.stream_apply_changes(as_stream(spark, feed, "at", batches=3), root)
    twin = C.apply_changes(tables.books, tables.changes)
    same(changes.current(spark, root), twin)
    version = changes.compact(spark, root, 0)
    same(spark.read.parquet(f"{root}/base/version={version}"), twin)
    same(changes.current(spark, root, version, after_batch=2), twin)


def test_store_with_compactions(spark, tables):
    """Compactions rewrite touched buckets only, older changes lose, and what was folded is not read again."""
    root = shared_folder(spark, "store")
    store.create(tables.books, root, tables.changes.schema["seq"].dataType.simpleString(), buckets=8)
    feed = tables.changes.withColumn("at", F.unix_date(F.col("seq.l_shipdate").cast("date")))
    seen = None
    for k in range(3):  # the newest changes first
        part = feed.filter(F.pmod(F.xxhash64("seq"), F.lit(3)) == 2 - k)
        store.stream_into(as_stream(spark, part, "at", batches=2).drop("at"), root, f"feed{k}")
        seen = part if seen is None else seen.unionByName(part)
        twin = C.apply_changes(tables.books, seen.drop("at"))
        same(store.current(spark, root), twin)
        if k < 2:
            version = store.compact(spark, root)
            same(store.current(spark, root), twin)
            assert store.Snapshot(spark, root).touched == [] and version == k + 1
    same(store.current(spark, root, version=0), twin)  # an older version with all changes after it
    one = tables.books.limit(1)
    changed = one.withColumns({"op": F.lit("upsert"), "seq": feed.agg(F.max("seq")).scalar(), "title": F.lit("new")})
    store.compact(spark, root)
    path = shared_folder(spark, "one")
    changed.write.parquet(path)
    store.stream_into(spark.readStream.schema(changed.schema).parquet(path), root, "one")
    now = store.Snapshot(spark, root)
    assert len(now.touched) == 1
    version = store.compact(spark, root)
    bases = spark.read.parquet(f"{root}/base").filter(F.col("version") == version).select("bucket").distinct().count()
    assert bases == 1 and sorted(store.Snapshot(spark, root).base.values()).count(version) == 1


def test_store_lookups_and_tombstones(spark):
    root = shared_folder(spark, "store")
    rows = spark.range(2000).select(F.concat(F.lit("a"), "id").alias("id"), F.col("id").alias("x"))
    store.create(rows, root, "bigint", buckets=32)

    def feed(name, *changes):
        df = spark.createDataFrame(changes, "op string, seq bigint, id string, x bigint")
        path = shared_folder(spark, "feed")
        df.coalesce(1).write.parquet(path)
        store.stream_into(spark.readStream.schema(df.schema).parquet(path), root, name)

    def found(*ids):
        made = store.lookup(spark, root, spark.createDataFrame([(i,) for i in ids], "id string"))
        return sorted((r.id, r.x) for r in made.collect())

    absent = spark.createDataFrame([("none7",)], "id string")
    now = store.Snapshot(spark, root)
    assert len(store.possible_buckets(now, spark.createDataFrame([("a5",)], "id string"))) == 1
    assert len(store.possible_buckets(now, absent)) == 0
    feed("f", ("remove", 10, "a1", None), ("upsert", 11, "a2", 7), ("upsert", 12, "new", 1))
    assert found("a1", "a2", "a3", "new", "nowhere") == [("a2", 7), ("a3", 3), ("new", 1)]
    store.compact(spark, root)
    feed("g", ("upsert", 5, "a1", 99))  # older than the removal that is folded
    assert found("a1", "a2") == [("a2", 7)]
    version = store.compact(spark, root, horizon=F.lit(11).cast("bigint"))
    base = spark.read.parquet(f"{root}/base").filter((F.col("version") == version) & (F.col("id") == "a1"))
    assert base.count() == 0  # the tombstone has left
    feed("h", ("upsert", 6, "a1", 98), ("upsert", 30, "a4", 40))
    assert found("a1", "a4") == [("a4", 40)]
    assert [r.id for r in spark.read.parquet(f"{root}/late").collect()] == ["a1"]


def test_heartbeat(spark, tel):
    out = read(spark, stateful.stream_heartbeat(as_stream(spark, tel, "event_id"), 12 * HOUR, "1 hour")).persist()
    twin = T.missed(tel.select("device", "ts", "event_id"), 12 * HOUR).filter("missed > 0")
    latest = tel.agg(F.max("ts")).first()[0]
    silent = tel.groupBy("device").agg(F.max("ts").alias("since")).filter(
        F.col("since") + F.expr("INTERVAL 24 HOURS") < F.lit(latest).cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR")
    )
    still = out.filter("seen IS NULL")
    assert silent.join(still.select("device"), "device", "left_anti").count() == 0
    gaps = out.filter("seen IS NOT NULL").select("device", F.col("seen").cast("timestamp_ntz").alias("ts"), "missed")
    alarmed = still.select("device", F.col("since").cast("timestamp_ntz").alias("since"))
    assert gaps.join(twin.select("device", "ts", "missed"), ["device", "ts", "missed"], "left_anti").count() == 0
    # A gap whose device had already been reported silent is not reported a second time.
    unreported = twin.join(gaps, ["device", "ts"], "left_anti")
    assert unreported.join(alarmed, "device", "left_anti").count() == 0


def test_older_changes_lose_after_compaction(spark, tables):
    root = shared_folder(spark, "memory")
    row = tables.books.limit(1).withColumns({"id": F.lit("n1"), "title": F.lit("new")})
    gone = row.withColumn("id", F.lit("n2"))
    changes.write_base(tables.books, root)

    def batch(number, *rows):
        df = None
        for source, op, seq, title in rows:
            made = source.withColumns({"op": F.lit(op), "seq": F.lit(seq).cast("long"), "title": F.lit(title)})
            df = made if df is None else df.unionByName(made)
        df.select("id", "op", "seq", *[c for c in changes.BOOK_COLUMNS if c != "id"]).write.parquet(
            f"{root}/changes/batch={number}"
        )

    batch(0, (row, "upsert", 10, "new"), (gone, "remove", 10, "x"))
    version = changes.compact(spark, root, 0)
    batch(1, (row, "upsert", 5, "stale"), (gone, "upsert", 5, "back"))
    for at in (version, changes.compact(spark, root, version)):
        found = {r.id: r.title for r in changes.current(spark, root, at).filter("id IN ('n1', 'n2')").collect()}
        assert found == {"n1": "new"}


def test_missing_targets_and_times_hold_the_command(spark):
    """As in batch, over several micro-batches: a missing target or time moves nothing and poisons nothing."""
    rows = [(1, i, None if i == 3 else 100.0, None if i == 0 else i) for i in range(12)]
    df = spark.createDataFrame(rows, "device INT, event_id INT, sp DOUBLE, s INT").selectExpr(
        "CAST(device AS BIGINT) AS device", "CAST(event_id AS BIGINT) AS event_id", "sp",
        "CAST(timestamp_seconds(1704067200 + s) AS TIMESTAMP_NTZ) AS ts",
    )
    out = read(spark, stateful.stream_ramp(as_stream(spark, df, "event_id", batches=3), 10.0))
    cols = ["device", "event_id", "cmd"]
    same(out.select(cols), ramp_limit(df, 10.0).select(cols))
    assert out.filter("cmd IS NULL OR isnan(cmd)").count() == 0
