import random
import struct

import pytest
from pyspark.sql import functions as F

from tracklens import dims
from tracklens.functions.numeric import decode_f32
from tracklens.operators import registers as R
from tracklens.plans.register_map import register_map


def decode(spark, *words):
    df = spark.createDataFrame(list(words), "hi INT, lo INT, o STRING")
    return [r[0] for r in df.select(decode_f32(F.col("hi"), F.col("lo"), F.col("o"))).collect()]


def test_decode_goldens(spark):
    right, swapped = decode(spark, (0x447A, 0, "msb"), (0x447A, 0, "lsb"))
    assert right == 1000.0
    assert swapped == pytest.approx(2.4565e-41, rel=1e-4)


def test_decode_matches_ieee(spark):
    words = [(0, 0), (0x8000, 0), (0xC2F6, 0xE979), (0x0000, 0x0001), (0x007F, 0xFFFF), (0x0080, 0), (0x7F7F, 0xFFFF), (0xBF80, 0)]
    expected = [struct.unpack(">f", struct.pack(">HH", *w))[0] for w in words]
    assert decode(spark, *[(*w, "msb") for w in words]) == expected
    assert decode(spark, *[(lo, hi, "lsb") for hi, lo in words]) == expected
    assert decode(spark, (0x7F80, 0, "msb"), (0x7FC0, 1, "msb"), (0xFF80, 0, "msb")) == [None, None, None]


def points(spark, *kinds, device=1):
    return spark.createDataFrame([(device, i, k) for i, k in enumerate(kinds)], "device INT, ord INT, kind STRING")


def test_layout_of_the_default_points(spark):
    two = points(spark, "32", "16")
    words = [(r.register, r.part) for r in R.register_words(R.register_layout(two)).orderBy("register").collect()]
    assert words == [(0, "high word"), (1, "low word"), (2, "int16")]
    (total,) = R.register_totals(two).collect()
    assert (total.points, total.registers) == (2, 3)


def test_names_wrap_with_a_suffix(spark):
    rows = R.name_points(points(spark, "bits", "bits", "bits", "bits", "32", "bits")).orderBy("ord").collect()
    assert [r.name for r in rows] == ["Alarms", "Trips", "Flags", "Alarms_3", "P_kW", "Trips_4"]


@pytest.mark.parametrize("rows", [3, 10])
def test_slices_give_the_same_map(spark, tables, rows):
    whole = register_map(tables.points).collect()
    cut = register_map(tables.points, rows=rows).collect()
    assert sorted(map(str, whole)) == sorted(map(str, cut))


def test_addresses_are_contiguous(spark, tables):
    words = R.register_words(R.register_layout(tables.points.select("device", "ord", "kind")))
    bad = words.groupBy("device").agg(
        F.count("*").alias("n"), F.count_distinct("register").alias("d"), F.max("register").alias("top")
    )
    assert bad.filter((F.col("n") != F.col("d")) | (F.col("top") != F.col("n") - 1)).count() == 0


def test_rules(spark):
    df = spark.createDataFrame([(1, 3), (3, 3), (0, 3), (4, 3)], "idx INT, len INT")
    assert [r.ok for r in R.in_bounds(df).collect()] == [True, True, False, False]
    cycles = spark.createDataFrame([(60, 100.0), (60, 16.0), (0, 5.0)], "sps INT, cycle_ms DOUBLE")
    got = [(r.frame_ms and round(r.frame_ms, 2), r.need_ms, r.keeps_up) for r in R.cycle_check(cycles).collect()]
    assert got == [(16.67, 16, False), (16.67, 16, True), (None, None, None)]
    modes = spark.createDataFrame([(True,), (False,)], "needs_force BOOLEAN")
    assert [r.send_mode for r in R.send_mode(modes, dims.send_mode_dim(spark)).orderBy("needs_force").collect()] == [
        "Send IEC 61131-3 logic only",
        "Send the full project",
    ]
    kinds = spark.createDataFrame([("cnt", True), ("cnt", False), ("odd", True)], "kind STRING, has_time BOOLEAN")
    got = {(r.kind, r.has_time): (r.object_group, r.variation) for r in R.variation(kinds, dims.variation_dim(spark)).collect()}
    assert got["cnt", True] == ("20 / 21", "with flag; group 21 is the frozen value")
    assert got["cnt", False][1] == "without flag" and got["odd", True] == (None, None)


def test_diagnosis(spark):
    asked = [("none", "closed"), ("none", "open"), ("flowing", "several"), ("flowing", "single"), ("none", "single"), ("none", None)]
    df = spark.createDataFrame([(i, *a) for i, a in enumerate(asked)], "i INT, first STRING, second STRING")
    assert [r.cause for r in R.diagnose(df, dims.diagnosis_dim(spark)).orderBy("i").collect()] == [
        "Firewall.",
        "Server IP or port mismatch.",
        "Client IP port collision.",
        "Reversed or mismatched DNP addresses.",
        None,
        None,
    ]


def test_templates(spark):
    # Four candidates and the features they have.
    rows = [
        (0, "Mesquite Flats", 1, 1, 1, 1),
        (1, "Cholla Ridge", 1, 0, 1, 0),
        (2, "Saguaro West", 0, 1, 1, 1),
        (3, "Ocotillo", 0, 0, 0, 0),
    ]
    cands = spark.createDataFrame(rows, "ord INT, name STRING, inv INT, hyb INT, met INT, sub INT")
    everything = dict.fromkeys(["inv", "hyb", "met", "sub"], True)
    ranked = R.template_match(cands, everything).orderBy(F.desc("score"), "ord").collect()
    assert [(r.name.split()[0], r.pct) for r in ranked] == [("Mesquite", 100), ("Saguaro", 75), ("Cholla", 50), ("Ocotillo", 0)]
    assert R.best_template(cands, everything).first().best == "Mesquite Flats"
    nothing = dict.fromkeys(everything, False)
    assert tuple(R.best_template(cands, nothing).first()) == ("no usable base", 0)
    assert R.best_template(cands, nothing | {"met": True}).first().best == "Mesquite Flats"


def test_burn_down(spark):
    errors = [624, 310, 96, 24, 1, 0]
    df = spark.createDataFrame([("p", i, e) for i, e in enumerate(errors)], "project STRING, pass INT, errors INT")
    rows = R.burn_down(df, ["project"]).orderBy("pass").collect()
    assert [r.fixed for r in rows] == [None, 314, 214, 72, 23, 1]
    assert rows[0].left_pct == 100.0 and rows[-1].left_pct == 0.0


def test_broken_references_and_faults(spark):
    uses = spark.createDataFrame([("A.x",), (" a.X ",), ("gone",), (None,)], "ref STRING")
    defs = spark.createDataFrame([("a.x",), ("b",)], "ref STRING")
    assert [r.ref for r in R.broken_refs(uses, defs).collect()] == ["gone", None]
    bits = spark.createDataFrame([(1, 0), (1, 4), (2, 0)], "device INT, bits INT")
    assert {r.device: r.fault for r in R.any_fault(bits, ["device"]).collect()} == {1: True, 2: False}


def test_template_ranking_by_request_rows(spark):
    cands = spark.createDataFrame(
        [(1, "a", 1, 1), (2, "b", 1, 0), (3, "c", 1, 1), (4, "d", 0, 0)], "ord INT, name STRING, inv INT, hyb INT"
    )
    wants = spark.createDataFrame(
        [("x", "inv"), ("x", "hyb"), ("x", "hyb"), ("y", "none"), (None, "hyb")], "request STRING, feature STRING"
    )
    rows = R.rank_templates(R.held_features(cands, ["inv", "hyb"]), wants.filter("request IS NOT NULL")).collect()
    got = sorted((r.request, r.place, r.ord, r.score, r.pct) for r in rows)
    assert got == [("x", 1, 1, 2, 100), ("x", 1, 3, 2, 100), ("x", 3, 2, 1, 50)]


@pytest.mark.parametrize("k", [1, 3])
def test_best_of_many_templates(spark, k):
    """The same as ranking every match, with fewer candidates looked at where a feature is hot."""
    rng = random.Random(5)
    rows = [(i, f"t{i % 40}", f) for i in range(600) for f in "abcdefgh" if rng.random() < (0.98 if f == "a" else 0.05)]
    held = spark.createDataFrame(rows, "ord INT, name STRING, feature STRING")
    wants = spark.createDataFrame([(r, f) for r in range(12) for f in "abcdefghz" if rng.random() < 0.6] + [(50, "z"), (51, "a")], "request INT, feature STRING")
    ranked = {}
    for r in R.rank_templates(held, wants).collect():
        ranked.setdefault(r.request, []).append((-r.score, r.ord, r.name, r.pct))
    want = {q: [(-s, o, n, p) for s, o, n, p in sorted(v)[:k]] for q, v in ranked.items()}
    got = {}
    for r in R.top_templates(held, wants, k).orderBy("request", "place").collect():
        got.setdefault(r.request, []).append((r.score, r.ord, r.name, r.pct))
    assert got == want and 50 not in got and len(got[51]) == k
    assert R.nominated(held, wants.filter("request < 50"), k).count() < sum(len(v) for q, v in ranked.items() if q < 50) / 2
    assert R.top_templates(held, wants.limit(0), k).count() == 0
