from pyspark.sql import functions as F
from test_telemetry import same

from tracklens.functions import text
from tracklens.operators import digests as D
from tracklens.operators import plan as P
from tracklens.operators import publish as G
from tracklens.sources.markdown import read_track_tables

# Declared entries and listed entries per role (work, read, reference) of 15 tracks.
TRACKS = [
    (21, 5, 1, 11), (5, 2, 0, 3), (3, 1, 0, 2), (11, 3, 4, 2), (13, 0, 2, 7),
    (10, 2, 3, 5), (12, 3, 3, 5), (10, 0, 2, 6), (7, 0, 2, 4), (8, 0, 7, 1),
    (14, 0, 13, 0), (6, 0, 6, 0), (10, 0, 7, 0), (8, 2, 0, 0), (4, 0, 2, 0),
]


def track_frames(spark):
    nested = [
        (i, n, [(r, f"{r}{k}") for r, count in zip("wfr", roles, strict=True) for k in range(count)])
        for i, (n, *roles) in enumerate(TRACKS)
    ]
    return spark.createDataFrame(nested, "track INT, declared INT, entries ARRAY<STRUCT<role STRING, title STRING>>")


def test_track_totals(spark):
    tracks = track_frames(spark)
    listed = P.flatten_tracks(tracks)
    summary = {(r.track, r.role): r.entries for r in P.track_summary(listed).collect()}
    assert summary[None, None] == 116
    assert tuple(listed.filter(F.col("role") == r).count() for r in "wfr") == (18, 52, 46)
    assert tracks.agg(F.sum("declared")).first()[0] == 142
    actual = listed.groupBy("track").agg(F.count("*").alias("actual"))
    checked = P.reconcile(tracks, actual, ["track"]).collect()
    assert sorted(r.track for r in checked if r.agrees) == [1, 2, 5, 9, 11]
    assert P.unit_rows(tracks.select("track", "declared")).count() == 142


def test_unit_rows_of_nothing(spark):
    assert P.unit_rows(spark.createDataFrame([(1, 0), (2, -3), (3, 2)], "track INT, declared INT")).count() == 2


def test_markdown_tables(spark, tmp_path):
    (tmp_path / "plan.md").write_text(
        "# Plan\n\nIntro | with a bar\n\n## First\n\n| Role | Book |\n|---|---|\n| Work through | One, two |\n"
        "| Read | Three (3) |\n\n## Second track\n\n| Role | Book |\n|:--|--:|\n| Reference | Four |\n| Skim | Five |\n"
    )
    found = {r.title: (r.track, r.role) for r in read_track_tables(spark, str(tmp_path)).collect()}
    assert found == {
        "One, two": ("First", "w"),
        "Three (3)": ("First", "f"),
        "Four": ("Second track", "r"),
        "Five": ("Second track", None),
    }


def test_a_changed_row_shuffles_one_range(spark):
    a = spark.range(600_000).select("id", (F.col("id") * 7 % 1000).alias("x"))
    b = a.withColumn("x", F.when(F.col("id") == 123_456, -1).otherwise(F.col("x")))
    bits = D.bits_for(600_000)
    trees = [D.digest_tree(df, ["id"], bits) for df in (a, b)]
    leaves = D.differing_leaves(*trees, bits)
    assert bits == 10 and leaves.count() == 1
    assert D.in_leaves(a, leaves, ["id"], bits).count() < 1000
    found = D.tree_diff(a, b, ["id"]).collect()
    assert sorted((r.side, r.id, r.x, r.copies) for r in found) == [("left", 123_456, 864_192 % 1000, 1), ("right", 123_456, -1, 1)]
    assert D.tree_diff(a, a, ["id"]).count() == 0


def test_tree_diff_equals_the_plain_difference(spark):
    rows = [(i % 50 if i % 13 else None, i % 7 if i % 11 else None) for i in range(400)]
    a, b = (spark.createDataFrame(r, "k INT, v INT") for r in (rows, rows[5:] + rows[:2] + [(99, 1)] * 3))
    for bits in (0, 3, 6):
        same(D.tree_diff(a, b, ["k"], bits), P.dataset_diff(a, b))
    nothing = a.limit(0)
    same(D.tree_diff(nothing, b, ["k"], 4), P.dataset_diff(nothing, b))
    assert D.tree_diff(nothing, nothing, ["k"]).count() == 0


def test_dataset_diff_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (1,), (2,)], "x INT")
    b = spark.createDataFrame([(1,), (3,), (None,)], "x INT")
    found = {(r.side, r.x): r.copies for r in P.dataset_diff(a, b).collect()}
    assert found == {("left", 1): 2, ("left", 2): 1, ("right", 3): 1, ("right", None): 1}
    assert P.dataset_diff(a, a).count() == 0


def test_latest_edition(spark):
    rows = spark.createDataFrame(
        [(1, "Algorithms 3e"), (2, "algorithms 4e"), (3, "Algebra"), (4, "Algebra 2e"), (5, "Calculus")], "id INT, title STRING"
    )
    assert {r.work: (r.edition, r.id, r.copies) for r in P.latest_edition(rows).collect()} == {
        "algorithms": (4, 2, 2),
        "algebra": (2, 4, 2),
        "calculus": (1, 5, 1),
    }


def test_roadmap_round_trip(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, None, "d"), (3, "e", "f")], "block INT, deep STRING, build STRING")
    long = P.roadmap_long(rows, ["deep", "build"], ["block"])
    assert long.count() == 4
    assert sorted(map(tuple, P.roadmap_wide(long, ["deep", "build"], ["block"]).collect())) == sorted(map(tuple, rows.collect()))


def test_page_helpers(spark):
    one = spark.createDataFrame([("aaaa <p><p>", 'say "hi"', 123, 4)], "body STRING, quote STRING, big INT, small INT")
    r = one.select(
        text.count_marker(F.col("body"), "aa").alias("n"),
        text.escape_attr(F.col("quote")).alias("q"),
        text.pad2(F.col("big")).alias("b"),
        text.pad2(F.col("small")).alias("s"),
    ).first()
    assert tuple(r) == (2, "say &quot;hi&quot;", "123", "04")
    labels = spark.createDataFrame([(" top ", "T", 1), ("", " Title ", 2), ("", "", 3), (None, None, 4)], "s STRING, t STRING, n INT")
    assert [x[0] for x in labels.select(G.card_label(F.col("s"), F.col("t"), F.col("n"))).collect()] == ["top", "Title", "Slide 3", "Slide 4"]


def test_links_per_variant(spark):
    pairs = spark.createDataFrame([(1, "a", "a"), (1, "a", "b")], "page INT, own STRING, target STRING")
    urls = spark.createDataFrame([("a", "a.html", "https://x/a"), ("b", "b.html", "https://x/b")], "target STRING, file STRING, absolute STRING")
    found = {(r.target, r.variant): (r.href, r.new_tab) for r in G.resolve_links(pairs, urls).collect()}
    assert found == {
        ("a", "standalone"): (None, False),
        ("a", "fragment"): (None, False),
        ("b", "standalone"): ("b.html", False),
        ("b", "fragment"): ("https://x/b", True),
    }
