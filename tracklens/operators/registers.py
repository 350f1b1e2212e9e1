"""Register maps, device diagnosis and conversion checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklens import dims
from tracklens.functions.text import half_up, stripped
from tracklens.operators.ordered import SLICE_ROWS, running
from tracklens.session import written


def width_of(kind: Column) -> Column:
    return F.when(kind == "32", 2).otherwise(1)


def _used(kind: str) -> str:
    return f"_used_{kind}"


def _name(kind: Column) -> Column:
    """The name of a point from how many of its kind came before it on the device."""
    out = F.lit(None).cast("string")
    for k, names in dims.POINT_NAMES.items():
        used = F.col(_used(k))
        base = F.element_at(F.array(*[F.lit(n) for n in names]), (used % len(names) + 1).cast("int"))
        suffix = F.when(used >= len(names), F.concat(F.lit("_"), used.cast("string"))).otherwise("")
        out = F.when(kind == k, F.concat(base, suffix)).otherwise(out)
    return out


def _running_points(df: DataFrame, layout: bool, names: bool, rows: int) -> DataFrame:
    kind = F.col("kind")
    specs: dict[str, tuple[str, Column]] = {}
    if layout:
        specs["address"] = ("total_before", width_of(kind))
    if names:
        for k in dims.POINT_NAMES:
            specs[_used(k)] = ("total_before", F.when(kind == k, 1).otherwise(0))
    out = running(df, ["device"], ["ord"], specs, rows)
    if names:
        out = out.withColumn("name", _name(kind)).drop(*[_used(k) for k in dims.POINT_NAMES])
    return out


def register_layout(df: DataFrame, rows: int = SLICE_ROWS) -> DataFrame:
    """The start address of each point: the widths before it on its device."""
    return _running_points(df, layout=True, names=False, rows=rows)


def name_points(df: DataFrame, rows: int = SLICE_ROWS) -> DataFrame:
    """Names in order of use per kind; a repeat carries the number used before it."""
    return _running_points(df, layout=False, names=True, rows=rows)


def layout_and_names(df: DataFrame, rows: int = SLICE_ROWS) -> DataFrame:
    """Both at once: one partitioning, one pass."""
    return _running_points(df, layout=True, names=True, rows=rows)


def register_totals(df: DataFrame) -> DataFrame:
    return df.groupBy("device").agg(
        F.count("*").alias("points"), F.sum(width_of(F.col("kind"))).cast("long").alias("registers")
    )


def register_words(layout: DataFrame) -> DataFrame:
    """One row per register: a 32-bit point takes its high word first, then its low word."""

    def word(offset: int, part: str) -> Column:
        return F.struct((F.col("address") + offset).alias("register"), F.lit(part).alias("part"))

    parts = (
        F.when(F.col("kind") == "32", F.array(word(0, "high word"), word(1, "low word")))
        .when(F.col("kind") == "bits", F.array(word(0, "bits 0–15")))
        .otherwise(F.array(word(0, "int16")))
    )
    return layout.withColumn("_word", F.explode(parts)).select(*layout.columns, "_word.*")


def in_bounds(df: DataFrame) -> DataFrame:
    """A 1-based index resolves when it is within the declared length, both ends included."""
    return df.withColumn("ok", F.col("idx").between(F.lit(1), F.col("len")))


def cycle_check(df: DataFrame) -> DataFrame:
    """Whether a cycle (ms) keeps up with a frame rate (samples per second), and the whole-ms cycle needed.

    No rate gives no frame (NULL).
    """
    frame = F.lit(1000.0) / F.nullif(F.col("sps"), F.lit(0))
    return df.withColumns(
        {"frame_ms": frame, "need_ms": F.floor(frame), "keeps_up": F.col("cycle_ms") <= frame}
    )


def eval_rate(df: DataFrame) -> DataFrame:
    """Evaluations per second of a period (ms), and whether the meter is at least as fast; a period of 0 has no rate."""
    per_second = F.lit(1000.0) / F.nullif(F.col("period_ms"), F.lit(0))
    return df.withColumns(
        {"per_second": per_second, "meter_ok": F.col("meter_ms") <= F.col("period_ms")}
    )


def variation(df: DataFrame, dim: DataFrame) -> DataFrame:
    """The object group and variation for a kind of point, with or without time."""
    chosen = F.when(F.col("has_time"), F.col("with_time")).otherwise(F.col("without_time"))
    return df.join(dim, "kind", "left").withColumn("variation", chosen).drop("with_time", "without_time")


def send_mode(df: DataFrame, dim: DataFrame) -> DataFrame:
    return df.join(dim, "needs_force", "left")


def diagnose(df: DataFrame, tree: DataFrame) -> DataFrame:
    """The cause two observations lead to; an answer the tree does not offer leads nowhere (NULL)."""
    first = tree.filter(F.col("node") == "start").select(F.col("answer").alias("first"), F.col("next").alias("_node"))
    second = tree.select(F.col("node").alias("_node"), F.col("answer").alias("second"), "cause")
    return df.join(first, "first", "left").join(second, ["_node", "second"], "left").drop("_node")


def broken_refs(uses: DataFrame, defs: DataFrame, ref: str = "ref") -> DataFrame:
    """Uses whose name has no definition; names compare trimmed and without case."""
    key = F.lower(stripped(F.col(ref)))
    known = defs.select(key.alias("_name")).distinct()
    return uses.join(known, key == F.col("_name"), "left_anti")


def normalise_fault(df: DataFrame) -> DataFrame:
    """Many vendor bits to one flag, per row."""
    return df.withColumn("fault", F.col("bits") != 0)


def any_fault(df: DataFrame, keys: list[str]) -> DataFrame:
    """One flag per group: any bit on any row."""
    return df.groupBy(*keys).agg(F.bool_or(F.col("bits") != 0).alias("fault"), F.count_if(F.col("bits") != 0).alias("rows"))


def burn_down(df: DataFrame, keys: list[str]) -> DataFrame:
    """Errors left after each pass: the change from the pass before, and the share of the first count remaining.

    ``df`` holds one row per key and pass, so a key has only as many rows as there were passes.
    """
    w = W.partitionBy(*keys).orderBy("pass")
    start = F.first("errors").over(w.rowsBetween(W.unboundedPreceding, 0))
    return df.withColumns(
        {
            "fixed": F.lag("errors").over(w) - F.col("errors"),
            "left_pct": F.col("errors") / F.nullif(start, F.lit(0)) * 100,
        }
    )


def template_score(wants: dict[str, bool]) -> tuple[Column, Column]:
    """Score and percent of a candidate: wanted features it has, over those wanted (none wanted counts as one)."""
    total = sum(bool(v) for v in wants.values()) or 1
    score = F.lit(0)
    for feature, wanted in wants.items():
        if wanted:
            score = score + F.when(F.coalesce(F.col(feature), F.lit(0)) != 0, 1).otherwise(0)
    return score.cast("int"), half_up(score / total * 100)


def template_match(cands: DataFrame, wants: dict[str, bool]) -> DataFrame:
    score, pct = template_score(wants)
    return cands.withColumns({"score": score, "pct": pct})


def best_template(cands: DataFrame, wants: dict[str, bool], keys: list[str] | None = None) -> DataFrame:
    """The top candidate (the earliest of equals), or ``no usable base`` when nothing matches."""
    scored = template_match(cands, wants)
    best = F.max(F.struct("score", (-F.col("ord")).alias("_first"), "name", "pct"))
    return (
        scored.groupBy(*(keys or []))
        .agg(best.alias("_best"))
        .select(
            *(keys or []),
            F.when(F.col("_best.score") > 0, F.col("_best.name")).otherwise("no usable base").alias("best"),
            F.col("_best.pct").alias("pct"),
        )
    )


def held_features(cands: DataFrame, features: list[str]) -> DataFrame:
    """``ord, name, feature``: one row per feature that a candidate has."""
    long = cands.unpivot(["ord", "name"], features, "feature", "_has")
    return long.filter(F.col("_has") != 0).drop("_has")


def rank_templates(held: DataFrame, wants: DataFrame) -> DataFrame:
    """Candidates per request: score, percent of the wanted features, and place (equal scores share one; they stand
    in the order of ``ord``).

    ``held`` has one row per candidate and feature, ``wants`` one per ``request`` and feature. They meet on the feature,
    so a candidate without a wanted feature has no row: a request without rows has no usable base. Places come from
    the number of candidates per request and score, so no task sees all candidates of a request.
    """
    wants = wants.select("request", "feature").distinct()
    totals = wants.groupBy("request").agg(F.count("*").alias("_total"))
    scored = (
        wants.join(held.select("ord", "name", "feature").distinct(), "feature")
        .groupBy("request", "ord", "name")
        .agg(F.count("*").cast("int").alias("score"))
    )
    better = W.partitionBy("request").orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)
    places = (
        scored.groupBy("request", "score")
        .agg(F.count("*").alias("_n"))
        .select("request", "score", (F.coalesce(F.sum("_n").over(better), F.lit(0)) + 1).alias("place"))
    )
    return (
        scored.join(places, ["request", "score"])
        .join(totals, "request")
        .select("request", "ord", "name", "score", half_up(F.col("score") / F.col("_total") * 100).alias("pct"), "place")
    )


def nominated(held: DataFrame, wants: DataFrame, k: int) -> DataFrame:
    """``request, ord, name, score, total``: candidates among which are the best ``k`` of every request, each with its whole score.

    A request looks up its features from the rarest on. A candidate not met by then has none of the features looked up, so its score
    is at most the number of the others; once ``k`` candidates score more, the request is done, and a feature that most
    candidates have is looked up only by requests that nothing else decides. There are as many rounds as the longest
    request has features; each writes what it met to the shared folder.
    """
    held = held.select("ord", "name", "feature").distinct()
    profiles = written(held.groupBy("ord", "name").agg(F.collect_set("feature").alias("_features")), "profiles")
    sizes = held.groupBy("feature").agg(F.count("*").alias("_size"))
    turn = F.row_number().over(W.partitionBy("request").orderBy(F.coalesce("_size", F.lit(0)), "feature"))
    turns = wants.select("request", "feature").distinct().join(sizes, "feature", "left").withColumn("_turn", turn)
    turns = written(turns.drop("_size"), "turns")
    requests = turns.groupBy("request").agg(F.collect_set("feature").alias("_wanted"), F.count("*").cast("int").alias("total"))
    requests = written(requests, "requests")
    open_, seen = requests, None
    for number in range(1, (requests.agg(F.max("total")).first()[0] or 0) + 1):
        now = turns.filter(F.col("_turn") == number).join(open_.select("request", "_wanted", "total"), "request")
        met = now.join(held, "feature").select("request", "ord", "name", "_wanted", "total").join(profiles, ["ord", "name"])
        score = F.size(F.array_intersect("_features", "_wanted")).alias("score")
        met = met.select("request", "ord", "name", score, "total")
        seen = written(met if seen is None else seen.unionByName(met).distinct(), "nominated")
        worst = top_by_score(seen, k).groupBy("request").agg(F.count("*").alias("_n"), F.min("score").alias("_kth"))
        beaten = (F.col("_n") >= k) & (F.col("_kth") > F.col("total") - number)
        left = requests.join(worst, "request", "left").filter(
            (F.col("total") > number) & ~F.coalesce(beaten, F.lit(False))
        )
        open_ = written(left.select("request", "_wanted", "total"), "open-requests")
        if open_.isEmpty():
            break
    if seen is None:
        return requests.select("request", F.lit(0).alias("ord"), F.lit("").alias("name"), F.lit(0).alias("score"), "total").limit(0)
    return seen


def top_by_score(scored: DataFrame, k: int) -> DataFrame:
    """The first ``k`` per request by falling score, equals in the order of ``ord`` and name; cut before the shuffle."""
    first = W.partitionBy("request").orderBy(F.desc("score"), "ord", "name")
    return scored.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= k)


def top_templates(held: DataFrame, wants: DataFrame, k: int) -> DataFrame:
    """The best ``k`` candidates per request: score, percent of the wanted features and place, without scoring every match."""
    best = top_by_score(nominated(held, wants, k), k)
    return best.select("request", "ord", "name", "score", half_up(F.col("score") / F.col("total") * 100).alias("pct"), "place")
