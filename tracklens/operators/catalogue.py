"""Faceted search, ordering, tallies and change application over a catalogue of items.

Missing prices and ratings count as 0 in filters, sorts and sums. An unknown format belongs to the
default format's kind, but a filter on one exact format compares the raw value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens import dims
from tracklens.functions import text
from tracklens.functions.text import stripped
from tracklens.session import written

BOOK_COLUMNS = ["id", "title", "author", "format", "retailer", "price", "rating", "status", "note", "added"]


# ---- predicates: None means the filter is off, so nothing reaches the plan ----


def blob() -> Column:
    """What a text query looks at."""
    return F.concat_ws(" ", "title", "author", F.coalesce("note", F.lit("")))


def wanted_text(query: str | None) -> str:
    return (query or "").strip().lower()


def matches_text(query: str | None) -> Column | None:
    """Trimmed, case-blind substring over title, author and note joined by spaces."""
    wanted = wanted_text(query)
    return F.contains(F.lower(blob()), F.lit(wanted)) if wanted else None


def has_status(status: str) -> Column | None:
    return None if status == dims.ANY else F.col("status") == status


def kind_of(format_col: Column) -> Column:
    """The kind of a format; unknown and missing ones take the default format's kind."""
    kinds = {fid: kind for fid, _, kind in dims.FORMATS}
    default = kinds[dims.DEFAULT_FORMAT]
    other = [fid for fid, kind in kinds.items() if kind != default]
    (other_kind,) = set(kinds.values()) - {default}
    return F.when(format_col.isin(other), other_kind).otherwise(default)


def has_format(wanted: str) -> Column | None:
    if wanted == dims.ANY:
        return None
    if wanted in {kind for _, _, kind in dims.FORMATS}:
        return kind_of(F.col("format")) == wanted
    return F.col("format") == wanted


def has_retailer(retailer: str) -> Column | None:
    return None if retailer == dims.ANY else F.col("retailer") == retailer


def within_price(limit: float) -> Column | None:
    """Inclusive ceiling, off from the sentinel upwards. Spelled so that it can reach the scan."""
    if limit >= dims.NO_PRICE_LIMIT:
        return None
    missing_passes = F.col("price").isNull() if limit >= 0 else F.lit(False)
    return missing_passes | (F.col("price") <= limit)


def above_rating(floor: float) -> Column | None:
    """Inclusive floor; a missing rating fails once the filter is on."""
    return None if floor <= dims.NO_RATING_FLOOR else F.col("rating") >= floor


def _keep(df: DataFrame, condition: Column | None) -> DataFrame:
    return df if condition is None else df.filter(condition)


def search(df: DataFrame, query: str) -> DataFrame:
    return _keep(df, matches_text(query))


def by_status(df: DataFrame, status: str) -> DataFrame:
    return _keep(df, has_status(status))


def by_format(df: DataFrame, wanted: str) -> DataFrame:
    return _keep(df, has_format(wanted))


def by_retailer(df: DataFrame, retailer: str) -> DataFrame:
    return _keep(df, has_retailer(retailer))


def max_price(df: DataFrame, limit: float) -> DataFrame:
    return _keep(df, within_price(limit))


def min_rating(df: DataFrame, floor: float) -> DataFrame:
    return _keep(df, above_rating(floor))


def filters(
    *,
    query: str = "",
    status: str = dims.ANY,
    format: str = dims.ANY,
    retailer: str = dims.ANY,
    max_price: float = dims.NO_PRICE_LIMIT,
    min_rating: float = dims.NO_RATING_FLOOR,
) -> Column:
    """All active filters as one predicate (TRUE when none is active)."""
    active = [
        has_status(status),
        has_retailer(retailer),
        has_format(format),
        within_price(max_price),
        above_rating(min_rating),
        matches_text(query),
    ]
    condition = F.lit(True)
    for c in active:
        if c is not None:
            condition = condition & c
    return condition


# ---- ordering ----


def sort_keys(key: str) -> list[Column]:
    """Sort expressions of one ordering; ties follow the insertion position, then the id."""
    leading = {
        "added": [F.desc("added")],
        "title": [F.collate("title", "UNICODE").asc()],
        "author": [F.collate("author", "UNICODE").asc()],
        "price": [F.coalesce("price", F.lit(0)).asc()],
        "rating": [F.coalesce("rating", F.lit(0)).desc()],
    }
    if key not in leading:
        raise ValueError(f"unknown ordering {key!r}")
    return [*leading[key], F.asc("added"), F.asc("id")]


def order_shelf(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(*sort_keys(key))


def top_shelf(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows of an ordering with their rank, as a top-k: no full sort, and only ``n`` rows meet."""
    from pyspark.sql import Window as W

    return order_shelf(df, key).limit(n).withColumn("rank", F.row_number().over(W.orderBy(*sort_keys(key))))


def ranked_shelf(df: DataFrame, key: str) -> DataFrame:
    """Every row with its rank in an ordering.

    The rows are dealt to ranges of the sort keys and sorted there; a row's rank is its place in its range plus the
    sizes of the ranges before, so no window sees more than one row per range. The ranges are written to the shared
    folder, as the places must not change between the two passes.
    """
    from pyspark.sql import Window as W

    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *sort_keys(key)).sortWithinPartitions(*sort_keys(key))
    # the id holds the partition above bit 33 and the place within it below
    placed = written(dealt.withColumn("_place", F.monotonically_increasing_id()), "ranges")
    placed = placed.withColumn("_range", F.shiftright("_place", 33))
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_size"))
    before = F.coalesce(F.sum("_size").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_range", before.alias("_before"))
    rank = F.col("_before") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(F.broadcast(offsets), "_range").withColumn("rank", rank).drop("_range", "_place", "_before")


def shelf(df: DataFrame, *, sort: str = "added", **chosen) -> DataFrame:
    """Every filter ANDed, then one ordering."""
    return order_shelf(df.filter(filters(**chosen)), sort)


# ---- lookups and display ----


def with_format(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Add the format's label and kind; unknown formats take the default row."""
    ((label, kind),) = [(lab, k) for fid, lab, k in dims.FORMATS if fid == dims.DEFAULT_FORMAT]
    return df.join(dim, "format", "left").withColumns(
        {"format_label": F.coalesce("format_label", F.lit(label)), "kind": F.coalesce("kind", F.lit(kind))}
    )


def with_status(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Add the status label; an unknown status has none."""
    return df.join(dim.select("status", "status_label"), "status", "left")


def display(df: DataFrame) -> DataFrame:
    return df.withColumns({"price_text": text.money(F.col("price")), "rating_text": text.rating_text(F.col("rating"))})


def links(df: DataFrame) -> DataFrame:
    return df.withColumns(text.search_links(F.col("title"), F.col("author")))


# ---- editing ----


def clean(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw records to typed ones, and the rejected ones with a blank title.

    Blank prices and ratings stay missing; form bounds are hints and are not enforced.
    """
    number = lambda c: F.when(stripped(c) != "", stripped(c))
    tidy = df.withColumns(
        {
            "title": stripped(F.col("title")),
            "author": stripped(F.col("author")),
            "price": number(F.col("price")).try_cast("decimal(10,2)"),
            "rating": number(F.col("rating")).try_cast("double"),
        }
    )
    blank = F.coalesce(stripped(F.col("title")), F.lit("")) == ""
    return tidy.filter(~blank), df.filter(blank)


def with_defaults(df: DataFrame) -> DataFrame:
    """Fill what a new record leaves open; the id and the position come from ``created_ms``."""
    return df.withColumns(
        {
            "id": F.coalesce("id", F.concat(F.lit("b"), F.col("created_ms").cast("string"))),
            "title": F.coalesce("title", F.lit("")),
            "author": F.coalesce("author", F.lit("")),
            "format": F.coalesce("format", F.lit(dims.DEFAULT_FORMAT)),
            "retailer": F.coalesce("retailer", F.lit(dims.RETAILERS[0])),
            "status": F.coalesce("status", F.lit(dims.STATUSES[0][1])),
            "note": F.coalesce("note", F.lit("")),
            "added": F.coalesce("added", "created_ms"),
        }
    ).drop("created_ms")


def next_status(status: Column) -> Column:
    """The status after this one, around the cycle; an unknown one goes to the first."""
    order = [sid for _, sid, _ in dims.STATUSES]
    step = F.when(F.lit(False), F.lit(None))
    for here, after in zip(order, order[1:] + order[:1], strict=True):
        step = step.when(status == here, after)
    return step.otherwise(order[0])


def cycle_status(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Advance the status of the listed ids; the other rows are unchanged."""
    marked = ids.select("id").distinct().withColumn("_hit", F.lit(True))
    return (
        df.join(marked, "id", "left")
        .withColumn("status", F.when(F.col("_hit"), next_status(F.col("status"))).otherwise(F.col("status")))
        .drop("_hit")
    )


def last_change(changes: DataFrame, keep: list[str] = BOOK_COLUMNS) -> DataFrame:
    """The last change per id by ``seq``, as an aggregate: repeats are combined before the shuffle."""
    rest = [c for c in keep if c != "id"]
    return (
        changes.groupBy("id")
        .agg(F.max_by(F.struct("op", *rest), "seq").alias("_last"))
        .select("id", "_last.*")
    )


def upsert(base: DataFrame, changes: DataFrame) -> DataFrame:
    """Replace whole rows by id, append new ones. Replaced rows keep their place (``pos``) when there is one."""
    latest = last_change(changes.withColumn("op", F.lit("upsert"))).drop("op")
    return _merge(base, latest.withColumn("_removed", F.lit(False)))


def remove(base: DataFrame, ids: DataFrame) -> DataFrame:
    return base.join(ids.select("id").distinct(), "id", "left_anti")


def apply_changes(base: DataFrame, changes: DataFrame) -> DataFrame:
    """A mixed feed of upserts and removes: only the last change of an id counts."""
    latest = last_change(changes)
    return _merge(base, latest.withColumn("_removed", F.col("op") == "remove").drop("op"))


def _merge(base: DataFrame, latest: DataFrame) -> DataFrame:
    """One full outer join: a change wins over the base row, a removal leaves nothing."""
    values = [c for c in BOOK_COLUMNS if c != "id"]
    there = base.select("id", F.struct(*values).alias("_old"), *[c for c in base.columns if c == "pos"])
    here = latest.select("id", F.struct(*values).alias("_new"), "_removed")
    merged = there.join(here, "id", "full_outer").filter(~F.coalesce("_removed", F.lit(False)))
    row = F.when(F.col("_removed").isNull(), F.col("_old")).otherwise(F.col("_new"))
    kept = [c for c in merged.columns if c == "pos"]
    return merged.select("id", row.alias("_row"), *kept).select("id", "_row.*", *kept)


# ---- tallies ----


def tally(df: DataFrame) -> DataFrame:
    """Cost to clear the wanted items and how many are physical, over the whole unfiltered set."""
    return df.agg(
        F.count("*").alias("titles"),
        F.coalesce(F.sum(F.when(F.col("status") == "want", F.coalesce("price", F.lit(0)))), F.lit(0))
        .cast("decimal(38,2)")
        .alias("want_total"),
        F.count_if(kind_of(F.col("format")) == "physical").alias("physical"),
    )


def shown_of(df: DataFrame, condition: Column) -> DataFrame:
    """``n of m shown`` and whether nothing is, in one pass."""
    shown = F.count_if(condition)
    return df.agg(shown.alias("shown"), F.count("*").alias("total"), (shown == 0).alias("nothing_shown"))
