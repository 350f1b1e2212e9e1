"""Nested plans against what they declare: flattening, summaries, reconciliation, editions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens import dims
from tracklens.functions.text import stripped


def flatten_tracks(df: DataFrame, keep: tuple[str, ...] = ("track",)) -> DataFrame:
    """One row per entry of ``entries`` (an array of role and title), with its 0-based place."""
    return df.select(*keep, F.posexplode("entries").alias("pos", "_entry")).select(*keep, "pos", "_entry.*")


def role_label(role: Column) -> Column:
    pairs = [F.lit(x) for pair in dims.ROLE_LABELS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), role)


def label_role(df: DataFrame) -> DataFrame:
    return df.withColumn("role_label", role_label(F.col("role")))


def track_summary(df: DataFrame) -> DataFrame:
    """Entries per track and role, with track subtotals (level 1) and the grand total (level 3)."""
    counted = df.groupBy("track", "role").agg(F.count("*").alias("_n"))  # first, so that only counts are expanded
    return counted.rollup("track", "role").agg(
        F.sum("_n").alias("entries"), F.grouping_id().cast("int").alias("level")
    )


def track_pivot(df: DataFrame) -> DataFrame:
    """One row per track with a count per role; the roles are fixed, so no pass to find them."""
    return df.groupBy("track").agg(*[F.count_if(F.col("role") == r).alias(r) for r in dims.ROLE_LABELS])


def reconcile(declared: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Declared against counted, by key; a side that lacks the key is NULL."""
    both = declared.select(*keys, "declared").join(actual.select(*keys, "actual"), keys, "full_outer")
    return both.withColumns(
        {
            "diff": F.coalesce("actual", F.lit(0)) - F.coalesce("declared", F.lit(0)),
            "agrees": F.col("declared").eqNullSafe(F.col("actual")),
        }
    )


def dataset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one side holds more often than the other: the side, the row, and how many more copies.

    Both multiset differences from one aggregate, so each side is read and shuffled once and repeats
    are combined first.
    """
    columns = a.columns
    signed = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1)))
    return (
        signed.groupBy(*columns)
        .agg(F.sum("_n").alias("_n"))
        .filter(F.col("_n") != 0)
        .select(
            F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"), *columns, F.abs("_n").alias("copies")
        )
    )


def unit_rows(df: DataFrame) -> DataFrame:
    """One row per declared unit, numbered from 1; nothing declared gives no row."""
    return df.withColumn("unit", F.explode(F.when(F.col("declared") > 0, F.sequence(F.lit(1), F.col("declared")))))


def roadmap_long(df: DataFrame, lanes: list[str], keys: list[str]) -> DataFrame:
    """Block rows with a column per lane to one row per block and lane; empty lanes are left out."""
    return df.unpivot(keys, lanes, "lane", "text").filter(F.col("text").isNotNull())


def roadmap_wide(df: DataFrame, lanes: list[str], keys: list[str]) -> DataFrame:
    """The way back: one column per lane."""
    return df.groupBy(*keys).agg(*[F.first(F.when(F.col("lane") == x, F.col("text")), True).alias(x) for x in lanes])


def edition_of(title: Column) -> Column:
    """The number in a trailing ``3e``; a title without one is a first edition."""
    found = F.regexp_extract(title, r"\s(\d+)e\s*$", 1)
    return F.when(found == "", 1).otherwise(found.try_cast("int"))


def work_of(title: Column) -> Column:
    """The title without its edition, trimmed and lower case."""
    return F.lower(stripped(F.regexp_replace(title, r"\s\d+e\s*$", "")))


def latest_edition(df: DataFrame, tie: str = "id") -> DataFrame:
    """The newest edition of each work. An aggregate, so the copies of one work are combined before the shuffle."""
    rest = F.struct(*df.columns)
    return (
        df.groupBy(work_of(F.col("title")).alias("work"))
        .agg(
            F.max_by(rest, F.struct(edition_of(F.col("title")), F.col(tie))).alias("_best"),
            F.count("*").alias("copies"),
        )
        .select("work", edition_of(F.col("_best.title")).alias("edition"), "_best.*", "copies")
    )
