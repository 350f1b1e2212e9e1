"""The full catalogue page: filtered and ordered cards, and the totals above them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens import dims
from tracklens.operators import catalogue as C


def cards(df: DataFrame, *, sort: str = "added", **chosen) -> DataFrame:
    """One row per shown item with its labels, display texts and search links."""
    spark = df.sparkSession
    chosen_rows = df.filter(C.filters(**chosen))
    labelled = C.with_status(
        C.with_format(chosen_rows, F.broadcast(dims.format_dim(spark))), F.broadcast(dims.status_dim(spark))
    )
    return C.order_shelf(C.links(C.display(labelled)), sort).select(
        "id", "title", "author", "format_label", "kind", "status_label", "price_text", "rating_text", *dims.LINK_TEMPLATES
    )


def totals(df: DataFrame, **chosen) -> DataFrame:
    """Whole-catalogue tallies and the shown count, all in one pass."""
    condition = C.filters(**chosen)
    shown = F.count_if(condition)
    return df.agg(
        F.count("*").alias("titles"),
        F.coalesce(F.sum(F.when(F.col("status") == "want", F.coalesce("price", F.lit(0)))), F.lit(0))
        .cast("decimal(38,2)")
        .alias("want_total"),
        F.count_if(C.kind_of(F.col("format")) == "physical").alias("physical"),
        shown.alias("shown"),
        (shown == 0).alias("nothing_shown"),
    )
