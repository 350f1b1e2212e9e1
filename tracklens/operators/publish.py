"""Published pages: markers, labels, links and output variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.functions import text

# The two forms every page is written in.
VARIANTS = ["standalone", "fragment"]


def sections(df: DataFrame, markers: dict[str, str], body: str = "html") -> DataFrame:
    """Occurrences of each marker per page, as a number and zero-padded."""
    counts = {name: text.count_marker(F.col(body), marker) for name, marker in markers.items()}
    return df.withColumns(counts | {f"{name}_text": text.pad2(c) for name, c in counts.items()})


def card_label(short: Column, title: Column, number: Column) -> Column:
    """The short name, else the title text, else ``Slide n``; trimmed."""
    named = F.coalesce(F.nullif(short, F.lit("")), F.nullif(title, F.lit("")))
    return text.stripped(F.coalesce(named, F.concat(F.lit("Slide "), number.cast("string"))))


def hrefs(body: Column) -> Column:
    """Every href value of a page, in order."""
    return F.regexp_extract_all(body, F.lit('href="([^"]*)"'), F.lit(1))


def links_json(urls: Column) -> Column:
    """Numbered URLs as a JSON map with text keys, from an array already on the row."""
    entries = F.transform(urls, lambda url, i: F.struct((i + 1).cast("string"), url))
    return F.to_json(F.map_from_entries(entries))


def resolve_links(pairs: DataFrame, urls: DataFrame) -> DataFrame:
    """Each declared (page, target) pair in each variant.

    A link to itself has no href; a standalone page links relatively, a fragment absolutely and in a
    new tab. Only declared pairs are resolved, never all pages against all.
    """
    own = F.col("target").eqNullSafe(F.col("own"))
    alone = F.col("variant") == "standalone"
    return (
        pairs.join(urls, "target", "left")
        .withColumn("variant", F.explode(F.array(*[F.lit(v) for v in VARIANTS])))
        .withColumns(
            {
                "href": F.when(own, None).when(alone, F.col("file")).otherwise(F.col("absolute")),
                "new_tab": ~own & ~alone,
            }
        )
        .drop("file", "absolute")
    )


def write_variants(df: DataFrame, path: str) -> str:
    """Write every record once per variant, a folder each."""
    each = df.withColumn("variant", F.explode(F.array(*[F.lit(v) for v in VARIANTS])))
    each.write.mode("errorifexists").partitionBy("variant").parquet(path)
    return path
