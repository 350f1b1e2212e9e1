"""Markdown track tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens import dims
from tracklens.functions.text import stripped

_CELLS = r"^\|\s*([^|]*?)\s*\|\s*([^|]*?)\s*\|\s*$"


def read_track_tables(spark: SparkSession, path: str) -> DataFrame:
    """Rows of (track, line, role, title): a ``##`` heading sets the track, its table rows are the entries.

    The reader cuts the files at the headings, so a record is one section with its heading on the first
    line: large files still split across tasks, and no ordering over a file is needed.
    """
    section = F.regexp_replace("value", r"^## ", "")
    lines = F.split(section, r"\r?\n")
    words = [F.lit(x) for pair in dims.ROLE_WORDS.items() for x in pair]
    return (
        spark.read.option("lineSep", "\n## ").text(path)
        .select(stripped(lines[0]).alias("track"), F.posexplode(lines).alias("line", "_text"))
        .filter(F.col("_text").rlike(_CELLS))
        .select(
            "track",
            "line",
            F.regexp_extract("_text", _CELLS, 1).alias("_word"),
            F.regexp_extract("_text", _CELLS, 2).alias("title"),
        )
        .filter((F.col("_word") != "Role") & ~F.col("_word").rlike(r"^:?-+:?$"))
        .select("track", "line", F.try_element_at(F.create_map(*words), F.col("_word")).alias("role"), "title")
    )
