"""Catalogue files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tracklens import dims


_BAD = "_corrupt_record"


def _schema() -> StructType:
    return StructType.fromDDL(dims.RAW_BOOK_SCHEMA)


def _text(spark: SparkSession, path: str, whole: bool) -> DataFrame | None:
    """The file's lines (or whole files), or None where there is no such path; any other fault is raised."""
    try:
        return spark.read.text(path, wholetext=whole)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def is_array_document(spark: SparkSession, path: str) -> bool:
    """Whether the first line that is not blank opens a JSON array. Runs a small job: it reads until that line."""
    lines = _text(spark, path, whole=False)
    first = None if lines is None else lines.filter(F.col("value").rlike(r"\S")).first()
    return first is not None and first.value.lstrip().startswith("[")


def _parsed_lines(lines: DataFrame) -> DataFrame:
    parsed = F.from_json("value", StructType([*_schema().fields]).add(_BAD, "string"), {"columnNameOfCorruptRecord": _BAD})
    return lines.filter(F.col("value").rlike(r"\S")).select("value", parsed.alias("_row"))


def load_books(
    spark: SparkSession,
    path: str,
    seed: DataFrame | None = None,
    fallback: bool = True,
    array_document: bool | None = None,
) -> DataFrame:
    """Raw catalogue rows from JSON, or the seed rows when nothing usable is stored.

    The stored form at scale is one JSON object per line, which Spark splits across tasks; the other form is one array
    per file. Which one it is shows in the first line, unless ``array_document`` says so; a folder holds files of one
    form. A line that is not an object, or a file that is not an array, is no record: :func:`rejected_books` returns
    those. ``fallback=False`` turns the seed off, so an emptied catalogue stays empty.
    """
    seed = dims.seed_books(spark) if seed is None else seed
    whole = is_array_document(spark, path) if array_document is None else array_document
    text = _text(spark, path, whole)
    if text is None:
        stored = spark.createDataFrame([], _schema())
    elif whole:
        arrays = text.filter(F.col("value").rlike(r"^\s*\["))
        stored = arrays.select(F.inline(F.from_json("value", ArrayType(_schema()))))
    else:
        rows = _parsed_lines(text).select("_row.*")
        stored = rows.filter(F.col(_BAD).isNull()).select(*_schema().fieldNames())
    if not fallback:
        return stored
    any_row = stored.limit(1).select(F.lit(True).alias("_stored"))
    return stored.unionByName(seed.join(any_row, F.col("_stored"), "left_anti"))


def rejected_books(spark: SparkSession, path: str, array_document: bool | None = None) -> DataFrame:
    """``value, reason`` of every line or file that :func:`load_books` cannot read; a missing path rejects nothing."""
    whole = is_array_document(spark, path) if array_document is None else array_document
    text = _text(spark, path, whole)
    if text is None:
        return spark.createDataFrame([], "value string, reason string")
    if whole:
        unread = ~F.col("value").rlike(r"^\s*\[") | F.from_json("value", ArrayType(_schema())).isNull()
        return text.filter(unread).select("value", F.lit("not an array").alias("reason"))
    bad = _parsed_lines(text).filter(F.col(f"_row.{_BAD}").isNotNull())
    return bad.select("value", F.lit("not an object").alias("reason"))


def save_books(df: DataFrame, path: str, fmt: str = "json") -> str:
    """Write the whole catalogue to a new folder; an existing one is an error, so a source is never overwritten."""
    df.write.mode("errorifexists").format(fmt).save(path)
    return path
