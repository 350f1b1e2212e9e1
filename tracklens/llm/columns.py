"""Names, keys and small expressions that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The order of a row without an id: before every other, and all such rows count as one document.
NO_ID = -(2**63)

#: White space of the contracts: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def ident(column: str) -> Column:
    """The id with NULL as the smallest long, so that it joins and compares like any other."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def row_key(id_col: str, text_col: str) -> Column:
    """A hash of id and text: tells rows of one id, or without an id, with different texts apart."""
    return F.xxhash64(ident(id_col), F.col(text_col).cast("string"))


def outward(column: str) -> Column:
    """The reverse of :func:`ident`."""
    return F.when(F.col(column) != F.lit(NO_ID), F.col(column))


def narrowed(df: DataFrame, **kept: str) -> DataFrame:
    """Only the named columns under new names, so that no other column of the input can clash: ``new="old"``."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in kept.items()])


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` alone would also change letters beyond ASCII."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.char_length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )
