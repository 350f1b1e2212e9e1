"""A device's register map: names, addresses, registers, and the decoded 32-bit values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.functions.numeric import decode_f32
from tracklens.operators import registers
from tracklens.operators.ordered import SLICE_ROWS


def register_map(points: DataFrame, rows: int = SLICE_ROWS) -> DataFrame:
    """One row per register; a 32-bit point shows its decoded value on both of its registers."""
    decoded = F.when(F.col("kind") == "32", decode_f32(F.col("hi"), F.col("lo"), F.col("word_order")))
    placed = registers.layout_and_names(points, rows).withColumn("value", decoded)
    return registers.register_words(placed)
