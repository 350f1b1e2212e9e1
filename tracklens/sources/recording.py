"""Recorded channels as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_recording(df: DataFrame, path: str) -> str:
    """Write the recording with a header line per file, to a new folder."""
    df.write.mode("errorifexists").option("header", True).csv(path)
    return path
