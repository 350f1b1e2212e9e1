"""A recording: picked channels, resampled, aligned, and checked against the response requirement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens import dims
from tracklens.operators import telemetry as T
from tracklens.operators.ordered import SLICE_ROWS
from tracklens.session import written

POWER, SETPOINT = "P at POI", "Plant setpoint"
COARSE_MS = 100


def warnings(signals: list[str], period_ms: float) -> list[str]:
    """What a recording with these channels and this sampling cannot show."""
    found = []
    if not {POWER, SETPOINT} <= set(signals):
        found.append(f"add both {POWER} and {SETPOINT} to validate the response")
    if period_ms > COARSE_MS:
        found.append(f"{period_ms:g} ms sampling is coarse for a frequency response trace")
    return found


def picked(df: DataFrame, signals: list[str]) -> DataFrame:
    """The chosen channels only; unknown names are an error."""
    unknown = set(signals) - {name for name, _, _ in dims.CHANNELS}
    if unknown:
        raise ValueError(f"unknown channels {sorted(unknown)}")
    return df.filter(F.col("signal").isin(signals))


def resampled(df: DataFrame, signals: list[str], period: str, keep: int | None = None) -> DataFrame:
    """The last sample of each period of the chosen channels; a recording keeps all of them unless told otherwise."""
    return T.downsample(picked(df, signals), period, ["event_id", "value"], keep, keys=("device", "signal"))


def aligned(samples: DataFrame, tolerance_s: float, rows: int = SLICE_ROWS, keep_slices: bool = False) -> DataFrame:
    """Measured power with the setpoint in force, from a resampled recording."""
    command = samples.filter(F.col("signal") == SETPOINT).withColumn("command", F.col("value"))
    feedback = samples.filter(F.col("signal") == POWER).withColumn("feedback", F.col("value"))
    return T.align(command, feedback, tolerance_s, rows=rows, keep_slices=keep_slices)


def compliance(
    samples: DataFrame, tolerance_s: float, limit_s: float, low: float, high: float, rows: int = SLICE_ROWS
) -> DataFrame:
    """Setpoint steps in a written recording and whether the power reached each in time.

    The checks read the samples several times, so hand in the recording as written, not the query behind
    it; the aligned record is written for the same reason.
    """
    both = aligned(samples, tolerance_s, rows, keep_slices=True).withColumnsRenamed({"command": "sp", "feedback": "out"})
    return T.response_ok(written(both, "aligned"), limit_s, low, high, rows=rows)
