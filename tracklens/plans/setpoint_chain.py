"""From the active setpoint to each device's limit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.operators import telemetry as T
from tracklens.operators.ordered import SLICE_ROWS, drop_slices, running, slices
from tracklens.operators.ramp import ramp_limit
from tracklens.session import written


@dataclass(frozen=True)
class ChainParams:
    active: str
    db_hz: float
    droop: float
    limit: float
    rate: float
    delay: float
    period: str


def setpoint_chain(df: DataFrame, p: ChainParams, rows: int = SLICE_ROWS) -> DataFrame:
    """Source, frequency delta, limit, ramp, dispatch and stuck-device cap, in that order.

    The cap and the dispatch sums depend only on measurements, so they are taken before the ramp: the
    Python step then runs once and nothing is joined back through it. What goes into the ramp is written
    first, because the ramp reads its input more than once.
    """
    plant = ["plant"]
    measured = T.adaptive_limit(df, p.delay, rows=rows).withColumn("period", T.bucket(F.col("ts"), p.period))
    sums = T.available(df.withColumn("period", T.bucket(F.col("ts"), p.period)), ["plant", "period"])
    active = F.when(F.col("source") == p.active, F.col("sp"))
    held = running(slices(measured, plant, T.ORDER, rows), plant, T.ORDER, {"setpoint": ("last", active)}, rows)
    wanted = F.coalesce("setpoint", F.lit(0.0)) + T.frequency_delta(F.col("hz"), p.db_hz, p.droop)
    final = written(held.withColumn("final", F.least(wanted, F.lit(p.limit))), "setpoint-chain")
    ramped = drop_slices(ramp_limit(final, p.rate, keys=("plant",), want="final", rows=rows))
    sent = T.dispatch(ramped, ["plant", "period"], sums=sums)
    return sent.withColumn("limit", F.least("limit", "adaptive")).drop("setpoint", "adaptive", "stuck_since")
