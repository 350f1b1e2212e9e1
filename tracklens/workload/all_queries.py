"""Imports every query module, so that the registry is full."""

from tracklens.workload import (  # noqa: F401
    calendar,
    catalogue,
    interactions,
    plan,
    registers,
    streams,
    telemetry,
)
from tracklens.workload.registry import ORACLES, QUERIES  # noqa: F401
