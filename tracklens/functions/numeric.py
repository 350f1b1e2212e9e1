"""Numeric expressions: register words to floats, bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_f32(first: Column, second: Column, order: Column) -> Column:
    """Two 16-bit registers as an IEEE-754 single, as a double.

    ``order`` is ``msb`` when the first register holds the high word and ``lsb`` when it holds the low
    one. Infinities and NaNs become NULL.
    """
    high = F.when(order == "lsb", second).otherwise(first).cast("long").bitwiseAND(0xFFFF)
    low = F.when(order == "lsb", first).otherwise(second).cast("long").bitwiseAND(0xFFFF)
    bits = F.shiftleft(high, 16).bitwiseOR(low)
    sign = F.when(F.shiftright(bits, 31) == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
    exponent = F.shiftright(bits, 23).bitwiseAND(0xFF)
    fraction = bits.bitwiseAND(0x7FFFFF).cast("double")
    normal = sign * (1.0 + fraction / float(1 << 23)) * F.pow(F.lit(2.0), exponent.cast("double") - 127.0)
    subnormal = sign * fraction * F.pow(F.lit(2.0), F.lit(-149.0)) + 0.0
    return F.when(exponent == 255, None).when(exponent == 0, subnormal).otherwise(normal)


def bounded(x: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(high, x))
