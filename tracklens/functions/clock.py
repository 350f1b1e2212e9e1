"""Calendar times and zones, tolerant of what is no time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FORM = r"^(\d{4})(\d{2})(\d{2})(?:T(\d{2})(\d{2})(\d{2})(Z?))?$"


def clock_time(stamp: Column, day_ends: bool = False) -> Column:
    """A date, local or UTC time of the calendar form as a clock time; anything else, or no such time, is NULL.

    A date alone is its first second, or its last where it ends something.
    """
    whole = F.lit("235959" if day_ends else "000000")
    full = F.when(F.char_length(stamp) == 8, F.concat(stamp, F.lit("T"), whole)).otherwise(stamp)
    parts = [F.regexp_extract(full, _FORM, k).try_cast("int") for k in range(1, 7)]
    return F.try_make_timestamp_ntz(*parts)


def known_zone(tz: Column) -> Column:
    """Whether a time zone is known."""
    year, one, none = F.lit(2000), F.lit(1), F.lit(0)
    return F.try_make_timestamp(year, one, one, none, none, none, tz).isNotNull()
