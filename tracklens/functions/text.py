"""Text expressions: money, ratings, links, escapes, counters, clock and duration labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracklens import dims

MISSING = "—"


def stripped(text: Column) -> Column:
    """The text without white space of any kind around it."""
    blank = r"[\s\p{Z}\x{FEFF}]+"
    return F.regexp_replace(text, f"^{blank}|{blank}$", "")


def money(price: Column) -> Column:
    """``$12.00``, or a dash when the price is missing; a price of 0 is shown."""
    return F.when(price.isNull(), MISSING).otherwise(F.concat(F.lit("$"), price.cast("decimal(18,2)").cast("string")))


def rating_text(rating: Column) -> Column:
    """``4.4 / 5``, or a dash when the rating is missing or 0."""
    known = F.coalesce(rating, F.lit(0))
    return F.when(known == 0, MISSING).otherwise(F.concat(rating.cast("decimal(18,1)").cast("string"), F.lit(" / 5")))


def encode_component(text: Column) -> Column:
    """Percent-encode like a URI component: a space is %20 and ``-_.!~*'()`` stay as they are."""
    out = F.url_encode(text)
    for encoded, plain in [("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")]:
        out = F.replace(out, F.lit(encoded), F.lit(plain))
    return out


def search_links(title: Column, author: Column) -> dict[str, Column]:
    """One search URL per site for ``title author``."""
    term = encode_component(F.concat_ws(" ", title, author))
    return {site: F.concat(F.lit(prefix), term) for site, prefix in dims.LINK_TEMPLATES.items()}


def escape_attr(text: Column) -> Column:
    """Make text safe inside a double-quoted attribute."""
    return F.replace(text, F.lit('"'), F.lit("&quot;"))


def pad2(number: Column) -> Column:
    """At least two digits; longer numbers are kept whole."""
    return F.format_string("%02d", number)


def count_marker(text: Column, marker: str) -> Column:
    """Non-overlapping occurrences of a literal marker."""
    dropped = F.length(text) - F.length(F.replace(text, F.lit(marker), F.lit("")))
    return (dropped / len(marker)).cast("long")


def half_up(x: Column) -> Column:
    """Round to a whole number, halves towards plus infinity."""
    return F.floor(x + F.lit(0.5))


def clock(minutes: Column) -> Column:
    """``HH:MM`` for fractional minutes after the session base; the total is rounded before it is split."""
    total = half_up(minutes + F.lit(dims.SESSION_BASE_MINUTES)).cast("long")
    return F.format_string("%02d:%02d", F.floor(total / 60).cast("long"), total % 60)


def duration(minutes: Column) -> Column:
    """``2h 04m`` for a length in minutes."""
    total = half_up(minutes).cast("long")
    return F.format_string("%dh %02dm", F.floor(total / 60).cast("long"), total % 60)
