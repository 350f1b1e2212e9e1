"""Running values over an ordered series per key, safe when one key holds most of the rows.

A plain window over ``partitionBy(key)`` sends every row of a key to one task. Here a key with more
than ``rows`` rows is cut into consecutive slices of about equal row counts, each slice becomes its own
window partition, and what the earlier slices contribute is carried in from a summary:

* one narrow pass draws rows by a hash of their content, ``SAMPLED`` per slice (all of them where slices are small), and
  takes every so-manieth of a key's drawn rows, in order, as a cut;
* one aggregate per (large key, slice) summarises the slices, a window over the summaries carries them on;
* the rows themselves are shuffled once, by (key, slice).

Cuts are points in the whole order, ties included, so a burst or a series at one instant is cut like any other; only rows
equal in every order column stay together. ``rows`` grows with the table where it must, to total rows / ``MAX_LARGE``: there are then
at most ``MAX_LARGE`` cuts and fewer than twice as many slices, whatever the data, which is why both helper tables
may be broadcast. Keys without a cut stay one slice and need no carry, so on unskewed data the plan is a single-shuffle window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICE_ROWS = 1_000_000
MAX_LARGE = 100_000
SAMPLED = 64

SLICE = "_slice"
_PARTS = "_parts"
_DRAWS = 2**31

#: The weights of the whole numbers that a double is split into, as powers of two, and the bits of each.
_WEIGHTS = (20, -10, -40, -70, -100)
_BITS = 30
_REACH = 2.0**50


def _on(left_keys: list[str], right: DataFrame) -> Column:
    cond = F.lit(True)
    for k in left_keys:
        cond = cond & F.col(k).eqNullSafe(right[f"_r_{k}"])
    return cond


def _cuts_below(cuts: Column, row: Column) -> Column:
    """How many of the sorted ``cuts`` are smaller than the row, by bisection."""

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        still = s["lo"] < s["hi"]
        below = F.coalesce(F.get(cuts, middle) < row, F.lit(False))
        return F.struct(
            F.when(still & below, middle + 1).otherwise(s["lo"]).alias("lo"),
            F.when(still & ~below, middle).otherwise(s["hi"]).alias("hi"),
        )

    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(cuts) + 1)).cast("int") + 1)
    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(cuts).alias("hi")), halve, lambda s: s["lo"])


def slices(df: DataFrame, keys: list[str], order: list[str] | str, rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``_slice`` (0 for every key without a cut) and ``_parts`` (NULL for those keys).

    A slice holds the rows after one cut up to and including the next. Where all rows are drawn (``rows`` of at most
    ``SAMPLED``) a slice has exactly ``rows``, elsewhere about as many. NULLs come first in the order.
    A frame that is sliced already keeps its slices, so steps over the same series share one partitioning.
    """
    if SLICE in df.columns:
        return df
    order = [order] if isinstance(order, str) else list(order)
    here = F.struct(*order)
    total = df.agg(F.count("*")).scalar()
    size = F.greatest(F.lit(rows), F.ceil(total / MAX_LARGE))
    share = F.least(F.lit(1.0), SAMPLED / size)
    drawn = df.select(*keys, here.alias("_o")).filter(F.pmod(F.xxhash64(*keys, *order), F.lit(_DRAWS)) < share * _DRAWS)
    nth = F.row_number().over(W.partitionBy(*keys).orderBy("_o"))
    cuts = drawn.withColumn("_n", nth).filter(F.col("_n") % F.round(size * share) == 0)
    cuts = cuts.groupBy(*keys).agg(F.sort_array(F.collect_list("_o")).alias("_cuts"))
    cuts = cuts.select(*[F.col(k).alias(f"_r_{k}") for k in keys], "_cuts")
    return (
        df.join(F.broadcast(cuts), _on(keys, cuts), "left")
        .withColumn(SLICE, F.when(F.col("_cuts").isNull(), 0).otherwise(_cuts_below(F.col("_cuts"), here)).cast("long"))
        .withColumn(_PARTS, F.when(F.col("_cuts").isNotNull(), F.size("_cuts") + 1))
        .drop("_cuts", *[f"_r_{k}" for k in keys])
    )


def _limbs(value: Column) -> list[Column]:
    """A double as whole numbers of under 31 bits, one per weight; bits below the last weight are cut off.

    The parts have the sign of the value, so every rest is exact. Values out of reach have no parts.
    """
    rest = F.when(F.abs(value) < _REACH, value).otherwise(F.when(value.isNotNull(), 0.0))
    out = []
    for weight in _WEIGHTS:
        part = (rest * 2.0**-weight).cast("long")
        out.append(part)
        rest = rest - part * 2.0**weight
    return out


def _carried(parts: list[Column]) -> list[Column]:
    """The same number with every whole number but the first within its bits."""
    out, over = [], F.lit(0).cast("long")
    for part in reversed(parts[1:]):
        full = part + over
        out.append(full.bitwiseAND(F.lit(2**_BITS - 1)))
        over = F.shiftright(full, _BITS)
    return [parts[0] + over, *reversed(out)]


def _joined(parts: Column) -> Column:
    """The double nearest to parts that are carried already, from the smallest up."""
    value = parts[len(_WEIGHTS) - 1] * 2.0 ** _WEIGHTS[-1]
    for k in range(len(_WEIGHTS) - 2, -1, -1):
        value = value + parts[k] * 2.0 ** _WEIGHTS[k]
    return value


def exact_parts(value: Column) -> dict[str, Column]:
    """What to add up, by suffix, for a sum of doubles that does not depend on the order of the rows.

    Whole numbers add exactly, in any order and any grouping. Infinities, NaN and values of 2^50 or more are added apart,
    as doubles.
    """
    far = F.when(~(F.abs(value) < _REACH), value)
    return {**{str(k): limb for k, limb in enumerate(_limbs(value))}, "far": far}


def exact_sum(parts: dict[str, Column]) -> Column:
    """The sum as a double, from the sums of :func:`exact_parts`; NULL where nothing was added."""
    carried = _carried([parts[str(k)] for k in range(len(_WEIGHTS))])
    other = _carried([-parts[str(k)] for k in range(len(_WEIGHTS))])
    positive = F.array(*carried)
    near = F.when(carried[0] >= 0, _joined(positive)).otherwise(-_joined(F.array(*other)))
    return F.coalesce(near + parts["far"], near)


def running(
    df: DataFrame, keys: list[str], order: list[str], specs: dict[str, tuple[str, Column]], rows: int = SLICE_ROWS
) -> DataFrame:
    """Add running columns per ``keys`` in ascending ``order``.

    ``specs`` maps an output name to ``(kind, value)``:

    * ``total``: sum of the value up to and including the row;
    * ``exact_total``: the same for doubles, added exactly and rounded once, so that it is the same however rows are sliced;
    * ``total_before``: sum over the earlier rows, 0 at the start;
    * ``last``: latest non-null value up to and including the row;
    * ``last_before``: latest non-null value on an earlier row;
    * ``previous``: the value on the row before, NULL at the start.
    """
    exact = {name: exact_parts(value) for name, (kind, value) in specs.items() if kind == "exact_total"}
    if exact:
        plain = {name: spec for name, spec in specs.items() if name not in exact}
        parts = {f"_x_{name}_{k}": ("total", part) for name, held in exact.items() for k, part in held.items()}
        made = running(df, keys, order, {**plain, **parts}, rows)
        sums = {name: exact_sum({k: F.col(f"_x_{name}_{k}") for k in held}) for name, held in exact.items()}
        return made.withColumns(sums).drop(*parts)
    ready = SLICE in df.columns
    base = slices(df, keys, order, rows)
    base = base.withColumns({f"_v_{name}": value for name, (_, value) in specs.items()})
    by_order = F.struct(*order)

    summary = []
    for name, (kind, _) in specs.items():
        value = F.col(f"_v_{name}")
        if kind in ("total", "total_before"):
            summary.append(F.sum(value).alias(f"_c_{name}"))
        elif kind in ("last", "last_before"):
            summary.append(F.max_by(value, F.when(value.isNotNull(), by_order)).alias(f"_c_{name}"))
        elif kind == "previous":
            summary.append(F.max_by(F.struct(value.alias("x")), by_order).alias(f"_c_{name}"))
        else:
            raise ValueError(f"unknown running kind {kind!r}")

    before = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    carries = {}
    for name, (kind, _) in specs.items():
        col = F.col(f"_c_{name}")
        carries[f"_c_{name}"] = (F.sum(col) if kind.startswith("total") else F.last(col, ignorenulls=True)).over(before)
    carry = (
        base.filter(F.col(_PARTS) > 1)
        .groupBy(*keys, SLICE)
        .agg(*summary)
        .select(
            *[F.col(k).alias(f"_r_{k}") for k in [*keys, SLICE]], *[c.alias(name) for name, c in carries.items()]
        )
    )
    joined = base.join(F.broadcast(carry), _on([*keys, SLICE], carry), "left")

    local = W.partitionBy(*keys, SLICE).orderBy(*order)
    upto = local.rowsBetween(W.unboundedPreceding, 0)
    earlier = local.rowsBetween(W.unboundedPreceding, -1)
    added = {}
    for name, (kind, _) in specs.items():
        value, carried = F.col(f"_v_{name}"), F.col(f"_c_{name}")
        if kind == "total":
            here = F.sum(value).over(upto)
            added[name] = F.when(carried.isNull(), here).otherwise(carried + F.coalesce(here, F.lit(0)))
        elif kind == "total_before":
            here = F.sum(value).over(earlier)
            added[name] = F.coalesce(carried, F.lit(0)) + F.coalesce(here, F.lit(0))
        elif kind == "last":
            added[name] = F.coalesce(F.last(value, ignorenulls=True).over(upto), carried)
        elif kind == "last_before":
            added[name] = F.coalesce(F.last(value, ignorenulls=True).over(earlier), carried)
        else:
            added[name] = F.coalesce(F.lag(F.struct(value.alias("x"))).over(local), carried)["x"]
    helpers = [f"_r_{k}" for k in [*keys, SLICE]] + [f"_v_{n}" for n in specs] + [f"_c_{n}" for n in specs]
    return joined.withColumns(added).drop(*helpers, *([] if ready else [SLICE, _PARTS]))


def drop_slices(df: DataFrame) -> DataFrame:
    return df.drop(SLICE, _PARTS)


