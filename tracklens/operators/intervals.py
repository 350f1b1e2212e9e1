"""Point-in-interval joins as equi-joins on dyadic pieces."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: An interval over so many buckets at most is listed once per bucket, so that usual intervals stay on one level.
PLAIN = 4


def _shifted(value: Column, level: Column) -> Column:
    return F.call_function("shiftright", value, level)


def dyadic(first: Column, last: Column) -> Column:
    """The buckets from ``first`` to ``last`` as an array of ``level, bucket``.

    A bucket of level k is 2^k buckets wide. Short runs are listed bucket by bucket; a longer one is cut into the fewest aligned
    pieces, at most two of a level, so a run of n buckets has fewer than 2 log2(n) + 2. Pieces do not overlap.
    """

    def of_level(level: Column) -> Column:
        low = -_shifted(-first, level)
        high = _shifted(last + 1, level) - 1
        odd, even = F.pmod(low, F.lit(2)) == 1, F.pmod(high, F.lit(2)) == 0
        piece = lambda bucket: F.struct(level.alias("level"), bucket.alias("bucket"))
        left = F.when((low <= high) & odd, piece(low))
        right = F.when((low <= high) & even, piece(high))
        return F.filter(F.array(left, right), lambda p: p.isNotNull())

    plain = F.transform(F.sequence(first, last), lambda b: F.struct(F.lit(0).alias("level"), b.alias("bucket")))
    levels = F.sequence(F.lit(0), F.ceil(F.log2((last - first + 1).cast("double"))).cast("int"))
    return F.when(last - first < PLAIN, plain).otherwise(F.flatten(F.transform(levels, of_level)))


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    at: Column,
    low: Column,
    high: Column,
    width: float,
    keys: tuple[str, ...] = (),
    how: str = "left",
) -> DataFrame:
    """Join each point to the intervals with ``low <= at <= high`` (both ends inclusive, numbers).

    Each interval is listed once per dyadic piece of buckets of ``width``, so even one over the whole range is a few dozen rows,
    and each point looks up its bucket on every level in use, so Spark sees an equi-join it can shuffle or, by its
    own size check, broadcast. Which levels are in use (64 at most) is asked first. Pick ``width`` near the usual
    interval length: then there is one level and a point is one row. With several levels a left join needs one more shuffle, to
    tell a point without any interval.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how is left or inner, not {how!r}")
    bucket = lambda c: F.floor(c / width).cast("long")
    spread = intervals.withColumns({"_lo": low, "_hi": high}).withColumn(
        "_piece", F.explode(F.when(F.col("_lo") <= F.col("_hi"), dyadic(bucket(F.col("_lo")), bucket(F.col("_hi")))))
    )
    levels = sorted(r[0] for r in spread.select("_piece.level").distinct().collect())
    for k in keys:
        spread = spread.withColumnRenamed(k, f"_i_{k}")
    placed = points.withColumns({"_at": at, "_at_level": F.lit(0)})
    several = len(levels) > 1 or levels[:1] not in ([], [0])
    if several:
        if how == "left":
            placed = placed.withColumn("_point", F.monotonically_increasing_id())
        placed = placed.withColumn("_at_level", F.explode(F.array(*[F.lit(k) for k in levels])))
    placed = placed.withColumn("_at_bucket", _shifted(bucket(F.col("_at")), F.col("_at_level")))
    cond = (F.col("_at_bucket") == F.col("_piece.bucket")) & F.col("_at").between(F.col("_lo"), F.col("_hi"))
    if several:
        cond = cond & (F.col("_at_level") == F.col("_piece.level"))
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_i_{k}"))
    joined = placed.join(spread, cond, how)
    if several and how == "left":
        point = W.partitionBy("_point")
        met = F.max(F.col("_piece").isNotNull()).over(point)
        first = F.row_number().over(point.orderBy("_at_level")) == 1
        joined = joined.withColumns({"_met": met, "_only": first}).filter(
            F.col("_piece").isNotNull() | (~F.col("_met") & F.col("_only"))
        )
    return joined.drop(
        "_at", "_at_level", "_at_bucket", "_piece", "_lo", "_hi", "_point", "_met", "_only", *[f"_i_{k}" for k in keys]
    )
