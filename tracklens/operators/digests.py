"""The difference of two data sets by a tree of digests: only the key ranges that differ are shuffled.

A row belongs to a range of its key's hash. A range's digest is the number of its rows, the exclusive or of their 64-bit
hashes and the sum of a second hash: it does not depend on the order of rows, repeats count, and the digest of a wider range is that of its parts
put together. One narrow pass with a combine before the shuffle makes the leaves; levels above come from them. Two trees are
compared from the root down, so equal data sets meet in one row, and stored trees are read only where they differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.operators.plan import dataset_diff

LEAF_ROWS = 1000
MAX_BITS = 20
STEP_BITS = 4


def leaf_of(keys: list[str], bits: int) -> Column:
    """The range of a key's hash: its top ``bits``."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits) if bits else F.lit(0).cast("long")


def bits_for(rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    """How many bits give leaves of about ``leaf_rows``: at most ``MAX_BITS``, so that a table of leaves stays small."""
    return min(MAX_BITS, max(0, -(-rows // leaf_rows) - 1).bit_length())


def _combined(df: DataFrame, *by: Column) -> DataFrame:
    return df.groupBy(*by).agg(F.sum("rows").alias("rows"), F.bit_xor("mixed").alias("mixed"), F.sum("added").alias("added"))


def digest_tree(df: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """``level, node, rows, mixed, added``: level 0 is the root, each level has up to 16 times the nodes of the one above.

    Every column counts. NULLs are values like any other; an empty table has no nodes.
    """
    hashed = df.select(
        leaf_of(keys, bits).alias("node"),
        F.lit(1).cast("long").alias("rows"),
        F.xxhash64(*df.columns).alias("mixed"),
        F.hash(*df.columns).cast("long").alias("added"),
    )
    depth = _depth(bits)
    leaves = _combined(hashed, F.col("node")).withColumn("level", F.lit(depth))
    above = F.array(*[F.lit(k) for k in range(depth + 1)])
    spread = leaves.withColumn("level", F.explode(above))
    node = F.call_function("shiftright", F.col("node"), STEP_BITS * (F.lit(depth) - F.col("level")))
    return _combined(spread.withColumn("node", node), F.col("level"), F.col("node"))


def _depth(bits: int) -> int:
    return -(-bits // STEP_BITS)


def differing_leaves(a: DataFrame, b: DataFrame, bits: int) -> DataFrame:
    """``node``: the leaves whose digests differ between two trees of the same ``bits``, found from the root down."""
    digest = ["rows", "mixed", "added"]

    def at(level: int, parents: DataFrame | None) -> DataFrame:
        sides = []
        for tree, name in ((a, "a"), (b, "b")):
            part = tree.filter(F.col("level") == level)
            if parents is not None:
                under = part.withColumn("_parent", F.call_function("shiftright", F.col("node"), F.lit(STEP_BITS)))
                part = under.join(parents.withColumnRenamed("node", "_parent"), "_parent", "left_semi")
            sides.append(part.select("node", F.struct(*digest).alias(name)))
        both = sides[0].join(sides[1], "node", "full_outer")
        return both.filter(~F.col("a").eqNullSafe(F.col("b"))).select("node")

    found = at(0, None)
    for level in range(1, _depth(bits) + 1):
        found = at(level, found)
    return found


def tree_diff(a: DataFrame, b: DataFrame, keys: list[str], bits: int | None = None) -> DataFrame:
    """As ``dataset_diff``, by digests: each side is read twice, and only rows of ranges that differ are shuffled.

    ``keys`` place a row; with several rows of a key all of them are compared. The table of leaves that differ has at most
    2 to the ``MAX_BITS`` rows of one number, so it may be broadcast.
    """
    if bits is None:
        bits = bits_for(a.count())
    if bits > MAX_BITS:
        raise ValueError(f"at most {MAX_BITS} bits, not {bits}")
    leaves = F.broadcast(differing_leaves(digest_tree(a, keys, bits), digest_tree(b, keys, bits), bits))
    return dataset_diff(*[in_leaves(df, leaves, keys, bits) for df in (a, b.select(*a.columns))])


def in_leaves(df: DataFrame, leaves: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """The rows whose keys lie in the given leaves."""
    placed = df.withColumn("_node", leaf_of(keys, bits))
    return placed.join(leaves.withColumnRenamed("node", "_node"), "_node", "left_semi").drop("_node")
