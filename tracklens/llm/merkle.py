"""A Merkle manifest of a data set: a tree of SHA-256 digests per group, the groups' roots under one root, a proof per row.

Slot pivot: the children of a parent are spread into slot columns by conditional aggregates. Concatenating the columns
gives the text to hash; leaving out the own column gives a child's siblings. One shuffle serves ``LEVELS`` levels: a parent ``LEVELS``
up has ``FANOUT ** LEVELS`` slots, and the levels between are columns computed from them. The slots of a round are
written to the shared folder, read once on the way up and once on the way down.

Children are numbered by a range partition of (group, order) and the counts of its parts, so a group that holds most
of the rows is spread like any other, rows repeated many times included. Everything runs in built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tracklens.llm.columns import narrowed
from tracklens.session import written

FANOUT = 2
LEVELS = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts: Column) -> Column:
    """The lowercase hex SHA-256 of texts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value: no two lists of fields read the same."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    return sha(*[framed(f) for f in fields])


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``at``, the row's place among those of its ``key`` in ascending ``order``, and ``n``, how many there are.

    The parts of a range partition are numbered by the counts of the parts before them; a row's own number splits
    rows that are otherwise equal.
    """
    ranged = rows.withColumn("_row", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange("key", *order, "_row").sortWithinPartitions("key", *order, "_row").drop("_row")
    placed = written(ranged.withColumn("_place", F.monotonically_increasing_id()), "merkle-rows")
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    stretches = placed.groupBy("key", "_part").agg(F.min("_place").alias("_first"), F.count("*").alias("_size"))
    before = W.partitionBy("key").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    stretches = stretches.select(
        "key",
        "_part",
        (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_size").over(W.partitionBy("key")).alias("n"),
    )
    joined = placed.join(stretches, ["key", "_part"])
    return joined.withColumn("at", F.col("_place") + F.col("_shift")).drop("_place", "_part", "_shift")


class Slots:
    """One round: the nodes of a level gathered under parents ``levels`` above them."""

    def __init__(self, nodes: DataFrame, payload: list[str], fanout: int, levels: int):
        self.fanout, self.levels, self.width = fanout, levels, fanout**levels
        own = F.struct("h", *payload)
        gathered = nodes.groupBy("key", "n", F.expr(f"at div {self.width}").alias("g")).agg(
            *[F.max(F.when(F.col("at") % self.width == j, own)).alias(f"s{j}") for j in range(self.width)]
        )
        for level in range(1, levels + 1):
            gathered = gathered.withColumns({f"x{level}_{m}": self._parent(level, m) for m in range(self._nodes(level))})
        self.table = written(gathered, "merkle-slots")

    def _nodes(self, level: int) -> int:
        return self.fanout ** (self.levels - level)

    def _count(self, level: int) -> Column:
        """How many nodes the key has at a level of this round."""
        span = self.fanout**level
        return F.expr(f"(n + {span - 1}) div {span}")

    def _node(self, level: int, m: int) -> Column:
        return F.col(f"x{level}_{m}") if level else F.col(f"s{m}.h")

    def _parent(self, level: int, m: int) -> Column:
        """The digest over the slots of a run; a node that is alone at its level is the root and stays as it is."""
        run = [self._node(level - 1, m * self.fanout + k) for k in range(self.fanout)]
        digest = F.when(self._count(level - 1) > 1, sha(*[F.coalesce(c, F.lit("")) for c in run])).otherwise(run[0])
        return F.when(run[0].isNotNull(), digest)

    def parents(self) -> DataFrame:
        """``key, at, n, h`` of the level above this round."""
        return self.table.select(
            "key", F.col("g").alias("at"), self._count(self.levels).alias("n"), self._node(self.levels, 0).alias("h")
        )

    def _siblings(self, slot: int) -> Column:
        """What stands left and right of the slot's ancestor in its run, level by level."""
        steps = []
        for level in range(self.levels):
            own = slot // self.fanout**level
            base = own // self.fanout * self.fanout
            left = [F.coalesce(self._node(level, m), F.lit("")) for m in range(base, own)]
            right = [F.coalesce(self._node(level, m), F.lit("")) for m in range(own + 1, base + self.fanout)]
            both = F.struct(F.concat(F.lit(""), *left).alias("left"), F.concat(F.lit(""), *right).alias("right"))
            steps.append(F.when(self._count(level) > 1, both))
        return F.filter(F.array(*steps), lambda s: s.isNotNull())

    def children(self, above: DataFrame) -> DataFrame:
        """The nodes of this round's lower level with their payload and proof; ``above`` has ``key, at, proof`` and more."""
        extra = [c for c in above.columns if c not in ("key", "at", "proof")]
        above = above.withColumnsRenamed({"at": "g", "proof": "_above"})
        slots = [
            F.when(
                F.col(f"s{j}").isNotNull(),
                F.struct(F.col(f"s{j}").alias("own"), F.lit(j).alias("slot"), self._siblings(j).alias("near")),
            )
            for j in range(self.width)
        ]
        near = self.table.select("key", "g", F.filter(F.array(*slots), lambda s: s.isNotNull()).alias("slots"))
        spread = near.join(above, ["key", "g"]).select("key", "g", "_above", *extra, F.explode("slots").alias("c"))
        return spread.select(
            "key",
            (F.col("g") * self.width + F.col("c.slot")).alias("at"),
            F.concat("c.near", "_above").alias("proof"),
            "c.own.*",
            *extra,
        )


def _rounds(nodes: DataFrame, payload: list[str], fanout: int, levels: int) -> list[Slots]:
    """Rounds from the leaves up until every key has one node; at least one."""
    made = [Slots(nodes, payload, fanout, levels)]
    while (made[-1].parents().agg(F.max("n")).first()[0] or 1) > 1:
        made.append(Slots(made[-1].parents(), [], fanout, levels))
    return made


def _down(rounds: list[Slots], above: DataFrame) -> DataFrame:
    for step in reversed(rounds[1:]):
        above = step.children(above).drop("h")
    return rounds[0].children(above)


def manifest(
    docs: DataFrame, leaves: dict[str, Column], group_col: str = "lang", order_col: str = "doc_id",
    fanout: int = FANOUT, levels: int = LEVELS,
) -> DataFrame:
    """One row per input row: the order column, ``leaves``, ``subroot``, ``root`` and ``proof``.

    ``leaves`` names digests over the columns of ``docs``; the first is the tree's leaf, the others come along. Rows of a
    group ascend by the order column, NULL first, ties by leaf; groups ascend by name as UTF-8 bytes, the NULL
    group first. ``proof`` is an array from leaf to root of what stands ``left`` and ``right`` of the row's node in its run.
    Repeated rows are leaves each. An empty table gives no rows. Other columns of ``docs`` are ignored.
    """
    key = F.coalesce(F.concat(F.lit("v"), F.col(f"`{group_col}`").cast("string")), F.lit(""))
    first, *others = leaves
    rows = docs.select(
        key.alias("key"), F.col(f"`{order_col}`").alias("_order"), *[c.alias(f"_{name}") for name, c in leaves.items()]
    )
    nodes = numbered(rows, ["_order", f"_{first}"]).withColumnRenamed(f"_{first}", "h")
    rounds = _rounds(nodes, ["_order", *[f"_{o}" for o in others]], fanout, levels)
    groups = rounds[-1].parents().select(F.lit("").alias("key"), F.col("key").alias("_group"), "h")
    top = _rounds(numbered(groups, ["_group"]), ["_group"], fanout, levels)
    root = top[-1].parents().select("key", "at", F.expr("CAST(array() AS ARRAY<STRUCT<left: STRING, right: STRING>>)").alias("proof"), F.col("h").alias("root"))
    subroots = _down(top, root).select(
        F.col("_group").alias("key"), F.lit(0).cast("long").alias("at"), "proof", "root", F.col("h").alias("subroot")
    )
    return _down(rounds, subroots).select(
        F.col("_order").alias(order_col),
        F.col("h").alias(first),
        *[F.col(f"_{o}").alias(o) for o in others],
        "subroot",
        "root",
        "proof",
    )


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda h, s: sha(s["left"], h, s["right"]))


def siblings_digest(proof: Column) -> Column:
    """The digest over all siblings, level by level, left to right."""
    return sha(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""))


def document_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of the documents table, and each proof tried on a row that may have been tampered with.

    Where 7 divides the CRC-32 of the decimal id, tampering adds 1 to ``n_chars``; a NULL stays NULL.
    """
    docs = narrowed(docs, **{f: f for f in FIELDS})
    columns = {f: F.col(f) for f in FIELDS}
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    tampered = F.when(hit & F.col("n_chars").isNotNull(), leaf(*(columns | {"n_chars": F.col("n_chars") + 1}).values()))
    made = manifest(docs, {"leaf": leaf(*columns.values()), "tampered": tampered})
    folded = made.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    return folded.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        siblings_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
