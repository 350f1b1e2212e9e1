"""Line dedup over levelled sorted runs of line hashes.

Documents arrive in batches, those with the largest ids first. A batch is reduced to one row per line key,
anti-joined with the runs on disk, and written as a run of its own: a key that no run holds yet is written with
the largest document holding it (which is final, as later batches only bring smaller ids), a key seen before only
with its further count. Two runs of a level are compacted into one of the next level, so that a batch meets as
many runs as the logarithm of the number of batches. The last compaction decides which lines go.

Only DataFrame functions run here. A line that a third of the documents share is combined before every shuffle,
and the join that marks its occurrences has one row per key on the other side, so adaptive execution can split it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.llm.columns import BLANKS, ascii_lower, ident
from tracklens.session import written

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2


def line_key(line: Column) -> Column:
    """A line without the white space around it, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def occurrences(docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """``did, row, pos, h1, h2`` of every line whose key is long enough; the key is 128 bits of two seeded hashes.

    ``row`` tells rows of one id with different texts apart.
    """
    lines = docs.select(
        ident(id_col).alias("did"),
        F.xxhash64(text_col).alias("row"),
        F.posexplode(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("pos", "line"),
    ).select("did", "row", "pos", line_key(F.col("line")).alias("key"))
    return lines.where(F.char_length("key") >= min_chars).select(
        "did", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )


def batch_keys(lines: DataFrame) -> DataFrame:
    """``h1, h2, docs, last``: how many documents hold a key and the largest of them."""
    return (
        lines.groupBy("h1", "h2", "did")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count("one").alias("docs"), F.max("did").alias("last"))
    )


class LineRuns:
    """The runs by level. ``add`` takes one batch; ``merged`` is the state over all runs."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def _put(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(written(run.sortWithinPartitions("h1", "h2"), f"line-run-{level}"))
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(_compacted(full), level + 1)

    def add(self, keys: DataFrame) -> None:
        """Add the keys of a batch whose documents all have smaller ids than those of earlier batches."""
        runs = [run for level in self.levels for run in level]
        if not runs:
            self._put(keys, 0)
            return
        fresh = keys
        for run in runs:
            fresh = fresh.join(run.select("h1", "h2"), ["h1", "h2"], "left_anti")
        held = F.max("last").alias("last")
        counted = keys.select("h1", "h2", "docs", F.lit(None).cast("long").alias("last"))
        newly = fresh.select("h1", "h2", F.lit(0).cast("long").alias("docs"), "last")
        self._put(counted.unionByName(newly).groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), held), 0)

    def merged(self) -> DataFrame | None:
        runs = [run for level in self.levels for run in level]
        return _compacted(runs) if runs else None


def _compacted(runs: list[DataFrame]) -> DataFrame:
    union = runs[0]
    for run in runs[1:]:
        union = union.unionByName(run)
    return union.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))


def _cuts(lines: DataFrame, batches: int) -> list[int]:
    """Ids that part the lines into batches, largest first; fewer where ids repeat."""
    shares = [i / batches for i in range(batches - 1, 0, -1)]
    found = lines.agg(F.percentile_approx("did", shares, 1000)).first()[0]
    return sorted(set(found or []), reverse=True)


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
) -> DataFrame:
    """Every row of ``docs`` with the repeated lines taken out of its text, plus ``n_lines`` and ``n_dropped``.

    A line goes when its key has at least ``min_chars`` code points, at least ``min_docs`` documents hold it, and
    its document is not the one with the largest id among them. NULL and empty texts are one empty line. Rows of
    one id count as one document, rows without an id as the smallest. A key repeated within its last document
    stays each time. All other columns pass through; columns of the input named like an added one are replaced.
    """
    lines = written(occurrences(docs, id_col, text_col, min_chars), "lines")
    runs, high = LineRuns(), None
    for low in [*_cuts(lines, batches), None]:
        part = lines if high is None else lines.where(F.col("did") < high)
        runs.add(batch_keys(part if low is None else part.where(F.col("did") >= low)))
        high = low
    repeated = runs.merged().where(F.col("docs") >= min_docs).select("h1", "h2", "last")
    gone = (
        lines.join(repeated, ["h1", "h2"])
        .where(F.col("did") < F.col("last"))
        .groupBy(F.col("did").alias("ld_did"), F.col("row").alias("ld_gone_row"))
        .agg(F.collect_set("pos").alias("ld_gone"))
    )
    kept_columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    split = docs.select(
        *[F.col(f"`{c}`") for c in kept_columns if c != text_col],
        ident(id_col).alias("ld_key"),
        F.xxhash64(text_col).alias("ld_row"),
        F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1).alias("ld_lines"),
    )
    joined = split.join(gone, (split.ld_key == gone.ld_did) & (split.ld_row == gone.ld_gone_row), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("ld_lines") - 1), F.col("ld_gone"))
    kept = F.when(F.col("ld_gone").isNull(), F.col("ld_lines")).otherwise(
        F.transform(left, lambda i: F.get(F.col("ld_lines"), i))
    )
    return joined.select(
        *[F.array_join(kept, "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in kept_columns],
        F.size("ld_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("ld_gone"), F.lit(0)).cast("long").alias("n_dropped"),
    )
