"""A catalogue kept by a change feed.

Each micro-batch appends only its last change per id, in a folder of its own; a replayed batch
overwrites that folder with the same rows. Readers merge the base with the changes after it, and
``compact`` folds them into a new base version, so no batch ever rewrites the catalogue and no
source is overwritten. A version keeps the last change of every id it has folded, removals included, and the batch it
reaches, so that an older change arriving later still loses.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.operators.catalogue import BOOK_COLUMNS, apply_changes


def write_base(df: DataFrame, root: str, version: int = 0) -> None:
    df.write.mode("errorifexists").parquet(f"{root}/base/version={version}")


def stream_apply_changes(sdf: DataFrame, root: str) -> None:
    """Run the available changes (``op``, ``seq`` and the row) into the change folders under ``root``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        last = batch.groupBy("id").agg(F.max_by(F.struct(*[c for c in batch.columns if c != "id"]), "seq").alias("_last"))
        last.select("id", "_last.*").write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")

    query = (
        sdf.select("op", "seq", *BOOK_COLUMNS)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{root}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing has been written; any other fault is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _changes(spark: SparkSession, root: str, version: int, after_batch: int | None) -> DataFrame | None:
    """The changes that count for a version: those it has folded and those of later batches."""
    folded = _stored(spark, f"{root}/folded/version={version}")
    later = _stored(spark, f"{root}/changes")
    if after_batch is None and folded is not None:
        after_batch = folded.agg(F.max("batch")).first()[0]
    if later is not None and after_batch is not None:
        later = later.filter(F.col("batch") > after_batch)
    found = [df for df in (folded, later) if df is not None]
    if not found:
        return None
    return found[0] if len(found) == 1 else found[0].unionByName(found[1].select(*found[0].columns))


def current(spark: SparkSession, root: str, version: int = 0, after_batch: int | None = None) -> DataFrame:
    """The catalogue now: base ``version`` with every change after the batch it reaches (or ``after_batch``)."""
    base = spark.read.parquet(f"{root}/base/version={version}")
    changes = _changes(spark, root, version, after_batch)
    return base if changes is None else apply_changes(base, changes.drop("batch"))


def compact(spark: SparkSession, root: str, version: int, after_batch: int | None = None) -> int:
    """Write base ``version + 1`` with the changes so far and return its number."""
    changes = _changes(spark, root, version, after_batch)
    if changes is not None:
        reached = changes.agg(F.max("batch")).first()[0]
        rest = F.struct(*[c for c in changes.columns if c not in ("id", "batch")])
        last = changes.groupBy("id").agg(F.max_by(rest, "seq").alias("_last")).select("id", "_last.*")
        last = last.withColumn("batch", F.lit(reached).cast(changes.schema["batch"].dataType))
        last.write.mode("errorifexists").parquet(f"{root}/folded/version={version + 1}")
    write_base(current(spark, root, version, after_batch), root, version + 1)
    return version + 1
