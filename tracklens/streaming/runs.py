"""Running a stream to files and reading its result back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.streaming.series import state_provider


def append_to(stream: DataFrame, path: str) -> str:
    """Run everything available into Parquet files (append mode; exactly once through the file sink's log)."""
    with state_provider(stream.sparkSession):
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("path", f"{path}/data")
            .option("checkpointLocation", f"{path}/state")
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    return f"{path}/data"


def update_to(stream: DataFrame, path: str) -> str:
    """Run everything available in update mode: each batch's changed rows go to their own folder.

    A replayed batch overwrites only its own folder with the same rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/data/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return f"{path}/data"


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row per key of what ``update_to`` wrote."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_row")).select(*keys, "_row.*")
