"""A versioned table kept by change feeds, in buckets of the id.

Under the root:

* ``base/version=V/bucket=B``: rows of a bucket as of the compaction that last touched it, removals kept as tombstones;
* ``changes/stream=S/batch=N/bucket=B``: the last change per id of a micro-batch; a replayed batch overwrites only its folder;
* ``manifest/buckets/version=V``: which base version holds each bucket; ``manifest/streams``: the batch of each stream that a
  version has folded; ``manifest/filters``: a Bloom filter per bucket; ``manifest/horizon``: the oldest change still taken.

The buckets' table is written last, and a version is there once it is. A reader opens the folders the manifest names and the
changes after it, so its cost after a compaction depends on the newer changes alone; a compaction rewrites only buckets
that have changes. A row keeps the ``seq`` of its last change, so an older change that comes later loses. Tombstones leave when
a compaction is given a horizon; from then on changes before it are set apart in ``late`` and not applied.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
WORD = 32_768  # bits of the built-in bitmap
BITS_PER_ROW = 10
PROBES = 3


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing has been written; any other fault is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def bucket_of(id_: Column, buckets: Column | int) -> Column:
    return F.pmod(F.xxhash64(id_), buckets if isinstance(buckets, Column) else F.lit(buckets)).cast("int")


def create(df: DataFrame, root: str, seq_type: str, buckets: int = BUCKETS) -> None:
    """Version 0 from ``df`` (``id`` and more columns); ``seq_type`` is the type of the changes' ``seq``."""
    rows = df.withColumns(
        {"seq": F.lit(None).cast(seq_type), "removed": F.lit(False), "bucket": bucket_of(F.col("id"), buckets)}
    )
    _write_base(rows, root, 0)
    spark = df.sparkSession
    none = spark.createDataFrame([], "stream string, reached int")
    numbers = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(0).alias("base"))
    _commit(spark, root, 0, numbers, none, None)


def _write_base(rows: DataFrame, root: str, version: int) -> None:
    """The rows of whole buckets, a file or more per bucket, and the filter over each bucket's ids."""
    path = f"{root}/base/version={version}"
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    spark = rows.sparkSession
    made = spark.read.schema(rows.schema).parquet(path)
    sizes = made.groupBy("bucket").agg(F.greatest(F.lit(1), F.ceil(F.count("*") * BITS_PER_ROW / WORD)).alias("words"))
    bits = made.select("bucket", "id").join(F.broadcast(sizes), "bucket")  # one row per bucket
    bits = bits.select("bucket", "words", F.explode(_positions(F.col("id"), F.col("words"))).alias("at"))
    filters = bits.groupBy("bucket", "words", F.floor(F.col("at") / WORD).alias("word")).agg(
        F.bitmap_construct_agg(F.col("at") % WORD).alias("bitmap")
    )
    filters.write.mode("overwrite").parquet(f"{root}/manifest/filters/version={version}")


def _positions(id_: Column, words: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(id_, F.lit(k)), (words * WORD).cast("long")) for k in range(PROBES)])


def _commit(
    spark: SparkSession, root: str, version: int, buckets: DataFrame, streams: DataFrame, horizon: Column | None
) -> None:
    streams.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/streams/version={version}")
    if horizon is not None:
        one = spark.range(1).select(horizon.alias("horizon"))
        one.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/horizon/version={version}")
    buckets.coalesce(1).write.mode("errorifexists").parquet(f"{root}/manifest/buckets/version={version}")


def latest_version(spark: SparkSession, root: str) -> int:
    return spark.read.parquet(f"{root}/manifest/buckets").agg(F.max("version")).first()[0]


class Snapshot:
    """What a version names, and the changes after it; at most one row per bucket and per stream reaches the driver."""

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        self.spark, self.root = spark, root
        self.version = latest_version(spark, root) if version is None else version
        at = lambda table: f"{root}/manifest/{table}/version={self.version}"
        self.base = {r.bucket: r.base for r in spark.read.parquet(at("buckets")).collect()}
        self.reached = {r.stream: r.reached for r in spark.read.parquet(at("streams")).collect()}
        found = stored(spark, f"{root}/changes")
        if found is not None:
            newer = [(F.col("stream") != s) | (F.col("batch") > r) for s, r in self.reached.items()]
            found = reduce(DataFrame.filter, newer, found)
        self.changes = found
        self.touched = [] if found is None else [r[0] for r in found.select("bucket").distinct().collect()]

    def rows(self, buckets: list[int]) -> DataFrame:
        """The base rows of some buckets; only their folders are read."""
        held: dict[int, list[int]] = {}
        for b in buckets:
            held.setdefault(self.base[b], []).append(b)
        base = self.spark.read.parquet(f"{self.root}/base")
        here = [(F.col("version") == v) & F.col("bucket").isin(bs) for v, bs in held.items()]
        return base.filter(reduce(lambda a, b: a | b, here, F.lit(False))).drop("version")

    def merged(self, buckets: list[int]) -> DataFrame:
        """Rows and tombstones of touched buckets with their changes: the one with the largest ``seq`` per id."""
        base = self.rows(buckets)
        changes = self.changes.filter(F.col("bucket").isin(buckets))
        changes = changes.withColumn("removed", F.col("op") == "remove").select(*base.columns)
        rest = [c for c in base.columns if c not in ("bucket", "id")]
        newest = base.unionByName(changes).groupBy("bucket", "id").agg(F.max_by(F.struct(*rest), F.struct("seq")).alias("_last"))
        return newest.select("bucket", "id", "_last.*")

    def current(self, buckets: list[int] | None = None) -> DataFrame:
        """The table now: touched buckets merged, the others as they stand."""
        wanted = list(self.base) if buckets is None else buckets
        touched = [b for b in wanted if b in self.touched]
        parts = self.rows([b for b in wanted if b not in self.touched])
        if touched:
            parts = parts.unionByName(self.merged(touched).select(*parts.columns))
        return parts.filter(~F.col("removed")).drop("seq", "removed", "bucket")


def current(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    return Snapshot(spark, root, version).current()


def stream_into(sdf: DataFrame, root: str, stream: str, checkpoint: str | None = None) -> None:
    """Run the available changes (``op``, ``seq``, ``id`` and the row) into the change folders of a named stream."""
    spark = sdf.sparkSession
    buckets = spark.read.parquet(f"{root}/manifest/buckets/version=0").count()

    def write(batch: DataFrame, batch_id: int) -> None:
        horizon = stored(batch.sparkSession, f"{root}/manifest/horizon")
        if horizon is not None:
            oldest = horizon.agg(F.max("horizon")).scalar()
            too_old = batch.filter(F.coalesce(F.col("seq") < oldest, F.lit(False)))
            too_old.write.mode("overwrite").parquet(f"{root}/late/stream={stream}/batch={batch_id}")
            batch = batch.filter(F.coalesce(F.col("seq") >= oldest, F.lit(True)))
        rest = F.struct(*[c for c in batch.columns if c != "id"])
        last = batch.groupBy("id").agg(F.max_by(rest, F.struct("seq")).alias("_last")).select("id", "_last.*")
        last = last.withColumn("bucket", bucket_of(F.col("id"), buckets))
        path = f"{root}/changes/stream={stream}/batch={batch_id}"
        last.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)

    query = (
        sdf.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint or f"{root}/state/{stream}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def compact(spark: SparkSession, root: str, horizon: Column | None = None) -> int:
    """Fold the changes so far into a new version, rewriting the buckets that have any, and return its number.

    With a ``horizon`` (a value of ``seq``) tombstones of older changes leave the buckets that are rewritten, and changes before it
    are no longer taken.
    """
    now = Snapshot(spark, root)
    version = now.version + 1
    reached = dict(now.reached)
    if now.touched:
        for r in now.changes.groupBy("stream").agg(F.max("batch").alias("batch")).collect():
            reached[str(r.stream)] = r.batch
        rows = now.merged(now.touched)
        if horizon is not None:
            rows = rows.filter(~(F.col("removed") & F.coalesce(F.col("seq") < horizon, F.lit(False))))
        _write_base(rows, root, version)
    buckets = [(b, version if b in now.touched else held) for b, held in now.base.items()]
    _commit(
        spark,
        root,
        version,
        spark.createDataFrame(buckets, "bucket int, base int"),
        spark.createDataFrame(list(reached.items()), "stream string, reached int"),
        horizon,
    )
    return version


def possible_buckets(now: Snapshot, ids: DataFrame) -> list[int]:
    """The buckets whose base may hold one of the ids, by the buckets' filters."""
    spark = now.spark
    homes = spark.createDataFrame(list(now.base.items()), "bucket int, version int")
    filters = spark.read.parquet(f"{now.root}/manifest/filters")
    sizes = filters.select("version", "bucket", "words").distinct().join(homes, ["version", "bucket"])  # one per bucket
    probes = ids.select("id").distinct().withColumn("bucket", bucket_of(F.col("id"), len(now.base)))
    probes = probes.join(F.broadcast(sizes), "bucket")
    probes = probes.withColumn("at", F.explode(_positions(F.col("id"), F.col("words"))))
    probes = probes.withColumn("word", F.floor(F.col("at") / WORD))
    met = probes.join(filters.select("version", "bucket", "word", "bitmap"), ["version", "bucket", "word"])
    bit = F.col("at") % WORD
    byte = F.conv(F.hex(F.substring("bitmap", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    hits = met.filter(is_set).groupBy("bucket", "id").agg(F.count_distinct("at").alias("n"))
    asked = probes.groupBy("bucket", "id").agg(F.count_distinct("at").alias("n"))
    return [r[0] for r in hits.join(asked, ["bucket", "id", "n"]).select("bucket").distinct().collect()]


def lookup(spark: SparkSession, root: str, ids: DataFrame) -> DataFrame:
    """The current rows of some ids: only buckets with changes, or whose filter says that they may hold one, are read."""
    now = Snapshot(spark, root)
    homes = [r[0] for r in ids.select(bucket_of(F.col("id"), len(now.base))).distinct().collect()]  # one row per bucket
    may = set(possible_buckets(now, ids))
    wanted = [b for b in homes if b in now.touched or b in may]
    return now.current(wanted).join(ids.select("id").distinct(), "id", "left_semi")
