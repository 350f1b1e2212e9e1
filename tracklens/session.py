"""Session defaults and the shared folder that written intermediates go to."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def local_session(app: str = "tracklens", cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new, empty folder name under the cluster's shared checkpoint folder.

    The root comes from ``spark.checkpoint.dir``. Where it is unset the session must be a local
    one (tests), which then gets a temporary root of its own; on a cluster an unset root is an error
    because executors could not see each other's files.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        root = _local_roots.get(spark.sparkContext.applicationId) or tempfile.mkdtemp(prefix="tracklens-")
        _local_roots[spark.sparkContext.applicationId] = root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: what follows starts from files any executor can reread.

    For a frame that later steps use several times; the alternative is to compute it each time.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for sessions where it is not installed."""
    context = spark.sparkContext
    name = "tracklens.zip"
    if any(str(f).endswith(name) for f in context.listFiles):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="tracklens-code-")) / "tracklens"
    context.addPyFile(shutil.make_archive(str(target), "zip", root, "tracklens"))
