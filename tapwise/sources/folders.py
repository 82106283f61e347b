"""The shared folder for checkpoints and intermediate tables."""

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`; a local one in local mode only."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tapwise-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Make `checkpoint()` usable where the session names no folder yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Drop the shuffle files of each job in the block when it has ended, not when the driver collects its garbage.

    For jobs whose result is written and that are not run again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written_once(df: DataFrame, name: str, *partitions: str) -> DataFrame:
    """`df` as a table written to the shared folder, for several passes over an expensive plan.

    Unlike a cache it outlives its executors, and each pass reads only the columns, and the given
    partitions, that it needs. The folder is left to the cluster's own clean-up.
    """
    path = run_folder(df.sparkSession, name)
    df.write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
