"""Session helpers shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def split_count(spark: SparkSession) -> int:
    """How many ranges an ordered computation is cut into: it follows the cluster's shuffle width."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(8, min(width, 4096))


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by the session; a local folder only for local masters."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="cellweave-")
    context.setCheckpointDir(shared)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """One Parquet copy in the shared folder, read back: columns stay prunable, and the files go when the driver's JVM ends.

    What the copy's own plan has shuffled is deleted at once: nothing else reads it.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    context = spark.sparkContext
    path = f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(place)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_at = place
    return back


def forget(df: DataFrame) -> None:
    """Delete the files of a ``written`` frame that nothing reads any more."""
    context = df.sparkSession.sparkContext
    df.written_at.getFileSystem(context._jsc.hadoopConfiguration()).delete(df.written_at, True)


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage and pins values that a recomputation could change.

    Floating sums depend on the order in which shuffle blocks arrive, so a plan that reads such
    a value on several branches reads it from one written copy.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settle_if_floating(df: DataFrame, column: str) -> DataFrame:
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return settle(df)
    return df


def scalar(df: DataFrame) -> Column:
    """One-row, one-column frame as a scalar subquery (no driver round trip, no join)."""
    return df.scalar()


def distinct_total(df: DataFrame, column: str, given=None) -> Column:
    """Number of distinct values of ``column`` unless the caller knows it."""
    if given is None:
        return scalar(df.select(column).distinct().agg(F.count("*").alias("n")))
    return given if isinstance(given, Column) else F.lit(given)
