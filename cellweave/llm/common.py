"""Shared helpers of the text operators."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.context import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = "\\x20\\x09-\\x0D"
_RECORDERS: list[list[DataFrame]] = []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that the cluster shares (``spark.checkpoint.dir``)."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back: compact, and it cuts lineage."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    if _RECORDERS:
        _RECORDERS[-1].append(out)
    return out


@contextmanager
def recorded(into: list[DataFrame]) -> Iterator[None]:
    """Note the frames stored inside, so that they can be discarded when nothing reads them any more."""
    _RECORDERS.append(into)
    try:
        yield
    finally:
        _RECORDERS.pop()


def alone(body: Callable[[], tuple[DataFrame, list[DataFrame]]]) -> DataFrame:
    """Result of ``body``, which also names the stored frames that the result reads; all others it stored are discarded."""
    made: list[DataFrame] = []
    with recorded(made):
        result, read = body()
    kept = {id(df) for df in read}
    discard(*[df for df in made if id(df) not in kept])
    if _RECORDERS:
        _RECORDERS[-1].extend(read)
    return result


def discard(*frames: DataFrame) -> None:
    """Delete the files of stored frames that nothing reads any more."""
    for df in frames:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now: its cleaner acts when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound what one Arrow batch of whole texts holds."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda variable is not inlined again."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only; pure ASCII texts take the fast built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
