"""Incremental ingestion of count files and running cell totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cellweave.sources.readers import parsed_counts


METRICS = "count_files"


def _stream_lines(spark: SparkSession, folder: str, batch_size: int) -> DataFrame:
    lines = spark.readStream.option("maxFilesPerTrigger", batch_size).option("ignoreCorruptFiles", "true").text(folder)
    return parsed_counts(lines.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")))


def stream_counts(spark: SparkSession, folder: str, batch_size: int = 100) -> DataFrame:
    """Stream ``counts_raw(run, gene, count)``: ``batch_size`` new files per micro-batch.

    The checkpoint of the writing query remembers finished files, which is the skip rule. Lines without a count are left out, as in
    batch reading; every progress report of the query counts them (``lines_of``), and ``stream_damaged`` streams the lines themselves.
    """
    lines = _stream_lines(spark, folder, batch_size).observe(
        METRICS, F.count("gene").alias("rows"), F.count_if(F.col("gene").isNull()).alias("malformed"))
    return lines.filter(F.col("gene").isNotNull() & ~F.col("gene").startswith("__")).select("run", "gene", "count")


def stream_damaged(spark: SparkSession, folder: str, batch_size: int = 100) -> DataFrame:
    """Stream ``(path, run, line)`` of lines that ``stream_counts`` leaves out, for a side table."""
    return _stream_lines(spark, folder, batch_size).filter(F.col("gene").isNull()).select("path", "run", "line")


def lines_of(query: StreamingQuery) -> dict[str, int]:
    """Rows and malformed lines of the reported micro-batches of a query on ``stream_counts``."""
    total = {"rows": 0, "malformed": 0}
    for report in query.recentProgress:
        seen = report.observedMetrics.get(METRICS)
        if seen is not None:
            for name in total:
                total[name] += seen[name]
    return total


def ingest_counts(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append to parquet; the file sink's commit log makes a repeated micro-batch harmless."""
    return (
        stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).outputMode("append").start()
    )


def stream_cell_totals(stream: DataFrame) -> DataFrame:
    """Running total and number of detected genes per run (a run is one cell until it is named)."""
    return stream.groupBy("run").agg(
        F.sum("count").alias("total_counts"), F.count_if(F.col("count") > 0).alias("total_features"))


def write_cell_totals(totals: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Keep the current totals table: complete output, replaced per micro-batch."""
    def replace(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    return (
        totals.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(replace).start()
    )
