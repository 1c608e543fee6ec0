"""The expression model bound to the given star-schema tables, in Spark and as SQL text.

gene = part, cell = supplier, count = summed quantity; suppliers carry nation and region as
individual and factor. Texts serve as reads, events as tagged alignments, order dates as intervals.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.context import ensure_checkpoint_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A fresh folder below the shared checkpoint folder, for write-and-read-back queries."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}"


def _quantities(spark: SparkSession, folder: str, gene) -> DataFrame:
    return table(spark, folder, "lineitem").groupBy(gene.alias("gene"), F.col("l_suppkey").alias("cell")).agg(
        F.sum("l_quantity").cast("bigint").alias("count"))


def counts(spark: SparkSession, folder: str) -> DataFrame:
    return _quantities(spark, folder, F.col("l_partkey"))


def counts_dense(spark: SparkSession, folder: str) -> DataFrame:
    """Few genes seen in nearly every cell: all rows, genes folded to 50."""
    return _quantities(spark, folder, F.col("l_partkey") % 50)


def counts_uneven(spark: SparkSession, folder: str) -> DataFrame:
    """Rare and common genes: every fourth part alone, the others folded by the root of their number; a fifth of the common
    genes has twice the quantity in one region."""
    part, third = F.col("l_partkey"), (F.col("l_partkey") * 7 + F.col("l_suppkey") * F.col("l_partkey")) % 3
    gene = F.when(part % 4 == 0, part + 1_000_000_000).otherwise(F.floor(F.sqrt(part.cast("double"))).cast("bigint") * 3 + third)
    raw = _quantities(spark, folder, gene).join(cells(spark, folder).select("cell", "factor"), "cell")
    raised = (F.col("gene") < 1_000_000_000) & (F.col("gene") % 5 == 1) & (F.col("factor") == "MIDDLE EAST")
    return raw.select("gene", "cell", (F.col("count") * F.when(raised, 2).otherwise(1)).cast("bigint").alias("count"))


def run_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Per-run counts: the line number plays the run."""
    return table(spark, folder, "lineitem").groupBy(
        F.col("l_linenumber").cast("string").alias("run"), F.col("l_partkey").alias("gene")
    ).agg(F.sum("l_quantity").cast("bigint").alias("count"))


def cells(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("s_suppkey").alias("cell"), F.col("s_name").alias("id"),
                F.col("n_name").alias("individual"), F.col("r_name").alias("factor"))
    )


def genes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("gene"),
        (F.col("p_brand") == "Brand#13").alias("is_ERCC"),
        (F.col("p_brand") == "Brand#5").alias("is_Mt"),
    )


def annotation(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    return part.select(
        F.concat(F.lit("ENSG"), F.lpad(F.col("p_partkey").cast("string"), 11, "0"), F.lit("."),
                 (F.col("p_size") % 10).cast("string")).alias("ensembl"),
        F.col("p_partkey").alias("gene"),
        F.col("p_name").alias("symbol"),
        (F.col("p_size") * 1000).cast("bigint").alias("len"),
        F.col("p_retailprice").cast("bigint").alias("start"),
        (F.col("p_retailprice").cast("bigint") + F.col("p_size") * 100).alias("end"),
    )


PRINTABLE = "".join(chr(c) for c in range(33, 127))
QUALITY = "".join(chr(33 + c % 41) for c in range(33, 127))


def reads(spark: SparkSession, folder: str) -> DataFrame:
    """Whole document texts reduced to printable characters; quality from the character code."""
    seq = F.regexp_replace("text", "[^!-~]", "")
    return table(spark, folder, "documents").select(
        F.col("source").alias("run"), F.lit(1).alias("mate"), F.col("doc_id").alias("read_idx"),
        F.concat(F.lit("r"), F.col("doc_id").cast("string")).alias("name"),
        seq.alias("seq"), F.translate(seq, PRINTABLE, QUALITY).alias("qual"))


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as interleaved records of one run per conversation."""
    seq = F.regexp_replace("text", "[^!-~]", "")
    return table(spark, folder, "conversations").select(
        F.col("conv_id").cast("string").alias("run"), F.col("turn").alias("read_idx"), F.col("role").alias("name"),
        seq.alias("seq"), F.translate(seq, PRINTABLE, QUALITY).alias("qual"))


def tagged(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("read"), F.col("user_id").alias("xc"), F.col("event_type").alias("gene"),
        F.get_json_object("props", "$.k").alias("umi"), (F.col("value") < 20).alias("dup"))


def _days(column: str):
    return F.date_diff(F.col(column).cast("date"), F.lit("1995-01-01").cast("date")).cast("bigint")


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    start = _days("l_shipdate")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("read"), F.col("l_linenumber").cast("bigint").alias("part"),
        F.col("l_partkey").alias("chrom"), start.alias("start"),
        (start + F.col("l_quantity").cast("bigint") - 1).alias("end"))


def exons(spark: SparkSession, folder: str) -> DataFrame:
    start = _days("o_orderdate")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("gene"), F.col("o_custkey").alias("chrom"), start.alias("start"), (start + 3).alias("end"))


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Dense assay: one row per vector and position."""
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("cell"), F.posexplode("embedding").alias("gene", "value")
    ).select(F.col("gene").cast("bigint").alias("gene"), "cell", F.col("value").cast("double").alias("value"))


def vector_cells(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("cell"), F.col("label").cast("string").alias("batch"))


def event_p(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    top = events.agg(F.max("value").alias("m")).scalar()
    return events.select(F.col("event_id").alias("gene"), (F.col("value") / top).alias("p_value"), "value")


def marker_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbouring parts as marker pairs; the phase follows the part size."""
    part = table(spark, folder, "part")
    phase = F.element_at(F.array(F.lit("G1"), F.lit("G2M"), F.lit("S")), (F.col("p_size") % 3 + 1).cast("int"))
    return part.select(phase.alias("phase"), F.col("p_partkey").alias("first"), (F.col("p_partkey") + 1).alias("second"))


# SQL text of the same bindings, as common table expressions.
SQL = {
    "counts": "counts AS (SELECT l_partkey AS gene, l_suppkey AS cell, CAST(SUM(l_quantity) AS BIGINT) AS count FROM lineitem GROUP BY 1, 2)",
    "dense": "counts AS (SELECT l_partkey % 50 AS gene, l_suppkey AS cell, CAST(SUM(l_quantity) AS BIGINT) AS count FROM lineitem GROUP BY 1, 2)",
    "uneven": """uneven AS (SELECT gene, cell, CAST(count * CASE WHEN gene < 1000000000 AND gene % 5 = 1 AND factor = 'MIDDLE EAST' THEN 2 ELSE 1 END AS BIGINT) AS count
FROM (SELECT CASE WHEN l_partkey % 4 = 0 THEN l_partkey + 1000000000 ELSE CAST(floor(sqrt(l_partkey)) AS BIGINT) * 3 + (l_partkey * 7 + l_suppkey * l_partkey) % 3 END AS gene,
l_suppkey AS cell, SUM(l_quantity) AS count FROM lineitem GROUP BY 1, 2) JOIN cells USING (cell))""",
    "run_counts": "run_counts AS (SELECT CAST(l_linenumber AS VARCHAR) AS run, l_partkey AS gene, CAST(SUM(l_quantity) AS BIGINT) AS count FROM lineitem GROUP BY 1, 2)",
    "cells": "cells AS (SELECT s_suppkey AS cell, s_name AS id, n_name AS individual, r_name AS factor FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)",
    "genes": "genes AS (SELECT p_partkey AS gene, p_brand = 'Brand#13' AS is_ERCC, p_brand = 'Brand#5' AS is_Mt FROM part)",
    "annotation": "annotation AS (SELECT concat('ENSG', lpad(CAST(p_partkey AS VARCHAR), 11, '0'), '.', CAST(p_size % 10 AS VARCHAR)) AS ensembl, p_partkey AS gene, p_name AS symbol, CAST(p_size * 1000 AS BIGINT) AS len, CAST(floor(p_retailprice) AS BIGINT) AS \"start\", CAST(floor(p_retailprice) AS BIGINT) + p_size * 100 AS \"end\" FROM part)",
    "library": "library AS (SELECT cell, SUM(count) AS total_counts FROM counts GROUP BY cell)",
    "size": "size AS (SELECT COUNT(DISTINCT cell) AS n_cells, COUNT(DISTINCT gene) AS n_genes FROM counts)",
    "reads": "reads AS (SELECT source AS run, doc_id AS read_idx, regexp_replace(text, '[^!-~]', '', 'g') AS seq FROM documents)",
    "qualities": "qualities AS (SELECT run, read_idx, seq, list_transform(string_split(seq, ''), lambda c: ascii(c) % 41) AS q FROM reads)",
    "tagged": "tagged AS (SELECT event_id AS read, user_id AS xc, event_type AS gene, json_extract_string(props, '$.k') AS umi, value < 20 AS dup FROM events)",
    "blocks": "blocks AS (SELECT l_orderkey AS read, CAST(l_linenumber AS BIGINT) AS part, l_partkey AS chrom, date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS s, date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) + CAST(l_quantity AS BIGINT) - 1 AS e FROM lineitem)",
    "exons": "exons AS (SELECT o_orderkey AS gene, o_custkey AS chrom, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS s, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 3 AS e FROM orders)",
    "vectors": "vectors AS (SELECT CAST(i AS BIGINT) AS gene, vec_id AS cell, CAST(embedding[i + 1] AS DOUBLE) AS value FROM embeddings, range(0, 64) t(i))",
    "p": "p AS (SELECT event_id AS gene, value / (SELECT MAX(value) FROM events) AS p_value, value FROM events)",
    "pairs": "pairs AS (SELECT ['G1', 'G2M', 'S'][p_size % 3 + 1] AS phase, p_partkey AS first, p_partkey + 1 AS second FROM part)",
}


def sql(names: str, body: str) -> str:
    """``WITH`` the named bindings, then the body (which may add its own after a comma)."""
    parts = ", ".join(SQL[n] for n in names.split())
    return f"WITH {parts}{body}" if body.startswith(",") else f"WITH {parts} {body}"
