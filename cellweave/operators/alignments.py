"""Alignments: blocks, feature counting, barcode histograms and digital expression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.operators.lookups import overlap_join


def alignment_blocks(alignments: DataFrame) -> DataFrame:
    """One row per aligned stretch (M, =, X) of each alignment: closed ``start``/``end`` positions."""
    operations = F.regexp_extract_all("cigar", F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1))
    empty = F.struct(
        F.col("pos").cast("bigint").alias("at"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("blocks"))

    def step(state, op):
        size = F.regexp_extract(op, r"(\d+)", 1).cast("bigint")
        kind = F.right(op, F.lit(1))
        block = F.array(F.struct(state.at.alias("start"), (state.at + size - 1).alias("end")))
        return F.struct(
            (state.at + F.when(kind.isin("M", "D", "N", "=", "X"), size).otherwise(0)).alias("at"),
            F.when(kind.isin("M", "=", "X"), F.concat(state.blocks, block)).otherwise(state.blocks).alias("blocks"))

    walked = F.aggregate(operations, empty, step)
    return alignments.withColumn("_b", F.explode(walked.blocks)).withColumns(
        {"start": F.col("_b.start"), "end": F.col("_b.end")}).drop("_b")


def _touched(blocks: DataFrame, exons: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Reads whose blocks touch a gene, with that gene, or ``__ambiguous`` for several: smallest and largest gene decide."""
    hits = overlap_join(blocks.select(*keys, "chrom", "start", "end"), exons, width)
    genes = hits.groupBy(*keys).agg(F.min("gene").alias("_low"), F.max("gene").alias("_high"))
    return genes.select(*keys, F.when(F.col("_low") != F.col("_high"), "__ambiguous").otherwise(F.col("_low").cast("string")).alias("gene"))


def assign_reads(blocks: DataFrame, exons: DataFrame, keys: list[str], width: int = 1000) -> DataFrame:
    """Union mode: a read belongs to the single gene its blocks touch.

    Smallest and largest gene decide between one and several, so no gene list is gathered. Reads
    without any overlap get ``__no_feature``, reads on several genes ``__ambiguous``.
    """
    genes = _touched(blocks, exons, keys, width)
    return blocks.select(*keys).distinct().join(genes, keys, "left").select(*keys, F.coalesce("gene", F.lit("__no_feature")).alias("gene"))


def count_features(alignments: DataFrame, exons: DataFrame, min_mapq: int = 10, width: int = 1000) -> DataFrame:
    """Reads per gene and run, with the summary classes; mates of a pair count as one read.

    One alignment that is not unique or too low decides its read's class, whatever genes the read touches, so only blocks of the
    other alignments meet the exons. Reads that touch no gene need no row there.
    """
    flag = F.col("flag")
    primary = alignments.filter((flag.bitwiseAND(0x900) == 0))
    multi = F.coalesce(F.col("tags")["NH"].cast("int"), F.lit(1)) > 1
    per_read = primary.groupBy("run", "name").agg(
        F.min(F.when(flag.bitwiseAND(4) != 0, 0).otherwise(1)).alias("_all"),
        F.max(F.when(flag.bitwiseAND(4) == 0, 1).otherwise(0)).alias("_any"),
        F.max(multi).alias("_multi"),
        F.min(F.when(flag.bitwiseAND(4) == 0, F.col("mapq"))).alias("_mapq"))
    state = (
        F.when(F.col("_any") == 0, "__not_aligned")
        .when(F.col("_multi"), "__alignment_not_unique")
        .when(F.col("_mapq") < min_mapq, "__too_low_aQual"))
    classed = per_read.select("run", "name", state.alias("_class"))
    open_ones = primary.filter((flag.bitwiseAND(4) == 0) & ~multi & ~F.coalesce(F.col("mapq") < min_mapq, F.lit(False)))
    blocks = alignment_blocks(open_ones.select("run", "name", "chrom", "pos", "cigar"))
    touched = _touched(blocks, exons, ["run", "name"], width)
    return (
        classed.join(touched, ["run", "name"], "left")
        .groupBy("run", F.coalesce("_class", "gene", F.lit("__no_feature")).alias("gene"))
        .agg(F.count("*").alias("count"))
    )


def barcode_histogram(alignments: DataFrame) -> DataFrame:
    """Reads per cell barcode without PCR duplicates."""
    return alignments.filter(~F.col("dup")).groupBy("xc").agg(F.count("*").alias("reads"))


def core_barcodes(alignments: DataFrame, n: int = 2000) -> DataFrame:
    """The ``n`` barcodes with most reads (ties by barcode)."""
    return barcode_histogram(alignments).orderBy(F.desc("reads"), F.asc("xc")).limit(n).select("xc")


def merge_umis(molecules: DataFrame) -> DataFrame:
    """Drop UMIs that differ in one base from a better supported UMI of the same cell and gene.

    Every UMI is written once per masked position; UMIs one base apart share a masked form, and
    the best supported member of each form is found with one combined aggregate.
    """
    masks = molecules.withColumn("_p", F.explode(F.sequence(F.lit(1), F.length("umi")))).withColumn(
        "_mask", F.concat(F.substring(F.col("umi"), F.lit(1), F.col("_p") - 1), F.lit("*"),
                          F.substring(F.col("umi"), F.col("_p") + 1, F.length("umi"))))
    best = masks.groupBy("xc", "gene", "_mask").agg(F.max(F.struct("reads", "umi")).alias("_best"))
    judged = masks.join(best, ["xc", "gene", "_mask"]).groupBy("xc", "gene", "umi", "reads").agg(
        F.max(F.col("_best.umi") != F.col("umi")).alias("_weaker"))
    return judged.filter(~F.col("_weaker")).drop("_weaker")


def digital_expression(alignments: DataFrame, n_barcodes: int = 2000, min_genes: int = 500, merge: bool = False) -> DataFrame:
    """Distinct UMIs per gene and cell for the core barcodes with enough genes."""
    core = alignments.join(core_barcodes(alignments, n_barcodes), "xc", "left_semi").filter(F.col("gene").isNotNull())
    molecules = core.groupBy("xc", "gene", "umi").agg(F.count("*").alias("reads"))
    if merge:
        molecules = merge_umis(molecules)
    counted = molecules.groupBy("gene", F.col("xc").alias("cell")).agg(F.count("*").alias("count"))
    rich = counted.groupBy("cell").agg(F.count("*").alias("_genes")).filter(F.col("_genes") >= min_genes)
    return counted.join(rich, "cell", "left_semi").select("gene", "cell", "count")


def dge_summary(alignments: DataFrame) -> DataFrame:
    """Reads, distinct molecules (gene with UMI) and genes per barcode."""
    molecules = alignments.groupBy("xc", "gene", "umi").agg(F.count("*").alias("n"))
    genes = molecules.groupBy("xc", "gene").agg(F.sum("n").alias("n"), F.count("*").alias("m"))
    return genes.groupBy("xc").agg(
        F.sum("n").alias("reads"), F.sum("m").alias("transcripts"), F.count("*").alias("genes"))
