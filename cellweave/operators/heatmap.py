"""Gene x cell heat map: centred values of chosen genes, rows and columns in the leaf order of their Ward trees."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.context import scalar, settle
from cellweave.operators.clustering import leaf_order, numbered_sets, ward
from cellweave.operators.distance import euclidean
from cellweave.operators.grids import spread
from cellweave.operators.ranking import restrict_genes


def with_silent(assay: DataFrame, genes: DataFrame, cells: DataFrame, value: str = "value") -> DataFrame:
    """``(gene, cell, value)`` of the chosen genes and cells; a gene or cell without any value gets one stored zero, so that it stays."""
    names, columns = genes.select("gene").distinct(), cells.select("cell").distinct()
    chosen = restrict_genes(assay, names).join(columns, "cell", "left_semi").select("gene", "cell", F.col(value).cast("double").alias("value"))
    zero = F.lit(0.0).alias("value")
    chosen = chosen.unionByName(columns.join(chosen, "cell", "left_anti").select(scalar(names.agg(F.min("gene"))).alias("gene"), "cell", zero))
    chosen = chosen.unionByName(names.join(chosen, "gene", "left_anti").select("gene", scalar(columns.agg(F.min("cell"))).alias("cell"), zero))
    return chosen.dropna(subset=["gene", "cell"])


def gene_distances(assay: DataFrame, means: DataFrame, n) -> DataFrame:
    """Euclidean distances between centred genes from stored values only: ``(i, j, d)``.

    Centring takes ``n`` times the squared difference of the means from a squared distance.
    """
    pairs = euclidean(assay.select(F.col("cell").alias("gene"), F.col("gene").alias("cell"), "value"))
    shift = F.col("m_i") - F.col("m_j")
    named = lambda side: means.select(F.col("gene").alias(side), F.col("mean").alias(f"m_{side}"))
    return pairs.join(named("i"), "i").join(named("j"), "j").withColumn("_n", n).select(
        "i", "j", F.sqrt(F.greatest(F.col("d") * F.col("d") - F.col("_n") * shift * shift, F.lit(0.0))).alias("d"))


def heatmap_matrix(assay: DataFrame, genes: DataFrame, cells: DataFrame, label: str, value: str = "value", variant: str = "ward.D") -> DataFrame:
    """``(gene, cell, gene_position, cell_position, value, label)`` for every chosen gene and cell.

    Equal cells merge first in their tree, so one of them stands for all in the distances. Values are centred by gene. Centring moves all cells of a gene alike, so distances between cells need stored values only, and the
    trees are grown without the dense matrix. That is spread at the end only: each gene over its places 1 to n, without a join
    of genes with cells; stored values then meet their place.
    """
    genes = settle(genes.select("gene").distinct())  # a choice by floating values is made once
    stored = settle(with_silent(assay, genes, cells, value))
    n = scalar(cells.select("cell").distinct().agg(F.count("*")))
    means = settle(stored.groupBy("gene").agg(F.sum("value").alias("_s")).withColumn("_n", n).select("gene", "_n", (F.col("_s") / F.col("_n")).alias("mean")))
    equal = settle(equal_cells(stored))
    apart = stored.join(equal.filter("k > 1").select(F.col("c").alias("cell")), "cell", "left_anti")
    across = settle(_places(stored, lambda: euclidean(apart), "cell", variant, equal))
    down = _places(means, lambda: gene_distances(stored, means, n), "gene", variant)
    grid = spread(means.join(down, "gene"), F.lit(1), F.col("_n"), "cell_position").drop("_n")
    placed = stored.join(across, "cell").select("gene", "cell_position", "value")
    columns = across.join(cells.select("cell", F.col(label).alias("label")), "cell")
    return grid.join(placed, ["gene", "cell_position"], "left").join(columns, "cell_position").select(
        "gene", "cell", "gene_position", "cell_position", (F.coalesce("value", F.lit(0.0)) - F.col("mean")).alias("value"), "label")


def equal_cells(stored: DataFrame) -> DataFrame:
    """Sets of cells with the same values of all genes, as ``ward`` takes them: of few genes most cells hold none, and their pairs need no distance."""
    held = F.array_sort(F.collect_list(F.when(F.col("value") != 0, F.struct("gene", "value"))))
    profiles = settle(stored.groupBy(F.col("cell").alias("c")).agg(held.alias("held")))
    sets = profiles.groupBy("held").agg(F.min("c").alias("lead"), F.count("*").alias("members")).filter("members > 1")
    return numbered_sets(profiles.join(sets, "held").select("lead", "c", "members"))


def _places(known: DataFrame, distances: Callable[[], DataFrame], name: str, variant: str, equal: DataFrame | None = None) -> DataFrame:
    """Leaf positions of all names; one alone has no tree and stands first."""
    names = known.select(name).distinct()
    if names.limit(2).count() < 2:
        return names.select(name, F.lit(1).cast("bigint").alias(f"{name}_position"))
    return leaf_order(ward(distances(), variant, equal)).select(F.col("cell").alias(name), F.col("position").alias(f"{name}_position"))
