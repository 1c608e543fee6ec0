"""Multiple-testing adjustment, ranks, top-k choices, ordering and deterministic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.context import distinct_total, settle, settle_if_floating
from cellweave.operators.ordering import minimum_from_right, row_numbers, value_ranks
from cellweave.operators.summaries import gene_means, gene_variance


def bh_adjust(df: DataFrame, p: str = "p_value", out: str = "fdr", keys: Sequence[str] = (), settled: bool = False) -> DataFrame:
    """Benjamini-Hochberg: running minimum from the largest p of p * m / rank, capped at 1.

    Works on distinct p values, so the usual pile of p = 1 is one row. Null p stays null and is
    not counted in m.
    """
    stable = df if settled else settle(df)
    ranked = value_ranks(stable.filter(F.col(p).isNotNull()), p, keys, few_values=False)
    scaled = ranked.withColumn("_q", F.col(p) * F.col("total") / (F.col("before") + F.col("n")))
    adjusted = minimum_from_right(scaled, p, "_q", "_m", keys)
    result = adjusted.select(*keys, p, F.least(F.col("_m"), F.lit(1.0)).alias(out))
    return stable.join(result, [*keys, p], "left")


def rank_average(assay: DataFrame, value: str, by: str = "cell", size=None, out: str = "rank") -> DataFrame:
    """Ranks inside ``by`` with ties averaged; unstored zeros share one rank below the positives.

    ``size`` is the number of values per group (default: distinct genes or cells of the assay).
    Values must be positive where stored. ``zero_rank`` is the rank of an unstored zero.
    """
    other = "gene" if by == "cell" else "cell"
    total = distinct_total(assay, other, size)
    stable = settle_if_floating(assay, value)
    ranks = value_ranks(stable, value, [by])
    zeros = F.col("_size") - F.col("total")
    ranked = ranks.withColumn("_size", total).select(
        by,
        value,
        (zeros + F.col("before") + (F.col("n") + 1) / 2).alias(out),
        F.when(zeros > 0, (zeros + 1) / 2).otherwise(0.0).alias("zero_rank"),
    )
    return stable.join(ranked, [by, value])


def _top(scored: DataFrame, score: str, n: int) -> DataFrame:
    return scored.orderBy(F.desc(score), F.asc("gene")).limit(n)


def top_variance_genes(assay: DataFrame, n: int = 2000, value: str = "count", n_cells=None) -> DataFrame:
    return _top(gene_variance(assay, value, n_cells), "variance", n)


def top_variance(assay: DataFrame, n: int = 2000, value: str = "count", n_cells=None) -> DataFrame:
    """Rows of the ``n`` most variable genes (ties by gene)."""
    return assay.join(top_variance_genes(assay, n, value, n_cells).select("gene"), "gene", "left_semi")


def top_mean(counts: DataFrame, n: int = 20, n_cells=None) -> DataFrame:
    """Rows of the ``n`` genes with the largest mean."""
    return counts.join(_top(gene_means(counts, n_cells), "total", n).select("gene"), "gene", "left_semi")


def order_results(results: DataFrame, column: str = "pvalue", descending: bool = False) -> DataFrame:
    """Result rows by a column, missing values last, ties by gene."""
    main = F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)
    return results.orderBy(main, F.asc("gene"))


def head_genes(results: DataFrame, n: int = 100, column: str = "pvalue", descending: bool = False) -> DataFrame:
    """First ``n`` genes of an ordering, as a feature set for later steps."""
    return order_results(results, column, descending).limit(n).select("gene")


def restrict_genes(assay: DataFrame, genes: DataFrame) -> DataFrame:
    return assay.join(genes.select("gene"), "gene", "left_semi")


def top_gene(results: DataFrame, column: str = "padj") -> DataFrame:
    """The gene with the smallest value (ties by gene), found without sorting."""
    return results.filter(F.col(column).isNotNull()).agg(
        F.min(F.struct(F.col(column), F.col("gene"))).alias("_m")).select("_m.gene", f"_m.{column}")


def top_tags(results: DataFrame, n: int = 10, column: str = "p_value") -> DataFrame:
    return order_results(results, column).limit(n)


def highest_expressed(counts: DataFrame, n: int = 50) -> DataFrame:
    """Genes with the largest share of all counts, in percent."""
    everything = counts.agg(F.sum("count").alias("t")).scalar()
    shares = counts.groupBy("gene").agg(F.sum("count").alias("total"))
    return _top(shares.withColumn("pct", 100.0 * F.col("total") / everything), "total", n)


def sample_cells(cells: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """``n`` cells without replacement; the same for any partitioning and any rerun."""
    return cells.orderBy(F.xxhash64(F.lit(seed), F.col("cell")), F.asc("cell")).limit(n)


def pool_windows(cells: DataFrame, sizes: Sequence[int] = (5, 10, 15, 20), size_column: str = "total_counts") -> DataFrame:
    """Sliding pools over cells on a ring.

    Cells ordered by library size are laid on a ring with odd places ascending on one side and
    even places descending on the other, so neighbours have similar libraries all the way round.
    One row per ``(pool_size, pool, cell)``.
    """
    placed = ring_order(cells, size_column)
    members = placed.withColumn("pool_size", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])))
    offsets = members.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pool_size") - 1)))
    return offsets.select(
        "pool_size", F.pmod(F.col("position") - F.col("_k"), F.col("n_cells")).alias("pool"), "cell")


def ring_order(cells: DataFrame, size_column: str = "total_counts") -> DataFrame:
    """``cell``, ring ``position`` from 0 and ``n_cells``."""
    numbered = row_numbers(cells, size_column, "cell", out="_r", total="n_cells")
    r = F.col("_r") - 1
    position = F.when(r % 2 == 0, F.floor(r / 2)).otherwise(F.col("n_cells") - 1 - F.floor(r / 2))
    return numbered.select("cell", size_column, position.alias("position"), "n_cells")


def sort_by_name(alignments: DataFrame) -> DataFrame:
    """Global order by read name: range partitions, each sorted."""
    return alignments.orderBy("name")
