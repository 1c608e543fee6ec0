"""Grouped summaries of the long count table. Zeros are data: every mean, variance and quantile
takes the number of cells or genes into account although zero rows are not stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellweave.context import distinct_total, scalar, settle, settle_if_floating
from cellweave.operators.grids import over_cells
from cellweave.operators.ordering import quantiles, row_numbers


def library_size(counts: DataFrame) -> DataFrame:
    return counts.groupBy("cell").agg(F.sum("count").alias("total_counts"))


def features_per_cell(counts: DataFrame) -> DataFrame:
    return counts.groupBy("cell").agg(F.count_if(F.col("count") > 0).alias("total_features"))


def _control_sums(flags: list[str]) -> list[Column]:
    return [F.sum(F.when(F.col(f), F.col("count")).otherwise(0)).alias(f"_sum_{f}") for f in flags]


def pct_controls(counts: DataFrame, genes: DataFrame, sets: list[str]) -> DataFrame:
    """Percent of a cell's counts in each control set; ``genes`` carries ``is_<set>`` flags."""
    flags = [f"is_{s}" for s in sets]
    flagged = counts.join(genes.select("gene", *flags), "gene", "left")
    sums = flagged.groupBy("cell").agg(F.sum("count").alias("_all"), *_control_sums(flags))
    return sums.select(
        "cell", *[(100.0 * F.col(f"_sum_is_{s}") / F.col("_all")).alias(f"pct_{s}") for s in sets]
    )


def top_features(counts: DataFrame, top: int) -> DataFrame:
    """The ``top`` largest counts of each cell. Spark limits each task's rows per cell before the
    shuffle, so at most ``top`` rows per cell and task travel."""
    by_count = W.partitionBy("cell").orderBy(F.desc("count"), F.asc("gene"))
    return counts.withColumn("rank_in_cell", F.row_number().over(by_count)).filter(F.col("rank_in_cell") <= top)


def pct_top(counts: DataFrame, top: int = 50) -> DataFrame:
    highest = top_features(counts, top).groupBy("cell").agg(F.sum("count").alias("_top"))
    joined = highest.join(library_size(counts), "cell")
    return joined.select("cell", (100.0 * F.col("_top") / F.col("total_counts")).alias(f"pct_top_{top}"))


def cell_qc(counts: DataFrame, genes: DataFrame, sets: list[str], top: int = 50) -> DataFrame:
    """Per-cell quality table: totals, detected genes, control shares, top share, log columns."""
    flags = [f"is_{s}" for s in sets]
    flagged = counts.join(genes.select("gene", *flags), "gene", "left")
    base = flagged.groupBy("cell").agg(
        F.sum("count").alias("total_counts"),
        F.count_if(F.col("count") > 0).alias("total_features"),
        *_control_sums(flags),
    )
    highest = top_features(counts, top).groupBy("cell").agg(F.sum("count").alias("_top"))
    return base.join(highest, "cell").select(
        "cell",
        "total_counts",
        "total_features",
        *[(100.0 * F.col(f"_sum_is_{s}") / F.col("total_counts")).alias(f"pct_{s}") for s in sets],
        (100.0 * F.col("_top") / F.col("total_counts")).alias(f"pct_top_{top}"),
        F.log10(F.col("total_counts") + 1).alias("log10_total_counts"),
        F.log10(F.col("total_features") + 1).alias("log10_total_features"),
    )


def gene_means(counts: DataFrame, n_cells=None) -> DataFrame:
    cells = distinct_total(counts, "cell", n_cells)
    return counts.groupBy("gene").agg(
        F.sum("count").alias("total"), (F.sum("count") / cells).alias("mean"))


def cells_per_gene(counts: DataFrame) -> DataFrame:
    return counts.groupBy("gene").agg(F.count_if(F.col("count") > 0).alias("n_cells"))


def gene_variance(assay: DataFrame, value: str = "count", n_cells=None) -> DataFrame:
    """Mean and unbiased variance per gene over all cells, unstored zeros included."""
    n = distinct_total(assay, "cell", n_cells).cast("double")
    x = F.col(value).cast("double")
    sums = assay.groupBy("gene").agg(F.sum(x).alias("_s"), F.sum(x * x).alias("_ss"))
    spread = (F.col("_ss") - F.col("_s") * F.col("_s") / F.col("_n")) / (F.col("_n") - 1)
    return sums.withColumn("_n", n).select(
        "gene", (F.col("_s") / F.col("_n")).alias("mean"), F.greatest(spread, F.lit(0.0)).alias("variance"))


def _metric(column: str, log: bool) -> Column:
    return (F.log10(F.col(column)) if log else F.col(column)).cast("double")


def _beyond(x: Column, median: Column, mad: Column, nmads: float, side: str) -> Column:
    if side == "lower":
        return x < median - nmads * mad
    if side == "higher":
        return x > median + nmads * mad
    raise ValueError(f"side must be lower or higher, not {side!r}")


def outlier_limits(qc: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """``(metric, median, mad)`` of several cell metrics in one pass per statistic."""
    long = settle(qc.select(*[x.alias(name) for name, x in metrics.items()]).unpivot(
        [], list(metrics), "metric", "x"))
    middle = settle(quantiles(long, "x", [0.5], ["median"], ["metric"], settled=True))
    gaps = long.join(F.broadcast(middle), "metric").select("metric", F.abs(F.col("x") - F.col("median")).alias("gap"))
    spread = quantiles(gaps, "gap", [0.5], ["mad"], ["metric"], settled=True)
    return settle(middle.join(spread.withColumn("mad", F.col("mad") * 1.4826), "metric"))


def flag_outliers(qc: DataFrame, rules: list[tuple[str, str, str, bool]], nmads: float = 3.0) -> DataFrame:
    """Add one flag per rule ``(flag name, column, side, log)``: further than ``nmads`` median
    absolute deviations from the median on the given side."""
    stable = settle(qc)
    metrics = {name: _metric(column, log) for name, column, _, log in rules}
    limits = outlier_limits(stable, metrics)
    flags = {}
    for name, _, side, _ in rules:
        own = limits.filter(F.col("metric") == name)
        flags[name] = _beyond(metrics[name], scalar(own.select("median")), scalar(own.select("mad")), nmads, side)
    return stable.withColumns(flags)


def is_outlier(qc: DataFrame, column: str, nmads: float = 3.0, side: str = "lower", log: bool = False) -> DataFrame:
    """The cell table with one flag column ``outlier``."""
    return flag_outliers(qc, [("outlier", column, side, log)], nmads)


def qc_report(flagged: DataFrame, flags: list[str]) -> DataFrame:
    """Cells dropped per reason and cells remaining."""
    dropped = F.lit(False)
    for flag in flags:
        dropped = dropped | F.col(flag)
    return flagged.agg(
        *[F.count_if(F.col(f)).alias(f"by_{f}") for f in flags], F.count_if(~dropped).alias("remaining"))


def summarize_columns(assay: DataFrame, value: str = "count", n_genes=None) -> DataFrame:
    """Minimum, quartiles, mean and maximum of each cell, zeros included."""
    genes = distinct_total(assay, "gene", n_genes)
    spread = quantiles(
        assay, value, [0.0, 0.25, 0.5, 0.75, 1.0], ["min", "q1", "median", "q3", "max"], ["cell"], genes)
    means = assay.groupBy("cell").agg((F.sum(value) / genes).alias("mean"))
    return spread.join(means, "cell")


def summarize_results(results: DataFrame, alpha: float = 0.1) -> DataFrame:
    """Numbers of genes up, down, without p value (outliers) and filtered as low counts."""
    called = F.col("padj") < alpha
    return results.agg(
        F.count("*").alias("total"),
        F.count_if(called & (F.col("log2FoldChange") > 0)).alias("up"),
        F.count_if(called & (F.col("log2FoldChange") < 0)).alias("down"),
        F.count_if(F.col("pvalue").isNull() & (F.col("baseMean") > 0)).alias("outliers"),
        F.count_if(F.col("padj").isNull() & F.col("pvalue").isNotNull()).alias("low_counts"),
    )


def histogram(df: DataFrame, column: str, bins: int, low: Column | None = None, high: Column | None = None) -> DataFrame:
    """Counts in ``bins`` equal-width bins from minimum to maximum; the maximum is in the last bin."""
    x = F.col(column).cast("double")
    low = scalar(df.agg(F.min(x).alias("v"))) if low is None else low
    high = scalar(df.agg(F.max(x).alias("v"))) if high is None else high
    limits = df.filter(x.isNotNull()).select(x.alias("_x")).withColumns({"_low": low, "_high": high})
    width = (F.col("_high") - F.col("_low")) / bins
    at = F.when(width > 0, F.floor((F.col("_x") - F.col("_low")) / width)).otherwise(0)
    placed = limits.withColumn("bin", F.least(at, F.lit(bins - 1)).cast("bigint"))
    return placed.groupBy("bin").agg(F.count("*").alias("n"))


def box_stats(assay: DataFrame, cells: DataFrame, value: str = "count", n_genes=None, whisker: float = 1.5) -> DataFrame:
    """Box-plot numbers per chosen cell; ``whisker=0`` runs the whiskers to the extremes."""
    genes = distinct_total(assay, "gene", n_genes)
    # Equal values of a cell are one row before anything is joined, ranked or compared with fences.
    held = settle_if_floating(assay.groupBy("cell", value).agg(F.count("*").alias("_n")), value)
    chosen = held.join(cells.select("cell"), "cell", "left_semi")
    spread = quantiles(
        chosen, value, [0.0, 0.25, 0.5, 0.75, 1.0], ["min", "q1", "median", "q3", "max"], ["cell"], genes, settled=True, weight="_n")
    if whisker == 0:
        return spread.select("cell", F.col("min").alias("low"), "q1", "median", "q3", F.col("max").alias("high"))
    reach = whisker * (F.col("q3") - F.col("q1"))
    fences = spread.withColumns({"_lf": F.col("q1") - reach, "_hf": F.col("q3") + reach})
    x = F.col(value).cast("double")
    within = (x >= F.col("_lf")) & (x <= F.col("_hf"))
    ends = (
        chosen.join(fences, "cell")
        .groupBy("cell")
        .agg(
            F.min(F.when(within, x)).alias("_low"),
            F.max(F.when(within, x)).alias("_high"),
            F.sum("_n").alias("_stored"),
        )
    )
    zero_inside = (F.col("_stored") < genes) & (F.col("_lf") <= 0) & (F.col("_hf") >= 0)
    low = F.when(zero_inside, F.least("_low", F.lit(0.0))).otherwise(F.col("_low"))
    high = F.when(zero_inside, F.greatest("_high", F.lit(0.0))).otherwise(F.col("_high"))
    return fences.join(ends, "cell").select(
        "cell", low.alias("low"), "q1", "median", "q3", high.alias("high"))


def density_2d(genes: DataFrame, x: Column, y: Column, x_width: float, y_width: float) -> DataFrame:
    """Two-dimensional bin counts of two expressions."""
    return (
        genes.select(F.floor(x / x_width).alias("x_bin"), F.floor(y / y_width).alias("y_bin"))
        .groupBy("x_bin", "y_bin")
        .agg(F.count("*").alias("n"))
    )


def group_stats(assay: DataFrame, cells: DataFrame, factor: str, value: str = "count") -> DataFrame:
    """One-vs-rest table per gene and level: detection rates, means and log2 fold change.

    The level list comes from the cell table (few rows); genes are expanded over it, so a level
    in which a gene is never seen is reported with zeros.
    """
    sizes = cells.groupBy(F.col(factor).alias("level")).agg(F.count("*").alias("n_in"))
    level_rows = sizes.select("level", "n_in", F.sum("n_in").over(W.partitionBy(F.lit(0))).alias("n_all"))
    x = F.col(value).cast("double")
    labelled = assay.join(cells.select("cell", F.col(factor).alias("level")), "cell")
    per_level = labelled.groupBy("gene", "level").agg(
        F.sum(x).alias("_sum"), F.count_if(x > 0).cast("double").alias("_seen"))
    level_list = scalar(level_rows.agg(F.collect_list(F.struct("level", "n_in", "n_all")).alias("l")))
    per_gene = per_level.groupBy("gene").agg(
        F.sum("_sum").alias("_sum_all"), F.sum("_seen").alias("_seen_all"))
    grid = per_gene.withColumn("_l", F.explode(level_list)).select("gene", "_sum_all", "_seen_all", "_l.*")
    joined = grid.join(per_level, ["gene", "level"], "left").na.fill(0.0, ["_sum", "_seen"])
    rest = F.col("n_all") - F.col("n_in")
    mean_in = F.col("_sum") / F.col("n_in")
    mean_out = F.when(rest > 0, (F.col("_sum_all") - F.col("_sum")) / rest).otherwise(0.0)
    return joined.select(
        "gene",
        "level",
        (F.col("_seen") / F.col("n_in")).alias("rate_in"),
        F.when(rest > 0, (F.col("_seen_all") - F.col("_seen")) / rest).otherwise(0.0).alias("rate_out"),
        mean_in.alias("mean_in"),
        mean_out.alias("mean_out"),
        F.log2((mean_in + 1.0) / (mean_out + 1.0)).alias("lfc"),
    )


def mean_variance(assay: DataFrame, value: str = "count", bins: int = 100, n_cells=None) -> DataFrame:
    """Average mean and variance of genes in ``bins`` equal-count bins by mean."""
    moments = gene_variance(assay, value, n_cells)
    placed = row_numbers(moments, "mean", "gene", out="_at", total="_all")
    # Equal-count bins with the larger bins first.
    small = F.floor(F.col("_all") / bins)
    extra = F.col("_all") % bins
    cut = extra * (small + 1)
    at = F.col("_at") - 1
    bin_no = F.when(at < cut, F.floor(at / (small + 1))).otherwise(
        extra + F.floor((at - cut) / F.greatest(small, F.lit(1)))) + 1
    return placed.withColumn("bin", bin_no.cast("bigint")).groupBy("bin").agg(
        F.count("*").alias("n"), F.avg("mean").alias("mean"), F.avg("variance").alias("variance"))


def mean_sd_trend(assay: DataFrame, value: str = "count", bins: int = 50, n_cells=None) -> DataFrame:
    """Median standard deviation of genes along the rank of their mean."""
    moments = gene_variance(assay, value, n_cells).withColumn("sd", F.sqrt("variance"))
    placed = row_numbers(moments, "mean", "gene", out="_at", total="_all")
    share = F.floor((F.col("_at") - 1) * bins / F.col("_all"))
    binned = placed.withColumn("rank_bin", share.cast("bigint"))
    medians = quantiles(binned, "sd", [0.5], ["median_sd"], ["rank_bin"])
    sizes = binned.groupBy("rank_bin").agg(F.count("*").alias("n"))
    return medians.join(sizes, "rank_bin")


def center_rows(assay: DataFrame, cells: DataFrame, value: str = "count", scale: bool = False) -> DataFrame:
    """Dense gene x cell rows minus the gene mean, optionally divided by the gene's deviation.

    The result is dense (a zero becomes minus the mean), so use it on chosen genes.
    """
    n = scalar(cells.agg(F.count("*").alias("n")))
    moments = gene_variance(assay, value, n)
    grid = over_cells(moments, cells.select("cell"))
    joined = grid.join(assay.select("gene", "cell", F.col(value).alias("_x")), ["gene", "cell"], "left")
    centered = F.coalesce(F.col("_x").cast("double"), F.lit(0.0)) - F.col("mean")
    if scale:
        centered = F.when(F.col("variance") > 0, centered / F.sqrt("variance")).otherwise(0.0)
    return joined.select("gene", "cell", centered.alias("value"))


def scale_rows(assay: DataFrame, cells: DataFrame, value: str = "count") -> DataFrame:
    return center_rows(assay, cells, value, scale=True)


def cell_scatter(assay: DataFrame, first, second, value: str = "count", genes: DataFrame | None = None) -> DataFrame:
    """Two cells side by side per gene; with ``genes`` also the genes seen in neither."""
    x = F.col(value)
    picked = assay.filter(F.col("cell").isin(first, second)).groupBy("gene").agg(
        F.coalesce(F.max(F.when(F.col("cell") == first, x)), F.lit(0)).alias("x"),
        F.coalesce(F.max(F.when(F.col("cell") == second, x)), F.lit(0)).alias("y"),
    )
    if genes is None:
        return picked
    return genes.select("gene").join(picked, "gene", "left").na.fill(0, ["x", "y"])
