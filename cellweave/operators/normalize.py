"""Normalization: size factors, per-cell scaling, transforms and batch removal."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.context import distinct_total, scalar, settle
from cellweave.operators.grids import over_cells
from cellweave.operators.ordering import quantiles, value_ranks
from cellweave.operators.ranking import pool_windows, ring_order
from cellweave.operators.summaries import library_size


def cpm(counts: DataFrame) -> DataFrame:
    """Counts per million of the cell's library."""
    return counts.join(library_size(counts), "cell").select(
        "gene", "cell", (F.col("count") * 1e6 / F.col("total_counts")).alias("cpm"))


def log_cpm(counts: DataFrame, prior: float = 2.0) -> DataFrame:
    """log2 CPM with a prior count scaled by library size.

    Zeros are not stored; ``zero_value`` is what an unstored zero of the same cell becomes.
    """
    library = library_size(counts)
    mean_library = scalar(library.agg(F.avg("total_counts").alias("m")))
    scaled = library.select(
        "cell",
        (F.lit(prior) * F.col("total_counts") / mean_library).alias("_prior"),
        F.col("total_counts").alias("_lib"),
    ).withColumn("_total", F.col("_lib") + 2.0 * F.col("_prior"))
    joined = counts.join(scaled, "cell")
    return joined.select(
        "gene",
        "cell",
        F.log2((F.col("count") + F.col("_prior")) * 1e6 / F.col("_total")).alias("log_cpm"),
        F.log2(F.col("_prior") * 1e6 / F.col("_total")).alias("zero_value"),
    )


def tmm_factors(counts: DataFrame, trim_m: float = 0.3, trim_a: float = 0.05, n_genes=None) -> DataFrame:
    """Trimmed-mean-of-M-values factors, scaled to geometric mean 1.

    The reference cell has its upper quartile share closest to the average. M and A of a gene
    depend only on the two counts, so rows are merged to distinct ``(cell, count, ref count)``
    with a weight before anything is ranked; ranks use the exact ratio and product of the counts.
    """
    genes = distinct_total(counts, "gene", n_genes)
    library = library_size(counts)
    upper = quantiles(counts, "count", [0.75], ["q"], ["cell"], genes)
    shares = library.join(upper, "cell").select(
        "cell", "total_counts", (F.col("q") / F.col("total_counts")).alias("_f"))
    shares = settle(shares)
    target = scalar(shares.agg(F.avg("_f").alias("a")))
    chosen = shares.withColumn("_d", F.abs(F.col("_f") - target)).agg(
        F.min(F.struct("_d", "cell", "total_counts")).alias("r"))
    reference = settle(chosen.select("r.cell", F.col("r.total_counts").alias("ref_total")))
    ref_counts = counts.join(reference, "cell", "left_semi").select("gene", F.col("count").alias("y_ref"))

    merged = (
        counts.join(ref_counts, "gene")
        .groupBy("cell", F.col("count").alias("y"), "y_ref")
        .agg(F.count("*").alias("w"))
        .join(shares.select("cell", F.col("total_counts").alias("lib")), "cell")
        .withColumn("ref_lib", scalar(reference.select("ref_total")))
        .withColumns({"ratio": F.col("y") / F.col("y_ref"), "product": (F.col("y") * F.col("y_ref")).cast("double")})
    )

    def ranks(column: str) -> DataFrame:
        ranked = value_ranks(merged, column, ["cell"], F.col("w"), few_values=False)
        return ranked.select(
            "cell", column, F.col("total").alias(f"_n_{column}"),
            (F.col("before") + (F.col("n") + 1) / 2).alias(f"_r_{column}"))

    ranked = merged.join(ranks("ratio"), ["cell", "ratio"]).join(ranks("product"), ["cell", "product"])
    n = F.col("_n_ratio")
    low_m, low_a = F.floor(n * trim_m) + 1, F.floor(n * trim_a) + 1
    kept = (
        (F.col("_r_ratio") >= low_m) & (F.col("_r_ratio") <= n + 1 - low_m)
        & (F.col("_r_product") >= low_a) & (F.col("_r_product") <= n + 1 - low_a)
    )
    m_value = F.log2((F.col("y") / F.col("lib")) / (F.col("y_ref") / F.col("ref_lib")))
    variance = (F.col("lib") - F.col("y")) / F.col("lib") / F.col("y") + (
        F.col("ref_lib") - F.col("y_ref")) / F.col("ref_lib") / F.col("y_ref")
    # The variance is 0 only for a gene that is all that both libraries hold; its M value is 0, so the cell keeps factor 1.
    sums = ranked.filter(kept).withColumn("_v", variance).filter("_v > 0").groupBy("cell").agg(
        F.sum(F.col("w") * m_value / F.col("_v")).alias("_up"), F.sum(F.col("w") / F.col("_v")).alias("_down"))
    raw = shares.select("cell").join(sums, "cell", "left").select(
        "cell", F.coalesce(F.col("_up") / F.col("_down"), F.lit(0.0)).alias("_log"))
    raw = settle(raw)
    center = scalar(raw.agg(F.avg("_log").alias("c")))
    return raw.select("cell", F.pow(F.lit(2.0), F.col("_log") - center).alias("factor"))


def tmm_size_factors(counts: DataFrame, n_genes=None) -> DataFrame:
    """Library size x TMM factor, scaled to geometric mean 1."""
    effective = tmm_factors(counts, n_genes=n_genes).join(library_size(counts), "cell").select(
        "cell", (F.col("factor") * F.col("total_counts")).alias("_e"))
    return _scaled_to_geometric_mean(settle(effective), "_e")


def _scaled_to_geometric_mean(cells: DataFrame, column: str) -> DataFrame:
    center = scalar(cells.agg(F.avg(F.log(column)).alias("c")))
    return cells.select("cell", F.exp(F.log(column) - center).alias("size_factor"))


def size_factors_ratio(counts: DataFrame, n_cells=None) -> DataFrame:
    """Median over genes without zeros of count / geometric mean."""
    cells = distinct_total(counts, "cell", n_cells)
    positive = counts.filter(F.col("count") > 0)
    geometric = (
        positive.groupBy("gene")
        .agg(F.avg(F.log("count")).alias("_lg"), F.count("*").alias("_n"))
        .filter(F.col("_n") == cells)
        .select("gene", "_lg")
    )
    ratios = positive.join(geometric, "gene").select(
        "cell", (F.log("count") - F.col("_lg")).alias("_ratio"))
    medians = quantiles(ratios, "_ratio", [0.5], ["_m"], ["cell"])
    return medians.select("cell", F.exp("_m").alias("size_factor"))


def size_factors_poscounts(counts: DataFrame, n_cells=None) -> DataFrame:
    """Ratios to the geometric mean over positive counts (zeros count in the root), rescaled to
    geometric mean 1."""
    cells = distinct_total(counts, "cell", n_cells)
    positive = counts.filter(F.col("count") > 0)
    geometric = positive.groupBy("gene").agg((F.sum(F.log("count")) / cells).alias("_lg"))
    ratios = positive.join(geometric, "gene").select(
        "cell", (F.log("count") - F.col("_lg")).alias("_ratio"))
    medians = quantiles(ratios, "_ratio", [0.5], ["_m"], ["cell"])
    return _scaled_to_geometric_mean(settle(medians.select("cell", F.exp("_m").alias("_e"))), "_e")


def size_factors_pooled(counts: DataFrame, sizes: Sequence[int] = (5, 10, 15, 20), n_genes=None,
                        anchor_weight: float = 1e-6) -> DataFrame:
    """Size factors from overlapping pools of cells.

    Cells are divided by their library size, summed over ring pools, and each pool profile is
    compared with the average profile; the median ratio of a pool estimates the sum of its
    cells' factors. One equation a cell, of weight ``anchor_weight``, says that its factor follows its library; it only decides
    what the pools leave open. The least-squares system of all equations is solved on the ring by ``_solve_ring``.
    """
    library = settle(library_size(counts))
    cells = scalar(library.agg(F.count("*")))
    pools = pool_windows(library, sizes)
    shares = counts.join(library, "cell").select(
        "gene", "cell", (F.col("count") / F.col("total_counts")).alias("x"))
    average = shares.groupBy("gene").agg((F.sum("x") / cells).alias("avg"))
    sums = shares.join(pools, "cell").groupBy("pool_size", "pool", "gene").agg(F.sum("x").alias("s"))
    ratios = sums.join(average, "gene").select("pool_size", "pool", (F.col("s") / F.col("avg")).alias("ratio"))
    genes = distinct_total(counts, "gene", n_genes)
    medians = quantiles(ratios, "ratio", [0.5], ["estimate"], ["pool_size", "pool"], genes)
    # Right-hand side: each pool's estimate is handed to its member cells.
    per_cell = pools.join(medians, ["pool_size", "pool"]).groupBy("cell").agg(F.sum("estimate").alias("rhs"))
    ring = ring_order(library).join(per_cell, "cell")
    rhs = F.col("rhs") + F.lit(anchor_weight)
    solved = _solve_ring(ring.select("cell", "position", "n_cells", rhs.alias("rhs")), sizes, anchor_weight)
    factors = solved.join(library, "cell").select(
        "cell", (F.greatest(F.col("theta"), F.lit(1e-8)) * F.col("total_counts")).alias("_raw"))
    factors = settle(factors)
    mean = scalar(factors.agg(F.avg("_raw").alias("m")))
    return factors.select("cell", (F.col("_raw") / mean).alias("size_factor"))


def _ring_kernel(sizes: Sequence[int], anchor_weight: float, tolerance: float = 1e-12) -> np.ndarray:
    """Inverse of the normal equations on an endless ring, from distance 0 to where it stays below ``tolerance`` of its top.

    A pool of s cells adds the squared sum of s roots of unity to every frequency of the normal matrix. The frequencies
    are refined until the kernel has faded inside a quarter of them.
    """
    points = 1 << 12
    while True:
        angle = np.pi * np.arange(points // 2 + 1) / points
        eigen = np.full(len(angle), float(anchor_weight))
        with np.errstate(invalid="ignore"):
            for size in sizes:
                eigen += np.where(angle > 0, np.sin(size * angle) / np.sin(angle), size) ** 2
        kernel = np.fft.irfft(1.0 / eigen, points)[:points // 2]
        large = np.flatnonzero(np.abs(kernel) > tolerance * kernel[0])
        if large[-1] < points // 4 or points == 1 << 22:  # beyond, rounding hides what is left of the kernel
            return kernel[:min(large[-1], points // 4) + 1]
        points *= 2


def _solve_ring(ring: DataFrame, sizes: Sequence[int], anchor_weight: float, chunk: int | None = None) -> DataFrame:
    """Solve the least-squares system on the ring, chunk by chunk.

    The normal matrix looks the same from every cell, so its inverse is a convolution with a kernel that fades: within
    half a million places for a weight of 1e-6, within a hundred for 1. A chunk takes as many places before and after it, around the ring
    as often as need be, so rings of any size are solved in one way, to the kernel's tolerance, and a task holds two chunks.
    """
    reach = len(_ring_kernel(sizes, anchor_weight)) - 1
    chunk = max(chunk or max(1 << 16, 2 * reach), reach + 1)
    size, position = F.col("n_cells"), F.col("position")
    chunks = F.ceil(size / chunk)

    def touched(place: Column) -> Column:
        first, last = F.floor((place - reach) / chunk), F.floor((place + reach) / chunk)
        return F.filter(F.sequence(first, last), lambda c: (c >= 0) & (c < chunks))

    # A chunk is longer than the reach, so beyond one turn of the ring there is one chunk only, which has every cell.
    images = F.array_union(touched(position), F.array_union(touched(position - size), touched(position + size)))
    wide = ring.withColumn("_c", F.explode(images))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        kernel = _ring_kernel(sizes, anchor_weight)
        pdf = pdf.sort_values("position")
        n, at = int(pdf["n_cells"].iloc[0]), pdf["position"].to_numpy()
        start = int(pdf["_c"].iloc[0]) * chunk
        width = min(chunk, n - start)
        around = np.arange(start - reach, start + width + reach) % n
        values = pdf["rhs"].to_numpy()[np.searchsorted(at, around)]
        length = 1 << int(len(values) + 2 * reach).bit_length()
        spread = np.zeros(length)
        spread[:reach + 1] = kernel
        spread[length - reach:] = kernel[:0:-1]
        theta = np.fft.irfft(np.fft.rfft(values, length) * np.fft.rfft(spread), length)[reach:reach + width]
        own = (at >= start) & (at < start + width)
        return pd.DataFrame({"cell": pdf["cell"][own], "theta": theta[at[own] - start]})

    cell_type = ring.schema["cell"].dataType.simpleString()
    return wide.groupBy("_c").applyInPandas(solve, f"cell {cell_type}, theta double")


def normalized_counts(counts: DataFrame, size_factors: DataFrame) -> DataFrame:
    return counts.join(size_factors, "cell").select(
        "gene", "cell", (F.col("count") / F.col("size_factor")).alias("value"))


def log_normalize(counts: DataFrame, size_factors: DataFrame) -> DataFrame:
    """log2(count / size factor + 1) with size factors centred to mean 1."""
    mean = scalar(size_factors.agg(F.avg("size_factor").alias("m")))
    centred = size_factors.select("cell", (F.col("size_factor") / mean).alias("size_factor"))
    return counts.join(centred, "cell").select(
        "gene", "cell", F.log2(F.col("count") / F.col("size_factor") + 1.0).alias("value"))


def rpkm(counts: DataFrame, lengths: DataFrame) -> DataFrame:
    """CPM per kilobase; lengths in bases."""
    return cpm(counts).join(lengths, "gene").select(
        "gene", "cell", (F.col("cpm") / (F.col("len") / 1000.0)).alias("rpkm"))


def fpkm(counts: DataFrame, positions: DataFrame) -> DataFrame:
    """log2(FPKM + 1) with length |end - start| / 1000; only annotated genes with a length.

    The library is taken over the annotated genes, as the table is cut to them first.
    """
    lengths = positions.select("gene", (F.abs(F.col("end") - F.col("start")) / 1000.0).alias("_kb")).filter("_kb > 0")
    annotated = counts.join(lengths, "gene")
    library = annotated.groupBy("cell").agg(F.sum("count").alias("_lib"))
    per_kb = F.col("count") * 1e6 / F.col("_lib") / F.col("_kb")
    return annotated.join(library, "cell").select("gene", "cell", F.log2(per_kb + 1.0).alias("value"))


def vst_value(q: Column, a0: Column, a1: Column) -> Column:
    """Closed-form variance-stabilized value for the dispersion trend a1 / mean + a0."""
    root = F.sqrt(a0 * q * (1.0 + a1 + a0 * q))
    return F.log2((1.0 + a1 + 2.0 * a0 * q + 2.0 * root) / (4.0 * a0))


def vst(counts: DataFrame, size_factors: DataFrame, a0, a1) -> DataFrame:
    """Stored counts transformed; ``shifted`` is the value minus that of a zero count, so the
    sparse table keeps its meaning (a zero has the same transform in every cell)."""
    a0, a1 = (c if isinstance(c, Column) else F.lit(float(c)) for c in (a0, a1))
    q = F.col("count") / F.col("size_factor")
    zero = vst_value(F.lit(0.0), a0, a1)
    return counts.join(size_factors, "cell").select(
        "gene", "cell", vst_value(q, a0, a1).alias("value"), (vst_value(q, a0, a1) - zero).alias("shifted"))


def batch_shift(assay: DataFrame, cells: DataFrame, batch: str, value: str = "value") -> DataFrame:
    """Per gene and batch: batch mean minus the mean of the gene's batch means, zeros included."""
    sizes = cells.groupBy(F.col(batch).alias("batch")).agg(F.count("*").alias("n"))
    batch_list = scalar(sizes.agg(F.collect_list(F.struct("batch", "n")).alias("l")))
    labelled = assay.join(cells.select("cell", F.col(batch).alias("batch")), "cell")
    sums = labelled.groupBy("gene", "batch").agg(F.sum(value).alias("_s"))
    grid = (
        sums.select("gene").distinct().withColumn("_b", F.explode(batch_list)).select("gene", "_b.*")
        .join(sums, ["gene", "batch"], "left")
        .select("gene", "batch", (F.coalesce("_s", F.lit(0.0)) / F.col("n")).alias("_mean"))
    )
    center = grid.groupBy("gene").agg(F.avg("_mean").alias("_center"))
    return grid.join(center, "gene").select("gene", "batch", (F.col("_mean") - F.col("_center")).alias("shift"))


def remove_batch(assay: DataFrame, cells: DataFrame, batch: str, value: str = "value") -> DataFrame:
    """Dense result: every gene x cell value minus the shift of the cell's batch."""
    shifts = batch_shift(assay, cells, batch, value)
    labelled = cells.select("cell", F.col(batch).alias("batch"))
    dense = over_cells(shifts, labelled, "batch")
    stored = assay.select("gene", "cell", F.col(value).alias("_x"))
    return dense.join(stored, ["gene", "cell"], "left").select(
        "gene", "cell", (F.coalesce("_x", F.lit(0.0)) - F.col("shift")).alias("value"))


def size_factor_table(counts: DataFrame, size_factors: DataFrame) -> DataFrame:
    """Size factor against library size in millions."""
    return library_size(counts).join(size_factors, "cell").select(
        "cell", "size_factor", (F.col("total_counts") / 1e6).alias("library_millions"))
