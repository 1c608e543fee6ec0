"""Normalization methods by name and the three complete analyses as compositions of operators.

Each analysis returns a dict of lazy result tables; a step that several tables share is settled
once. Tables are computed when the caller writes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.context import settle
from cellweave.operators import clustering, distance, filters, lookups, models, ranking, summaries, variance
from cellweave.operators import normalize as norm
from cellweave.operators.projection import pca


def _by_library(counts: DataFrame) -> DataFrame:
    return summaries.library_size(counts).select("cell", F.col("total_counts").cast("double").alias("size_factor"))


def _log_cpm_plus_one(counts: DataFrame, **_) -> DataFrame:
    return norm.cpm(counts).select("gene", "cell", F.log2(F.col("cpm") + 1.0).alias("value"))


def _edger_cpm(counts: DataFrame, **_) -> DataFrame:
    return norm.log_cpm(counts).select("gene", "cell", F.col("log_cpm").alias("value"), "zero_value")


def _edger_tmm(counts: DataFrame, **_) -> DataFrame:
    """CPM with library sizes scaled by the TMM factors."""
    scaled = norm.tmm_factors(counts).join(summaries.library_size(counts), "cell").select(
        "cell", (F.col("factor") * F.col("total_counts") / 1e6).alias("size_factor"))
    return norm.normalized_counts(counts, scaled)


# package:algorithm -> function(counts, **tables) giving (gene, cell, value).
METHODS = {
    ("scater", "default"): lambda c, **t: norm.log_normalize(c, norm.size_factors_pooled(c)),
    ("scater", "cpm"): _log_cpm_plus_one,
    ("scater", "tmm"): lambda c, **t: norm.log_normalize(c, norm.tmm_size_factors(c)),
    ("scater", "fpkm"): lambda c, **t: norm.fpkm(c, t["positions"]),
    ("deseq", "default"): lambda c, **t: norm.normalized_counts(c, norm.size_factors_ratio(c)),
    ("deseq", "tmm"): lambda c, **t: norm.normalized_counts(c, norm.tmm_size_factors(c)),
    ("deseq", "fpkm"): lambda c, **t: norm.fpkm(c, t["positions"]),
    ("edger", "default"): _edger_tmm,
    ("edger", "tmm"): _edger_tmm,
    ("edger", "cpm"): _edger_cpm,
    ("edger", "rpkm"): lambda c, **t: norm.rpkm(c, t["lengths"]).withColumnRenamed("rpkm", "value"),
}


def split_method(method: str) -> tuple[str, str]:
    """``package:algorithm`` in lower case; the algorithm is the part after the colon."""
    package, _, algorithm = method.strip().lower().partition(":")
    if (package, algorithm) not in METHODS:
        known = ", ".join(sorted(":".join(k) for k in METHODS))
        raise ValueError(f"unknown normalization {method!r}; known: {known}")
    return package, algorithm


def normalize(counts: DataFrame, method: str, **tables: DataFrame) -> DataFrame:
    return METHODS[split_method(method)](counts, **tables)


def _size_factors(counts: DataFrame, package: str, algorithm: str) -> DataFrame:
    if algorithm == "tmm" or (package, algorithm) == ("edger", "default"):
        return norm.tmm_size_factors(counts)
    if (package, algorithm) == ("deseq", "default"):
        return norm.size_factors_ratio(counts)
    if (package, algorithm) == ("scater", "default"):
        return norm.size_factors_pooled(counts)
    return _by_library(counts)


def _trees(assay: DataFrame, genes: DataFrame | None, prefix: str) -> dict[str, DataFrame]:
    """Distances of three kinds, as tables; trees are built from them on demand."""
    return {
        f"{prefix}euclidean": distance.euclidean(assay, genes),
        f"{prefix}pearson": distance.pearson_distance(assay, genes),
        f"{prefix}spearman": distance.spearman_distance(assay, genes),
    }


def cluster_tables(distances: DataFrame, k: int = 4) -> dict[str, DataFrame]:
    """Merges, clusters and leaf order of one distance table."""
    merges = clustering.ward(distances)
    return {"merges": merges, "clusters": clustering.cut_k(merges, k), "order": clustering.leaf_order(merges)}


def run_deseq(counts: DataFrame, cells: DataFrame, factors: list[str], method: str = "DESeq:default", n_keep: int = 2000,
              min_total: int = 25, annotation: DataFrame | None = None) -> dict[str, DataFrame]:
    """Variable genes, size factors, dispersions, LRT, ordered results; distances of the VST assay."""
    package, algorithm = split_method(method)
    kept = settle(filters.filter_min_total(ranking.top_variance(counts, n_keep), min_total))
    factors_table = settle(_size_factors(kept, package, algorithm))
    known = cells.join(factors_table, "cell")
    ready = models.prepare(kept, known, factors)
    estimates = settle(models.gene_dispersions(ready))
    a0, a1 = models.dispersion_trend(estimates)
    dispersions = settle(models.deseq_dispersion(ready, estimates))
    results = models.nb_lrt(kept, known, factors, ready, dispersions.select("gene", F.col("map").alias("dispersion")))
    transformed = norm.vst(kept, factors_table, a0, a1)
    shifted = settle(transformed.select("gene", "cell", F.col("shifted").alias("value")))
    table = results.drop("eta", "leverage")
    final = table
    if annotation is not None:
        ids = table.withColumn("id", F.col("gene"))
        final = lookups.map_ids(ids, annotation, "symbol").drop("id")
    final = ranking.order_results(filters.drop_incomplete(final))
    head = settle(ranking.head_genes(table, 100))
    return {
        "size_factors": factors_table,
        "dispersions": dispersions,
        "vst": transformed,
        "results": final,
        "summary": summaries.summarize_results(table),
        "fitted": results,
        "ma": models.ma_table(table),
        "mean_sd": summaries.mean_sd_trend(shifted, "value"),
        **_trees(shifted, None, ""),
        **_trees(shifted, head, "head_"),
    }


def run_scater(counts: DataFrame, cells: DataFrame, genes: DataFrame, factor: str, method: str = "scater:default",
               marker_pairs: DataFrame | None = None, min_mean: float = 1.0, nmads: float = 3.0,
               **tables: DataFrame) -> dict[str, DataFrame]:
    """Cell quality, phase choice, gene filter, normalization, variable genes and correlated pairs."""
    qc = settle(summaries.cell_qc(counts, genes, ["ERCC", "Mt"]))
    rules = [("low_size", "total_counts", "lower", True), ("low_features", "total_features", "lower", True),
             ("high_mt", "pct_Mt", "higher", False), ("high_spike", "pct_ERCC", "higher", False)]
    flagged = settle(summaries.flag_outliers(qc, rules, nmads))
    flags = [r[0] for r in rules]
    kept = filters.filter_cells(counts, flagged, flags)
    out = {"qc": flagged, "qc_report": summaries.qc_report(flagged, flags)}
    if marker_pairs is not None:
        phases = settle(variance.phase_scores(kept, marker_pairs))
        kept = filters.filter_phase(kept, phases, "G1")
        out["phases"] = phases
    kept = settle(filters.filter_min_mean(kept, min_mean))
    assay = settle(normalize(kept, method, **tables))
    left = cells.join(kept.select("cell").distinct(), "cell", "left_semi")
    n_cells = left.agg(F.count("*")).scalar()
    moments = settle(summaries.gene_variance(assay, "value", n_cells))
    parts = settle(variance.decompose_variance(moments, variance.variance_trend(moments), n_cells))
    hvg = settle(variance.highly_variable(parts))
    pairs = settle(variance.correlate_pairs(assay, hvg.select("gene"), n_cells=n_cells))
    significant = filters.select_significant(pairs, "fdr", 0.05)
    covariates = left.join(qc.select("cell", "log10_total_features", "log10_total_counts", "pct_top_50"), "cell")
    return {
        **out,
        "logcounts": assay,
        "variance": parts,
        "hvg": hvg,
        "pairs": pairs,
        "chosen": lookups.pair_members(significant),
        "adjusted": norm.remove_batch(ranking.restrict_genes(assay, hvg), left, factor),
        "explained": variance.explained_variance(
            assay, covariates, factor, ["log10_total_features", "log10_total_counts", "pct_top_50"]),
        **_trees(assay, None, ""),
    }


def run_edger(counts: DataFrame, cells: DataFrame, factors: list[str], method: str = "edgeR:default",
              min_cpm: float = 1.0, min_cells: int = 2, coef: int = 1, **tables: DataFrame) -> dict[str, DataFrame]:
    """CPM filter, normalization, dispersions and the test of one coefficient of the group design."""
    package, algorithm = split_method(method)
    kept = settle(filters.filter_cpm(counts, min_cpm, min_cells))
    grouped = lookups.group_key(cells, factors).select("cell", "group")
    size_factors = settle(_size_factors(kept, package, algorithm))
    known = grouped.join(size_factors, "cell")
    dispersions = settle(models.nb_dispersion(kept, grouped))
    results = settle(models.glm_lrt(
        kept, known, "group", coef, dispersions=dispersions.select("gene", F.col("tagwise").alias("dispersion"))))
    return {
        "cpm_summary": summaries.summarize_columns(norm.cpm(counts), "cpm"),
        "kept_summary": summaries.summarize_columns(norm.cpm(kept), "cpm"),
        "normalized": normalize(kept, method, **tables),
        "dispersions": dispersions,
        "mean_variance": summaries.mean_variance(kept),
        "bcv": models.bcv_table(kept, dispersions),
        "results": results,
        "top": ranking.top_tags(results, 10, "pvalue"),
        "de_genes": models.de_genes(results),
        "smear": models.smear_table(kept, results),
    }


def project(assay: DataFrame, cells: DataFrame, ntop: int = 500, k: int = 2):
    return pca(assay, cells, ntop=ntop, k=k)
