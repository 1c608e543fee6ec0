"""Gene, cell and row filters on the long table ``counts(gene, cell, count)`` without zero rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.context import distinct_total


def drop_summary_rows(counts: DataFrame, gene: str = "gene") -> DataFrame:
    """Drop the counting tool's summary rows by name, wherever they stand in the file."""
    return counts.filter(~F.col(gene).startswith("__"))


def flag_controls(genes: DataFrame, patterns: dict[str, str], column: str = "gene") -> DataFrame:
    """``is_<set>`` per control pattern, and ``is_endogenous`` where no pattern matches."""
    flags = {f"is_{name}": F.col(column).rlike(pattern) for name, pattern in patterns.items()}
    matched = F.lit(False)
    for flag in flags.values():
        matched = matched | flag
    return genes.withColumns({**flags, "is_endogenous": ~matched})


def _keep_genes(counts: DataFrame, kept: DataFrame) -> DataFrame:
    return counts.join(kept.select("gene"), "gene", "left_semi")


def filter_min_total(counts: DataFrame, minimum: int = 25) -> DataFrame:
    totals = counts.groupBy("gene").agg(F.sum("count").alias("total"))
    return _keep_genes(counts, totals.filter(F.col("total") >= minimum))


def genes_passing_cpm(counts: DataFrame, minimum: float = 1.0, min_cells: int = 2) -> DataFrame:
    """Genes whose counts per million exceed ``minimum`` in at least ``min_cells`` cells."""
    library = counts.groupBy("cell").agg(F.sum("count").alias("library"))
    above = F.col("count") * 1e6 > F.col("library") * F.lit(float(minimum))
    return (
        counts.join(library, "cell")
        .filter(above)
        .groupBy("gene")
        .agg(F.count("*").alias("cells_above"))
        .filter(F.col("cells_above") >= min_cells)
        .select("gene")
    )


def filter_cpm(counts: DataFrame, minimum: float = 1.0, min_cells: int = 2) -> DataFrame:
    """Library sizes are to be taken again from the result: they shrink with the dropped genes."""
    return _keep_genes(counts, genes_passing_cpm(counts, minimum, min_cells))


def filter_min_mean(counts: DataFrame, minimum: float = 1.0, n_cells=None) -> DataFrame:
    cells = distinct_total(counts, "cell", n_cells)
    totals = counts.groupBy("gene").agg(F.sum("count").alias("total"))
    return _keep_genes(counts, totals.filter(F.col("total") >= F.lit(float(minimum)) * cells))


def genes_in_min_cells(counts: DataFrame, min_cells: int = 10) -> DataFrame:
    """Reported, not applied: genes seen in at least ``min_cells`` cells."""
    seen = counts.filter(F.col("count") > 0).groupBy("gene").agg(F.count("*").alias("n_cells"))
    return seen.filter(F.col("n_cells") >= min_cells)


def filter_min_cells(counts: DataFrame, min_cells: int = 10) -> DataFrame:
    return _keep_genes(counts, genes_in_min_cells(counts, min_cells))


def filter_nonzero(counts: DataFrame) -> DataFrame:
    totals = counts.groupBy("gene").agg(F.sum("count").alias("total"))
    return _keep_genes(counts, totals.filter(F.col("total") > 0))


def filter_cells(counts: DataFrame, qc: DataFrame, flags: list[str]) -> DataFrame:
    """Keep the cells none of whose outlier flags is set."""
    dropped = F.lit(False)
    for flag in flags:
        dropped = dropped | F.coalesce(F.col(flag), F.lit(False))
    return counts.join(qc.filter(~dropped).select("cell"), "cell", "left_semi")


def filter_phase(counts: DataFrame, phases: DataFrame, phase: str = "G1") -> DataFrame:
    """Keep cells of one phase; a missing phase counts as the text "NA"."""
    kept = phases.filter(F.coalesce(F.col("phase"), F.lit("NA")) == phase)
    return counts.join(kept.select("cell"), "cell", "left_semi")


def fill_zero(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.fill(0, columns)


def drop_incomplete(results: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return results.na.drop("any", subset=columns)


def select_significant(
    results: DataFrame,
    fdr: str = "fdr",
    max_fdr: float = 0.05,
    at_least: dict[str, float] | None = None,
    above: dict[str, float] | None = None,
) -> DataFrame:
    """Rows with ``fdr <= max_fdr`` and further lower bounds (inclusive and strict)."""
    keep: Column = F.col(fdr) <= max_fdr
    for column, bound in (at_least or {}).items():
        keep = keep & (F.col(column) >= bound)
    for column, bound in (above or {}).items():
        keep = keep & (F.col(column) > bound)
    return results.filter(keep)


def pending_runs(manifest: DataFrame, done: DataFrame, run: str = "run") -> DataFrame:
    """Manifest rows whose output does not exist yet."""
    return manifest.join(done.select(run).distinct(), run, "left_anti")
