"""The first complete path: counts, library sizes, CPM filter, variable genes, CPM."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cellweave.operators.filters import filter_cpm
from cellweave.operators.normalize import cpm
from cellweave.operators.ranking import top_variance
from cellweave.plans import bindings


def variable_gene_cpm(spark: SparkSession, folder: str, n_genes: int = 100) -> DataFrame:
    kept = filter_cpm(bindings.counts(spark, folder), 2500, 2)
    return cpm(top_variance(kept, n_genes))
