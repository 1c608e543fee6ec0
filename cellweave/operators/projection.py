"""Projections of cells: principal components and classical scaling of a distance table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.context import settle
from cellweave.operators.ranking import head_genes, restrict_genes, top_variance_genes
from cellweave.operators.summaries import gene_variance


def pca(assay: DataFrame, cells: DataFrame, ntop: int = 500, k: int = 2, value: str = "value",
        scale: bool = False, genes: DataFrame | None = None, n_cells: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Scores ``(cell, PC1..PCk)`` and ``(component, percent)`` of the most variable genes.

    A cell's vector holds at most ``ntop`` values, so vectors and the gene x gene covariance are
    bounded by the gene choice and not by the data. Each component's largest loading is positive.
    """
    if genes is None:
        genes = top_variance_genes(assay, ntop, value, n_cells)
    moments = gene_variance(restrict_genes(assay, genes), value, n_cells).limit(ntop + 1).collect()
    if len(moments) > ntop:
        raise ValueError(f"more than ntop={ntop} genes were given")
    ordered = sorted(moments, key=lambda r: r["gene"])
    names = [r["gene"] for r in ordered]
    means = np.array([r["mean"] for r in ordered])
    sds = np.array([r["variance"] for r in ordered]) ** 0.5
    unit = np.where(sds > 0, sds, 1.0) if scale else np.ones(len(names))

    spark = assay.sparkSession
    kind = assay.schema["gene"].dataType.simpleString()
    index = spark.createDataFrame(
        [(g, i, float(u)) for i, (g, u) in enumerate(zip(names, unit))], f"gene {kind}, at int, unit double")
    entries = assay.join(index, "gene").groupBy("cell").agg(
        F.map_from_entries(F.collect_list(F.struct("at", F.col(value) / F.col("unit")))).alias("m"))
    filled = cells.select("cell").join(entries, "cell", "left").select(
        "cell",
        array_to_vector(F.transform(
            F.sequence(F.lit(0), F.lit(len(names) - 1)),
            lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)))).alias("vector"),
    )
    filled = settle(filled)
    model = PCA(k=k, inputCol="vector", outputCol="raw").fit(filled)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    offsets = (means / unit) @ loadings
    raw = model.transform(filled).select("cell", vector_to_array("raw").alias("raw"))
    scores = raw.select("cell", *[
        ((F.get("raw", F.lit(c)) - float(offsets[c])) * float(signs[c])).alias(f"PC{c + 1}") for c in range(k)])
    shares = [(f"PC{c + 1}", 100.0 * float(v)) for c, v in enumerate(model.explainedVariance.toArray())]
    return scores, spark.createDataFrame(shares, "component string, percent double")


def pca_of_head(assay: DataFrame, cells: DataFrame, results: DataFrame, n: int = 100, k: int = 2, value: str = "value"):
    """The same on the first ``n`` genes of a result table."""
    return pca(assay, cells, ntop=n, k=k, value=value, genes=head_genes(results, n))


def mds(distances: DataFrame, k: int = 2, rounds: int = 30, tolerance: float = 1e-6) -> DataFrame:
    """Classical scaling ``(cell, axis1..axisk)`` of a complete distance table.

    Subspace iteration on the doubly centred squared distances. The distances stay distributed: a
    round is one join with the cells' few direction values, one sum per cell, and one aggregate of
    which only ``width x width`` numbers reach the driver.
    """
    d2 = F.col("d") * F.col("d")
    edges = settle(distances.select(F.explode(F.array(
        F.struct(F.col("i").alias("a"), F.col("j").alias("b"), d2.alias("d2")),
        F.struct(F.col("j").alias("a"), F.col("i").alias("b"), d2.alias("d2")))).alias("e")).select("e.*"))
    rows = settle(edges.groupBy(F.col("a").alias("cell")).agg(F.sum("d2").alias("row_sum")))
    n, total = rows.agg(F.count("*"), F.sum("row_sum")).first()
    width = min(k + 6, n)
    # Fixed starting directions from the cell id: the same for any partitioning.
    state = settle(rows.select("cell", (F.col("row_sum") / n).alias("row_mean"), F.array(*[
        F.pmod(F.xxhash64("cell", F.lit(c)), F.lit(2**20)) / float(2**20) - 0.5 for c in range(width)]).alias("v"),
        F.array_repeat(F.lit(0.0), width).alias("u")))
    gram, plain, weighted, _ = _summaries(state, width)
    previous = None
    for _ in range(rounds):
        turn = _orthonormal(gram)
        basis = _turned(state, "v", turn, "u")
        state = settle(_apply_centred(edges, basis, width, plain @ turn, weighted @ turn, total / (n * n)))
        gram, plain, weighted, ritz = _summaries(state, width)
        ritz = (ritz + ritz.T) / 2
        values = np.sort(np.linalg.eigvalsh(ritz))[::-1][:k]
        if previous is not None and np.all(np.abs(values - previous) <= tolerance * max(abs(values[0]), 1e-300)):
            break
        previous = values
    values, vectors = np.linalg.eigh(ritz)
    order = np.argsort(values)[::-1][:k]
    axes = _turned(state, "u", vectors[:, order] * np.sqrt(np.maximum(values[order], 0.0)), "axes")
    return axes.select("cell", *[F.get("axes", F.lit(c)).alias(f"axis{c + 1}") for c in range(k)])


def _turned(state: DataFrame, column: str, matrix: np.ndarray, out: str) -> DataFrame:
    """Row vectors times a small matrix, in Arrow batches (new numbers need no new generated code)."""
    def turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = np.array(pdf[column].tolist()).reshape(len(pdf), matrix.shape[0]) @ matrix
            yield pd.DataFrame({"cell": pdf["cell"], "row_mean": pdf["row_mean"], out: list(rows)})

    kind = state.schema["cell"].dataType.simpleString()
    return state.mapInPandas(turn, f"cell {kind}, row_mean double, {out} array<double>")


def _summaries(state: DataFrame, width: int):
    """Gram matrix of v, sums of v, row-mean weighted sums of v and u'v: one small row per task."""
    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(2 * width * width + 2 * width)
        for pdf in batches:
            if len(pdf):
                v, u = (np.array(pdf[c].tolist()).reshape(len(pdf), width) for c in ("v", "u"))
                total += np.concatenate([(v.T @ v).ravel(), v.sum(axis=0), pdf["row_mean"].to_numpy() @ v, (u.T @ v).ravel()])
        yield pd.DataFrame({"at": np.arange(len(total)), "value": total})

    sums = state.mapInPandas(add_up, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    found = np.zeros(2 * width * width + 2 * width)
    for at, value in sums:
        found[at] = value
    square = width * width
    return (found[:square].reshape(width, width), found[square:square + width],
            found[square + width:square + 2 * width], found[square + 2 * width:].reshape(width, width))


def _orthonormal(gram: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(gram)
    safe = np.where(values > 1e-13 * max(values.max(), 1e-300), values, np.inf)
    return vectors / np.sqrt(safe)


def _apply_centred(edges: DataFrame, basis: DataFrame, width: int, plain: np.ndarray, weighted: np.ndarray,
                   grand: float) -> DataFrame:
    """-1/2 J D2 J applied to the basis vectors ``u``, as vectors ``v`` next to them."""
    moved = edges.join(basis.select(F.col("cell").alias("b"), "u"), "b").groupBy(F.col("a").alias("cell")).agg(
        F.array(*[F.sum(F.col("d2") * F.get("u", F.lit(c))) for c in range(width)]).alias("p"))

    def centre(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            p = np.array(pdf["p"].tolist()).reshape(len(pdf), width)
            v = -0.5 * (p - np.outer(pdf["row_mean"], plain) - weighted + grand * plain)
            yield pd.DataFrame({"cell": pdf["cell"], "row_mean": pdf["row_mean"], "v": list(v), "u": pdf["u"]})

    kind = basis.schema["cell"].dataType.simpleString()
    return moved.join(basis, "cell").mapInPandas(
        centre, f"cell {kind}, row_mean double, v array<double>, u array<double>")
