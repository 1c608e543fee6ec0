"""Negative-binomial models per gene: dispersions, likelihood-ratio tests, shrinkage, markers.

A likelihood depends on a cell only through its design row, size factor and count, so every gene is first
reduced, with map-side combining, to the distinct combinations of the three and how many cells hold each; cells
without a count enter through sums that are tabulated once per design row to the last digits (``nb.CellCurves``), so a fit costs what
the gene's own counts cost, for any number of cells. One task holds the combinations
of one gene, the tables and, for outliers, the distinct (design row, size factor) pairs of all cells, 24 bytes each. Where size factors are
too many for that, ``prepare(bins_per_octave=...)`` joins near ones, for every gene and every size of data alike.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_schema

from cellweave.context import scalar, settle, split_count
from cellweave.functions import nb
from cellweave.functions.tails import chi2_tail, f_quantile, trigamma
from cellweave.operators.grids import number_cells, spread_between
from cellweave.operators.ordering import quantiles, value_ranks
from cellweave.operators.ranking import bh_adjust
from cellweave.operators.summaries import group_stats, library_size

MAX_DESIGN_ROWS = 1000
CUTOFFS = 50  # mean counts tried by independent filtering


@dataclass
class Design:
    """A checked, small design: one row per distinct factor combination."""

    factors: list[str]
    rows: list[tuple]
    names: list[str]
    matrix: np.ndarray


def make_design(cells: DataFrame, factors: list[str]) -> Design:
    """Design ``~ f1 + f2 + ...`` over the distinct factor combinations (first level dropped)."""
    found = cells.select(*factors).distinct().limit(MAX_DESIGN_ROWS + 1).collect()
    if len(found) > MAX_DESIGN_ROWS:
        raise ValueError(f"more than {MAX_DESIGN_ROWS} factor combinations")
    rows = sorted(tuple(r) for r in found)
    names, columns = ["intercept"], [np.ones(len(rows))]
    for f, factor in enumerate(factors):
        for level in sorted({r[f] for r in rows})[1:]:
            names.append(f"{factor}_{level}")
            columns.append(np.array([float(r[f] == level) for r in rows]))
    return Design(factors, rows, names, np.column_stack(columns))


def _numbered_cells(cells: DataFrame, design: Design, bins_per_octave: int | None = None) -> DataFrame:
    """``(cell, row, log_size, bin)``; the design rows are few by construction."""
    spark = cells.sparkSession
    kinds = [cells.schema[f].dataType.simpleString() for f in design.factors]
    schema = ", ".join(f"`{f}` {k}" for f, k in zip(design.factors, kinds)) + ", row int"
    table = spark.createDataFrame([(*r, i) for i, r in enumerate(design.rows)], schema)
    numbered = cells.join(F.broadcast(table), design.factors).select("cell", "row", "size_factor", F.log("size_factor").alias("log_size"))
    if bins_per_octave is None:
        return numbered
    near = F.floor(F.log2("size_factor") * bins_per_octave)
    return numbered.withColumn("log_size", F.avg("log_size").over(W.partitionBy("row", near)))


def _collect_bins(numbered: DataFrame, rows: int) -> nb.CellBins:
    """Distinct design rows and size factors, and their tabulated sums, which are all that a fit needs of them."""
    found = numbered.groupBy("row", "log_size").agg(F.count("*").alias("cells")).toPandas().sort_values(["row", "log_size"])
    bins = nb.CellBins(found["row"].to_numpy(), found["log_size"].to_numpy(), found["cells"].to_numpy(dtype=float))
    bins.curves(rows)
    return bins


def gene_sums(counts: DataFrame, numbered: DataFrame) -> DataFrame:
    """How many cells of a gene hold a count: ``(gene, row, log_size, count, cells)``."""
    seen = counts.filter(F.col("count") > 0).join(numbered, "cell")
    return seen.groupBy("gene", "row", "log_size", F.col("count").cast("double").alias("count")).agg(
        F.count("*").cast("double").alias("cells"))


AT_ONCE = 1 << 16  # rows of genes that are fitted together, or one gene; a few genes need many steps, which a large batch shares


def _gene_batches(df: DataFrame, body: Callable[[pa.Array, np.ndarray, dict[str, np.ndarray]], list], schema: str) -> DataFrame:
    """Columns that ``body`` makes of the names of some genes, the edges of their rows and the columns, ordered by design row, size and count.

    Genes are dealt over a fixed number of tasks: the rows are few but each gene costs a fit, so tasks must not be merged by size.
    Spark orders them and a task holds the rows of one gene and one batch; no frame is made per gene.
    """
    tasks = split_count(df.sparkSession)
    dealt = df.repartition(tasks, F.xxhash64("gene")).sortWithinPartitions("gene", "row", "log_size", "count")
    names = df.columns
    kind = T.StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(kind)

        def done(table: pa.Table, edges: list[int]) -> Iterator[pa.RecordBatch]:
            columns = {n: table.column(n).to_numpy() for n in names if n != "gene"}
            genes, ends = table.column("gene"), np.array(edges)
            at = 0
            while at < len(ends) - 1:
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + AT_ONCE, "right")) - 1)
                own = ends[at:to + 1]
                names_of = genes.take(pa.array(own[:-1])).combine_chunks()
                out = body(names_of, own - own[0], {n: c[own[0]:own[-1]] for n, c in columns.items()})
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([_arrow(c, f.type) for c, f in zip(out, target)], schema=target)
                at = to

        def edges_of(table: pa.Table) -> list[int]:
            codes = table.column("gene").dictionary_encode("encode").combine_chunks().indices.to_numpy()
            return [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist()]

        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < AT_ONCE:
                continue
            if batch.column("gene")[0] == batch.column("gene")[-1] == held[0].column("gene")[0]:
                continue  # still one gene
            table = pa.Table.from_batches(held).combine_chunks()
            edges = edges_of(table)
            yield from done(table, edges)
            held = table.slice(edges[-1]).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from done(table, [*edges_of(table), table.num_rows])

    return dealt.mapInArrow(run, schema)


def _arrow(column, kind: pa.DataType) -> pa.Array:
    """Arrays of numbers, one row a gene, as lists; nan as null."""
    if isinstance(column, np.ndarray) and column.ndim == 2:
        offsets = np.arange(len(column) + 1, dtype=np.int32) * column.shape[1]
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(column.ravel()), type=kind)
    if isinstance(column, np.ndarray) and column.dtype.kind == "f":
        return pa.array(column, kind, mask=np.isnan(column))
    return (column if isinstance(column, pa.Array) else pa.array(column)).cast(kind)


def _each_gene(df: DataFrame, body: Callable[[dict[str, np.ndarray]], list[tuple]], schema: str) -> DataFrame:
    """Rows of ``body`` for the columns of every gene alone."""

    def one_by_one(genes: pa.Array, edges: np.ndarray, columns: dict[str, np.ndarray]) -> list:
        rows = []
        for name, x, y in zip(genes.to_pylist(), edges, edges[1:]):
            rows += body({"gene": name, **{n: c[x:y] for n, c in columns.items()}})
        return [list(c) for c in zip(*rows)] or [[]]

    return _gene_batches(df, one_by_one, schema)


@dataclass
class _Read:
    """A batch of genes: sums, distinct counts, counts with their cells, and sums of scaled counts and their squares."""

    sums: nb.GeneBatch
    seen: nb.CountValues
    count: np.ndarray
    cells: np.ndarray
    scaled: np.ndarray
    squares: np.ndarray


def _read_genes(edges: np.ndarray, columns: dict[str, np.ndarray]) -> _Read:
    count, cells = columns["count"], columns["cells"]
    gene = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    sums = nb.GeneBatch(len(edges) - 1, gene, columns["row"], columns["log_size"], count * cells)
    order = np.lexsort((count, gene))
    of, value = gene[order], count[order]
    first = np.flatnonzero(np.diff(of, prepend=-1) | (np.diff(value, prepend=-1.0) != 0))
    seen = nb.CountValues(of[first], value[first], np.add.reduceat(cells[order], first))
    scaled = count / np.exp(sums.log_size)
    return _Read(sums, seen, count, cells, sums.sums(cells * scaled), sums.sums(cells * scaled**2))


def _moment_dispersions(read: _Read, n: float, inverse_size: float) -> np.ndarray:
    mean = read.scaled / n
    variance = (read.squares - read.scaled * read.scaled / n) / max(n - 1, 1)
    return np.clip((variance - inverse_size * mean) / np.maximum(mean * mean, 1e-12), 1e-4, 10.0)


@dataclass
class Prepared:
    """Everything a family of fits shares."""

    design: Design
    bins: nb.CellBins
    sums: DataFrame
    numbered: DataFrame
    gene_type: str


def prepare(counts: DataFrame, cells: DataFrame, factors: list[str], bins_per_octave: int | None = None) -> Prepared:
    """``cells`` is ``(cell, size_factor, factors...)``; one pass over the counts.

    Size factors are taken as they are; ``bins_per_octave`` replaces those of a bin by their mean, which bounds
    what a task holds (1024 bins an octave change a cell's expected count by less than 0.04 percent).
    """
    design = make_design(cells, factors)
    numbered = settle(_numbered_cells(cells, design, bins_per_octave))
    return Prepared(design, _collect_bins(numbered, len(design.rows)), settle(gene_sums(counts, numbered)), numbered,
                    counts.schema["gene"].dataType.simpleString())


def gene_dispersions(ready: Prepared) -> DataFrame:
    """Gene-wise dispersion by adjusted profile likelihood: ``(gene, mean, dispersion)``."""
    x, bins = ready.design.matrix, ready.bins
    n = bins.cells.sum()
    inverse_size = float(bins.cells @ np.exp(-bins.log_size) / n)

    def estimate(genes: pa.Array, edges: np.ndarray, columns: dict[str, np.ndarray]) -> list:
        read = _read_genes(edges, columns)
        alpha = _moment_dispersions(read, n, inverse_size)
        for _ in range(2):
            beta, _, _, _ = nb.fits(x, read.sums, bins, alpha)
            alpha = nb.best_dispersions(x, np.maximum(beta @ x.T, -30), read.sums, bins, read.seen)
        return [genes, read.scaled / n, alpha]

    return _gene_batches(ready.sums, estimate, f"gene {ready.gene_type}, mean double, dispersion double")


def dispersion_trend(estimates: DataFrame, rounds: int = 200) -> tuple[float, float]:
    """``(a0, a1)`` of dispersion = a1 / mean + a0 by gamma regression with identity link.

    Each round is one aggregate of five sums; genes far from the current curve are left out.
    """
    used = estimates.filter((F.col("dispersion") > 100 * nb.MIN_DISPERSION) & (F.col("mean") > 0))
    a0, a1 = 0.1, 1.0
    for round_no in range(rounds):
        curve = F.lit(a1) / F.col("mean") + F.lit(a0)
        # The first curve is only a start: every gene counts until one has been fitted.
        ratio = F.col("dispersion") / curve if round_no else F.lit(1.0)
        w, u, d = 1.0 / (curve * curve), 1.0 / F.col("mean"), F.col("dispersion")
        s = used.filter((ratio > 1e-4) & (ratio < 15)).agg(
            F.sum(w), F.sum(w * u), F.sum(w * u * u), F.sum(w * d), F.sum(w * u * d)).first()
        if s[0] is None:
            break
        det = s[0] * s[2] - s[1] * s[1]
        if det <= 1e-12 * s[0] * s[2]:
            new0, new1 = s[3] / s[0], 0.0
        else:
            new0, new1 = (s[2] * s[3] - s[1] * s[4]) / det, (s[0] * s[4] - s[1] * s[3]) / det
        new0, new1 = max(new0, 1e-6), max(new1, 0.0)
        if new1 == 0.0:
            new0 = max(s[3] / s[0], 1e-6)
        close = abs(math.log(new0 / a0)) + abs(new1 - a1) / (abs(a1) + 1e-6) < 1e-6
        a0, a1 = new0, new1
        if close:
            break
    else:
        raise ArithmeticError(f"the dispersion trend has not converged in {rounds} rounds")
    return a0, a1


def _prior_variance(estimates: DataFrame, a0: float, a1: float, cells: float, columns: int) -> tuple[float, float]:
    """Spread of log dispersions around the trend, and the part not due to sampling."""
    curve = F.lit(a1) / F.col("mean") + F.lit(a0)
    gaps = settle(estimates.filter(F.col("dispersion") > 100 * nb.MIN_DISPERSION).select(
        F.log(F.col("dispersion") / curve).alias("gap")))
    middle = scalar(quantiles(gaps, "gap", [0.5], ["m"], settled=True))
    spread = gaps.select(F.abs(F.col("gap") - middle).alias("gap"))
    mad = quantiles(settle(spread), "gap", [0.5], ["m"], settled=True).first()
    observed = (1.4826 * (mad[0] if mad and mad[0] is not None else 0.5)) ** 2
    return observed, max(observed - trigamma(max(cells - columns, 1.0) / 2), 0.25)


def deseq_dispersion(ready: Prepared, estimates: DataFrame | None = None) -> DataFrame:
    """Three dispersions per gene: ``gene_wise``, ``trend`` and the final ``map`` estimate."""
    estimates = settle(gene_dispersions(ready)) if estimates is None else estimates
    a0, a1 = dispersion_trend(estimates)
    x, bins = ready.design.matrix, ready.bins
    observed, prior = _prior_variance(estimates, a0, a1, float(bins.cells.sum()), x.shape[1])
    joined = ready.sums.join(estimates, "gene")

    def shrink(genes: pa.Array, edges: np.ndarray, columns: dict[str, np.ndarray]) -> list:
        read = _read_genes(edges, columns)
        mean, own = (columns[c][edges[:-1]] for c in ("mean", "dispersion"))
        curve = a1 / mean + a0
        beta, _, _, _ = nb.fits(x, read.sums, bins, np.maximum(own, 1e-8))
        shrunk = nb.best_dispersions(x, np.maximum(beta @ x.T, -30), read.sums, bins, read.seen, (np.log(curve), prior))
        far = np.log(own) > np.log(curve) + 2 * math.sqrt(observed)
        return [genes, mean, own, curve, np.where(far, own, shrunk)]

    return _gene_batches(joined, shrink, f"gene {ready.gene_type}, mean double, gene_wise double, trend double, map double")


_FIT_SCHEMA = ("baseMean double, log2FoldChange double, lfcSE double, stat double, pvalue double, dispersion double, "
               "eta array<double>, leverage array<double>, converged boolean, max_cooks double, cells_above long")


def likelihood_ratio(ready: Prepared, dispersions: DataFrame, drop: list[int], report: int = -1) -> DataFrame:
    """Full design against the design without the columns ``drop``; ``report`` is the coefficient shown.

    ``dispersions`` is ``(gene, dispersion)``. The result also carries each design row's fitted
    log rate and leverage factor for later use, whether both fits converged, the largest Cook's distance among
    cells whose design row has at least three cells (null if none has), and how many cells exceed that cell's count.
    """
    x, bins = ready.design.matrix, ready.bins
    columns = x.shape[1]
    report = report % columns
    kept = [c for c in range(columns) if c not in {d % columns for d in drop}]
    reduced = x[:, kept]
    n = bins.cells.sum()
    joined = ready.sums.join(dispersions.select("gene", "dispersion"), "gene")

    def test(genes: pa.Array, edges: np.ndarray, given: dict[str, np.ndarray]) -> list:
        read = _read_genes(edges, given)
        alpha = np.maximum(given["dispersion"][edges[:-1]], nb.MIN_DISPERSION)
        beta, weight, full, converged = nb.fits(x, read.sums, bins, alpha)
        if reduced.shape[1]:
            _, _, small, also = nb.fits(reduced, read.sums, bins, alpha)
        else:
            small, also = nb.log_likelihoods(np.zeros((len(alpha), len(x))), read.sums, bins, alpha), True
        stat = np.maximum(2 * (full - small), 0.0)
        inverse = nb.inverses(x, weight)
        eta, leverage = np.maximum(beta @ x.T, -30), np.einsum("ri,gij,rj->gr", x, inverse, x)
        most, value = nb.most_influential_of(read.sums, read.count, read.cells, bins, eta, leverage, columns, alpha)
        above = read.sums.sums(read.cells * (read.count > value[read.sums.gene]))
        tail = np.array([chi2_tail(v, columns - len(kept)) for v in stat.tolist()])
        error = np.sqrt(np.maximum(inverse[:, report, report], 0.0)) / math.log(2)
        return [genes, read.scaled / n, beta[:, report] / math.log(2), error, stat, tail, alpha, eta, leverage, converged & also,
                most, above.astype(np.int64)]

    return _gene_batches(joined, test, f"gene {ready.gene_type}, {_FIT_SCHEMA}")


def nb_lrt(counts: DataFrame, cells: DataFrame, factors: list[str], ready: Prepared | None = None,
           dispersions: DataFrame | None = None, alpha: float = 0.1, outliers: bool = True, filtering: bool = True) -> DataFrame:
    """Likelihood-ratio test of ``~ factors`` against ``~ 1`` with shrunken dispersions.

    Rows ``(gene, baseMean, log2FoldChange, lfcSE, stat, pvalue, padj, dispersion, ...)``; the fold change is that of the
    last coefficient. Genes with an outlying cell lose their p value (``outliers``), genes with too low a mean
    their adjusted p value (``filtering`` for discoveries at ``alpha``).
    """
    ready = ready or prepare(counts, cells, factors)
    if dispersions is None:
        dispersions = deseq_dispersion(ready).select("gene", F.col("map").alias("dispersion"))
    columns = ready.design.matrix.shape[1]
    tested = likelihood_ratio(ready, dispersions, drop=list(range(1, columns)))
    if outliers:
        tested = without_outliers(tested, ready)
    return independent_filter(tested, alpha) if filtering else bh_adjust(tested, "pvalue", "padj")


def cooks_cutoff(ready: Prepared, level: float = 0.99) -> float:
    """The ``level`` quantile of F with the number of coefficients and of the remaining cells; none without remaining cells."""
    columns, n = ready.design.matrix.shape[1], ready.bins.cells.sum()
    return f_quantile(level, columns, n - columns) if n > columns else math.inf


def without_outliers(tested: DataFrame, ready: Prepared, level: float = 0.99) -> DataFrame:
    """Null p value where the largest Cook's distance passes ``cooks_cutoff``.

    With a single factor of two levels a gene keeps it if at least three cells have larger counts than that cell.
    """
    flagged = F.coalesce(F.col("max_cooks") > cooks_cutoff(ready, level), F.lit(False))
    if len(ready.design.factors) == 1 and len(ready.design.rows) == 2:
        flagged = flagged & (F.col("cells_above") < 3)
    return tested.withColumn("pvalue", F.when(~flagged, F.col("pvalue")))


def independent_filter(tested: DataFrame, alpha: float = 0.1, mean: str = "baseMean", p: str = "pvalue", out: str = "padj") -> DataFrame:
    """Benjamini-Hochberg among genes whose mean reaches the cutoff with most discoveries at ``alpha``; others get null.

    ``CUTOFFS`` cutoffs are tried, quantiles of the mean at even steps from the share of zero means to 0.95 (to 1 if that
    share reaches 0.95). A gene takes part in every cutoff it reaches; p values are ranked inside all cutoffs in one
    pass, and the discoveries of a cutoff are the rank of the largest p value whose p * m / rank lies below ``alpha``. Of
    equal cutoffs the lowest wins. ``threshold`` is the chosen cutoff.
    """
    stable = settle(tested)
    zero = stable.agg(F.avg((F.col(mean) == 0).cast("double")).alias("z")).first()["z"]
    if zero is None:
        return stable.withColumn(out, F.lit(None).cast("double")).withColumn("threshold", F.lit(None).cast("double"))
    last = 0.95 if zero < 0.95 else 1.0
    steps = [zero + (last - zero) * k / (CUTOFFS - 1) for k in range(CUTOFFS)]
    names = [f"c{k}" for k in range(CUTOFFS)]
    cuts = list(quantiles(stable.select(mean), mean, steps, names, settled=True).first())
    # Cutoffs ascend, so a gene takes part in the first ones: up to the number of cutoffs not above its mean.
    reached = sum((F.when(F.col(mean) >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    parts = stable.filter(F.col(p).isNotNull()).select(p, F.explode(F.sequence(F.lit(1), reached)).alias("at"))
    ranked = value_ranks(parts, p, ["at"], few_values=False)
    rank = F.col("before") + F.col("n")
    found = ranked.groupBy("at").agg(F.max(F.when(F.col(p) * F.col("total") / rank < alpha, rank).otherwise(0)).alias("hits"))
    best = found.orderBy(F.desc("hits"), "at").first()
    threshold = cuts[best["at"] - 1 if best else 0]
    passed = bh_adjust(stable.filter(F.col(mean) >= threshold).select("gene", p), p, out).select("gene", out)
    return stable.join(passed, "gene", "left").withColumn("threshold", F.lit(float(threshold)))


def glm_lrt(counts: DataFrame, cells: DataFrame, group: str, coef: int = 1, ready: Prepared | None = None,
            dispersions: DataFrame | None = None, prior_n: float = 10.0) -> DataFrame:
    """Test of one coefficient (1 = first column) of the group design with tag-wise dispersions."""
    ready = ready or prepare(counts, cells, [group])
    if dispersions is None:
        dispersions = nb_dispersion(counts, cells.select("cell", F.col(group).alias("group")), prior_n).select(
            "gene", F.col("tagwise").alias("dispersion"))
    tested = likelihood_ratio(ready, dispersions, drop=[coef - 1], report=coef - 1)
    return bh_adjust(tested, "pvalue", "fdr")


def nb_dispersion(counts: DataFrame, groups: DataFrame, prior_n: float = 10.0,
                  grid: tuple[float, float, int] = (-9.0, 4.0, 27)) -> DataFrame:
    """Common and tag-wise dispersion by conditional likelihood: ``(gene, common, tagwise)``.

    Counts are scaled to the geometric-mean library. Unstored zeros add nothing to the
    conditional likelihood, so stored rows suffice. The likelihood is taken on a log2 grid of
    dispersions and its top is refined by a parabola; the tag-wise value maximizes the gene's own
    curve plus ``prior_n`` times the average curve.
    """
    low, high, points = grid
    library = library_size(counts)
    center = scalar(library.agg(F.avg(F.log("total_counts")).alias("c")))
    sizes = groups.groupBy("group").agg(F.count("*").cast("double").alias("n"))
    scale = library.join(groups, "cell").join(sizes, "group").select(
        "cell", "group", "n", (F.exp(center) / F.col("total_counts")).alias("_scale"))
    # Every row is evaluated on the whole grid, so genes are dealt over all tasks, whatever their bytes; a gene's rows stay together.
    pseudo = counts.filter("count > 0").join(scale, "cell").select(
        "gene", F.col("group").alias("row"), "n", F.lit(0.0).alias("log_size"), (F.col("count") * F.col("_scale")).alias("count"))
    inverse = 2.0 ** (low + (high - low) / (points - 1) * np.arange(points))

    def likelihood(genes: pa.Array, edges: np.ndarray, columns: dict[str, np.ndarray]) -> list:
        gene, y = np.repeat(np.arange(len(edges) - 1), np.diff(edges)), columns["count"]
        curve = np.zeros((len(edges) - 1, points))
        for at in range(0, len(y), nb.ON_GRID):  # also the rows of one gene
            part = slice(at, at + nb.ON_GRID)
            first = np.flatnonzero(np.diff(gene[part], prepend=-1))
            curve[gene[part][first]] += np.add.reduceat(nb.rising(y[part], np.zeros(len(y[part]), dtype=np.int64), inverse[None, :]), first)
        group = np.append(True, (gene[1:] != gene[:-1]) | (columns["row"][1:] != columns["row"][:-1]))
        first = np.flatnonzero(group)
        z, n = np.add.reduceat(y, first), columns["n"][first]
        given = nb.rising(z, np.arange(len(z)), inverse / n[:, None]) + z[:, None] * np.log(n)[:, None]
        return [genes, curve - np.add.reduceat(given, np.flatnonzero(np.diff(gene[first], prepend=-1)))]

    # What is added to either part for z * log(size) is the same, but for the sizes of the groups.
    kind = counts.schema["gene"].dataType.simpleString()
    curves = settle(_gene_batches(pseudo, likelihood, f"gene {kind}, c array<double>"))
    genes = scalar(curves.agg(F.count("*")))
    average = curves.select(F.posexplode("c").alias("at", "v")).groupBy("at").agg((F.sum("v") / genes).alias("v"))
    common = settle(average.agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("c")))
    common_value = scalar(common.select(_top_of(F.col("c"), low, high, points)))
    mean = scalar(common.select(F.transform("c", lambda p: p.v)))
    combined = F.transform("c", lambda v, at: F.struct(at.alias("at"), (v + prior_n * F.get(F.col("_mean"), at)).alias("v")))
    per_gene = curves.withColumn("_mean", mean).withColumn("c", combined)
    return per_gene.select("gene", common_value.alias("common"), _top_of(F.col("c"), low, high, points).alias("tagwise"))


def _top_of(curve, low: float, high: float, points: int):
    """Dispersion at the top of a sampled curve, refined by the parabola through three points."""
    best = F.array_max(F.transform(curve, lambda p: F.struct(p.v.alias("v"), (-p.at).alias("m"))))
    at = F.greatest(F.lit(1), F.least(F.lit(points - 2), -best.m))
    v0, v1, v2 = (F.get(curve, at + s).v for s in (-1, 0, 1))
    bend = v0 - 2.0 * v1 + v2
    shift = F.when(bend < 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 0.5 * (v0 - v2) / bend))).otherwise(-best.m - at)
    return F.pow(F.lit(2.0), F.lit(low) + (high - low) / (points - 1) * (at + shift))


def shrink_lfc(ready: Prepared, fitted: DataFrame, coefficient: int = 1, rounds: int = 500) -> DataFrame:
    """Fold changes of one coefficient under a Cauchy prior whose scale comes from all genes.

    ``fitted`` has that coefficient's ``log2FoldChange`` and ``lfcSE`` and the ``dispersion``. The
    prior variance solves the usual moment equation; each round is one aggregate.
    """
    x, bins = ready.design.matrix, ready.bins
    table = settle(fitted.select(
        "gene", "dispersion", (F.col("log2FoldChange") * math.log(2)).alias("b"),
        F.pow(F.col("lfcSE") * math.log(2), F.lit(2.0)).alias("v")))
    usable = table.filter((F.col("v") < 100) & (F.abs("b") < 10))
    prior = 1.0
    for _ in range(rounds):
        w = 1.0 / ((F.col("v") + prior) * (F.col("v") + prior))
        up, down = usable.agg(F.sum(w * (F.col("b") * F.col("b") - F.col("v"))), F.sum(w)).first()
        if not down:
            break
        new = max(up / down, 1e-6)
        close = abs(new - prior) < 1e-6 * prior
        prior = new
        if close:
            break
    else:
        raise ArithmeticError(f"the prior of fold changes has not converged in {rounds} rounds")
    scale, n = min(math.sqrt(prior), 1.0), bins.cells.sum()

    def refit(genes: pa.Array, edges: np.ndarray, columns: dict[str, np.ndarray]) -> list:
        read = _read_genes(edges, columns)
        alpha = columns["dispersion"][edges[:-1]]
        beta, weight, _, _ = nb.fits(x, read.sums, bins, alpha, prior_scale=scale, coefficient=coefficient)
        own = nb.inverses(x, weight)[:, coefficient, coefficient]
        b, s2 = beta[:, coefficient], scale * scale
        information = 1.0 / np.maximum(own, 1e-300) + 2 * (s2 - b * b) / (s2 + b * b) ** 2
        se = np.sqrt(np.where(information > 0, 1.0 / np.where(information > 0, information, 1.0), own))
        return [genes, read.scaled / n, b / math.log(2), se / math.log(2)]

    joined = ready.sums.join(table.select("gene", "dispersion"), "gene")
    return _gene_batches(joined, refit, f"gene {ready.gene_type}, baseMean double, log2FoldChange double, lfcSE double")


def cooks(counts: DataFrame, ready: Prepared, fitted: DataFrame, cells: DataFrame) -> DataFrame:
    """Cook's distance of every gene in the chosen cells, zeros included: ``(gene, cell, cooks)``.

    The result has genes x cells rows, none of which is shuffled: the cells of a design row are a range of numbers, and a gene's zeros lie
    between the numbers of its stored cells. What a number stands for is a row a cell, sent to every task.
    """
    columns = ready.design.matrix.shape[1]
    chosen = ready.numbered.join(cells.select("cell"), "cell", "left_semi").select("cell", "row", "size_factor")
    rows = fitted.select("gene", "dispersion", F.posexplode(F.arrays_zip("eta", "leverage")).alias("row", "at")).select(
        "gene", "dispersion", "row", "at.eta", "at.leverage")

    def distance(count) -> Column:
        mu = F.exp("eta") * F.col("size_factor")
        gap = count - mu
        hat = F.least(F.lit(0.999999), F.col("leverage") * mu / (1.0 + F.col("dispersion") * mu))
        return (gap * gap / (mu + F.col("dispersion") * mu * mu) / columns * hat / ((1.0 - hat) * (1.0 - hat))).alias("cooks")

    numbered, first, last = number_cells(chosen, "row")
    numbered = settle(numbered)
    stored = counts.join(numbered, "cell").select("gene", "row", "cell", "cell_number", "size_factor", "count")
    held = stored.groupBy("gene", "row").agg(F.array_sort(F.collect_set("cell_number")).alias("_held"))
    # Every row of genes costs as much as it has cells: dealt over all tasks, whatever their bytes.
    empty = rows.join(held, ["gene", "row"], "left").repartition(split_count(counts.sparkSession), F.xxhash64("gene", "row"))
    zeros = spread_between(empty, first, last, "_held").join(F.broadcast(numbered.select("cell", "cell_number", "size_factor")), "cell_number")
    return zeros.select("gene", "cell", distance(F.lit(0))).unionByName(
        stored.join(rows, ["gene", "row"]).select("gene", "cell", distance(F.col("count"))))


def find_markers(counts: DataFrame, cells: DataFrame, factor: str) -> DataFrame:
    """One-vs-rest markers of every level of a factor in one job.

    ``(gene, level, rate_in, rate_out, mean_in, mean_out, lfc, log2FoldChange, stat, pvalue,
    padj)``; padj is taken inside each level.
    """
    ready = prepare(counts, cells, [factor])
    bins, levels = ready.bins, [r[0] for r in ready.design.rows]
    n = bins.cells.sum()
    inverse_size = float(bins.cells @ np.exp(-bins.log_size) / n)
    two = np.array([[1.0, 0.0], [1.0, 1.0]])
    one = np.ones((2, 1))
    every = np.arange(len(levels))
    curves = bins.curves(len(levels))
    sides = [nb.JoinedRows(curves.joined([every[every != level], every[every == level]])) for level in range(len(levels))]

    def test(genes: pa.Array, edges: np.ndarray, columns: dict[str, np.ndarray]) -> list:
        read = _read_genes(edges, columns)
        start = _moment_dispersions(read, n, inverse_size)
        found = []
        for level in range(len(levels)):
            side, all_rows = sides[level], read.sums
            part = nb.GeneBatch(all_rows.genes, all_rows.gene, (all_rows.row == level).astype(np.int64), all_rows.log_size, all_rows.total)
            beta, _, _, _ = nb.fits(two, part, side, start)
            own = nb.best_dispersions(two, np.maximum(beta @ two.T, -30), part, side, read.seen)
            beta, _, full, _ = nb.fits(two, part, side, own)
            _, _, small, _ = nb.fits(one, part, side, own)
            stat = np.maximum(2 * (full - small), 0.0)
            found.append((np.full(len(stat), level), beta[:, 1] / math.log(2), stat, np.array([chi2_tail(v, 1) for v in stat.tolist()])))
        return [pa.concat_arrays([genes] * len(levels)), *(np.concatenate(c) for c in zip(*found))]

    kind = cells.schema[factor].dataType.simpleString()
    names = cells.sparkSession.createDataFrame(list(enumerate(levels)), f"at int, level {kind}")
    tested = _gene_batches(ready.sums, test, f"gene {ready.gene_type}, at int, log2FoldChange double, stat double, pvalue double")
    adjusted = bh_adjust(tested.join(F.broadcast(names), "at").drop("at"), "pvalue", "padj", keys=["level"])
    return group_stats(counts, cells, factor).join(adjusted, ["gene", "level"])


def ma_table(results: DataFrame, alpha: float = 0.1) -> DataFrame:
    """Mean against fold change with the significance flag."""
    called = F.coalesce(F.col("padj") < alpha, F.lit(False))
    return results.select("gene", "baseMean", "log2FoldChange", called.alias("significant"))


def volcano_table(results: DataFrame, p: str = "padj", alpha: float = 0.1, fold: float = 1.0) -> DataFrame:
    """Fold change against -log10 of the p value, with ``call`` up, down or none: below ``alpha`` and beyond ``fold``.

    Genes without p value are left out; a p value that underflows to 0 is drawn at the smallest double.
    """
    change, value = F.col("log2FoldChange"), F.greatest(F.col(p), F.lit(2.2250738585072014e-308))
    call = F.when((F.col(p) < alpha) & (change > fold), "up").when((F.col(p) < alpha) & (change < -fold), "down").otherwise("none")
    return results.filter(F.col(p).isNotNull()).select("gene", change, (-F.log10(value)).alias("strength"), call.alias("call"))


def smear_table(counts: DataFrame, results: DataFrame, max_p: float = 0.001) -> DataFrame:
    """log2 CPM against fold change with DE flag (adjusted p below ``max_p``)."""
    return results.join(_log_cpm_of_genes(counts), "gene").select(
        "gene", "log_cpm", "log2FoldChange", (F.col("fdr") < max_p).alias("de"))


def _log_cpm_of_genes(counts: DataFrame) -> DataFrame:
    everything = scalar(counts.agg(F.sum("count").alias("t")))
    return counts.groupBy("gene").agg(F.log2(F.sum("count") * 1e6 / everything).alias("log_cpm"))


def bcv_table(counts: DataFrame, dispersions: DataFrame) -> DataFrame:
    """log2 CPM against the biological coefficient of variation, common and tag-wise."""
    return dispersions.join(_log_cpm_of_genes(counts), "gene").select(
        "gene", "log_cpm", F.sqrt("common").alias("bcv_common"), F.sqrt("tagwise").alias("bcv_tagwise"))


def de_genes(tested: DataFrame, max_p: float = 0.001) -> DataFrame:
    return tested.filter(F.col("fdr") < max_p).select("gene")


def gene_counts(counts: DataFrame, size_factors: DataFrame, cells: DataFrame, gene, group: str) -> DataFrame:
    """Normalized count + 0.5 of one gene in every cell, with the cell's group."""
    own = counts.filter(F.col("gene") == gene).select("cell", "count")
    return cells.select("cell", F.col(group).alias("group")).join(size_factors, "cell").join(own, "cell", "left").select(
        "cell", "group", (F.coalesce("count", F.lit(0)) / F.col("size_factor") + 0.5).alias("value"))
