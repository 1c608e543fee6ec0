import math
import re

import numpy as np
import pandas as pd
import pytest

from cellweave.functions import nb, tails
from cellweave.operators import grids, models, normalize
from cellweave.plans import analyses


def test_tails():
    assert abs(tails.chi2_tail(3.841458820694124, 1) - 0.05) < 1e-12
    assert abs(tails.chi2_tail(9.487729036781154, 4) - 0.05) < 1e-12
    assert abs(tails.chi2_tail(11.070497693516351, 5) - 0.05) < 1e-12
    assert np.allclose(tails.lgamma_array(np.array([0.1, 1.0, 7.5])), [math.lgamma(v) for v in (0.1, 1.0, 7.5)])
    assert abs(tails.trigamma(1.0) - math.pi**2 / 6) < 1e-9


def test_fit_is_a_maximum():
    rng = np.random.default_rng(1)
    row, size = rng.integers(0, 3, 200), rng.normal(0, 0.3, 200)
    y = rng.poisson(np.exp(size + np.array([1.0, 2.0, 1.5])[row]))
    seen = y > 0
    bins = nb.CellBins(row, size, np.ones(200))
    gene = nb.GeneSums(row[seen], size[seen], y[seen].astype(float))
    x = np.column_stack([np.ones(3), [0, 1, 0], [0, 0, 1]])
    beta, _, best, _ = nb.fit(x, gene, bins, 0.2)
    for shift in np.eye(3) * 0.01:
        assert nb.log_likelihood(x @ (beta + shift), gene, bins, 0.2) < best
        assert nb.log_likelihood(x @ (beta - shift), gene, bins, 0.2) < best


def _simulated(spark, genes=60, cells=120):
    rng = np.random.default_rng(7)
    size = np.exp(rng.normal(0, 0.2, cells))
    group = np.array(["a", "b"])[np.arange(cells) % 2]
    mean = np.exp(rng.normal(2.0, 0.5, genes))[:, None] * size
    mean[:5, group == "b"] *= 4
    y = rng.negative_binomial(5, 5 / (5 + mean))
    g, c = np.nonzero(y)
    counts = pd.DataFrame({"gene": g, "cell": c, "count": y[g, c]})
    table = pd.DataFrame({"cell": np.arange(cells), "group": group, "size_factor": size})
    return spark.createDataFrame(counts), spark.createDataFrame(table)


def test_f_quantiles():
    for level, upper, lower, value in ((0.95, 1, 1, 161.447639), (0.99, 2, 10, 7.559432), (0.95, 4, 20, 2.866081), (0.5, 7, 7, 1.0)):
        assert abs(tails.f_quantile(level, upper, lower) - value) < 1e-5


def _bh(p):
    order = np.argsort(-p)
    q = np.minimum.accumulate(p[order] * len(p) / np.arange(len(p), 0, -1))
    out = np.empty(len(p))
    out[order] = np.minimum(q, 1)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_independent_filter_takes_the_cutoff_with_most_discoveries(spark, seed):
    rng = np.random.default_rng(seed)
    mean = np.where(rng.random(400) < 0.1, 0.0, np.exp(rng.normal(2, 2, 400)))
    p = np.where((mean > 20) & (rng.random(400) < 0.5), rng.random(400) * 0.02, rng.random(400)).round(3)
    known = (rng.random(400) > 0.05) & (mean > 0)
    table = pd.DataFrame({"gene": range(400), "baseMean": mean, "pvalue": np.where(known, p, np.nan)})
    frame = spark.createDataFrame(table).selectExpr("gene", "baseMean", "nanvl(pvalue, null) AS pvalue")
    got = models.independent_filter(frame).toPandas().sort_values("gene")
    best = (-1, None)
    for theta in np.linspace((mean == 0).mean(), 0.95, models.CUTOFFS):
        cutoff = np.quantile(mean, theta)
        inside = known & (mean >= cutoff)
        hits = (_bh(p[inside]) < 0.1).sum() if inside.any() else 0
        if hits > best[0]:
            best = (hits, cutoff)
    inside = known & (mean >= best[1])
    assert abs(got.threshold.iloc[0] - best[1]) < 1e-9 and best[0] > 10
    assert np.allclose(got.padj[inside], _bh(p[inside])) and got.padj[~inside].isna().all() and (known & ~inside).any()


def test_independent_filter_without_genes(spark):
    empty = spark.createDataFrame([], "gene int, baseMean double, pvalue double")
    assert models.independent_filter(empty).columns == ["gene", "baseMean", "pvalue", "padj", "threshold"]
    nothing = spark.createDataFrame([(1, 2.0, None)], "gene int, baseMean double, pvalue double")
    assert models.independent_filter(nothing).first()["padj"] is None


def _influence(y, size, row, eta, leverage, columns, alpha):
    """Cook's distances cell by cell, with the trimmed moments written out."""
    z, variances = y / size, []
    for r in set(row):
        own = np.sort(z[row == r])
        if len(own) >= 3:
            share, factor = (1 / 3, 2.04) if len(own) <= 3 else (1 / 4, 1.86) if len(own) <= 23 else (1 / 8, 1.51)
            cut = int(len(own) * share)
            middle = own[cut:len(own) - cut].mean()
            variances.append(factor * np.sort((own - middle) ** 2)[cut:len(own) - cut].mean())
    spread = max((max(variances) - z.mean()) / z.mean() ** 2, 0.04)
    mu = size * np.exp(eta[row])
    hat = leverage[row] * mu / (1 + alpha * mu)
    return (y - mu) ** 2 / (mu + spread * mu**2) / columns * hat / (1 - hat) ** 2


def test_outliers_lose_their_p_value(spark):
    """Also with counts above 4,096 and size factors closer than a thousandth of an octave."""
    counts, cells = _simulated(spark)
    wild = counts.unionByName(spark.createDataFrame([(30, 200, 90_000)], "gene long, cell long, count long")).filter("not (gene = 30 and cell = 7)")
    wild = wild.selectExpr("gene", "IF(cell = 200, 7, cell) AS cell", "count")
    ready = models.prepare(wild, cells, ["group"])
    dispersions = wild.selectExpr("gene", "0.2D AS dispersion").distinct()
    full = models.likelihood_ratio(ready, dispersions, [1]).toPandas().set_index("gene")
    table, levels = cells.toPandas(), sorted(set(cells.toPandas()["group"]))
    y = np.zeros((60, len(table)))
    for r in wild.collect():
        y[r["gene"], r["cell"]] = r["count"]
    row = table["group"].map(levels.index).to_numpy()
    for g in (0, 7, 30):
        want = _influence(y[g], table["size_factor"].to_numpy(), row, np.array(full.eta[g]), np.array(full.leverage[g]), 2, 0.2)
        assert abs(full.max_cooks[g] / want.max() - 1) < 1e-9
        assert full.cells_above[g] == (y[g] > y[g][want.argmax()]).sum()
    assert full.converged.all()
    kept = models.nb_lrt(wild, cells, ["group"], dispersions=dispersions).toPandas().set_index("gene")
    assert np.isnan(kept.pvalue[30]) and kept.pvalue[:5].notna().all()
    again = models.nb_lrt(wild, cells, ["group"], dispersions=dispersions, outliers=False, filtering=False).toPandas().set_index("gene")
    assert again.pvalue.notna().all() and again.padj.notna().all()
    near = models.prepare(wild, cells.withColumn("size_factor", cells.size_factor * 1.0), ["group"], bins_per_octave=1024)
    binned = models.likelihood_ratio(near, dispersions, [1]).toPandas().set_index("gene")
    assert np.allclose(binned.log2FoldChange[:20], full.log2FoldChange[:20], atol=2e-3)


def test_planted_genes_are_found(spark):
    counts, cells = _simulated(spark)
    results = models.nb_lrt(counts, cells, ["group"]).toPandas().set_index("gene").sort_index()
    assert (results.padj[:5] < 1e-6).all()
    assert (results.log2FoldChange[:5] > 1.4).all()
    assert (results.pvalue[5:] < 0.01).mean() < 0.1
    assert results.dispersion.between(0.02, 1.0).mean() > 0.9


def test_markers_point_to_the_right_level(spark):
    counts, cells = _simulated(spark)
    found = models.find_markers(counts, cells, "group").toPandas()
    top = found[(found.level == "b") & (found.gene < 5)]
    assert (top.log2FoldChange > 1.4).all() and (top.padj < 1e-6).all()


def test_tmm_factors_have_geometric_mean_one(spark):
    counts, _ = _simulated(spark)
    factors = normalize.tmm_factors(counts).toPandas().factor
    assert abs(np.log(factors).mean()) < 1e-9


def test_tmm_of_libraries_that_hold_one_gene(spark):
    """Cells and a reference that hold the same gene only: equal shares, no variance to divide by."""
    counts = spark.createDataFrame([(1, 1, 5), (1, 2, 9), (1, 3, 2), (2, 3, 7)], "gene long, cell long, count long")
    factors = {r.cell: r.factor for r in normalize.tmm_factors(counts).collect()}
    assert factors[1] == factors[2] and abs(np.log(list(factors.values())).sum()) < 1e-9
    sizes = {r.cell: r.size_factor for r in normalize.tmm_size_factors(counts).collect()}
    assert abs(sizes[2] / sizes[1] - 9 / 5) < 1e-9


def test_pooled_factors_follow_the_planted_sizes(spark):
    counts, cells = _simulated(spark, genes=200)
    found = normalize.size_factors_pooled(counts).toPandas().merge(cells.toPandas(), on="cell", suffixes=("", "_true"))
    assert np.corrcoef(np.log(found.size_factor), np.log(found.size_factor_true))[0, 1] > 0.9


@pytest.mark.parametrize("n, weight, chunk", [(900, 30.0, None), (900, 30.0, 1), (37, 1.0, None), (7, 1.0, None), (2500, 0.5, 300), (100, 1e-6, None)])
def test_ring_solution_satisfies_the_equations(spark, n, weight, chunk):
    """One chunk, many chunks, rings shorter than a pool, and the weight in use, against the system written out."""
    pools, truth = [], np.random.default_rng(2).random(n) + 0.5
    for size in (5, 10, 15, 20):
        for at in range(n):
            row = np.zeros(n)
            np.add.at(row, np.arange(at, at + size) % n, 1.0)
            pools.append(row)
    a = np.array(pools)
    b = a @ truth + np.random.default_rng(3).normal(0, 0.1, len(a))
    rhs = a.T @ b + weight
    ring = spark.createDataFrame(pd.DataFrame({"cell": range(n), "position": range(n), "n_cells": n, "rhs": rhs}))
    got = normalize._solve_ring(ring, (5, 10, 15, 20), weight, chunk).toPandas().sort_values("cell")
    assert len(got) == n
    assert np.abs((a.T @ a + weight * np.eye(n)) @ got.theta.to_numpy() - rhs).max() < 2e-7 * np.abs(rhs).max()


def test_method_names():
    assert analyses.split_method("DESeq:TMM") == ("deseq", "tmm")
    with pytest.raises(ValueError):
        analyses.split_method("Scatter:Default")


def test_dispersion_curves_are_added_up_where_their_gene_is(spark, monkeypatch):
    """Only finished curves are shuffled by gene and grid point, not those of a gene's parts."""
    plans = []

    def settle(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(models, "settle", settle)
    counts = spark.createDataFrame([(g, c, 1 + (g * c) % 5) for g in range(6) for c in range(8)], "gene long, cell long, count long")
    groups = spark.createDataFrame([(c, "ab"[c % 2]) for c in range(8)], "cell long, group string")
    assert models.nb_dispersion(counts, groups).count() == 6
    assert not re.search(r"hashpartitioning\(gene#\d+L, cell#\d+L, \d+\), REPARTITION_BY_NUM", plans[0])


def test_fits_read_tables_of_the_cells_and_no_cell_without_a_count():
    rng = np.random.default_rng(8)
    row, log_size = np.repeat([0, 1, 2], 400), np.concatenate([np.sort(rng.normal(0, 1, 400)) for _ in range(3)])
    cells = rng.integers(1, 4, 1200).astype(float)
    curves = nb.CellBins(row, log_size, cells).curves(3)
    for t in (-70.0, -41.2, -3.3, 0.4, 12.8, 60.0):
        z = np.exp(t + log_size)
        want = np.stack([np.bincount(row, cells * v) for v in (np.log1p(z), z / (1 + z), z / (1 + z) ** 2)], axis=1)
        assert np.allclose(curves.at(np.full(3, t)), want, rtol=1e-13)
    x = np.array([[1.0, 0, 0], [1, 1, 0], [1, 0, 1]])
    seen = np.sort(rng.choice(1200, 40, replace=False))
    count = rng.integers(1, 30, 40).astype(float)
    gene = nb.GeneSums(row[seen], log_size[seen], count)
    only = nb.JoinedRows(curves)  # holds no cells
    beta, inverse, _, rest = nb.fit(x, gene, only, 0.4)
    eta = x @ beta
    mu = np.exp(log_size + eta[row])
    total = np.bincount(seen, count, 1200)
    assert rest and np.allclose(x.T @ np.bincount(row, (total - cells * mu) / (1 + 0.4 * mu)), 0, atol=1e-6)
    assert 1e-8 <= nb.best_dispersion(x, eta, gene, only, *[v.astype(float) for v in np.unique(count, return_counts=True)]) <= 20
    rows = pd.DataFrame({"row": row[seen], "log_size": log_size[seen], "count": count, "cells": 1.0})
    leverage = np.einsum("ij,jk,ik->i", x, inverse, x)
    top, value = nb.most_influential(rows, nb.CellBins(row, log_size, cells), eta, leverage, 3, 0.4)
    held = np.append(np.ones(40), cells - np.bincount(seen, minlength=1200))
    y, r, s = np.append(count, np.zeros(1200)), np.append(row[seen], row), np.append(log_size[seen], log_size)
    y, r, s, held = (v[held > 0] for v in (y, r, s, held))
    spread = nb.robust_dispersion(r, y / np.exp(s), held, 3)
    m = np.exp(s + eta[r])
    hat = leverage[r] * m / (1 + 0.4 * m)
    distance = (y - m) ** 2 / (m + spread * m * m) / 3 * hat / (1 - hat) ** 2
    assert np.isclose(top, distance.max(), rtol=1e-9) and value == y[distance.argmax()]


def test_genes_are_read_whole_across_batches(spark):
    rows = [(g, 0, 0.1 * k, float(k + 1), 1.0) for g in (None, 1, 2, 3) for k in range(7)] + [(4, 0, 0.0, 2.0, 3.0)]
    frame = spark.createDataFrame(rows, "gene long, row int, log_size double, count double, cells double")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (1, 3, 5, 1000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
            got = models._each_gene(frame, lambda r: [(r["gene"], len(r["row"]), float(r["count"].sum()), bool(np.all(np.diff(r["log_size"]) >= 0)))],
                                    "gene long, n long, total double, ordered boolean").collect()
            assert sorted(map(tuple, got), key=lambda r: r[0] or 0) == [(g, 7, 28.0, True) for g in (None, 1, 2, 3)] + [(4, 1, 2.0, True)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_genes_of_a_batch_are_fitted_as_if_alone():
    """One pass over a batch, whatever steps its genes need: also genes of one count, of huge counts and of a single design row."""
    rng = np.random.default_rng(11)
    row, log_size = np.repeat([0, 1, 2], 50), np.concatenate([np.sort(rng.normal(0, 0.5, 50)) for _ in range(3)])
    bins = nb.CellBins(row, log_size, np.ones(150))
    x, wide = np.array([[1.0, 0, 0], [1, 1, 0], [1, 0, 1]]), np.array([[1.0, 0], [1, 1], [1, 1]])
    genes = []
    for k in range(30):
        seen = np.sort(rng.choice(150 if k % 5 else 50, 1 if k == 7 else 40, replace=False))
        genes.append((seen, rng.negative_binomial(2, 0.1, len(seen)) + 1.0 + (90_000.0 if k == 9 else 0.0)))
    gene, at, count = (np.concatenate(v) for v in ([np.full(len(s), k) for k, (s, _) in enumerate(genes)], [s for s, _ in genes], [c for _, c in genes]))
    batch, alpha = nb.GeneBatch(30, gene, row[at], log_size[at], count), rng.uniform(0.05, 2, 30)
    order = np.lexsort((count, gene))
    seen = nb.CountValues(gene[order], count[order], np.ones(len(order)))
    calls = []
    look = nb.CellCurves.at
    nb.CellCurves.at = lambda self, t, *rest: calls.append(len(t)) or look(self, t, *rest)
    try:
        for design in (x, wide):
            calls.clear()
            beta, weight, value, rest = nb.fits(design, batch, bins, alpha)
            assert len(calls) < 300 and max(calls) == 30  # not one pass a gene
            own = nb.best_dispersions(design, np.maximum(beta @ design.T, -30), batch, bins, seen)
            top, cell = nb.most_influential_of(batch, count, np.ones(len(count)), bins, beta @ design.T, np.ones((30, 3)) * 0.1, 3, alpha)
            for k, (s, c) in enumerate(genes):
                alone = nb.GeneSums(row[s], log_size[s], c)
                b, inverse, v, r = nb.fit(design, alone, bins, alpha[k])
                assert rest[k] == r and np.allclose(beta[k], b, atol=1e-8) and np.isclose(value[k], v) and np.allclose(nb.inverses(design, weight)[k], inverse)
                one = nb.best_dispersion(design, np.maximum(design @ b, -30), alone, bins, *np.unique(c, return_counts=True))
                assert np.isclose(own[k], one, rtol=1e-6)
                rows = {"row": row[s], "log_size": log_size[s], "count": c, "cells": np.ones(len(c))}
                t, w = nb.most_influential(rows, bins, design @ b, np.ones(3) * 0.1, 3, alpha[k])
                assert np.isclose(top[k], t) and cell[k] == w
    finally:
        nb.CellCurves.at = look


def test_differences_of_log_gamma_keep_their_digits():
    """Against the sum of logs, where the difference of two large terms has lost it."""
    for value, alpha in ((50.0, 1e-8), (3.0, 1e-5), (700.0, 0.2), (1.0, 20.0)):
        want = math.fsum(math.log1p(k * alpha) for k in range(int(value)))
        assert abs(nb.rising(np.array([value]), np.array([0]), np.array([[alpha]]))[0, 0] - want) < 1e-11 * max(1.0, want)


def test_genes_of_a_batch_end_where_the_next_begins(spark, monkeypatch):
    """Batches that are larger and smaller than one gene's rows, with null and string genes."""
    rows = [(g, k % 2, 0.1 * k, float(k + 1), 1.0) for g in (None, "a", "b", "c", "d") for k in range(9)]
    frame = spark.createDataFrame(rows, "gene string, row int, log_size double, count double, cells double")
    for most, size in ((1, 2), (9, 4), (20, 3), (1 << 16, 7)):
        monkeypatch.setattr(models, "AT_ONCE", most)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
        try:
            body = lambda genes, edges, c: [genes, np.diff(edges), np.add.reduceat(c["count"], edges[:-1])]
            got = models._gene_batches(frame, body, "gene string, n long, total double").collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert sorted(map(tuple, got), key=lambda r: r[0] or "") == [(g, 9, 45.0) for g in (None, "a", "b", "c", "d")]


def test_cooks_of_every_gene_and_chosen_cell_without_a_shuffle_of_them(spark, monkeypatch):
    monkeypatch.setattr(grids, "SPAN", 5)  # several arrays a row
    counts, cells = _simulated(spark, genes=12, cells=60)
    counts = counts.filter("not (gene = 3 and cell % 2 = 1)").unionByName(spark.createDataFrame([(4, 1000, 7)], counts.schema))
    ready = models.prepare(counts, cells, ["group"])
    fitted = models.likelihood_ratio(ready, counts.selectExpr("gene", "0.2D AS dispersion").distinct(), [1])
    found = models.cooks(counts, ready, fitted, cells.filter("cell <> 5").select("cell"))
    assert not re.search(r"hashpartitioning\((cell_number|gene#\d+L, cell)", found._jdf.queryExecution().executedPlan().toString())
    got = {(r.gene, r.cell): r.cooks for r in found.collect()}
    assert found.count() == len(got) == 12 * 59
    y, table = {(r["gene"], r["cell"]): r["count"] for r in counts.collect()}, cells.toPandas()
    for r in fitted.collect():
        for c, group, size in table[["cell", "group", "size_factor"]].itertuples(index=False):
            at = "ab".index(group)
            mu = math.exp(r.eta[at]) * size
            hat = min(0.999999, r.leverage[at] * mu / (1 + 0.2 * mu))
            want = (y.get((r.gene, c), 0) - mu) ** 2 / (mu + 0.2 * mu * mu) / 2 * hat / (1 - hat) ** 2
            assert c == 5 or abs(got[r.gene, c] - want) <= 1e-9 * max(want, 1e-12)
