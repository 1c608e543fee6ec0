import numpy as np
import pytest

from cellweave.operators import clustering, heatmap


def test_every_cell_of_the_matrix_once_with_silent_genes_and_cells(spark):
    rng = np.random.default_rng(4)
    x = np.where(rng.random((6, 9)) < .5, rng.random((6, 9)) * 5, 0)
    x[:3, :4] += 20  # two blocks
    x[5, :] = 0
    x[:, 8] = 0
    rows = [(g, c, float(x[g, c])) for g in range(6) for c in range(9) if x[g, c]] + [(77, 1, 3.0)]
    assay = spark.createDataFrame(rows, "gene long, cell long, value double")
    cells = spark.createDataFrame([(c, "ab"[c < 4]) for c in range(9)], "cell long, factor string")
    genes = spark.createDataFrame([(g,) for g in range(6)], "gene long")
    got = heatmap.heatmap_matrix(assay, genes, cells, "factor").collect()
    assert len(got) == 54 and {(r.gene_position, r.cell_position) for r in got} == {(i, j) for i in range(1, 7) for j in range(1, 10)}
    for r in got:
        assert r.value == pytest.approx(x[r.gene, r.cell] - x[r.gene].mean()) and r.label == "ab"[r.cell < 4]
    raised = sorted({r.cell_position for r in got if r.cell < 4})
    assert raised[-1] - raised[0] == 3  # the block stands together
    raised = sorted({r.gene_position for r in got if r.gene < 3})
    assert raised[-1] - raised[0] == 2


def test_one_gene_one_cell_and_nothing(spark):
    assay = spark.createDataFrame([(1, 1, 2.0)], "gene long, cell long, value double")
    cells = spark.createDataFrame([(1, "a")], "cell long, factor string")
    one = heatmap.heatmap_matrix(assay, assay.select("gene"), cells, "factor").collect()
    assert [tuple(r) for r in one] == [(1, 1, 1, 1, 0.0, "a")]
    assert heatmap.heatmap_matrix(assay, assay.select("gene"), cells.limit(0), "factor").count() == 0
    assert heatmap.heatmap_matrix(assay, assay.select("gene").limit(0), cells, "factor").count() == 0


def test_equal_cells_need_no_distances(spark, monkeypatch):
    """Sets of equal and of silent cells: the tree of all cells, from the pairs of unlike ones only; also of cells that are all equal."""
    seen, whole = [], heatmap.euclidean
    monkeypatch.setattr(heatmap, "euclidean", lambda assay: seen.append(assay.select("cell").distinct().count()) or whole(assay))
    x = np.random.default_rng(9).integers(1, 9, (4, 30)).astype(float)
    x[:, 3:12], x[:, 20:30] = x[:, [3]], 0
    assay = spark.createDataFrame([(g, c, float(x[g, c])) for g in range(4) for c in range(30) if x[g, c]], "gene long, cell long, value double")
    cells, genes = spark.range(30).selectExpr("id AS cell", "'a' AS factor"), spark.range(4).withColumnRenamed("id", "gene")
    got = {r.cell: r.cell_position for r in heatmap.heatmap_matrix(assay, genes, cells, "factor").filter("gene = 0").collect()}
    assert seen[0] == 13 and sorted(got.values()) == list(range(1, 31))
    stored = heatmap.with_silent(assay, genes, cells)
    want = {r.cell: r.position for r in clustering.leaf_order(clustering.ward(whole(stored))).collect()}
    assert got == want
    same = spark.range(5).selectExpr("0L AS gene", "id AS cell", "2.0D AS value")
    flat = heatmap.heatmap_matrix(same, genes.limit(1), cells.filter("cell < 5"), "factor").collect()
    assert sorted((r.cell, r.cell_position) for r in flat) == [(c, c + 1) for c in range(5)]
