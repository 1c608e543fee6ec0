import pytest

from cellweave.operators import grids, normalize


def test_rows_meet_every_cell_of_their_group_once(spark, monkeypatch):
    monkeypatch.setattr(grids, "SPAN", 3)  # several arrays a row
    cells = spark.createDataFrame([(f"c{i:02}", "abc"[(i % 7) // 3], i * 2) for i in range(25)] + [("none", None, 0)], "cell string, batch string, extra long")
    rows = spark.createDataFrame([(g, s, g * 10) for g in range(4) for s in "abcz"], "gene long, batch string, own long")
    got = [tuple(r) for r in grids.over_cells(rows, cells, "batch").select("gene", "batch", "own", "cell", "extra").collect()]
    assert sorted(got) == sorted((g, "abc"[(i % 7) // 3], g * 10, f"c{i:02}", i * 2) for g in range(4) for i in range(25))
    every = grids.over_cells(rows.select("gene").distinct(), cells.select("cell", "extra"))
    assert every.count() == 4 * 26 == every.select("gene", "cell").distinct().count()


def test_no_cells_or_no_groups(spark):
    cells = spark.createDataFrame([("a", None)], "cell string, batch string")
    rows = spark.createDataFrame([(1, "x")], "gene long, batch string")
    assert grids.over_cells(rows, cells, "batch").count() == 0
    assert grids.over_cells(rows.drop("batch"), cells.select("cell").limit(0)).count() == 0


def test_batch_removal_has_no_join_on_the_batch_of_the_grid(spark):
    cells = spark.createDataFrame([(i, "big" if i < 30 else "small") for i in range(40)], "cell long, batch string")
    assay = spark.createDataFrame([(g, i, float(g + (5 if i < 30 else 0))) for g in range(5) for i in range(40) if (g + i) % 3], "gene long, cell long, value double")
    out = normalize.remove_batch(assay, cells, "batch")
    got = {(r.gene, r.cell): r.value for r in out.collect()}
    x = {(r.gene, r.cell): r.value for r in assay.collect()}
    assert len(got) == 200
    for g in range(5):
        means = [sum(x.get((g, i), 0) for i in own) / len(own) for own in (range(30), range(30, 40))]
        for i in range(40):
            shift = means[i >= 30] - sum(means) / 2
            assert got[g, i] == pytest.approx(x.get((g, i), 0) - shift)
