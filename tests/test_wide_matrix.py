"""Wide matrices: work follows the stored values, not one row per field or one sort of whole lines."""

import pytest

from cellweave.sources import readers, writers


def test_no_whole_line_is_sorted_or_made_a_row_per_zero(spark, tmp_path):
    cells = [f"c{i}" for i in range(3000)]
    stored = [("g1", "c0", 7), ("g1", "c2999", 100), ("g2", "c1500", 10), ("g3", "c4", 0)]
    writers.write_matrix(spark.createDataFrame(stored, "gene string, cell string, count bigint"), str(tmp_path / "m"), cells)
    back = readers.read_matrix(spark, str(tmp_path / "m") + "/*.gz")
    assert sorted(tuple(r) for r in back.collect()) == [("g1", "c0", 7), ("g1", "c2999", 100), ("g2", "c1500", 10)]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode(arrays_zip" not in plan and "min_by" not in plan
    dense = readers.read_matrix(spark, str(tmp_path / "m") + "/*.gz", keep_zeros=True)
    assert dense.count() == 9000 and dense.filter("count = 0").count() == 8997


def test_headers_and_odd_fields(spark, tmp_path):
    (tmp_path / "a.txt").write_text('\n"x"\t"y"\tz\r\nA\t0\t00\t0.0\r\n\nB\t10\t0\t200\nC\t0\t5\n')
    (tmp_path / "b.txt").write_text("gene\ty\tx\nA\t3\t0\n")
    back = readers.read_matrix(spark, [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")])
    # C has as many fields as the header of its file, whose first name then stands for the gene.
    assert sorted(tuple(r) for r in back.collect()) == [("A", "y", 3), ("B", "x", 10), ("B", "z", 200), ("C", "z", 5)]


def test_a_value_counted_twice_is_an_error(spark, tmp_path):
    twice = spark.createDataFrame([("g", "a", 1), ("g", "a", 2)], "gene string, cell string, count bigint")
    with pytest.raises(Exception, match="twice"):
        writers.write_matrix(twice, str(tmp_path / "m"), ["a", "b"])
