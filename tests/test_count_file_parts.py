"""Count files of all runs come from one pass, with as many parts as their size asks for."""

from pathlib import Path

from cellweave.plans import read_queries
from cellweave.sources import readers


def test_a_small_run_is_one_file(spark, tmp_path):
    glob = read_queries._count_files(spark, "/root/testdata/sf0.001", str(tmp_path / "in"))
    parts = [len(list(folder.glob("part-*"))) for folder in (tmp_path / "in").glob("file=htseq_*_results.txt")]
    assert parts == [1] * 7 and Path(glob).name == "file=htseq_*_results.txt"
    assert sorted(r[0] for r in readers.read_count_files(spark, glob).select("run").distinct().collect()) == list("1234567")
