import gzip

from cellweave.sources import readers
from cellweave.streaming import ingest

LINES = ["g1\t5", "g2\tNA", "g3\t7\t8", "g4", "", '"g5"\t9\r', "\t3", "g6\t99999999999999999999", "__no_feature\t4", " \t "]
BAD = ["g2\tNA", "g3\t7\t8", "g4", "\t3", "g6\t99999999999999999999"]


def files(folder):
    (folder / "htseq_a_results.txt").write_text("\n".join(LINES) + "\n")
    (folder / "htseq_b_results.txt").write_text("g1\t1\n")
    (folder / "htseq_empty_results.txt").write_text("")
    (folder / "htseq_z_results.txt.gz").write_bytes(gzip.compress(b"g1\t3\n")[:10] + b"\xff" * 40)
    return str(folder / "htseq_*_results.txt*")


def test_batch_names_lines_and_files_it_leaves_out(spark, tmp_path):
    paths = files(tmp_path)
    counts = {tuple(r) for r in readers.read_count_files(spark, paths).collect()}
    assert counts == {("a", "g1", 5), ("a", "g5", 9), ("a", "__no_feature", 4), ("b", "g1", 1)}
    assert sorted(r.line for r in readers.damaged_count_lines(spark, paths).collect()) == sorted(BAD)
    report = {r.path.rsplit("/htseq_")[-1].split("_")[0]: (r.rows, r.malformed, r.skipped) for r in readers.count_file_report(spark, paths).collect()}
    assert report == {"a": (3, 5, False), "b": (1, 0, False), "z": (0, 0, True)}


def test_stream_counts_and_keeps_the_same_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    paths = files(tmp_path / "in")
    query = ingest.ingest_counts(ingest.stream_counts(spark, paths, 1), str(tmp_path / "out"), str(tmp_path / "c1"))
    query.awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("a", "g1", 5), ("a", "g5", 9), ("b", "g1", 1)}
    assert ingest.lines_of(query) == {"rows": 4, "malformed": 5}
    ingest.ingest_counts(ingest.stream_damaged(spark, paths, 1), str(tmp_path / "bad"), str(tmp_path / "c2")).awaitTermination()
    assert sorted(r.line for r in spark.read.parquet(str(tmp_path / "bad")).collect()) == sorted(BAD)
