import gzip
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cellweave.operators import alignments, reads
from cellweave.sources import readers, writers


def _fastq(n, prefix="r"):
    return "".join(f"@{prefix}{k}\n{'ACGT' * (k % 5 + 1)}\n+\n@{'I' * (4 * (k % 5 + 1) - 1)}\n" for k in range(n))


def test_fastq_in_many_splits(spark, tmp_path):
    (tmp_path / "run7.fastq").write_text(_fastq(500))
    (tmp_path / "empty.fastq").write_text("")
    with gzip.open(tmp_path / "run8.fastq.gz", "wt") as out:
        out.write(_fastq(20, "z"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        table = readers.read_fastq(spark, str(tmp_path)).toPandas()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    own = table[table.run == "run7"].sort_values("read_idx")
    assert list(own.name) == [f"r{k}" for k in range(500)] and (own.seq.str.len() == own.qual.str.len()).all()
    assert (own.qual.str[0] == "@").all() and (table.run == "run8").sum() == 20


@pytest.mark.parametrize("split", [60, 137, 400, 5000])
def test_fastq_is_whole_for_any_split(spark, tmp_path, split):
    """Qualities that begin with @ and +, reads longer than a split, names like plus lines, carriage returns."""
    rng = random.Random(split)
    records = []
    for k in range(160):
        size = rng.choice([1, 5, 30, 400])
        records.append((f"{rng.choice('r+@')}{k}", "".join(rng.choice("ACGTN") for _ in range(size)), "".join(rng.choice("@+I#") for _ in range(size))))
    text = "".join(f"@{n}\r\n{s}\r\n+{rng.choice(['', n])}\r\n{q}\r\n" for n, s, q in records)
    (tmp_path / "long.fastq").write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        table, damaged = readers.read_fastq_checked(spark, str(tmp_path))
        rows = table.orderBy("read_idx").collect()
        lost = damaged.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r.read_idx, r.name, r.seq, r.qual) for r in rows] == [(k, *r) for k, r in enumerate(records)] and lost == 0
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" not in plan and "hashpartitioning(path" not in plan  # text is read once, and records stay where they are


@pytest.mark.parametrize("split", [200, 100_000])
def test_damaged_fastq_lines_are_given(spark, tmp_path, split):
    good = _fastq(60)
    lines = good.splitlines(keepends=True)
    del lines[4 * 30 + 2]  # a lost plus line
    (tmp_path / "bad.fastq").write_text("".join(lines) + "@cut\nACG\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        table, damaged = readers.read_fastq_checked(spark, str(tmp_path))
        names = {r.name for r in table.collect()}
        lost = [x for r in damaged.collect() for x in r.lines]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert names == {f"r{k}" for k in range(60)} - {"r30"}
    assert {"@r30", "@cut"} <= set(lost) and len(lost) == 5


def test_fastq_of_empty_files(spark, tmp_path):
    (tmp_path / "e.fastq").write_text("")
    table, damaged = readers.read_fastq_checked(spark, str(tmp_path))
    assert table.count() == damaged.count() == 0


def test_paired_files_and_interleaving(spark, tmp_path):
    (tmp_path / "x_1.fastq").write_text(_fastq(4, "a"))
    (tmp_path / "x_2.fastq").write_text(_fastq(4, "b"))
    pairs = readers.read_fastq_paired(spark, str(tmp_path)).toPandas().sort_values("read_idx")
    assert list(zip(pairs.name1, pairs.name2)) == [(f"a{k}", f"b{k}") for k in range(4)]


def test_manifest_with_carriage_returns(spark, tmp_path):
    path = tmp_path / "meta.txt"
    path.write_bytes(b"ID\tIndividual\tExperiment\tRun\tFASTQ_URI\tmolecular_subtype\r\n"
                     b"BC01\tBC01\tX1\tR1\t\t (ER+)\r\nBC01.1\tBC01\tX2\tR2\t\t (ER+)")
    table = readers.read_manifest(spark, str(path)).toPandas()
    assert list(table.molecular_subtype) == ["(ER+)", "(ER+)"] and table.fastq_uri.isna().all()
    assert list(table.id) == ["BC01", "BC01.1"]


def test_matrix_round_trip_keeps_wide_columns(spark, tmp_path):
    counts = pd.DataFrame({"gene": ["g1", "g1", "g2"], "cell": ["c1", "c3", "c2"], "count": [5, 7, 9]})
    writers.write_matrix(spark.createDataFrame(counts), str(tmp_path / "m"), ["c1", "c2", "c3"], chunk=2)
    back = readers.read_matrix(spark, str(tmp_path / "m") + "/*.gz").toPandas().sort_values(["gene", "cell"])
    assert back.values.tolist() == counts.values.tolist()


def test_matrix_with_short_quoted_header(spark, tmp_path):
    (tmp_path / "a_counts.txt").write_text('"c1"\t"c2"\n"g1"\t1\t0\n"g2"\t0\t0\n"__ambiguous"\t3\t4\n')
    back = readers.read_count_dir(spark, str(tmp_path)).toPandas()
    assert back.values.tolist() == [["g1", "c1", 1]]


def test_dge_names_cells_by_position(spark, tmp_path):
    with gzip.open(tmp_path / "R1_dge.txt.gz", "wt") as out:
        out.write("GENE\tAAA\tCCC\ng1\t0\t2\ng2\t3\t0\n")
    manifest = spark.createDataFrame([("R1", "BC01")], "run string, id string")
    back = readers.read_dge_files(spark, str(tmp_path), manifest).toPandas().sort_values("gene")
    assert back.values.tolist() == [["g1", "BC01_2", 2], ["g2", "BC01_1", 3]]


def test_sectioned_matrix(spark, tmp_path):
    head = "".join(f"\tf{k}\t{k}\t{k * 10}\n" for k in range(10))
    (tmp_path / "s.txt").write_text(head + "\t\t\t\n" + "g1\tx\t4\t0\ng2\tx\t0\t6\n")
    metadata, counts = readers.read_sectioned_matrix(spark, str(tmp_path / "s.txt"))
    assert metadata.filter("field = 'f3'").orderBy("cell").select("value").toPandas().value.tolist() == ["3", "30"]
    assert sorted(map(tuple, counts.toPandas().values.tolist())) == [("g1", 1, 4), ("g2", 2, 6)]


def test_spliced_counting(spark, tmp_path):
    (tmp_path / "r.sam").write_text(
        "@HD\tVN:1\n"
        "a\t0\tc\t100\t60\t10M100N10M\t*\t0\t0\tA\tI\tNH:i:1\n"
        "b\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\n"
        "c\t0\tc\t150\t60\t10M\t*\t0\t0\tA\tI\tNH:i:1\n"
        "d\t0\tc\t105\t60\t120M\t*\t0\t0\tA\tI\tNH:i:1\n")
    exons = spark.createDataFrame([("g1", "c", 90, 110), ("g2", "c", 220, 230)], "gene string, chrom string, start int, end int")
    got = {r.gene: r["count"] for r in alignments.count_features(readers.read_sam(spark, str(tmp_path)), exons).collect()}
    assert got == {"g1": 1, "__not_aligned": 1, "__no_feature": 1, "__ambiguous": 1}


def test_adapter_and_palindrome_clipping(spark):
    adapter = "AGATCGGAAGAGCACACGTCTGAACTCCAGTCA"
    insert = "ACGTTGCAACGGTTAACCGGATATCCGGAATTCACGGTACCATGGTTTCAGATTACACC"
    changed = adapter[:4] + "A" + adapter[5:]
    table = pd.DataFrame({"run": "r", "mate": 1, "read_idx": [0, 1], "name": "n",
                          "seq": [insert + changed, insert], "qual": ["I" * len(insert + changed), "I" * len(insert)]})
    adapters = spark.createDataFrame([("a", adapter)], "name string, seq string")
    got = reads.clip_adapters(spark.createDataFrame(table), adapters).orderBy("read_idx").toPandas()
    assert list(got.seq) == [insert, insert] and list(got.qual.str.len()) == [len(insert)] * 2
    mate = insert.translate(reads.COMPLEMENT)[::-1]
    pair = pd.DataFrame({"seq1": [insert + adapter], "qual1": ["I" * (len(insert) + 33)], "seq2": [mate + adapter], "qual2": ["I" * (len(insert) + 33)]})
    cut = reads.clip_palindromes(spark.createDataFrame(pair)).first()
    assert cut.seq1 == insert and cut.seq2 == mate


def test_paired_trimming_classes(spark):
    good, bad = "I" * 40, "#" * 40
    rows = [("r", m, k, "n", "A" * 40, q) for k, (q1, q2) in enumerate([(good, good), (good, bad), (bad, bad)]) for m, q in ((1, q1), (2, q2))]
    table = spark.createDataFrame(rows, "run string, mate int, read_idx bigint, name string, seq string, qual string")
    got = reads.trim_reads(table, paired=True).groupBy("pairing").agg(F.count("*").alias("n")).collect()
    assert {r.pairing: r.n for r in got} == {"p": 2, "u": 1}


def test_matrix_refuses_a_cell_without_a_column(spark, tmp_path):
    counts = spark.createDataFrame([("g1", "c1", 1), ("g1", "c9", 2)], "gene string, cell string, count long")
    with pytest.raises(Exception, match="counted cell without a column: c9"):
        writers.write_matrix(counts, str(tmp_path / "m"), ["c1", "c2"])
