from cellweave.operators import alignments


def _counts(spark, rows):
    table = spark.createDataFrame([("r", n, f, c, p, q, g, {"NH": h} if h else {}) for n, f, c, p, q, g, h in rows],
                                  "run string, name string, flag int, chrom string, pos int, mapq int, cigar string, tags map<string,string>")
    exons = spark.createDataFrame([("g1", "c", 100, 120), ("g2", "c", 200, 220)], "gene string, chrom string, start int, end int")
    return alignments.count_features(table, exons)


ROWS = [
    ("one", 0, "c", 100, 60, "10M", "1"), ("spliced", 0, "c", 110, 60, "10M80N10M", "1"), ("none", 0, "c", 500, 60, "10M", None),
    ("multi", 1, "c", 100, 60, "10M", "1"), ("multi", 1, "c", 200, 60, "10M", "2"),  # the unique mate does not save its read
    ("low", 1, "c", 100, 60, "10M", "1"), ("low", 1, "c", 100, 3, "10M", "1"), ("unmapped", 4, "*", 0, 0, "*", None),
    ("half", 1, "c", 200, 60, "10M", "1"), ("half", 5, "*", 0, 0, "*", None), ("unknown", 0, "c", 205, None, "5M", None),
    ("second", 256, "c", 100, 60, "10M", "1")]


def test_classes_of_reads(spark):
    got = {r.gene: r["count"] for r in _counts(spark, ROWS).collect()}
    assert got == {"g1": 1, "g2": 2, "__ambiguous": 1, "__no_feature": 1, "__alignment_not_unique": 1, "__too_low_aQual": 1, "__not_aligned": 1}


def test_decided_alignments_make_no_blocks(spark, monkeypatch):
    """Only alignments that may still decide on a gene are cut into blocks."""
    seen, whole = [], alignments.alignment_blocks

    def watched(table):
        seen.append(sorted(r.name for r in table.select("name").collect()))
        return whole(table)

    monkeypatch.setattr(alignments, "alignment_blocks", watched)
    _counts(spark, ROWS).collect()
    assert seen == [["half", "low", "multi", "none", "one", "spliced", "unknown"]]
