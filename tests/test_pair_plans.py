"""Pairs meet their rows once: one join for marker pairs, one trimming for mates."""

from cellweave.operators import lookups, reads


def test_marker_pairs_take_one_join(spark):
    assay = spark.createDataFrame([("a", "c1", 3), ("b", "c1", 4), ("b", "c2", 5), ("z", "c2", 6)], "gene string, cell string, count bigint")
    pairs = spark.createDataFrame([("S", "a", "b"), ("S", "b", "b"), ("G1", "x", "a")], "phase string, first string, second string")
    seen = lookups.pair_expression(assay, pairs)
    assert sorted(tuple(r) for r in seen.collect()) == [
        ("G1", "x", "a", "c1", 0.0, 3.0), ("S", "a", "b", "c1", 3.0, 4.0), ("S", "a", "b", "c2", 0.0, 5.0),
        ("S", "b", "b", "c1", 4.0, 4.0), ("S", "b", "b", "c2", 5.0, 5.0)]
    assert seen._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_mates_are_trimmed_once(spark):
    good, short = "A" * 40, "A" * 10
    rows = [("r", i, mate, f"n{i}", s, "I" * len(s)) for i, pair in enumerate([(good, good), (good, short), (short, short)])
            for mate, s in enumerate(pair, 1)]
    table = spark.createDataFrame(rows, "run string, read_idx bigint, mate int, name string, seq string, qual string")
    kept = reads.trim_reads(table, paired=True)
    assert sorted((r["read_idx"], r["mate"], r["pairing"]) for r in kept.collect()) == [(0, 1, "p"), (0, 2, "p"), (1, 1, "u")]
    assert "Join" not in kept._jdf.queryExecution().optimizedPlan().toString()
