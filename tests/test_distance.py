import hashlib
import itertools

import numpy as np
import pandas as pd

from cellweave.functions import digests
from cellweave.operators import distance, lookups, variance


def test_flat_cell_has_no_correlation_distance(spark):
    rows = [(g, c, float(v)) for c, own in enumerate([(2, 2, 2), (1, 5, 9), (9, 5, 1)]) for g, v in enumerate(own)]
    got = {(r.i, r.j): r.d for r in distance.pearson_distance(spark.createDataFrame(rows, "gene long, cell long, value double")).collect()}
    assert got[(0, 1)] is None and got[(0, 2)] is None and abs(got[(1, 2)] - 2.0) < 1e-9


def test_finished_pairs_are_not_shuffled(spark):
    """Sparse, dense and string items; only blocks are shuffled, never rows of pairs."""
    rng = np.random.default_rng(5)
    for share in (0.02, 0.9):
        x = rng.poisson(3.0, (40, 90)) * (rng.random((40, 90)) < share) + (np.arange(90) == 0) * 1.0
        x[7] = 0
        i, j = np.nonzero(x)
        rows = pd.DataFrame({"cell": [f"c{k:02d}" for k in i], "gene": j, "value": x[i, j]})
        rows.loc[len(rows)] = ["c07", 3, 0.0]
        got = distance.euclidean(spark.createDataFrame(rows), block=9)
        table = got.toPandas()
        a, b = table.i.str[1:].astype(int), table.j.str[1:].astype(int)
        assert len(table) == 40 * 39 // 2 and (table.i < table.j).all()
        assert np.allclose(table.d, np.linalg.norm(x[a] - x[b], axis=1))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[:plan.index("MapInPandas")]


def test_labels_shuffle_no_pair(spark):
    rows = [(g, c, float(v)) for c, own in enumerate([(2, 1, 2), (1, 5, 9), (9, 5, 1)]) for g, v in enumerate(own)]
    pairs = distance.pearson_distance(spark.createDataFrame(rows, "gene long, cell long, value double"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = distance.heatmap_distances(pairs, spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "cell long, kind string"), "kind")
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.i, r.j, r.label_i, r.label_j) for r in got.collect()) == [(0, 1, "a", "b"), (0, 2, "a", "c"), (1, 2, "b", "c")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_gene_pairs_are_never_broadcast(spark):
    got = lookups.gene_pairs(spark.range(0, 300, 3).withColumnRenamed("id", "gene"), block_rows=9)
    assert sorted(map(tuple, got.collect())) == list(itertools.combinations(range(0, 300, 3), 2))
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()


def test_no_null_correlations_below_two_cells(spark):
    """As when a filter has left no gene and so no cell."""
    assert [r.rho for n in (0, 1) for r in variance.null_correlations(spark, n, draws=2).collect()] == [None] * 4
    nothing = spark.createDataFrame([], "gene long, cell long, value double")
    assert variance.correlate_pairs(nothing, nothing, n_cells=0, draws=10).count() == 0


def test_null_correlations_follow_the_order_of_the_digests(spark):
    got = variance.null_correlations(spark, 41, draws=30, seed=7)
    assert "MapInPandas" in got._jdf.queryExecution().executedPlan().toString()  # arrays of numbers, not one struct a place
    want = []
    for draw in range(30):
        order = sorted(range(1, 42), key=lambda k: hashlib.md5(f"7-{draw}-{k}".encode()).hexdigest())
        want.append(1.0 - 6.0 * sum((x - k) ** 2 for k, x in enumerate(order, 1)) / (41 * (41 * 41 - 1.0)))
    assert sorted(r.rho for r in got.collect()) == sorted(want)


def test_blocks_are_written_once_and_never_copied(spark, monkeypatch):
    """Many blocks of bounded size; each pair of blocks meets in one order, and items whose values are all null or zero stay."""
    monkeypatch.setattr(distance, "ENTRIES", 20)
    rng = np.random.default_rng(6)
    x = rng.poisson(1.0, (30, 12)).astype(float)
    x[4] = 0
    i, j = np.nonzero(x)
    rows = [(int(a), int(c), float(x[a, c])) for a, c in zip(i, j)] + [(4, 2, None), (4, 3, 0.0)]
    assay = spark.createDataFrame(rows, "cell long, gene long, value double")
    blocks = distance._written_blocks(assay, "value", "cell", "gene", 256)
    assert blocks.count() > len(rows) // 20 - 3 and sum(len(r.v) // 8 for r in blocks.collect()) == len(i)
    got = distance.pair_products(assay)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Exchange" not in plan
    table = got.toPandas()
    assert len(table) == 30 * 29 // 2 == len(table.drop_duplicates(["i", "j"])) and (table.i < table.j).all()
    assert np.allclose(table.xy, (x @ x.T)[table.i, table.j])


def test_digests_of_numbered_texts():
    """Numbers of all lengths, in several parts, after texts of all lengths, also those that need a second block of MD5."""
    for start in (b"", b"7-", b"100-99999-", b"x" * 49, b"x" * 50, b"x" * 60):
        count = 12_345 if len(start) < 20 else 1_000
        halves = digests.md5_of_numbered(start, count, digests.numbered_words(len(start), count))
        want = [hashlib.md5(start + b"%d" % k).digest() for k in range(1, count + 1)]
        assert [int(a).to_bytes(8, "big") + int(b).to_bytes(8, "big") for a, b in zip(*halves)] == want


def test_null_correlations_hash_many_places_at_once(spark, monkeypatch):
    """One call of the library a place took most of the time."""
    calls, whole = [], hashlib.md5
    monkeypatch.setattr(hashlib, "md5", lambda *a: calls.append(1) or whole(*a))
    digests.md5_of_numbered(b"100-5-", 5000, digests.numbered_words(6, 5000))
    assert not calls
