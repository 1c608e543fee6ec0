import numpy as np
import pandas as pd
import pytest

from cellweave import context
from cellweave.operators import clustering, distance, projection


def _points(n=40):
    rng = np.random.default_rng(4)
    return np.vstack([rng.normal(c, 0.5, (n // 2, 6)) for c in (0.0, 4.0)])


def _distances(spark, x):
    i, j = np.triu_indices(len(x), 1)
    return spark.createDataFrame(pd.DataFrame({"i": i, "j": j, "d": np.linalg.norm(x[i] - x[j], axis=1)}))


def _naive_heights(x, squared):
    d = np.linalg.norm(x[:, None] - x[None], axis=2) ** (2 if squared else 1)
    np.fill_diagonal(d, np.inf)
    size, heights = np.ones(len(x)), []
    for _ in range(len(x) - 1):
        a, b = divmod(int(d.argmin()), len(x))
        heights.append(d[a, b])
        merged = ((size[a] + size) * d[a] + (size[b] + size) * d[b] - size * d[a, b]) / (size[a] + size[b] + size)
        merged[[a, b]] = np.inf
        d[a], d[:, a], d[b], d[:, b] = merged, merged, np.inf, np.inf
        size[a] += size[b]
    return np.sqrt(heights) if squared else np.array(heights)


@pytest.mark.parametrize("variant", ["ward.D", "ward.D2"])
def test_ward_equals_sequential_ward(spark, variant):
    """Also more cells than were once finished in one task."""
    x = _points(24 if variant == "ward.D" else 90)
    merges = clustering.ward(_distances(spark, x), variant).toPandas().sort_values("step")
    assert np.allclose(merges.height, np.sort(_naive_heights(x, variant == "ward.D2")))
    assert merges["size"].max() == len(x)


def test_ward_with_equal_distances_and_a_chain(spark):
    """Ties go by name; unlike distances merge few pairs a round."""
    tied = pd.DataFrame([(i, j, 1.0) for i in range(6) for j in range(i + 1, 6)], columns=["i", "j", "d"])
    got = clustering.ward(spark.createDataFrame(tied)).toPandas().sort_values("step")
    assert got[["left", "right"]].values.tolist()[0] == [0, 1] and got["size"].max() == 6 and len(got) == 5
    x = np.cumsum(1.5 ** np.arange(9))[:, None]
    chain = clustering.ward(_distances(spark, x)).toPandas().sort_values("step")
    assert np.allclose(chain.height, _naive_heights(x, False)) and chain["left"].tolist() == [0, 2, 0, 4, 6, 0, 6, 0]
    with pytest.raises(ValueError):
        clustering.ward(spark.createDataFrame([(1, 2, 1.0), (3, 4, 1.0)], "i int, j int, d double"))


def test_ward_over_many_groups_of_rows(spark, monkeypatch):
    """Rows of a merge meet in one group, copies of a cell tie, and a cell whose distances are all null has no place in the tree."""
    monkeypatch.setattr(clustering, "BLOCK", 64)
    x = np.random.default_rng(3).normal(size=(24, 5))
    x[12:18] = x[:6] + 1e-9
    near = _distances(spark, x)
    lost = spark.createDataFrame([(i, 30, None) for i in range(24)], "i bigint, j bigint, d double")
    merges = clustering.ward(near.unionByName(lost)).toPandas().sort_values("step")
    assert len(merges) == 23 and 30 not in set(merges.right)
    assert np.allclose(merges.height, np.sort(_naive_heights(x, False)))


def test_ward_merges_equal_cells_at_once(spark, monkeypatch):
    """Two sets of equal cells take no round each, and give the tree of single merges."""
    rounds, plan = [], clustering._plan
    monkeypatch.setattr(clustering, "_plan", lambda rows: rounds.append(1) or plan(rows))
    x = np.random.default_rng(5).normal(size=(30, 4))
    x[3:12], x[20:30] = x[3], x[20]
    merges = clustering.ward(_distances(spark, x)).toPandas().sort_values("step")
    assert np.allclose(merges.height, np.sort(_naive_heights(x, False))) and len(rounds) < 9
    zero = merges[merges.height == 0]
    assert set(zero.left) == {3, 20} and zero[zero.left == 3].right.tolist() == list(range(4, 12)) and zero[zero.left == 3].left_size.tolist() == list(range(1, 9))


def test_ward_deals_its_rows_in_passes(spark, monkeypatch):
    """Every pass shuffles a part of the rows, and its shuffle files are gone when it is written."""
    held, whole = [], context.written
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()

    def written(df, name):
        out = whole(df, name)
        files = manager.diskBlockManager().getAllFiles()
        held.append(sum("shuffle" in files.apply(k).getName() for k in range(files.size())))
        return out

    monkeypatch.setattr(clustering, "written", written)
    monkeypatch.setattr(clustering, "BLOCK", 64)
    monkeypatch.setattr(clustering, "PASS", 200)
    x = np.random.default_rng(13).normal(size=(24, 5))
    merges = clustering.ward(_distances(spark, x)).toPandas().sort_values("step")
    assert np.allclose(merges.height, np.sort(_naive_heights(x, False)))
    assert len(held) > 20 and held[-1] <= held[0]


def test_cut_and_order(spark):
    x = _points()
    merges = clustering.ward(_distances(spark, x))
    clusters = clustering.cut_k(merges, 2).toPandas().sort_values("cell").cluster.to_numpy()
    assert len(set(clusters[:20])) == 1 and len(set(clusters[20:])) == 1 and clusters[0] != clusters[-1]
    order = clustering.leaf_order(merges).toPandas().sort_values("position")
    assert list(order.position) == list(range(1, 41))
    assert len(set(clusters[order.cell.to_numpy()][:20])) == 1
    small = clustering.cut_height(merges, 0.5, 5).toPandas()
    assert set(small.cluster) == {1, 2}


def test_components_of_a_long_chain(spark):
    edges = pd.DataFrame({"gene1": range(0, 60), "gene2": range(1, 61)})
    edges.loc[30] = [100, 101]
    modules = clustering.gene_modules(spark.createDataFrame(edges)).toPandas()
    assert sorted(modules.groupby("module").gene.count()) == [2, 30, 31]


def _assay(spark, x):
    i, j = np.nonzero(x)
    return spark.createDataFrame(pd.DataFrame({"cell": i, "gene": j, "value": x[i, j]}))


def test_blocked_products_over_many_blocks(spark):
    x = np.random.default_rng(8).poisson(0.4, (50, 70)).astype(float)
    got = distance.pair_products(_assay(spark, x), block=8, chunk=16).toPandas()
    present = [c for c in range(50) if x[c].any()]
    assert len(got) == len(present) * (len(present) - 1) // 2
    assert np.allclose(got.xy, (x @ x.T)[got.i, got.j])


def test_pca_matches_numpy(spark):
    x = _points() + 10
    scores, shares = projection.pca(_assay(spark, x), spark.range(40).withColumnRenamed("id", "cell"), ntop=6, k=2)
    got = scores.toPandas().sort_values("cell")
    u, s, _ = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert np.allclose(np.abs(got.PC1), np.abs(u[:, 0] * s[0]))
    assert abs(shares.toPandas().percent[0] - 100 * s[0] ** 2 / (s**2).sum()) < 1e-6


def test_mds_recovers_distances(spark):
    x = _points(24)[:, :2]
    axes = projection.mds(_distances(spark, x), 2).toPandas().sort_values("cell")[["axis1", "axis2"]].to_numpy()
    want = np.linalg.norm(x[:, None] - x[None], axis=2)
    assert np.abs(np.linalg.norm(axes[:, None] - axes[None], axis=2) - want).max() < 1e-3
