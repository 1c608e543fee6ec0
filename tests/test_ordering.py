import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cellweave.operators import ordering, ranking


def _skewed(n=3000, seed=3):
    """One group holds most rows and one value most of them."""
    rng = np.random.default_rng(seed)
    group = np.where(rng.random(n) < 0.6, 0, rng.integers(1, 6, n))
    value = np.where(rng.random(n) < 0.5, 1.0, rng.normal(size=n).round(3))
    return pd.DataFrame({"g": group, "v": value, "id": np.arange(n)})


def test_row_numbers_match_sorting(spark):
    pdf = _skewed()
    for descending in (False, True):
        got = ordering.row_numbers(spark.createDataFrame(pdf), "v", "id", ["g"], descending=descending).toPandas()
        want = pdf.sort_values(["g", "v", "id"], ascending=[True, not descending, True])
        want["want"] = want.groupby("g").cumcount() + 1
        both = got.merge(want, on="id")
        assert len(both) == len(pdf) and (both.row_number == both.want).all()


def test_quantiles_with_zeros_match_numpy(spark):
    pdf = _skewed()
    pdf = pdf[pdf.v != 0]
    got = ordering.quantiles(spark.createDataFrame(pdf), "v", [0.1, 0.5, 0.9], ["a", "b", "c"], ["g"], F.lit(4000)).toPandas()
    for row in got.itertuples():
        values = pdf.v[pdf.g == row.g].to_numpy()
        full = np.concatenate([values, np.zeros(4000 - len(values))])
        assert np.allclose([row.a, row.b, row.c], np.quantile(full, [0.1, 0.5, 0.9]))


def test_result_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(_skewed())
    results = []
    for n in (1, 7):
        table = ordering.row_numbers(df.repartition(n), "v", "id", ["g"])
        results.append(table.orderBy("id").select("id", "row_number").collect())
    assert results[0] == results[1]


def test_bh_matches_direct_formula(spark):
    p = np.round(np.random.default_rng(5).random(500), 2)
    got = ranking.bh_adjust(spark.createDataFrame(pd.DataFrame({"id": range(500), "p_value": p}))).toPandas().sort_values("id")
    order = np.argsort(-p, kind="stable")
    want = np.minimum(1, np.minimum.accumulate(p[order] * 500 / np.arange(500, 0, -1)))
    back = np.empty(500)
    back[order] = want
    assert np.allclose(got.fdr, back) and (got.fdr >= got.p_value - 1e-12).all()


def test_sampling_is_stable(spark):
    cells = spark.range(1000).withColumnRenamed("id", "cell")
    first = {r[0] for r in ranking.sample_cells(cells, 25).collect()}
    assert len(first) == 25 and first == {r[0] for r in ranking.sample_cells(cells.repartition(5), 25).collect()}
