import duckdb
import pytest

import __spark_entry__ as contract

DATA = "/root/testdata/sf0.001"
NAMES = ["filter_cpm", "cell_qc", "summarize_columns", "rank_average", "spearman_distance", "overlap_join", "nb_dispersion"]


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["gene", "cell", "cpm"] and df.limit(1).count() == 1


def test_every_counterpart_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, name):
    db = duckdb.connect()
    for t in ("supplier", "nation", "region", "part", "orders", "lineitem", "events", "documents", "embeddings", "customer"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = contract.queries()[name](spark, DATA)
    cursor = db.execute(contract.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    order = [names.index(c) for c in df.columns]
    key = lambda r: tuple(f"{float(v):.6g}" if isinstance(v, float) else str(v) for v in r)
    want = sorted(key([r[i] for i in order]) for r in cursor.fetchall())
    assert sorted(key(r) for r in df.collect()) == want
