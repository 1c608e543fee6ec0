"""Run a query of the text operators on small tables next to its SQL."""

import duckdb


def compare(spark, query, sql, folder, names):
    db = duckdb.connect()
    for t in names:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    df = query(spark, str(folder))
    cursor = db.execute(sql)
    columns = [c[0] for c in cursor.description]
    assert set(columns) == set(df.columns), (columns, df.columns)
    want = sorted(map(repr, cursor.fetchall()))
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got == want, ([x for x in got if x not in want][:3], [x for x in want if x not in got][:3])
    return got


def write(folder, **tables):
    """Write pandas or Arrow tables as one Parquet file each."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    for name, rows in tables.items():
        pq.write_table(rows if isinstance(rows, pa.Table) else pa.table(rows), f"{folder}/{name}.parquet")
    return str(folder)
