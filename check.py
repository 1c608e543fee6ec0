"""Run registered queries next to their SQL in DuckDB and compare: ``check.py [folder] [names...]``."""

import sys
import time
import traceback

import duckdb

sys.path.insert(0, __file__.rsplit("/", 1)[0])

from pyspark.sql import SparkSession  # noqa: E402

from cellweave.plans import registry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    key = lambda v: "~" if v is None else f"{float(v):.6g}" if isinstance(v, float) else str(v)
    return [names[i] for i in order], sorted(tuple(key(r[i]) for i in order) for r in rows)


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(registry.QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    bad = 0
    for name in chosen:
        begin = time.time()
        try:
            df = registry.QUERIES[name](spark, folder)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - begin
            text = registry.ORACLES.get(name)
            if text is None:
                print(f"ROWS  {name:28s} {len(rows):8d} rows {took:6.1f}s", flush=True)
                continue
            cursor = db.execute(text)
            names = [c[0] for c in cursor.description]
            types = [str(c[1]) for c in cursor.description]
            want = cursor.fetchall()
            a, b = canonical(df.columns, rows), canonical(names, want)
            ok = a == b
            bad += not ok
            print(f"{'OK   ' if ok else 'WRONG'} {name:28s} {len(rows):8d} rows {took:6.1f}s oracle {time.time()-begin-took:5.1f}s", flush=True)
            odd = [f"{n}:{t}" for n, t in zip(names, types) if "DECIMAL" in t or "HUGE" in t or t == "INTEGER"]
            odd += [f"{n}:{t}" for n, t in df.dtypes if t == "int" or "decimal" in t]
            if odd:
                print("   types to mend:", odd)
            if not ok:
                print("   columns", a[0], b[0], dict(df.dtypes), types, "rows", len(rows), len(want))
                print("   ", [r for r in a[1] if r not in set(b[1])][:2], [r for r in b[1] if r not in set(a[1])][:2])
        except Exception as error:
            bad += 1
            print(f"FAIL  {name}: {type(error).__name__} {str(error)[:1500]}", flush=True)
            if "-v" in sys.argv:
                traceback.print_exc()
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))
