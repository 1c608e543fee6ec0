"""Box-plot numbers are taken from distinct values of a cell with their numbers."""

from cellweave.operators import summaries


def test_equal_values_are_merged_before_fences(spark):
    rows = [(g, "a", 1 + g % 3) for g in range(60)] + [(100, "a", 90), (0, "b", 5)]
    counts = spark.createDataFrame(rows, "gene bigint, cell string, count bigint")
    cells = spark.createDataFrame([("a",), ("b",)], "cell string")
    stats = summaries.box_stats(counts, cells)
    got = {r["cell"]: tuple(r)[1:] for r in stats.collect()}
    assert got == {"a": (1.0, 1.0, 2.0, 3.0, 3.0), "b": (0.0, 0.0, 0.0, 0.0, 0.0)}
    plan = stats._jdf.queryExecution().optimizedPlan().toString()
    # Rows of genes are counted, never joined with the fences of their cell.
    below_joins = [line for line in plan.splitlines() if "LogicalRDD" in line or "LocalRelation" in line]
    assert below_joins and "Aggregate [cell" in plan and "count(1)" in plan and "sum(_n" in plan
    exact = summaries.box_stats(counts.withColumn("count", counts["count"] * 1.0), cells)
    assert {r["cell"]: tuple(r)[1:] for r in exact.collect()} == got
