"""Time the headline queries and print one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from cellweave.plans import registry  # noqa: E402

HEADLINES = [
    "deinterleave", "library_size", "cell_qc", "filter_cpm", "cpm", "log_normalize", "gene_variance", "top_variance",
    "pct_top", "group_stats", "rank_average", "bh_adjust", "summarize_columns", "tmm_factors", "size_factors_ratio",
    "remove_batch", "explained_variance", "overlap_join", "count_features", "digital_expression", "nb_dispersion",
    "correlate_pairs", "base_content", "variable_gene_cpm",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    registry.QUERIES["library_size"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINES:
        begin = time.time()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - begin, 3)
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
