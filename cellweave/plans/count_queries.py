"""Queries on the count model: lookups, filters, summaries, ranks and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.functions.columns import log2p1, run_from_path, strip_version
from cellweave.operators import filters, lookups, ranking, summaries
from cellweave.plans import bindings as b
from cellweave.plans.bindings import sql
from cellweave.plans.catalog import query, rounded

# ---- columns and filters -------------------------------------------------------------------


@query("strip_version", sql("annotation", "SELECT gene, regexp_replace(ensembl, '\\..*', '') AS id FROM annotation"))
def _(spark, d):
    return b.annotation(spark, d).select("gene", strip_version("ensembl").alias("id"))


@query("drop_summary_rows", sql("run_counts", """, mixed AS (
  SELECT run, CAST(gene AS VARCHAR) AS gene, count FROM run_counts
  UNION ALL SELECT run, '__no_feature', SUM(count) FROM run_counts GROUP BY run)
SELECT run, gene, CAST(count AS BIGINT) AS count FROM mixed WHERE NOT starts_with(gene, '__')"""))
def _(spark, d):
    raw = b.run_counts(spark, d)
    summary = raw.groupBy("run").agg(F.lit("__no_feature").alias("gene"), F.sum("count").alias("count"))
    mixed = raw.withColumn("gene", F.col("gene").cast("string")).unionByName(summary)
    return filters.drop_summary_rows(mixed)


@query("run_from_path", """SELECT o_orderkey AS id,
  regexp_extract(concat('/data/htseq_', o_orderkey, '_results.txt'), 'htseq_([^/]*)_results\\.txt$', 1) AS htseq,
  regexp_extract(concat('/data/', o_custkey, '_dge.txt.gz'), '([^/]*)_dge\\.txt\\.gz$', 1) AS dge,
  concat(o_orderkey, '_1.fastq') AS base FROM orders""")
def _(spark, d):
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    return b.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"),
        run_from_path(F.concat(F.lit("/data/htseq_"), key, F.lit("_results.txt")), "htseq").alias("htseq"),
        run_from_path(F.concat(F.lit("/data/"), cust, F.lit("_dge.txt.gz")), "dge").alias("dge"),
        run_from_path(F.concat(F.lit("https://host/x/"), key, F.lit("_1.fastq.gz")), "any").alias("base"))


@query("flag_controls", """SELECT p_partkey AS gene, p_name AS symbol, p_name LIKE 'small%' AS is_small,
  p_name LIKE '%widget' AS is_widget, NOT (p_name LIKE 'small%' OR p_name LIKE '%widget') AS is_endogenous FROM part""")
def _(spark, d):
    names = b.annotation(spark, d).select("gene", "symbol")
    return filters.flag_controls(names, {"small": "^small", "widget": "widget$"}, "symbol")


@query("filter_min_total", sql("counts", """SELECT gene, cell, count FROM counts WHERE gene IN
  (SELECT gene FROM counts GROUP BY gene HAVING SUM(count) >= 600)"""))
def _(spark, d):
    return filters.filter_min_total(b.counts(spark, d), 600)


@query("filter_cpm", sql("counts library", """SELECT gene, cell, count FROM counts WHERE gene IN (
  SELECT c.gene FROM counts c JOIN library l USING (cell) WHERE c.count * 1e6 > l.total_counts * 2500
  GROUP BY c.gene HAVING COUNT(*) >= 10)"""))
def _(spark, d):
    return filters.filter_cpm(b.counts(spark, d), 2500, 10)


@query("filter_min_mean", sql("counts size", """SELECT gene, cell, count FROM counts WHERE gene IN
  (SELECT gene FROM counts GROUP BY gene HAVING SUM(count) >= 7 * (SELECT n_cells FROM size))"""))
def _(spark, d):
    return filters.filter_min_mean(b.counts(spark, d), 7)


@query("filter_min_cells", sql("counts", """SELECT gene, cell, count FROM counts WHERE gene IN
  (SELECT gene FROM counts GROUP BY gene HAVING COUNT(*) >= 27)"""))
def _(spark, d):
    return filters.filter_min_cells(b.counts(spark, d), 27)


@query("genes_in_min_cells", sql("counts", "SELECT gene, COUNT(*) AS n_cells FROM counts GROUP BY gene HAVING COUNT(*) >= 27"))
def _(spark, d):
    return filters.genes_in_min_cells(b.counts(spark, d), 27)


@query("filter_nonzero", sql("counts", "SELECT gene, cell, count FROM counts WHERE count > 0"))
def _(spark, d):
    return filters.filter_nonzero(b.counts(spark, d))


@query("fill_zero", sql("counts", """SELECT g.gene, COALESCE(c.count, 0) AS count FROM (SELECT p_partkey AS gene FROM part) g
LEFT JOIN (SELECT gene, count FROM counts WHERE cell = 0) c USING (gene)"""))
def _(spark, d):
    own = b.counts(spark, d).filter("cell = 0").select("gene", "count")
    return filters.fill_zero(b.genes(spark, d).select("gene").join(own, "gene", "left"), ["count"])


@query("drop_incomplete", sql("counts", """SELECT p_partkey AS gene, x.count FROM part
JOIN (SELECT gene, count FROM counts WHERE cell = 0) x ON gene = p_partkey"""))
def _(spark, d):
    own = b.counts(spark, d).filter("cell = 0").select("gene", "count")
    return filters.drop_incomplete(b.genes(spark, d).select("gene").join(own, "gene", "left"))


@query("select_significant", sql("p", "SELECT gene, value FROM p WHERE p_value <= 0.05 AND value >= 0.5 AND value > 1.5"))
def _(spark, d):
    return filters.select_significant(b.event_p(spark, d), "p_value", 0.05, {"value": 0.5}, {"value": 1.5}).select("gene", "value")


@query("pending_runs", """SELECT o_orderkey AS run, o_orderstatus AS status FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def _(spark, d):
    manifest = b.table(spark, d, "orders").select(F.col("o_orderkey").alias("run"), F.col("o_orderstatus").alias("status"))
    return filters.pending_runs(manifest, b.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("run")))


# ---- lookups and merges --------------------------------------------------------------------


@query("attach_cell_id", sql("run_counts", """, m AS (SELECT CAST(s_nationkey AS VARCHAR) AS run, MIN(s_name) AS cell FROM supplier GROUP BY 1)
SELECT r.run, r.gene, r.count, m.cell FROM run_counts r LEFT JOIN m USING (run)"""))
def _(spark, d):
    manifest = b.table(spark, d, "supplier").select(F.col("s_nationkey").cast("string").alias("run"), F.col("s_name").alias("id"))
    return lookups.attach_cell_id(b.run_counts(spark, d), manifest)


@query("cell_factors", sql("cells", "SELECT cell, individual, factor FROM cells"))
def _(spark, d):
    manifest = b.cells(spark, d).select(F.col("cell").alias("id"), "individual", "factor")
    return lookups.cell_factors(b.counts(spark, d).select("cell").distinct(), manifest, ["individual", "factor"])


@query("unpivot_factors", sql("cells", """SELECT cell, 'individual' AS factor, individual AS value FROM cells
UNION ALL SELECT cell, 'region', factor FROM cells"""))
def _(spark, d):
    wide = b.cells(spark, d).select("cell", "individual", F.col("factor").alias("region"))
    return lookups.unpivot_factors(wide, ["individual", "region"])


@query("merge_dge", sql("counts", "SELECT gene, cell, count FROM counts"))
def _(spark, d):
    quantities = b.table(spark, d, "lineitem").select(
        "l_linenumber", F.col("l_partkey").alias("gene"), F.col("l_suppkey").alias("cell"),
        F.col("l_quantity").cast("bigint").alias("count"))
    parts = [quantities.filter(F.col("l_linenumber") == k).drop("l_linenumber") for k in range(1, 8)]
    return lookups.merge_dge(parts)


@query("merge_wide", sql("run_counts", """SELECT gene, CAST(SUM(CASE WHEN run = '1' THEN count ELSE 0 END) AS BIGINT) AS r1,
CAST(SUM(CASE WHEN run = '2' THEN count ELSE 0 END) AS BIGINT) AS r2,
CAST(SUM(CASE WHEN run = '3' THEN count ELSE 0 END) AS BIGINT) AS r3
FROM run_counts WHERE run IN ('1', '2', '3') GROUP BY gene"""))
def _(spark, d):
    runs = b.run_counts(spark, d)
    parts = [runs.filter(F.col("run") == str(k)).select("gene", F.col("count").alias(f"r{k}")) for k in (1, 2, 3)]
    return lookups.merge_wide(parts)


@query("bind_counts", sql("run_counts", "SELECT run, gene, count FROM run_counts"))
def _(spark, d):
    runs = b.run_counts(spark, d)
    return lookups.bind_counts([runs.filter(F.col("run") == str(k)) for k in range(1, 8)])


@query("attach_length", sql("annotation", """, l AS (SELECT symbol AS gene, len, row_number() OVER (PARTITION BY symbol ORDER BY gene) AS rn FROM annotation)
SELECT a.gene AS part, a.symbol AS gene, l.len FROM annotation a LEFT JOIN l ON a.symbol = l.gene AND rn = 1"""))
def _(spark, d):
    ann = b.annotation(spark, d)
    lengths = ann.select(F.col("symbol").alias("gene"), "len", F.col("gene").alias("position"))
    return lookups.attach_length(ann.select(F.col("gene").alias("part"), F.col("symbol").alias("gene")), lengths, "position")


@query("map_ids", sql("annotation", """SELECT n_name AS symbol, x.gene FROM (SELECT symbol AS n_name FROM annotation UNION SELECT n_name FROM nation) n
LEFT JOIN (SELECT symbol, MIN(gene) AS gene FROM annotation GROUP BY symbol) x ON x.symbol = n.n_name"""))
def _(spark, d):
    ann = b.annotation(spark, d)
    ids = ann.select("symbol").union(b.table(spark, d, "nation").select("n_name")).distinct()
    return lookups.map_ids(ids, ann.select("symbol", "gene"), "gene", key="symbol")


@query("convert_ids", sql("annotation", """, k AS (SELECT symbol, len, COUNT(*) AS n, MIN(gene) AS g FROM annotation GROUP BY symbol, len)
SELECT symbol, MAX(CASE WHEN t = 1 THEN g END) AS put_na, MIN(g) AS use_first FROM
(SELECT symbol, g, SUM(n) OVER (PARTITION BY symbol) AS t FROM k) GROUP BY symbol"""))
def _(spark, d):
    ann = b.annotation(spark, d).select("symbol", "gene")
    ids = ann.select("symbol").distinct()
    strict = lookups.convert_ids(ids, ann, "gene", "putNA", key="symbol").withColumnRenamed("gene", "put_na")
    first = lookups.convert_ids(ids, ann, "gene", "useFirst", key="symbol").withColumnRenamed("gene", "use_first")
    return strict.join(first, "symbol")


@query("duplicated_keys", sql("annotation", "SELECT symbol, COUNT(*) AS rows FROM annotation GROUP BY symbol HAVING COUNT(*) > 1"))
def _(spark, d):
    return lookups.duplicated_keys(b.annotation(spark, d), "symbol")


@query("without_duplicated", sql("annotation", """SELECT gene, symbol, len FROM annotation WHERE concat(symbol, len) IN
(SELECT concat(symbol, len) FROM annotation GROUP BY 1 HAVING COUNT(*) = 1)"""))
def _(spark, d):
    ann = b.annotation(spark, d).select("gene", "symbol", "len", F.concat("symbol", "len").alias("key"))
    return lookups.without_keys(ann, lookups.duplicated_keys(ann, "key"), "key").select("gene", "symbol", "len")


@query("match_ids", """SELECT c_custkey AS id, p_partkey AS matched FROM customer LEFT JOIN part ON p_partkey = c_custkey""")
def _(spark, d):
    ids = b.table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return lookups.match_ids(ids, b.table(spark, d, "part").select(F.col("p_partkey").alias("id")))


@query("annotate_positions", sql("counts annotation", """SELECT t.gene, t.total, a."start", a."end" FROM
(SELECT gene, CAST(SUM(count) AS BIGINT) AS total FROM counts GROUP BY gene) t JOIN annotation a USING (gene)"""))
def _(spark, d):
    totals = b.counts(spark, d).groupBy("gene").agg(F.sum("count").alias("total"))
    return lookups.annotate_positions(totals, b.annotation(spark, d).select("gene", "start", "end"))


@query("semi_genes", sql("counts genes", "SELECT gene, cell, count FROM counts WHERE gene IN (SELECT gene FROM genes WHERE is_ERCC)"))
def _(spark, d):
    return lookups.semi(b.counts(spark, d), b.genes(spark, d).filter("is_ERCC"))


@query("gene_pairs", sql("genes", """SELECT x.gene AS gene1, y.gene AS gene2 FROM genes x, genes y
WHERE x.gene < y.gene AND x.is_ERCC AND y.is_ERCC"""))
def _(spark, d):
    return lookups.gene_pairs(b.genes(spark, d).filter("is_ERCC"), block_rows=64)


@query("pair_members", sql("pairs", "SELECT first AS gene FROM pairs WHERE phase = 'S' UNION SELECT second FROM pairs WHERE phase = 'S'"))
def _(spark, d):
    pairs = b.marker_pairs(spark, d).filter("phase = 'S'")
    return lookups.pair_members(pairs.select(F.col("first").alias("gene1"), F.col("second").alias("gene2")))


@query("pair_expression", sql("counts pairs", """SELECT phase, first, second, COALESCE(a.cell, z.cell) AS cell,
COALESCE(a.count, 0) AS x1, COALESCE(z.count, 0) AS x2 FROM
(SELECT * FROM pairs JOIN counts ON gene = first) a FULL JOIN (SELECT * FROM pairs JOIN counts ON gene = second) z
USING (phase, first, second, cell)"""))
def _(spark, d):
    seen = lookups.pair_expression(b.counts(spark, d), b.marker_pairs(spark, d))
    return seen.withColumns({"x1": F.col("x1").cast("bigint"), "x2": F.col("x2").cast("bigint")})


@query("assign_batches", sql("cells", """SELECT individual, id, row_number() OVER (PARTITION BY individual ORDER BY id) AS row_number,
(row_number() OVER (PARTITION BY individual ORDER BY id) - 1) // 3 + 1 AS batch FROM cells"""))
def _(spark, d):
    return lookups.assign_batches(b.cells(spark, d).select("individual", "id"), 3, "individual", "id")


@query("group_key", sql("cells", "SELECT cell, concat_ws('.', individual, factor) AS \"group\" FROM cells"))
def _(spark, d):
    return lookups.group_key(b.cells(spark, d), ["individual", "factor"]).select("cell", "group")


@query("factor_levels", sql("cells", "SELECT DISTINCT factor FROM cells"))
def _(spark, d):
    return lookups.levels(b.cells(spark, d), "factor")


@query("factor_codes", sql("cells", "SELECT cell, dense_rank() OVER (ORDER BY factor) AS code FROM cells"))
def _(spark, d):
    return lookups.factor_codes(b.cells(spark, d), "factor").select("cell", "code")


@query("design_matrix", sql("cells", """, l AS (SELECT factor, dense_rank() OVER (ORDER BY factor) AS k, cell FROM cells)
SELECT cell, CAST(1 AS BIGINT) AS intercept, CAST(factor = 'AMERICA' AS BIGINT) AS america, CAST(factor = 'ASIA' AS BIGINT) AS asia,
CAST(factor = 'EUROPE' AS BIGINT) AS europe, CAST(factor = 'MIDDLE EAST' AS BIGINT) AS middle_east FROM l"""))
def _(spark, d):
    matrix = lookups.design_matrix(b.cells(spark, d), ["factor"])
    return matrix.withColumnsRenamed({c: c.removeprefix("factor_").lower().replace(" ", "_") for c in matrix.columns})


# ---- summaries -----------------------------------------------------------------------------


@query("library_size", sql("counts", "SELECT cell, CAST(SUM(count) AS BIGINT) AS total_counts FROM counts GROUP BY cell"))
def _(spark, d):
    return summaries.library_size(b.counts(spark, d))


@query("features_per_cell", sql("counts", "SELECT cell, COUNT(*) AS total_features FROM counts GROUP BY cell"))
def _(spark, d):
    return summaries.features_per_cell(b.counts(spark, d))


@query("pct_controls", sql("counts genes", """SELECT cell,
round(100.0 * SUM(CASE WHEN is_ERCC THEN count ELSE 0 END) / SUM(count), 6) AS pct_ERCC,
round(100.0 * SUM(CASE WHEN is_Mt THEN count ELSE 0 END) / SUM(count), 6) AS pct_Mt
FROM counts JOIN genes USING (gene) GROUP BY cell"""))
def _(spark, d):
    table = summaries.pct_controls(b.counts(spark, d), b.genes(spark, d), ["ERCC", "Mt"])
    return table.select("cell", *rounded("pct_ERCC", "pct_Mt"))


_TOP = """, r AS (SELECT cell, count, row_number() OVER (PARTITION BY cell ORDER BY count DESC, gene) AS rn FROM counts),
top AS (SELECT cell, SUM(count) AS t FROM r WHERE rn <= 50 GROUP BY cell)"""


@query("pct_top", sql("counts library", _TOP + """
SELECT cell, round(100.0 * t / total_counts, 6) AS pct_top_50 FROM top JOIN library USING (cell)"""))
def _(spark, d):
    return summaries.pct_top(b.counts(spark, d), 50).select("cell", *rounded("pct_top_50"))


@query("top_features", sql("counts", """SELECT gene, cell, count, rank_in_cell FROM (SELECT *, row_number() OVER
(PARTITION BY cell ORDER BY count DESC, gene) AS rank_in_cell FROM counts) WHERE rank_in_cell <= 5"""))
def _(spark, d):
    return summaries.top_features(b.counts(spark, d), 5).withColumn("rank_in_cell", F.col("rank_in_cell").cast("bigint"))


_QC = _TOP + """, qc AS (SELECT cell, CAST(SUM(count) AS BIGINT) AS total_counts, COUNT(*) AS total_features,
100.0 * SUM(CASE WHEN is_ERCC THEN count ELSE 0 END) / SUM(count) AS pct_ERCC,
100.0 * SUM(CASE WHEN is_Mt THEN count ELSE 0 END) / SUM(count) AS pct_Mt,
100.0 * MAX(t) / SUM(count) AS pct_top_50, log10(SUM(count) + 1) AS log10_total_counts, log10(COUNT(*) + 1) AS log10_total_features
FROM counts JOIN genes USING (gene) JOIN top USING (cell) GROUP BY cell)"""


def _qc(spark, d):
    return summaries.cell_qc(b.counts(spark, d), b.genes(spark, d), ["ERCC", "Mt"])


@query("cell_qc", sql("counts genes", _QC + """SELECT cell, total_counts, total_features, round(pct_ERCC, 6) AS pct_ERCC,
round(pct_Mt, 6) AS pct_Mt, round(pct_top_50, 6) AS pct_top_50, round(log10_total_counts, 6) AS log10_total_counts,
round(log10_total_features, 6) AS log10_total_features FROM qc"""))
def _(spark, d):
    return _qc(spark, d).select("cell", "total_counts", "total_features", *rounded(
        "pct_ERCC", "pct_Mt", "pct_top_50", "log10_total_counts", "log10_total_features"))


_RULES = [("by_size", "total_counts", "lower", True), ("by_feature", "total_features", "lower", True),
          ("by_mt", "pct_Mt", "higher", False), ("by_spike", "pct_ERCC", "higher", False)]
_FLAGS = _QC + """, m AS (SELECT median(log10(total_counts)) AS a, median(log10(total_features)) AS f, median(pct_Mt) AS t, median(pct_ERCC) AS s FROM qc),
k AS (SELECT median(abs(log10(total_counts) - a)) * 1.4826 AS ka, median(abs(log10(total_features) - f)) * 1.4826 AS kf,
median(abs(pct_Mt - t)) * 1.4826 AS kt, median(abs(pct_ERCC - s)) * 1.4826 AS ks FROM qc, m),
flags AS (SELECT cell, log10(total_counts) < a - ka AS by_size, log10(total_features) < f - kf AS by_feature,
pct_Mt > t + kt AS by_mt, pct_ERCC > s + ks AS by_spike FROM qc, m, k)"""


def _flagged(spark, d):
    return summaries.flag_outliers(_qc(spark, d), _RULES, nmads=1.0)


@query("flag_outliers", sql("counts genes", _FLAGS + "SELECT cell, by_size, by_feature, by_mt, by_spike FROM flags"))
def _(spark, d):
    return _flagged(spark, d).select("cell", *[r[0] for r in _RULES])


@query("is_outlier", sql("counts library", """, m AS (SELECT median(total_counts) AS a FROM library),
k AS (SELECT median(abs(total_counts - a)) * 1.4826 AS ka FROM library, m)
SELECT cell, CAST(total_counts AS BIGINT) AS total_counts, total_counts > a + 2 * ka AS outlier FROM library, m, k"""))
def _(spark, d):
    return summaries.is_outlier(summaries.library_size(b.counts(spark, d)), "total_counts", 2.0, "higher")


@query("qc_report", sql("counts genes", _FLAGS + """SELECT CAST(SUM(CAST(by_size AS INT)) AS BIGINT) AS by_by_size, CAST(SUM(CAST(by_feature AS INT)) AS BIGINT) AS by_by_feature,
CAST(SUM(CAST(by_mt AS INT)) AS BIGINT) AS by_by_mt, CAST(SUM(CAST(by_spike AS INT)) AS BIGINT) AS by_by_spike,
CAST(SUM(CAST(NOT (by_size OR by_feature OR by_mt OR by_spike) AS INT)) AS BIGINT) AS remaining FROM flags"""))
def _(spark, d):
    return summaries.qc_report(_flagged(spark, d), [r[0] for r in _RULES])


@query("filter_cells", sql("counts genes", _FLAGS + """SELECT gene, cell, count FROM counts WHERE cell IN
(SELECT cell FROM flags WHERE NOT (by_size OR by_feature OR by_mt OR by_spike))"""))
def _(spark, d):
    return filters.filter_cells(b.counts(spark, d), _flagged(spark, d), [r[0] for r in _RULES])


@query("gene_means", sql("counts size", """SELECT gene, CAST(SUM(count) AS BIGINT) AS total,
round(SUM(count) * 1.0 / (SELECT n_cells FROM size), 6) AS mean FROM counts GROUP BY gene"""))
def _(spark, d):
    return summaries.gene_means(b.counts(spark, d)).select("gene", "total", *rounded("mean"))


@query("cells_per_gene", sql("counts", "SELECT gene, COUNT(*) AS n_cells FROM counts GROUP BY gene"))
def _(spark, d):
    return summaries.cells_per_gene(b.counts(spark, d))


_MOMENTS = """, moments AS (SELECT gene, SUM(count) * 1.0 / MAX(n_cells) AS mean,
(SUM(count * count) - SUM(count) * 1.0 * SUM(count) / MAX(n_cells)) / (MAX(n_cells) - 1) AS variance FROM counts, size GROUP BY gene)"""


@query("gene_variance", sql("counts size", _MOMENTS + "SELECT gene, round(mean, 6) AS mean, round(variance, 6) AS variance FROM moments"))
def _(spark, d):
    return summaries.gene_variance(b.counts(spark, d)).select("gene", *rounded("mean", "variance"))


_SPREAD = """, grid AS (SELECT g.gene, c.cell, COALESCE(x.count, 0) AS count FROM (SELECT DISTINCT gene FROM counts) g
CROSS JOIN (SELECT DISTINCT cell FROM counts) c LEFT JOIN counts x USING (gene, cell)),
spread AS (SELECT cell, CAST(MIN(count) AS DOUBLE) AS mn, quantile_cont(count, 0.25) AS q1, quantile_cont(count, 0.5) AS med,
quantile_cont(count, 0.75) AS q3, CAST(MAX(count) AS DOUBLE) AS mx, AVG(count) AS mean FROM grid GROUP BY cell)"""


@query("summarize_columns", sql("counts", _SPREAD + """SELECT cell, mn AS min, round(q1, 6) AS q1, round(med, 6) AS median,
round(q3, 6) AS q3, mx AS max, round(mean, 6) AS mean FROM spread"""))
def _(spark, d):
    return summaries.summarize_columns(b.counts(spark, d)).select(
        "cell", "min", *rounded("q1", "median", "q3"), "max", *rounded("mean"))


@query("box_stats", sql("counts", _SPREAD + """SELECT cell, CAST(MIN(count) FILTER (count >= q1 - 1.5 * (q3 - q1)) AS DOUBLE) AS low,
q1, med AS median, q3, CAST(MAX(count) FILTER (count <= q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS high
FROM grid JOIN spread USING (cell) GROUP BY cell, q1, med, q3"""))
def _(spark, d):
    counts = b.counts(spark, d)
    return summaries.box_stats(counts, counts.select("cell").distinct())


@query("box_range", sql("counts", _SPREAD + "SELECT cell, mn AS low, q1, med AS median, q3, mx AS high FROM spread"))
def _(spark, d):
    counts = b.counts(spark, d)
    return summaries.box_stats(counts, counts.select("cell").distinct(), whisker=0)


@query("histogram", sql("counts library", """, r AS (SELECT MIN(total_counts) AS lo, (MAX(total_counts) - MIN(total_counts)) / 20.0 AS w FROM library)
SELECT least(CAST(floor((total_counts - lo) / w) AS BIGINT), 19) AS bin, COUNT(*) AS n FROM library, r GROUP BY 1"""))
def _(spark, d):
    return summaries.histogram(summaries.library_size(b.counts(spark, d)), "total_counts", 20)


@query("histogram_counts", sql("counts", """, v AS (SELECT log2(count + 1) AS x FROM counts), r AS (SELECT MIN(x) AS lo, (MAX(x) - MIN(x)) / 10.0 AS w FROM v)
SELECT least(CAST(floor((x - lo) / w) AS BIGINT), 9) AS bin, COUNT(*) AS n FROM v, r GROUP BY 1"""))
def _(spark, d):
    return summaries.histogram(b.counts(spark, d).select(log2p1("count").alias("x")), "x", 10)


@query("density_2d", sql("counts size", """, g AS (SELECT CAST(floor(log10(SUM(count) * 1.0 / MAX(n_cells)) / 0.05) AS BIGINT) AS x_bin,
CAST(floor(COUNT(*) / 5.0) AS BIGINT) AS y_bin FROM counts, size GROUP BY gene)
SELECT x_bin, y_bin, COUNT(*) AS n FROM g GROUP BY 1, 2"""))
def _(spark, d):
    counts = b.counts(spark, d)
    table = summaries.gene_means(counts).join(summaries.cells_per_gene(counts), "gene")
    return summaries.density_2d(table, F.log10("mean"), F.col("n_cells"), 0.05, 5.0)


@query("group_stats", sql("counts cells", """, n AS (SELECT factor AS level, COUNT(*) AS n_in, SUM(COUNT(*)) OVER () AS n_all FROM cells GROUP BY factor),
p AS (SELECT gene, factor AS level, SUM(count) AS s, COUNT(*) AS k FROM counts JOIN cells USING (cell) GROUP BY 1, 2),
t AS (SELECT gene, SUM(s) AS sa, SUM(k) AS ka FROM p GROUP BY gene),
f AS (SELECT t.gene, n.level, n_in, n_all - n_in AS n_out, COALESCE(s, 0) AS s, COALESCE(k, 0) AS k, sa, ka FROM t CROSS JOIN n LEFT JOIN p ON p.gene = t.gene AND p.level = n.level)
SELECT gene, level, round(k * 1.0 / n_in, 6) AS rate_in, round((ka - k) * 1.0 / n_out, 6) AS rate_out, round(s * 1.0 / n_in, 6) AS mean_in,
round((sa - s) * 1.0 / n_out, 6) AS mean_out, round(log2((s * 1.0 / n_in + 1) / ((sa - s) * 1.0 / n_out + 1)), 6) AS lfc FROM f"""))
def _(spark, d):
    table = summaries.group_stats(b.counts(spark, d), b.cells(spark, d), "factor")
    return table.select("gene", "level", *rounded("rate_in", "rate_out", "mean_in", "mean_out", "lfc"))


@query("mean_variance", sql("counts size", _MOMENTS + """, t AS (SELECT *, ntile(100) OVER (ORDER BY mean, gene) AS bin FROM moments)
SELECT bin, COUNT(*) AS n, round(AVG(mean), 6) AS mean, round(AVG(variance), 6) AS variance FROM t GROUP BY bin"""))
def _(spark, d):
    return summaries.mean_variance(b.counts(spark, d)).select("bin", "n", *rounded("mean", "variance"))


@query("mean_sd_trend", sql("counts size", _MOMENTS + """, t AS (SELECT sqrt(variance) AS sd, row_number() OVER (ORDER BY mean, gene) AS k, COUNT(*) OVER () AS m FROM moments)
SELECT CAST(floor((k - 1) * 50 / m) AS BIGINT) AS rank_bin, COUNT(*) AS n, round(median(sd), 6) AS median_sd FROM t GROUP BY 1"""))
def _(spark, d):
    return summaries.mean_sd_trend(b.counts(spark, d)).select("rank_bin", "n", *rounded("median_sd"))


_TOP35 = _MOMENTS + """, top AS (SELECT gene, mean, variance FROM moments ORDER BY variance DESC, gene LIMIT 35),
grid AS (SELECT t.gene, c.cell, COALESCE(x.count, 0) AS x, mean, variance FROM top t CROSS JOIN (SELECT s_suppkey AS cell FROM supplier) c LEFT JOIN counts x USING (gene, cell))"""


@query("center_rows", sql("counts size", _TOP35 + "SELECT gene, cell, round(x - mean, 6) AS value FROM grid"))
def _(spark, d):
    top = ranking.top_variance(b.counts(spark, d), 35)
    return summaries.center_rows(top, b.cells(spark, d)).select("gene", "cell", *rounded("value"))


@query("scale_rows", sql("counts size", _TOP35 + "SELECT gene, cell, round((x - mean) / sqrt(variance), 6) AS value FROM grid"))
def _(spark, d):
    top = ranking.top_variance(b.counts(spark, d), 35)
    return summaries.scale_rows(top, b.cells(spark, d)).select("gene", "cell", *rounded("value"))


@query("cell_scatter", sql("counts", """SELECT p_partkey AS gene, CAST(COALESCE(MAX(CASE WHEN cell = 0 THEN count END), 0) AS BIGINT) AS x,
CAST(COALESCE(MAX(CASE WHEN cell = 1 THEN count END), 0) AS BIGINT) AS y FROM part LEFT JOIN counts ON gene = p_partkey GROUP BY 1"""))
def _(spark, d):
    return summaries.cell_scatter(b.counts(spark, d), 0, 1, genes=b.genes(spark, d))


@query("log2_counts", sql("counts", "SELECT gene, cell, round(log2(count + 1), 6) AS value FROM counts"))
def _(spark, d):
    return b.counts(spark, d).select("gene", "cell", log2p1("count").alias("value")).select("gene", "cell", *rounded("value"))


# ---- ranks, top-k, sampling ----------------------------------------------------------------


@query("bh_adjust", sql("p", """, r AS (SELECT gene, p_value, p_value * COUNT(*) OVER () / rank_max AS q FROM
(SELECT *, COUNT(*) OVER (ORDER BY p_value RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rank_max FROM p))
SELECT gene, round(least(1.0, MIN(q) OVER (ORDER BY p_value DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) AS fdr FROM r"""))
def _(spark, d):
    return ranking.bh_adjust(b.event_p(spark, d)).select("gene", *rounded("fdr"))


@query("rank_average", sql("counts size", """, r AS (SELECT gene, cell, rank() OVER (PARTITION BY cell ORDER BY count) AS rk,
COUNT(*) OVER (PARTITION BY cell, count) AS ties, COUNT(*) OVER (PARTITION BY cell) AS k FROM counts)
SELECT gene, cell, n_genes - k + rk + (ties - 1) / 2.0 AS rank FROM r, size"""))
def _(spark, d):
    return ranking.rank_average(b.counts(spark, d), "count").select("gene", "cell", F.col("rank").cast("double").alias("rank"))


@query("top_variance", sql("counts size", _MOMENTS + """SELECT gene, cell, count FROM counts WHERE gene IN
(SELECT gene FROM moments ORDER BY round(variance, 9) DESC, gene LIMIT 200)"""))
def _(spark, d):
    return ranking.top_variance(b.counts(spark, d), 200)


@query("top_mean", sql("counts", """SELECT gene, cell, count FROM counts WHERE gene IN
(SELECT gene FROM counts GROUP BY gene ORDER BY SUM(count) DESC, gene LIMIT 20)"""))
def _(spark, d):
    return ranking.top_mean(b.counts(spark, d), 20)


@query("order_results", sql("p", "SELECT gene, value FROM p ORDER BY p_value, gene"))
def _(spark, d):
    return ranking.order_results(b.event_p(spark, d), "p_value").select("gene", "value")


@query("head_genes", sql("p", "SELECT gene FROM p ORDER BY p_value, gene LIMIT 100"))
def _(spark, d):
    return ranking.head_genes(b.event_p(spark, d), 100, "p_value")


@query("top_gene", sql("p", "SELECT gene, value FROM p ORDER BY value, gene LIMIT 1"))
def _(spark, d):
    return ranking.top_gene(b.event_p(spark, d), "value")


@query("top_tags", sql("p", "SELECT gene, value FROM p ORDER BY p_value, gene LIMIT 10"))
def _(spark, d):
    return ranking.top_tags(b.event_p(spark, d), 10).select("gene", "value")


@query("highest_expressed", sql("counts", """SELECT gene, CAST(SUM(count) AS BIGINT) AS total, round(100.0 * SUM(count) / (SELECT SUM(count) FROM counts), 6) AS pct
FROM counts GROUP BY gene ORDER BY total DESC, gene LIMIT 50"""))
def _(spark, d):
    return ranking.highest_expressed(b.counts(spark, d), 50).select("gene", "total", *rounded("pct"))


@query("sample_cells")
def _(spark, d):
    return ranking.sample_cells(b.cells(spark, d).select("cell"), 25)


@query("pool_windows", sql("counts library", """, r AS (SELECT cell, row_number() OVER (ORDER BY total_counts, cell) - 1 AS k, COUNT(*) OVER () AS n FROM library),
o AS (SELECT cell, n, CASE WHEN k % 2 = 0 THEN k // 2 ELSE n - 1 - k // 2 END AS pos FROM r)
SELECT CAST(s.v AS BIGINT) AS pool_size, (pos - t.i + n) % n AS pool, cell FROM o, (VALUES (5), (10)) s(v), range(0, 10) t(i) WHERE t.i < s.v"""))
def _(spark, d):
    return ranking.pool_windows(summaries.library_size(b.counts(spark, d)), (5, 10))
