"""Queries on normalization, distances, clustering and projection."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from cellweave.operators import clustering, distance, heatmap, normalize, projection, ranking, summaries, variance
from cellweave.operators.filters import filter_min_total
from cellweave.plans import bindings as b
from cellweave.plans.bindings import sql
from cellweave.plans.catalog import query, rounded
from cellweave.plans.flagship import variable_gene_cpm

# ---- normalization -------------------------------------------------------------------------


@query("cpm", sql("counts library", "SELECT gene, cell, round(count * 1e6 / total_counts, 6) AS cpm FROM counts JOIN library USING (cell)"))
def _(spark, d):
    return normalize.cpm(b.counts(spark, d)).select("gene", "cell", *rounded("cpm"))


@query("variable_gene_cpm", sql("counts library size", """, kept AS (SELECT * FROM counts WHERE gene IN (SELECT c.gene FROM counts c JOIN library l USING (cell)
  WHERE c.count * 1e6 > l.total_counts * 2500 GROUP BY c.gene HAVING COUNT(*) >= 2)),
v AS (SELECT gene, (SUM(count * count) - SUM(count) * 1.0 * SUM(count) / (SELECT COUNT(DISTINCT cell) FROM kept)) AS s FROM kept GROUP BY gene),
top AS (SELECT * FROM kept WHERE gene IN (SELECT gene FROM v ORDER BY round(s, 6) DESC, gene LIMIT 100)),
l AS (SELECT cell, SUM(count) AS t FROM top GROUP BY cell)
SELECT gene, cell, round(count * 1e6 / t, 6) AS cpm FROM top JOIN l USING (cell)"""))
def _(spark, d):
    return variable_gene_cpm(spark, d).select("gene", "cell", *rounded("cpm"))


_LOGCPM = """, s AS (SELECT cell, total_counts AS lib, 2.0 * total_counts / (SELECT AVG(total_counts) FROM library) AS prior FROM library)
SELECT gene, cell, round(log2((count + prior) * 1e6 / (lib + 2 * prior)), 6) AS log_cpm, round(log2(prior * 1e6 / (lib + 2 * prior)), 6) AS zero_value
FROM counts JOIN s USING (cell)"""


@query("log_cpm", sql("counts library", _LOGCPM))
def _(spark, d):
    return normalize.log_cpm(b.counts(spark, d)).select("gene", "cell", *rounded("log_cpm", "zero_value"))


_TMM = """, grid AS (SELECT g.gene, c.cell, COALESCE(x.count, 0) AS count FROM (SELECT DISTINCT gene FROM counts) g CROSS JOIN library c LEFT JOIN counts x USING (gene, cell)),
f AS (SELECT cell, quantile_cont(count, 0.75) / MAX(total_counts) AS f FROM grid JOIN library USING (cell) GROUP BY cell),
ref AS (SELECT cell, total_counts AS ref_lib FROM f JOIN library USING (cell), (SELECT AVG(f) AS a FROM f) ORDER BY abs(f - a), cell LIMIT 1),
m AS (SELECT c.cell, c.count AS y, r.count AS yr, l.total_counts AS n, ref_lib AS nr FROM counts c JOIN (SELECT gene, count FROM counts WHERE cell = (SELECT cell FROM ref)) r USING (gene)
  JOIN library l ON l.cell = c.cell, ref),
k AS (SELECT *, rank() OVER (PARTITION BY cell ORDER BY y / yr) + (COUNT(*) OVER (PARTITION BY cell, y / yr) - 1) / 2.0 AS rm,
  rank() OVER (PARTITION BY cell ORDER BY y * yr) + (COUNT(*) OVER (PARTITION BY cell, y * yr) - 1) / 2.0 AS ra, COUNT(*) OVER (PARTITION BY cell) AS t FROM m),
w AS (SELECT cell, log2((y / n) / (yr / nr)) AS mv, (n - y) / n / y + (nr - yr) / nr / yr AS v FROM k
  WHERE rm >= floor(t * 0.3) + 1 AND rm <= t + 1 - (floor(t * 0.3) + 1) AND ra >= floor(t * 0.05) + 1 AND ra <= t + 1 - (floor(t * 0.05) + 1)),
raw AS (SELECT l.cell, COALESCE(s, 0) AS lf FROM library l LEFT JOIN (SELECT cell, SUM(mv / v) / SUM(1 / v) AS s FROM w GROUP BY cell) x USING (cell)),
tmm AS (SELECT cell, pow(2, lf - (SELECT AVG(lf) FROM raw)) AS factor FROM raw)"""


@query("tmm_factors", sql("counts library", _TMM + "SELECT cell, round(factor, 6) AS factor FROM tmm"))
def _(spark, d):
    return normalize.tmm_factors(b.counts(spark, d)).select("cell", *rounded("factor"))


@query("tmm_size_factors", sql("counts library", _TMM + """, e AS (SELECT cell, ln(factor * total_counts) AS le FROM tmm JOIN library USING (cell))
SELECT cell, round(exp(le - (SELECT AVG(le) FROM e)), 6) AS size_factor FROM e"""))
def _(spark, d):
    return normalize.tmm_size_factors(b.counts(spark, d)).select("cell", *rounded("size_factor"))


_RATIO = """, g AS (SELECT gene, AVG(ln(count)) AS lg FROM counts GROUP BY gene HAVING COUNT(*) = (SELECT n_cells FROM size)),
sf AS (SELECT cell, exp(median(ln(count) - lg)) AS size_factor FROM counts JOIN g USING (gene) GROUP BY cell)"""


@query("size_factors_ratio", sql("dense size", _RATIO + "SELECT cell, round(size_factor, 6) AS size_factor FROM sf"))
def _(spark, d):
    return normalize.size_factors_ratio(b.counts_dense(spark, d)).select("cell", *rounded("size_factor"))


_POS = """, g AS (SELECT gene, SUM(ln(count)) / MAX(n_cells) AS lg FROM counts, size GROUP BY gene),
r AS (SELECT cell, median(ln(count) - lg) AS m FROM counts JOIN g USING (gene) GROUP BY cell),
sf AS (SELECT cell, exp(m - (SELECT AVG(m) FROM r)) AS size_factor FROM r)"""


@query("size_factors_poscounts", sql("counts size", _POS + "SELECT cell, round(size_factor, 6) AS size_factor FROM sf"))
def _(spark, d):
    return normalize.size_factors_poscounts(b.counts(spark, d)).select("cell", *rounded("size_factor"))


# The normal equations have the same row for every cell, so their solution is written with the frequencies of the ring.
_POOLED = """, rn AS (SELECT cell, total_counts, row_number() OVER (ORDER BY total_counts, cell) - 1 AS k, COUNT(*) OVER () AS n FROM library),
ri AS (SELECT cell, total_counts, n, CASE WHEN k % 2 = 0 THEN k // 2 ELSE n - 1 - k // 2 END AS pos FROM rn),
sh AS (SELECT gene, cell, count / total_counts AS x FROM counts JOIN library USING (cell)),
av AS (SELECT gene, SUM(x) / (SELECT COUNT(*) FROM library) AS a FROM sh GROUP BY gene),
mb AS (SELECT s.v AS size, (pos - t.i + n) % n AS pool, cell FROM ri, (VALUES (5), (10), (15), (20)) s(v), range(0, 20) t(i) WHERE t.i < s.v),
ps AS (SELECT size, pool, gene, SUM(x) AS x FROM mb JOIN sh USING (cell) GROUP BY ALL),
pg AS (SELECT p.size, p.pool, quantile_cont(COALESCE(x, 0) / a, 0.5) AS estimate FROM (SELECT DISTINCT size, pool FROM mb) p CROSS JOIN av
       LEFT JOIN ps ON ps.size = p.size AND ps.pool = p.pool AND ps.gene = av.gene GROUP BY ALL),
rh AS (SELECT ri.pos, ri.n, ri.cell, ri.total_counts, SUM(estimate) + 1e-6 AS rhs FROM mb JOIN pg USING (size, pool) JOIN ri USING (cell) GROUP BY ALL),
fr AS (SELECT f.i AS f, n, 1e-6 + SUM(CASE WHEN f.i = 0 THEN s.v * s.v ELSE pow(sin(pi() * f.i * s.v / n) / sin(pi() * f.i / n), 2) END) AS e
       FROM (SELECT DISTINCT n FROM ri), range(0, 100000) f(i), (VALUES (5), (10), (15), (20)) s(v) WHERE f.i < n GROUP BY ALL),
ke AS (SELECT d.i AS d, SUM(cos(2 * pi() * ((f * d.i) % n) / n) / e) / n AS k FROM fr, range(0, 100000) d(i) WHERE d.i < n GROUP BY d.i, n),
th AS (SELECT x.cell, x.total_counts, SUM(k * y.rhs) AS theta FROM rh x, rh y, ke WHERE d = (x.pos - y.pos + x.n) % x.n GROUP BY ALL),
rw AS (SELECT cell, greatest(theta, 1e-8) * total_counts AS raw FROM th)
SELECT cell, round(raw / (SELECT AVG(raw) FROM rw), 4) AS size_factor FROM rw"""


@query("size_factors_pooled", sql("dense library", _POOLED))
def _(spark, d):
    return normalize.size_factors_pooled(b.counts_dense(spark, d)).select("cell", F.round("size_factor", 4).alias("size_factor"))


@query("normalized_counts", sql("dense size", _RATIO + "SELECT gene, cell, round(count / size_factor, 6) AS value FROM counts JOIN sf USING (cell)"))
def _(spark, d):
    counts = b.counts_dense(spark, d)
    return normalize.normalized_counts(counts, normalize.size_factors_ratio(counts)).select("gene", "cell", *rounded("value"))


_LOGNORM = """, sf AS (SELECT cell, total_counts / (SELECT AVG(total_counts) FROM library) AS size_factor FROM library),
logs AS (SELECT gene, cell, log2(count / size_factor + 1) AS value FROM counts JOIN sf USING (cell))"""


def _library_factors(counts):
    return summaries.library_size(counts).select("cell", F.col("total_counts").cast("double").alias("size_factor"))


def _logs(spark, d):
    counts = b.counts(spark, d)
    return normalize.log_normalize(counts, _library_factors(counts))


@query("log_normalize", sql("counts library", _LOGNORM + "SELECT gene, cell, round(value, 6) AS value FROM logs"))
def _(spark, d):
    return _logs(spark, d).select("gene", "cell", *rounded("value"))


@query("rpkm", sql("counts library annotation", """SELECT c.gene, cell, round(count * 1e6 / total_counts / (len / 1000.0), 6) AS rpkm
FROM counts c JOIN library USING (cell) JOIN annotation a ON a.gene = c.gene"""))
def _(spark, d):
    return normalize.rpkm(b.counts(spark, d), b.annotation(spark, d).select("gene", "len")).select("gene", "cell", *rounded("rpkm"))


@query("fpkm", sql("counts annotation", """, k AS (SELECT c.gene, cell, count, abs("end" - "start") / 1000.0 AS kb FROM counts c JOIN annotation a ON a.gene = c.gene WHERE "end" <> "start"),
l AS (SELECT cell, SUM(count) AS lib FROM k GROUP BY cell)
SELECT gene, cell, round(log2(count * 1e6 / lib / kb + 1), 6) AS value FROM k JOIN l USING (cell)"""))
def _(spark, d):
    return normalize.fpkm(b.counts(spark, d), b.annotation(spark, d)).select("gene", "cell", *rounded("value"))


@query("vst", sql("counts library", """, sf AS (SELECT cell, total_counts / (SELECT AVG(total_counts) FROM library) AS s FROM library),
q AS (SELECT gene, cell, count / s AS q FROM counts JOIN sf USING (cell))
SELECT gene, cell, round(log2((1 + 2.0 + 2 * 0.1 * q + 2 * sqrt(0.1 * q * (1 + 2.0 + 0.1 * q))) / 0.4), 6) AS value,
round(log2((1 + 2.0 + 2 * 0.1 * q + 2 * sqrt(0.1 * q * (1 + 2.0 + 0.1 * q))) / 0.4) - log2(3 / 0.4), 6) AS shifted FROM q"""))
def _(spark, d):
    counts = b.counts(spark, d)
    library = summaries.library_size(counts)
    mean = library.agg(F.avg("total_counts")).scalar()
    factors = library.select("cell", (F.col("total_counts") / mean).alias("size_factor"))
    return normalize.vst(counts, factors, 0.1, 2.0).select("gene", "cell", *rounded("value", "shifted"))


@query("remove_batch", sql("vectors", """, m AS (SELECT gene, label, AVG(value) AS m FROM vectors JOIN embeddings ON vec_id = cell GROUP BY 1, 2),
c AS (SELECT gene, AVG(m) AS c FROM m GROUP BY gene)
SELECT gene, cell, round(value - (m - c), 6) AS value FROM vectors JOIN embeddings ON vec_id = cell JOIN m USING (gene, label) JOIN c USING (gene)"""))
def _(spark, d):
    return normalize.remove_batch(b.vectors(spark, d), b.vector_cells(spark, d), "batch").select("gene", "cell", *rounded("value"))


@query("batch_shift_counts", sql("counts cells", """, n AS (SELECT factor AS batch, COUNT(*) AS n FROM cells GROUP BY 1),
g AS (SELECT DISTINCT gene FROM counts), s AS (SELECT gene, factor AS batch, SUM(count) AS s FROM counts JOIN cells USING (cell) GROUP BY 1, 2),
m AS (SELECT g.gene, n.batch, COALESCE(s, 0) * 1.0 / n AS m FROM g CROSS JOIN n LEFT JOIN s ON s.gene = g.gene AND s.batch = n.batch)
SELECT gene, batch, round(m - AVG(m) OVER (PARTITION BY gene), 6) AS shift FROM m"""))
def _(spark, d):
    return normalize.batch_shift(b.counts(spark, d), b.cells(spark, d), "factor", "count").select("gene", "batch", *rounded("shift"))


@query("size_factor_table", sql("counts size library", _POS + """SELECT cell, round(size_factor, 6) AS size_factor, total_counts / 1e6 AS library_millions
FROM sf JOIN library USING (cell)"""))
def _(spark, d):
    counts = b.counts(spark, d)
    table = normalize.size_factor_table(counts, normalize.size_factors_poscounts(counts))
    return table.select("cell", *rounded("size_factor"), "library_millions")


# ---- distances -----------------------------------------------------------------------------

_DOTS = """, cl AS (SELECT DISTINCT cell FROM x), mo AS (SELECT cell, SUM(v) AS s, SUM(v * v) AS ss FROM x GROUP BY cell),
pr AS (SELECT a.cell AS i, z.cell AS j, SUM(a.v * z.v) AS xy FROM x a JOIN x z ON a.gene = z.gene AND a.cell < z.cell GROUP BY 1, 2),
al AS (SELECT a.cell AS i, z.cell AS j, COALESCE(xy, 0) AS xy, a.s AS si, a.ss AS ssi, z.s AS sj, z.ss AS ssj FROM mo a JOIN mo z ON a.cell < z.cell LEFT JOIN pr ON pr.i = a.cell AND pr.j = z.cell)"""
_R = "(xy - si * sj / {n}) / sqrt((ssi - si * si / {n}) * (ssj - sj * sj / {n}))"


@query("cell_pairs", sql("counts", ", x AS (SELECT gene, cell, count * 1.0 AS v FROM counts)" + _DOTS + "SELECT i, j, round(xy, 6) AS xy FROM al"))
def _(spark, d):
    return distance.pair_products(b.counts(spark, d), "count").select("i", "j", *rounded("xy"))


@query("euclidean", sql("counts library", _LOGNORM + ", x AS (SELECT gene, cell, value AS v FROM logs)" + _DOTS + """
SELECT i, j, round(sqrt(greatest(ssi + ssj - 2 * xy, 0)), 6) AS d FROM al"""))
def _(spark, d):
    return distance.euclidean(_logs(spark, d)).select("i", "j", *rounded("d"))


@query("euclidean_subset", sql("counts library", _LOGNORM + """, t AS (SELECT gene FROM counts GROUP BY gene ORDER BY SUM(count) DESC, gene LIMIT 100),
x AS (SELECT gene, cell, value AS v FROM logs WHERE gene IN (SELECT gene FROM t))""" + _DOTS + """
SELECT i, j, round(sqrt(greatest(ssi + ssj - 2 * xy, 0)), 6) AS d FROM al"""))
def _(spark, d):
    genes = ranking.highest_expressed(b.counts(spark, d), 100)
    return distance.euclidean(_logs(spark, d), genes).select("i", "j", *rounded("d"))


_PEARSON = _LOGNORM + ", x AS (SELECT gene, cell, value AS v FROM logs)" + _DOTS + ", r AS (SELECT i, j, " + _R.format(
    n="(SELECT n_genes FROM size)") + " AS r FROM al)"


@query("pearson_distance", sql("counts library size", _PEARSON + "SELECT i, j, round(r, 6) AS r, round(sqrt(2 * (1 - r)), 6) AS d FROM r"))
def _(spark, d):
    return distance.pearson_distance(_logs(spark, d)).select("i", "j", *rounded("r", "d"))


_RANKS = """, k AS (SELECT gene, cell, rank() OVER (PARTITION BY {by} ORDER BY count) AS rk, COUNT(*) OVER (PARTITION BY {by}, count) AS t, COUNT(*) OVER (PARTITION BY {by}) AS m FROM {src}),
x AS (SELECT gene, cell, {n} - m + rk + (t - 1) / 2.0 - CASE WHEN {n} > m THEN ({n} - m + 1) / 2.0 ELSE 0 END AS v FROM k)"""


@query("spearman_distance", sql("counts size", _RANKS.format(by="cell", src="counts", n="(SELECT n_genes FROM size)") + _DOTS + """
, r AS (SELECT i, j, """ + _R.format(n="(SELECT n_genes FROM size)") + """ AS r FROM al)
SELECT i, j, round(r, 6) AS r, round(sqrt(2 * (1 - r)), 6) AS d FROM r"""))
def _(spark, d):
    return distance.spearman_distance(b.counts(spark, d), value="count").select("i", "j", *rounded("r", "d"))


@query("vector_distances", sql("vectors", ", x AS (SELECT gene, cell, value AS v FROM vectors)" + _DOTS + """
SELECT i, j, round(sqrt(greatest(ssi + ssj - 2 * xy, 0)), 6) AS d FROM al"""))
def _(spark, d):
    return distance.euclidean(b.vectors(spark, d)).select("i", "j", *rounded("d"))


@query("leading_lfc", sql("counts library", _LOGNORM + """, top AS (SELECT gene FROM counts GROUP BY gene ORDER BY SUM(count) DESC, gene LIMIT 100),
g AS (SELECT t.gene, c.cell, COALESCE(value, 0) AS v FROM top t CROSS JOIN library c LEFT JOIN logs USING (gene, cell)),
q AS (SELECT a.cell AS i, z.cell AS j, (a.v - z.v) * (a.v - z.v) AS s, row_number() OVER (PARTITION BY a.cell, z.cell ORDER BY (a.v - z.v) * (a.v - z.v) DESC) AS rn
  FROM g a JOIN g z ON a.gene = z.gene AND a.cell < z.cell)
SELECT i, j, round(sqrt(SUM(s) / 20), 6) AS d FROM q WHERE rn <= 20 GROUP BY 1, 2"""))
def _(spark, d):
    genes = ranking.highest_expressed(b.counts(spark, d), 100)
    return distance.leading_lfc(ranking.restrict_genes(_logs(spark, d), genes), top=20).select("i", "j", *rounded("d"))


@query("heatmap_distances", sql("counts library size cells", _PEARSON + """SELECT i, j, round(sqrt(2 * (1 - r)), 6) AS d, a.factor AS label_i, z.factor AS label_j
FROM r JOIN cells a ON a.cell = i JOIN cells z ON z.cell = j"""))
def _(spark, d):
    table = distance.heatmap_distances(distance.pearson_distance(_logs(spark, d)), b.cells(spark, d), "factor")
    return table.select("i", "j", *rounded("d"), "label_i", "label_j")


# ---- clustering and projection -------------------------------------------------------------


def _tree(spark, d, variant="ward.D"):
    return clustering.ward(distance.pearson_distance(_logs(spark, d)), variant)


# Ward step by step on the whole matrix, held as one list by rows: the smallest entry merges its row and column.
_WARD = """, dm AS (SELECT i, j, {start} AS d FROM (SELECT i, j, sqrt(2 * (1 - r)) AS d0 FROM r WHERE r IS NOT NULL)),
nm AS (SELECT list(c ORDER BY c) AS names, COUNT(*) AS n FROM (SELECT i AS c FROM dm UNION SELECT j FROM dm)),
ix AS (SELECT unnest(names) AS c, unnest(range(0, n)) AS k FROM nm),
fm AS (SELECT list(COALESCE(d, 1e300) ORDER BY x.k, y.k) AS d FROM ix x CROSS JOIN ix y LEFT JOIN dm ON dm.i = least(x.c, y.c) AND dm.j = greatest(x.c, y.c)),
walk AS (SELECT 0 AS step, n, d, list_transform(range(0, n), lambda k: 1) AS sz, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS b, CAST(NULL AS DOUBLE) AS h,
  CAST(NULL AS BIGINT) AS size, CAST(NULL AS BIGINT) AS left_size FROM fm, nm
UNION ALL SELECT step + 1, n, list_transform(range(0, n * n), lambda q: CASE
    WHEN q // n = q % n OR q // n = b2 OR q % n = b2 OR sz[q // n + 1] = 0 OR sz[q % n + 1] = 0 THEN 1e300
    WHEN q // n = a2 OR q % n = a2 THEN ((sz[a2 + 1] + sz[q // n + q % n - a2 + 1]) * d[a2 * n + q // n + q % n - a2 + 1]
      + (sz[b2 + 1] + sz[q // n + q % n - a2 + 1]) * d[b2 * n + q // n + q % n - a2 + 1] - sz[q // n + q % n - a2 + 1] * h2) / (sz[a2 + 1] + sz[b2 + 1] + sz[q // n + q % n - a2 + 1])
    ELSE d[q + 1] END), list_transform(range(0, n), lambda k: CASE WHEN k = a2 THEN sz[a2 + 1] + sz[b2 + 1] WHEN k = b2 THEN 0 ELSE sz[k + 1] END),
  a2, b2, h2, sz[a2 + 1] + sz[b2 + 1], sz[a2 + 1]
  FROM (SELECT *, list_min(d) AS h2, (list_position(d, list_min(d)) - 1) // n AS a2, (list_position(d, list_min(d)) - 1) % n AS b2 FROM walk WHERE step < n - 1)),
merges AS (SELECT CAST(step AS BIGINT) AS step, names[a + 1] AS "left", names[b + 1] AS "right", {height} AS height, size, left_size FROM walk, nm WHERE step > 0)"""
_PATHS = """, links AS (SELECT "right" AS node, "left" AS parent, left_size FROM merges WHERE {kept}),
path AS (SELECT c AS cell, c AS node, CAST(0 AS BIGINT) AS off FROM ix UNION ALL SELECT cell, parent, off + left_size FROM path JOIN links USING (node)),
rooted AS (SELECT cell, arg_max(node, off) AS root, MAX(off) AS off FROM path GROUP BY cell) """


def _ward_sql(body, squared=False, kept="true"):
    tree = _WARD.replace("{start}", "d0 * d0" if squared else "d0").replace("{height}", "sqrt(h)" if squared else "h")
    text = sql("counts library size", _PEARSON + tree + _PATHS.replace("{kept}", kept) + body)
    return text.replace("WITH ", "WITH RECURSIVE ", 1)


_MERGES = """ SELECT step, "left", "right", round(height, 6) AS height, CAST(size AS BIGINT) AS size, CAST(left_size AS BIGINT) AS left_size FROM merges"""


@query("ward", _ward_sql(_MERGES))
def _(spark, d):
    return _tree(spark, d).select("step", "left", "right", *rounded("height"), "size", "left_size")


@query("ward_squared", _ward_sql(_MERGES, squared=True))
def _(spark, d):
    return _tree(spark, d, "ward.D2").select("step", "left", "right", *rounded("height"), "size", "left_size")


@query("cut_k", _ward_sql("SELECT cell, CAST(DENSE_RANK() OVER (ORDER BY root) AS BIGINT) AS cluster FROM rooted", kept="step <= (SELECT MAX(step) FROM merges) - 3"))
def _(spark, d):
    return clustering.cut_k(_tree(spark, d), 4)


@query("cut_height", _ward_sql(""", sz2 AS (SELECT root, COUNT(*) AS n FROM rooted GROUP BY root),
cd AS (SELECT root, row_number() OVER (ORDER BY n DESC, root) AS cluster FROM sz2 WHERE n >= 2)
SELECT cell, CAST(COALESCE(cluster, 0) AS BIGINT) AS cluster FROM rooted LEFT JOIN cd USING (root)""", kept="height <= 0.9 * (SELECT MAX(height) FROM merges)"))
def _(spark, d):
    return clustering.cut_height(_tree(spark, d), 0.9, 2)


@query("leaf_order", _ward_sql("SELECT cell, CAST(off + 1 AS BIGINT) AS position FROM rooted"))
def _(spark, d):
    return clustering.leaf_order(_tree(spark, d))


def _named_tree(name, distances):
    """The tree of another set of distances, its tables named apart."""
    body = distances + ", " + _WARD[_WARD.index("nm AS"):].replace("{height}", "h") + _PATHS.replace("{kept}", "true")
    return re.sub(r"\b(dm|nm|ix|fm|walk|merges|links|path|rooted)\b", rf"\1_{name}", body)


_APART = """, dm AS (SELECT a.{x} AS i, z.{x} AS j, sqrt(SUM((a.v - z.v) * (a.v - z.v))) AS d FROM ce a JOIN ce z ON a.{y} = z.{y} AND a.{x} < z.{x} GROUP BY 1, 2)"""


@query("heatmap_matrix", sql("counts library size cells", _LOGNORM + """,
tp AS (SELECT gene FROM (SELECT gene, SUM(value) AS s, SUM(value * value) AS ss FROM logs GROUP BY gene), size ORDER BY (ss - s * s / n_cells) / (n_cells - 1) DESC, gene LIMIT 35),
gr AS (SELECT tp.gene, cells.cell, COALESCE(logs.value, 0) AS v FROM tp CROSS JOIN cells LEFT JOIN logs ON logs.gene = tp.gene AND logs.cell = cells.cell),
ce AS (SELECT gene, cell, v - AVG(v) OVER (PARTITION BY gene) AS v FROM gr)""" + _named_tree("c", _APART.format(x="cell", y="gene"))
    + _named_tree("g", _APART.format(x="gene", y="cell")) + """
SELECT gene, ce.cell, CAST(g.off + 1 AS BIGINT) AS gene_position, CAST(c.off + 1 AS BIGINT) AS cell_position, round(v, 6) AS value, factor AS label
FROM ce JOIN rooted_g g ON g.cell = ce.gene JOIN rooted_c c ON c.cell = ce.cell JOIN cells ON cells.cell = ce.cell""").replace("WITH ", "WITH RECURSIVE ", 1))
def _(spark, d):
    logs = _logs(spark, d)
    table = heatmap.heatmap_matrix(logs, ranking.top_variance_genes(logs, 35, "value"), b.cells(spark, d), "factor")
    return table.select("gene", "cell", "gene_position", "cell_position", *rounded("value"), "label")


@query("components", """WITH RECURSIVE e AS (SELECT DISTINCT c_custkey AS a, c_nationkey + 1000000 AS z FROM customer),
b AS (SELECT a AS x, z AS y FROM e UNION SELECT z, a FROM e), walk AS (SELECT x AS node, x AS reach FROM b UNION SELECT node, y FROM walk JOIN b ON reach = x)
SELECT node, MIN(reach) AS component FROM walk GROUP BY node""")
def _(spark, d):
    edges = b.table(spark, d, "customer").select(F.col("c_custkey").alias("a"), (F.col("c_nationkey") + 1000000).cast("bigint").alias("z"))
    return clustering.components(edges, "a", "z")


_PCA_GENES = 100


@query("pca")
def _(spark, d):
    return projection.pca(_logs(spark, d), b.cells(spark, d), ntop=_PCA_GENES)[0]


@query("pca_percent")
def _(spark, d):
    return projection.pca(_logs(spark, d), b.cells(spark, d), ntop=_PCA_GENES, scale=True)[1]


@query("mds")
def _(spark, d):
    genes = ranking.highest_expressed(b.counts(spark, d), 100)
    return projection.mds(distance.leading_lfc(ranking.restrict_genes(_logs(spark, d), genes), top=20))


# ---- variance and pairs --------------------------------------------------------------------


def _decomposed(spark, d):
    logs = _logs(spark, d)
    moments = summaries.gene_variance(logs, "value")
    cells = b.cells(spark, d).agg(F.count("*")).scalar()
    return variance.decompose_variance(moments, variance.variance_trend(moments), cells)


_TREND = _LOGNORM + """, mo AS (SELECT gene, SUM(value) / MAX(n_cells) AS mean, (SUM(value * value) - SUM(value) * SUM(value) / MAX(n_cells)) / (MAX(n_cells) - 1) AS variance FROM logs, size GROUP BY gene),
lim AS (SELECT MIN(mean) AS lo, MAX(mean) AS hi FROM mo WHERE variance > 0),
kn AS (SELECT CAST(k AS INT) AS knot, lo + (hi - lo) * k / 19 AS ka, (hi - lo) * 0.4 AS reach FROM lim, range(0, 20) t(k)),
wt AS (SELECT knot, ka, mean - ka AS x, ln(variance) AS y, pow(1 - pow(abs(mean - ka) / reach, 3), 3) AS w FROM mo, kn WHERE variance > 0 AND abs(mean - ka) < reach),
sm AS (SELECT knot, ka, SUM(w) AS w, SUM(w * x) AS wx, SUM(w * x * x) AS wxx, SUM(w * y) AS wy, SUM(w * x * y) AS wxy FROM wt GROUP BY 1, 2)"""


@query("variance_trend", sql("counts library size", _TREND + """SELECT CAST(knot AS BIGINT) AS knot, round(ka, 6) AS "at",
round((wxx * wy - wx * wxy) / (w * wxx - wx * wx), 6) AS fit FROM sm"""))
def _(spark, d):
    trend = variance.variance_trend(summaries.gene_variance(_logs(spark, d), "value"))
    return trend.select(F.col("knot").cast("bigint").alias("knot"), *rounded("at", "fit"))


@query("decompose_variance")
def _(spark, d):
    return _decomposed(spark, d)


@query("highly_variable")
def _(spark, d):
    return variance.highly_variable(_decomposed(spark, d), 0.5, 0.1)


_COR = """, top AS (SELECT gene FROM counts GROUP BY gene ORDER BY SUM(count) DESC, gene LIMIT 100),
sub AS (SELECT * FROM counts WHERE gene IN (SELECT gene FROM top))""" + _RANKS.format(
    by="gene", src="sub", n="(SELECT n_cells FROM size)") + """, mo AS (SELECT gene, SUM(v) AS s, SUM(v * v) AS ss FROM x GROUP BY gene),
pr AS (SELECT a.gene AS i, z.gene AS j, SUM(a.v * z.v) AS xy FROM x a JOIN x z ON a.cell = z.cell AND a.gene < z.gene GROUP BY 1, 2),
al AS (SELECT a.gene AS i, z.gene AS j, COALESCE(xy, 0) AS xy, a.s AS si, a.ss AS ssi, z.s AS sj, z.ss AS ssj FROM mo a JOIN mo z ON a.gene < z.gene LEFT JOIN pr ON pr.i = a.gene AND pr.j = z.gene)
SELECT i AS gene1, j AS gene2, round(""" + _R.format(n="(SELECT n_cells FROM size)") + ", 6) AS rho FROM al"


@query("correlate_pairs", sql("counts size", _COR))
def _(spark, d):
    counts = b.counts(spark, d)
    cells = counts.agg(F.count_distinct("cell")).scalar()
    pairs = variance.correlate_pairs(counts, ranking.highest_expressed(counts, 100), "count", cells)
    return pairs.select("gene1", "gene2", *rounded("rho"))


# Random orders by MD5, as the operator draws them; every pair is compared with all of them.
_PAIR_P = """, co AS ({cor}),
dr AS (SELECT it, k, n_cells AS n, row_number() OVER (PARTITION BY it ORDER BY md5(concat('100-', it, '-', k)), k) AS pos
       FROM range(0, 2000) t(it), (SELECT n_cells, unnest(range(1, CAST(n_cells AS BIGINT) + 1)) AS k FROM size)),
nl AS (SELECT round(1 - 6.0 * SUM((pos - k) * (pos - k)) / (CAST(n AS DOUBLE) * (CAST(n AS DOUBLE) * n - 1)), 12) AS v FROM dr GROUP BY it, n),
tl AS (SELECT gene1, gene2, rho, COUNT(*) FILTER (v <= round(rho, 12)) + 1 AS low, COUNT(*) FILTER (v >= round(rho, 12)) + 1 AS high FROM co, nl GROUP BY ALL),
pp AS (SELECT gene1, gene2, rho, least(1.0, 2.0 * least(low, high) / 2001.0) AS p FROM tl),
rp AS (SELECT *, p * COUNT(*) OVER () / (RANK() OVER (ORDER BY p) + COUNT(*) OVER (PARTITION BY p) - 1) AS q FROM pp),
fp AS (SELECT gene1, gene2, rho, p, least(1.0, MIN(q) OVER (ORDER BY p DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS fdr FROM rp)"""


def _pairs(spark, d):
    counts = b.counts(spark, d)
    cells = counts.agg(F.count_distinct("cell")).scalar()
    return variance.correlate_pairs(counts, ranking.highest_expressed(counts, 100), "count", cells, draws=2000)


def _pair_sql(body):
    head, _, cor = _COR.rpartition("\nSELECT i AS gene1")
    return sql("counts size", head + _PAIR_P.replace("{cor}", "SELECT i AS gene1" + cor.replace(", 6) AS rho", ", 15) AS rho")) + body)


@query("correlate_pairs_fdr", _pair_sql(" SELECT gene1, gene2, round(rho, 6) AS rho, round(p, 6) AS p_value, round(fdr, 6) AS fdr FROM fp"))
def _(spark, d):
    return _pairs(spark, d).select("gene1", "gene2", *rounded("rho", "p_value", "fdr"))


@query("gene_modules", _pair_sql(""", ed AS (SELECT gene1 AS x, gene2 AS y FROM pp WHERE p <= 0.01 UNION SELECT gene2, gene1 FROM pp WHERE p <= 0.01),
wk AS (SELECT x AS node, x AS reach FROM ed UNION SELECT node, y FROM wk JOIN ed ON reach = x),
cm AS (SELECT node, MIN(reach) AS component FROM wk GROUP BY node), sc AS (SELECT component, COUNT(*) AS size FROM cm GROUP BY component),
cd AS (SELECT component, size, row_number() OVER (ORDER BY size DESC, component) AS module FROM sc)
SELECT node AS gene, module, size FROM cm JOIN cd USING (component)""").replace("WITH ", "WITH RECURSIVE ", 1))
def _(spark, d):
    return clustering.gene_modules(_pairs(spark, d).filter("p_value <= 0.01"))


@query("explained_variance", sql("counts cells library", """, q AS (SELECT c.cell, factor, l.total_counts * 1.0 AS t FROM cells c JOIN library l USING (cell)), n AS (SELECT COUNT(*) AS n, SUM(t) AS t, SUM(t * t) AS tt FROM q),
k AS (SELECT factor, COUNT(*) AS k FROM q GROUP BY factor), p AS (SELECT gene, factor, SUM(count) AS s, SUM(count * count) AS ss, SUM(count * t) AS xt FROM counts JOIN q USING (cell) GROUP BY 1, 2),
g AS (SELECT gene, SUM(s) AS s, SUM(ss) AS ss, SUM(s * 1.0 * s / k) AS bt, SUM(xt) AS xt FROM p JOIN k USING (factor) GROUP BY gene)
SELECT gene, round((bt - s * s / n) / (ss - s * s / n), 6) AS r2_factor,
round(pow(xt - s * t / n, 2) / ((ss - s * s / n) * (tt - t * t / n)), 6) AS r2_total_counts FROM g, n"""))
def _(spark, d):
    counts = b.counts(spark, d)
    cells = b.cells(spark, d).join(summaries.library_size(counts), "cell")
    table = variance.explained_variance(counts, cells, "factor", ["total_counts"], "count")
    return table.select("gene", *rounded("r2_factor", "r2_total_counts"))


# Observed votes, and the same of cells whose values have been dealt to other genes: orders of the genes by MD5, turned by an MD5 of the cell.
_PHASES = """, un AS (SELECT DISTINCT gene FROM counts UNION SELECT first FROM pairs UNION SELECT second FROM pairs), gn AS (SELECT COUNT(*) AS g FROM un),
od AS (SELECT r, gene, row_number() OVER (PARTITION BY r ORDER BY md5(concat('100-', r, '-', gene)), gene) - 1 AS at FROM un, range(0, 21) t(r)),
cr AS (SELECT cell, r, CASE WHEN r = 0 THEN 0 ELSE CAST('0x' || substr(md5(concat('100-', r, '-cell-', cell)), 1, 8) AS BIGINT) % g END AS turn FROM (SELECT DISTINCT cell FROM counts), range(0, 21) t(r), gn),
pr AS (SELECT f.r, phase, f.at AS a, z.at AS b FROM pairs JOIN od f ON f.gene = first JOIN od z ON z.gene = second AND z.r = f.r),
vl AS (SELECT cr.r, cr.cell, (od.at + turn) % g AS at, count FROM counts JOIN od ON od.gene = counts.gene AND od.r = 0 JOIN cr USING (cell), gn),
sd AS (SELECT vl.r, cell, phase, a, b, count AS x1, 0 AS x2 FROM vl JOIN pr ON pr.r = vl.r AND pr.a = vl.at
UNION ALL SELECT vl.r, cell, phase, a, b, 0, count FROM vl JOIN pr ON pr.r = vl.r AND pr.b = vl.at),
sv AS (SELECT r, cell, phase, a, b, SUM(x1) AS x1, SUM(x2) AS x2 FROM sd GROUP BY ALL HAVING SUM(x1) <> SUM(x2)),
sc AS (SELECT r, cell, phase, COUNT(*) AS votes, 1.0 * COUNT(*) FILTER (x1 > x2) / COUNT(*) AS share FROM sv GROUP BY ALL),
ns AS (SELECT o.cell, o.phase, AVG(CASE WHEN n.share < o.share THEN 1.0 ELSE 0.0 END) AS score FROM sc o JOIN sc n ON n.cell = o.cell AND n.phase = o.phase AND n.r > 0 WHERE o.r = 0 GROUP BY ALL),
wd AS (SELECT cell, MAX(CASE WHEN phase = 'G1' THEN score END) AS g1, MAX(CASE WHEN phase = 'G2M' THEN score END) AS g2m, MAX(CASE WHEN phase = 'S' THEN score END) AS s FROM ns GROUP BY cell),
ph AS (SELECT *, CASE WHEN g1 IS NULL AND g2m IS NULL THEN NULL WHEN COALESCE(g1, 0) < 0.5 AND COALESCE(g2m, 0) < 0.5 THEN 'S' WHEN COALESCE(g1, 0) >= COALESCE(g2m, 0) THEN 'G1' ELSE 'G2M' END AS phase FROM wd)"""


def _phases(spark, d):
    return variance.phase_scores(b.counts(spark, d), b.marker_pairs(spark, d), n_random=20)


@query("phase_scores", sql("counts pairs", _PHASES + "SELECT cell, phase, round(g1, 6) AS g1, round(g2m, 6) AS g2m, round(s, 6) AS s FROM ph"))
def _(spark, d):
    return _phases(spark, d).select("cell", "phase", *rounded("g1", "g2m", "s"))


@query("filter_phase", sql("counts pairs", _PHASES + "SELECT gene, cell, count FROM counts WHERE cell IN (SELECT cell FROM ph WHERE phase = 'G1')"))
def _(spark, d):
    from cellweave.operators.filters import filter_phase

    return filter_phase(b.counts(spark, d), _phases(spark, d), "G1")


@query("filtered_trend", sql("counts", """SELECT COUNT(*) AS rows, CAST(SUM(count) AS BIGINT) AS total FROM counts WHERE gene IN
(SELECT gene FROM counts GROUP BY gene HAVING SUM(count) >= 25)"""))
def _(spark, d):
    return filter_min_total(b.counts(spark, d)).agg(F.count("*").alias("rows"), F.sum("count").alias("total"))
