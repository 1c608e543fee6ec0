"""Queries on negative-binomial models, markers and the method registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.operators import models, summaries
from cellweave.plans import analyses
from cellweave.plans import bindings as b
from cellweave.plans.bindings import sql
from cellweave.plans.catalog import query, rounded


def _cells(spark, d):
    """Cells with size factor (library over its mean) and region."""
    library = summaries.library_size(b.counts(spark, d))
    mean = library.agg(F.avg("total_counts")).scalar()
    return b.cells(spark, d).join(library, "cell").select(
        "cell", "factor", (F.col("total_counts") / mean).alias("size_factor"))


_GRID = """, c AS (SELECT exp(AVG(ln(total_counts))) AS c FROM library), gr AS (SELECT cell, factor FROM cells JOIN library USING (cell)),
ps AS (SELECT gene, factor, count * c / total_counts AS y FROM counts JOIN library USING (cell) JOIN gr USING (cell), c),
nn AS (SELECT factor, COUNT(*) * 1.0 AS n FROM gr GROUP BY 1), r AS (SELECT CAST(k AS INT) AS k, pow(2.0, -(-9.0 + 13.0 / 26 * k)) AS r FROM range(0, 27) t(k)),
o AS (SELECT gene, k, SUM(lgamma(y + r) - lgamma(r)) AS v FROM ps, r GROUP BY 1, 2),
z AS (SELECT gene, factor, SUM(y) AS z FROM ps GROUP BY 1, 2),
t AS (SELECT gene, k, SUM(lgamma(n * r) - lgamma(z + n * r)) AS v FROM z JOIN nn USING (factor), r GROUP BY 1, 2),
cv AS (SELECT gene, k, o.v + t.v AS v FROM o JOIN t USING (gene, k)), av AS (SELECT k, AVG(v) AS m FROM cv GROUP BY k),
al AS (SELECT gene, k, v + 10 * m AS v FROM cv JOIN av USING (k) UNION ALL SELECT -1, k, m FROM av),
bs AS (SELECT gene, arg_max(k, v) AS top FROM al GROUP BY gene), cl AS (SELECT gene, top, least(greatest(top, 1), 25) AS k FROM bs),
p3 AS (SELECT cl.gene, top, cl.k, a.v AS v0, m.v AS v1, e.v AS v2 FROM cl JOIN al a ON a.gene = cl.gene AND a.k = cl.k - 1 JOIN al m ON m.gene = cl.gene AND m.k = cl.k JOIN al e ON e.gene = cl.gene AND e.k = cl.k + 1),
dd AS (SELECT gene, pow(2.0, -9.0 + 0.5 * (k + CASE WHEN v0 - 2 * v1 + v2 < 0 THEN greatest(-1.0, least(1.0, 0.5 * (v0 - v2) / (v0 - 2 * v1 + v2))) ELSE top - k END)) AS dispersion FROM p3)
SELECT gene, round((SELECT dispersion FROM dd WHERE gene = -1), 6) AS common, round(dispersion, 6) AS tagwise FROM dd WHERE gene >= 0"""


def _groups(spark, d):
    return b.cells(spark, d).select("cell", F.col("factor").alias("group"))


@query("nb_dispersion", sql("counts library cells", _GRID))
def _(spark, d):
    return models.nb_dispersion(b.counts(spark, d), _groups(spark, d)).select("gene", *rounded("common", "tagwise"))


@query("deseq_dispersion")
def _(spark, d):
    return models.deseq_dispersion(models.prepare(b.counts(spark, d), _cells(spark, d), ["factor"]))


def _moments(counts, cells):
    """Dispersions by moments, which SQL can restate; zeros count."""
    n, inverse = cells.agg(F.count("*")).scalar(), cells.agg(F.avg(1 / F.col("size_factor"))).scalar()
    z = F.col("count") / F.col("size_factor")
    sums = counts.join(cells, "cell").groupBy("gene").agg(F.sum(z).alias("a"), F.sum(z * z).alias("q"))
    mean = F.col("a") / n
    value = ((F.col("q") - F.col("a") * mean) / (n - 1) - inverse * mean) / (mean * mean)
    return sums.select("gene", F.least(F.lit(10.0), F.greatest(F.lit(1e-4), value)).alias("dispersion"))


def _tested(spark, d):
    counts, cells = b.counts_uneven(spark, d), _cells(spark, d)
    return models.nb_lrt(counts, cells, ["factor"], dispersions=_moments(counts, cells), alpha=0.01)


# Newton steps of a group's log rate by list functions, robust dispersions, Cook's distances with the F tail by Simpson's rule,
# and Benjamini-Hochberg at every cutoff.
_STEPS = ", ".join(repr(0.95 * k / 49) for k in range(50))
_NEWTON = """list_reduce(list_prepend(ln(list_sum(y) / list_sum(s)), list_transform(range(40), lambda i: CAST(i AS DOUBLE))), lambda e, i: e
 + list_sum(list_transform(list_zip(y, s), lambda t: (t[1] - t[2] * exp(e)) / (1 + alpha * t[2] * exp(e))))
 / list_sum(list_transform(list_zip(y, s), lambda t: t[2] * exp(e) * (1 + alpha * t[1]) / pow(1 + alpha * t[2] * exp(e), 2))))"""
_LOGLIK = """list_sum(list_transform(list_zip(y, s), lambda t: t[1] * (ln(t[2]) + eta - ln(1 + alpha * t[2] * exp(eta))) - ln(1 + alpha * t[2] * exp(eta)) / alpha))"""
_TRIM = "CASE WHEN len(z) <= 3 THEN floor(len(z) / 3.0) WHEN len(z) <= 23 THEN floor(len(z) * 0.25) ELSE floor(len(z) * 0.125) END"
_TESTED = f""", lm AS (SELECT AVG(total_counts) AS a FROM library), nu AS (SELECT cell, factor, total_counts / a AS s FROM cells JOIN library USING (cell), lm),
nn AS (SELECT COUNT(*) AS n, AVG(1 / s) AS inv, COUNT(DISTINCT factor) AS levels FROM nu),
us AS (SELECT * FROM uneven),
mo AS (SELECT gene, SUM(count / s) AS a, SUM(pow(count / s, 2)) AS q FROM us JOIN nu USING (cell) GROUP BY gene),
dp AS (SELECT gene, a / n AS mean, least(10.0, greatest(1e-4, ((q - a * (a / n)) / (n - 1) - inv * (a / n)) / pow(a / n, 2))) AS alpha FROM mo, nn),
gr AS (SELECT gene, factor, alpha, mean, list(CAST(COALESCE(count, 0) AS DOUBLE) ORDER BY cell) AS y, list(s ORDER BY cell) AS s
       FROM dp CROSS JOIN nu LEFT JOIN us USING (gene, cell) GROUP BY ALL),
f1 AS (SELECT *, CASE WHEN list_sum(y) = 0 THEN -30.0 ELSE {_NEWTON} END AS eta FROM gr),
l1 AS (SELECT *, {_LOGLIK} AS ll, list_transform(list_zip(y, s), lambda t: t[1] / t[2]) AS z,
       list_transform(s, lambda v: v * exp(eta) / (1 + alpha * v * exp(eta))) AS w FROM f1),
tr AS (SELECT *, {_TRIM} AS cut FROM l1),
mi AS (SELECT *, list_avg(list_slice(list_sort(z), cut + 1, len(z) - cut)) AS middle FROM tr),
va AS (SELECT *, CASE WHEN len(z) >= 3 THEN CASE WHEN len(z) <= 3 THEN 2.04 WHEN len(z) <= 23 THEN 1.86 ELSE 1.51 END * list_avg(list_slice(
       list_sort(list_transform(z, lambda v: pow(v - middle, 2))), cut + 1, len(z) - cut)) END AS v FROM mi),
sp AS (SELECT *, greatest(0.04, COALESCE((MAX(v) OVER (PARTITION BY gene) - mean) / pow(mean, 2), 0.04)) AS spread FROM va),
ck AS (SELECT gene, MAX(CASE WHEN len(y) >= 3 THEN list_max(list_transform(list_zip(y, s, w), lambda t: pow(t[1] - t[2] * exp(eta), 2)
       / (t[2] * exp(eta) + spread * pow(t[2] * exp(eta), 2)) / levels * least(0.999999, t[3] / list_sum(w)) / pow(1 - least(0.999999, t[3] / list_sum(w)), 2))) END) AS d,
       SUM(ll) AS ll FROM sp, nn GROUP BY gene),
al AS (SELECT gene, alpha, mean, flatten(list(y)) AS y, flatten(list(s)) AS s FROM gr GROUP BY ALL),
f0 AS (SELECT *, {_NEWTON} AS eta FROM al), l0 AS (SELECT gene, mean, {_LOGLIK} AS ll0 FROM f0),
fx AS (SELECT gene, mean, greatest(0.0, 2 * (ll - ll0)) AS stat, sqrt(levels * d / (levels * d + n - levels)) AS u, levels / 2.0 AS p, (n - levels) / 2.0 AS q FROM ck JOIN l0 USING (gene), nn),
tl AS (SELECT *, exp(lgamma(p + q) - lgamma(p) - lgamma(q)) * u / 6000 * list_sum(list_transform(range(2001), lambda i:
       CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * 2 * pow(u * i / 2000, 2 * p - 1) * pow(1 - pow(u * i / 2000, 2), q - 1))) AS share FROM fx),
pv AS (SELECT gene, mean, stat, CASE WHEN share <= 0.99 THEN exp(-stat / 2) * (1 + stat / 2) END AS pvalue FROM tl),
cu AS (SELECT unnest(range(1, 51)) AS step, unnest(quantile_cont(mean, [{_STEPS}])) AS cutoff FROM pv),
rk AS (SELECT step, cutoff, pvalue, COUNT(*) OVER (PARTITION BY step) AS m, RANK() OVER (PARTITION BY step ORDER BY pvalue) + COUNT(*) OVER (PARTITION BY step, pvalue) - 1 AS rank
       FROM pv JOIN cu ON mean >= cutoff WHERE pvalue IS NOT NULL),
ht AS (SELECT step, cutoff, MAX(CASE WHEN pvalue * m / rank < 0.01 THEN rank ELSE 0 END) AS hits FROM rk GROUP BY ALL),
ch AS (SELECT cutoff AS threshold FROM ht ORDER BY hits DESC, step LIMIT 1),
ad AS (SELECT DISTINCT pvalue, least(1.0, MIN(pvalue * m / rank) OVER (ORDER BY pvalue DESC)) AS padj FROM rk JOIN ch ON cutoff = threshold),
results AS (SELECT gene, mean, stat, pv.pvalue, CASE WHEN mean >= threshold THEN padj END AS padj, threshold FROM pv CROSS JOIN ch LEFT JOIN ad ON pv.pvalue = ad.pvalue)
"""


@query("nb_lrt", sql("counts library cells uneven", _TESTED + """SELECT gene, round(mean, 6) AS "baseMean", round(stat, 5) AS stat, round(pvalue, 6) AS pvalue,
round(padj, 6) AS padj, round(threshold, 6) AS threshold FROM results"""))
def _(spark, d):
    return _tested(spark, d).select("gene", F.round("stat", 5).alias("stat"), *rounded("baseMean", "pvalue", "padj", "threshold"))


@query("nb_lrt_fitted")
def _(spark, d):
    return models.nb_lrt(b.counts(spark, d), _cells(spark, d), ["factor"]).drop("eta", "leverage")


@query("glm_lrt")
def _(spark, d):
    return models.glm_lrt(b.counts(spark, d), _cells(spark, d), "factor", coef=2).drop("eta", "leverage")


def _fitted(spark, d):
    counts = b.counts(spark, d)
    ready = models.prepare(counts, _cells(spark, d), ["factor"])
    dispersions = models.gene_dispersions(ready).select("gene", "dispersion")
    return counts, ready, models.likelihood_ratio(ready, dispersions, drop=[1], report=1)


@query("shrink_lfc")
def _(spark, d):
    _, ready, fitted = _fitted(spark, d)
    return models.shrink_lfc(ready, fitted, 1)


@query("cooks")
def _(spark, d):
    counts, ready, fitted = _fitted(spark, d)
    return models.cooks(counts, ready, fitted, b.cells(spark, d).select("cell"))


@query("find_markers")
def _(spark, d):
    return models.find_markers(b.counts(spark, d), _cells(spark, d), "factor")


@query("summarize_results", sql("counts library cells uneven", _TESTED + f""", lf AS (
SELECT gene, MAX(CASE WHEN factor = 'MIDDLE EAST' THEN eta END) - MAX(CASE WHEN factor = 'AFRICA' THEN eta END) AS lfc FROM f1 GROUP BY gene)
SELECT COUNT(*) AS total, COUNT(*) FILTER (padj < 0.01 AND lfc > 0) AS up, COUNT(*) FILTER (padj < 0.01 AND lfc < 0) AS down,
COUNT(*) FILTER (pvalue IS NULL AND mean > 0) AS outliers, COUNT(*) FILTER (padj IS NULL AND pvalue IS NOT NULL) AS low_counts FROM results JOIN lf USING (gene)"""))
def _(spark, d):
    return summaries.summarize_results(_tested(spark, d), 0.01)


# A region without a count of the gene has no finite fold change: it is left out on both sides.
_FOLDS = """, lf AS (SELECT gene, MAX(CASE WHEN factor = 'MIDDLE EAST' THEN eta END) AS up, MAX(CASE WHEN factor = 'AFRICA' THEN eta END) AS down FROM f1 GROUP BY gene)"""


def _finite(results):
    return results.withColumn("log2FoldChange", F.when(F.abs("log2FoldChange") < 12, F.col("log2FoldChange")))


@query("ma_table", sql("counts library cells uneven", _TESTED + _FOLDS + """
SELECT gene, round(mean, 6) AS "baseMean", CASE WHEN up > -30 AND down > -30 THEN round((up - down) / ln(2), 6) END AS "log2FoldChange",
COALESCE(padj < 0.01, false) AS significant FROM results JOIN lf USING (gene)"""))
def _(spark, d):
    return _finite(models.ma_table(_tested(spark, d), 0.01)).select("gene", "significant", *rounded("baseMean", "log2FoldChange"))


@query("volcano_table", sql("counts library cells uneven", _TESTED + _FOLDS + """, vt AS (SELECT gene, CASE WHEN up > -30 AND down > -30 THEN (up - down) / ln(2) END AS lfc, padj
FROM results JOIN lf USING (gene) WHERE padj IS NOT NULL)
SELECT gene, round(lfc, 6) AS "log2FoldChange", round(-log10(padj), 6) AS strength,
CASE WHEN padj < 0.01 AND lfc > 0.5 THEN 'up' WHEN padj < 0.01 AND lfc < -0.5 THEN 'down' ELSE 'none' END AS call FROM vt"""))
def _(spark, d):
    return models.volcano_table(_finite(_tested(spark, d)), alpha=0.01, fold=0.5).select("gene", "call", *rounded("log2FoldChange", "strength"))


@query("bcv_table")
def _(spark, d):
    counts = b.counts(spark, d)
    return models.bcv_table(counts, models.nb_dispersion(counts, _groups(spark, d)))


@query("smear_table")
def _(spark, d):
    counts = b.counts(spark, d)
    return models.smear_table(counts, models.glm_lrt(counts, _cells(spark, d), "factor", coef=2))


@query("gene_counts", sql("counts cells library", """SELECT cell, factor AS "group", round(COALESCE(count, 0) / (total_counts / (SELECT AVG(total_counts) FROM library)) + 0.5, 6) AS value
FROM cells JOIN library USING (cell) LEFT JOIN (SELECT cell, count FROM counts WHERE gene = 7) USING (cell)"""))
def _(spark, d):
    cells = _cells(spark, d)
    return models.gene_counts(b.counts(spark, d), cells.select("cell", "size_factor"), cells.drop("size_factor"), 7, "factor").select(
        "cell", "group", *rounded("value"))


@query("normalize_registry", sql("counts library", "SELECT gene, cell, round(log2(count * 1e6 / total_counts + 1), 6) AS value FROM counts JOIN library USING (cell)"))
def _(spark, d):
    return analyses.normalize(b.counts(spark, d), "scater:CPM").select("gene", "cell", *rounded("value"))


@query("normalize_deseq_tmm")
def _(spark, d):
    return analyses.normalize(b.counts(spark, d), "DESeq:TMM")


@query("run_edger")
def _(spark, d):
    tables = analyses.run_edger(b.counts(spark, d), b.cells(spark, d).select("cell", "factor"), ["factor"], "edgeR:TMM", min_cpm=2500, min_cells=2)
    return tables["results"].drop("eta", "leverage")


@query("run_deseq")
def _(spark, d):
    tables = analyses.run_deseq(
        b.counts(spark, d), b.cells(spark, d).select("cell", "factor"), ["factor"], "DESeq:TMM",
        n_keep=300, annotation=b.annotation(spark, d).select(F.col("gene").alias("id"), "symbol"))
    return tables["results"]


@query("run_scater")
def _(spark, d):
    tables = analyses.run_scater(
        b.counts(spark, d), b.cells(spark, d).select("cell", "factor"), b.genes(spark, d), "factor", "scater:TMM",
        min_mean=7.0, nmads=2.0)
    return tables["variance"]


