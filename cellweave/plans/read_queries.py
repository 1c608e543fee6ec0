"""Queries on reads, alignments and intervals, and write-and-read-back queries of every file format."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.context import settle
from cellweave.operators import alignments, lookups, ranking, reads
from cellweave.plans import bindings as b
from cellweave.plans.bindings import sql
from cellweave.plans.catalog import query, rounded
from cellweave.sources import readers, writers
from cellweave.streaming import ingest

# ---- reads ---------------------------------------------------------------------------------


@query("deinterleave", """SELECT CAST(conv_id AS VARCHAR) AS run, turn // 2 AS read_idx, turn % 2 + 1 AS mate, role AS name FROM conversations""")
def _(spark, d):
    return reads.deinterleave(b.turns(spark, d)).select("run", "read_idx", F.col("mate").cast("bigint").alias("mate"), "name")


@query("pair_mates", """SELECT CAST(a.conv_id AS VARCHAR) AS run, a.turn // 2 AS read_idx, a.role AS name1, z.role AS name2,
length(regexp_replace(a.text, '[^!-~]', '', 'g')) AS len1, length(regexp_replace(z.text, '[^!-~]', '', 'g')) AS len2
FROM conversations a JOIN conversations z ON a.conv_id = z.conv_id AND a.turn % 2 = 0 AND z.turn = a.turn + 1""")
def _(spark, d):
    pairs = lookups.pair_mates(reads.deinterleave(b.turns(spark, d)))
    return pairs.select("run", "read_idx", "name1", "name2", F.length("seq1").cast("bigint").alias("len1"),
                        F.length("seq2").cast("bigint").alias("len2"))


def _shape(df):
    return df.select("run", "read_idx", F.length("seq").cast("bigint").alias("length"), F.md5("seq").alias("seq"))


@query("trim_ends", sql("reads qualities", """, e AS (SELECT run, read_idx, seq, list_position(list_transform(q, lambda v: v >= 20), true) AS f,
len(q) + 1 - list_position(list_reverse(list_transform(q, lambda v: v >= 20)), true) AS l FROM qualities)
SELECT run, read_idx, CAST(CASE WHEN f IS NULL OR f = 0 THEN 0 ELSE l - f + 1 END AS BIGINT) AS length,
md5(CASE WHEN f IS NULL OR f = 0 THEN '' ELSE substr(seq, f, l - f + 1) END) AS seq FROM e"""))
def _(spark, d):
    return _shape(reads.trim_ends(b.reads(spark, d), 20, 20))


@query("trim_sliding", sql("reads qualities", """, w AS (SELECT run, read_idx, seq, list_position(list_transform(range(1, len(q) - 2), lambda i: q[i] + q[i + 1] + q[i + 2] + q[i + 3] < 60), true) AS f FROM qualities)
SELECT run, read_idx, CAST(CASE WHEN f IS NULL OR f = 0 THEN length(seq) ELSE f - 1 END AS BIGINT) AS length,
md5(CASE WHEN f IS NULL OR f = 0 THEN seq ELSE substr(seq, 1, f - 1) END) AS seq FROM w"""))
def _(spark, d):
    return _shape(reads.trim_sliding(b.reads(spark, d), 4, 15))


@query("filter_min_len", sql("reads", "SELECT run, read_idx, length(seq) AS length, md5(seq) AS seq FROM reads WHERE length(seq) >= 36"))
def _(spark, d):
    return _shape(reads.filter_min_len(b.reads(spark, d), 36))


def _adapters(spark, d):
    """The benchmark passages, reduced like the reads, play the adapters."""
    return b.table(spark, d, "benchmark").select(
        F.col("item_id").cast("string").alias("name"), F.regexp_replace("text", "[^!-~]", "").alias("seq"))


@query("trim_reads")
def _(spark, d):
    kept = reads.trim_reads(reads.deinterleave(b.turns(spark, d)), paired=True)
    return kept.groupBy("pairing").agg(F.count("*").alias("reads"), F.sum(F.length("seq")).alias("bases"))


@query("extract_barcodes", """WITH s AS (SELECT a.conv_id, a.turn, regexp_replace(a.text, '[^!-~]', '', 'g') AS seq FROM conversations a
JOIN conversations z ON a.conv_id = z.conv_id AND a.turn % 2 = 0 AND z.turn = a.turn + 1)
SELECT CAST(conv_id AS VARCHAR) AS run, turn // 2 AS read_idx, substr(seq, 1, 12) AS xc, substr(seq, 13, 8) AS umi FROM s""")
def _(spark, d):
    pairs = lookups.pair_mates(reads.deinterleave(b.turns(spark, d)))
    return reads.extract_barcodes(pairs).select("run", "read_idx", "xc", "umi")


@query("quality_by_position", sql("reads qualities", """, u AS (SELECT run, unnest(q) AS q, unnest(range(0, len(q))) AS pos FROM qualities)
SELECT run, pos, quantile_cont(q, 0.25) AS q1, quantile_cont(q, 0.5) AS median, quantile_cont(q, 0.75) AS q3, round(AVG(q), 6) AS mean FROM u GROUP BY 1, 2"""))
def _(spark, d):
    table = reads.quality_by_position(b.reads(spark, d))
    return table.select("run", F.col("pos").cast("bigint").alias("pos"), "q1", "median", "q3", *rounded("mean"))


@query("base_content", sql("reads", """SELECT run, COUNT(*) AS reads, CAST(SUM(length(seq)) AS BIGINT) AS bases,
round(100.0 * SUM(length(seq) - length(regexp_replace(seq, '[GCgc]', '', 'g'))) / SUM(length(seq)), 6) AS gc_pct,
round(100.0 * SUM(length(seq) - length(regexp_replace(seq, '[Nn]', '', 'g'))) / SUM(length(seq)), 6) AS n_pct FROM reads GROUP BY run"""))
def _(spark, d):
    return reads.base_content(b.reads(spark, d)).select("run", "reads", "bases", *rounded("gc_pct", "n_pct"))


@query("length_distribution", sql("reads", "SELECT run, length(seq) AS length, COUNT(*) AS n FROM reads GROUP BY 1, 2"))
def _(spark, d):
    return reads.length_distribution(b.reads(spark, d))


@query("duplicate_levels", sql("reads", ", c AS (SELECT run, seq, COUNT(*) AS copies FROM reads GROUP BY 1, 2) SELECT run, copies, COUNT(*) AS sequences FROM c GROUP BY 1, 2"))
def _(spark, d):
    return reads.duplicate_levels(b.reads(spark, d))


@query("over_represented", sql("reads", """, n AS (SELECT run, COUNT(*) AS n FROM reads GROUP BY run)
SELECT r.run, md5(seq) AS seq, COUNT(*) AS copies FROM reads r JOIN n USING (run) GROUP BY r.run, seq, n HAVING 100.0 * COUNT(*) / n >= 0.5"""))
def _(spark, d):
    return reads.over_represented(b.reads(spark, d), 0.5).select("run", F.md5("seq").alias("seq"), "copies")


_QC = """, u AS (SELECT run, unnest(q) AS q, unnest(range(0, len(q))) AS pos FROM qualities), md AS (SELECT run, pos, quantile_cont(q, 0.5) AS m FROM u GROUP BY 1, 2),
lo AS (SELECT run, MIN(m) AS m FROM md GROUP BY run), ct AS (SELECT run, abs(100.0 * SUM(length(seq) - length(regexp_replace(seq, '[GCgc]', '', 'g'))) / SUM(length(seq)) - 50) AS gc,
100.0 * SUM(length(seq) - length(regexp_replace(seq, '[Nn]', '', 'g'))) / SUM(length(seq)) AS nn, 100.0 * (COUNT(*) - COUNT(DISTINCT seq)) / COUNT(*) AS dp FROM reads GROUP BY run),
qc AS (SELECT run, 'median_quality' AS module, m AS value FROM lo UNION ALL SELECT run, 'gc_pct', gc FROM ct UNION ALL SELECT run, 'n_pct', nn FROM ct UNION ALL SELECT run, 'duplicate_pct', dp FROM ct)"""


@query("read_qc", sql("reads qualities", _QC + "SELECT run, module, round(value, 6) AS value FROM qc"))
def _(spark, d):
    return reads.read_qc(b.reads(spark, d)).select("run", "module", *rounded("value"))


@query("qc_aggregate", sql("reads qualities", _QC + """, st AS (SELECT module, CASE WHEN (module = 'median_quality' AND value < 20) OR (module = 'gc_pct' AND value > 30) OR (module = 'n_pct' AND value > 20) OR (module = 'duplicate_pct' AND value > 50) THEN 'fail'
WHEN (module = 'median_quality' AND value < 25) OR (module = 'gc_pct' AND value > 15) OR (module = 'n_pct' AND value > 5) OR (module = 'duplicate_pct' AND value > 20) THEN 'warn' ELSE 'pass' END AS status FROM qc)
SELECT module, status, COUNT(*) AS runs FROM st GROUP BY 1, 2"""))
def _(spark, d):
    return reads.qc_aggregate(reads.read_qc(b.reads(spark, d)))


@query("qc_rollup", """WITH m AS (SELECT DISTINCT lang AS individual, source AS run FROM documents), r AS (SELECT source AS run, COUNT(*) AS a, COUNT(*) FILTER (length(regexp_replace(text, '[^!-~]', '', 'g')) >= 200) AS t FROM documents GROUP BY 1)
SELECT individual, CAST(SUM(a) AS BIGINT) AS reads, CAST(SUM(t) AS BIGINT) AS trimmed, CAST(SUM(a) AS BIGINT) AS aligned, CAST(0 AS BIGINT) AS assigned FROM m JOIN r USING (run) GROUP BY 1""")
def _(spark, d):
    documents = b.reads(spark, d)
    per_run = documents.groupBy("run").agg(F.count("*").alias("reads"))
    trimmed = reads.filter_min_len(documents, 200).groupBy("run").agg(F.count("*").alias("reads"))
    manifest = b.table(spark, d, "documents").select(F.col("lang").alias("individual"), F.col("source").alias("run"))
    return reads.qc_rollup(manifest, per_run, trimmed, per_run, per_run.filter("reads < 0"))


# ---- alignments ----------------------------------------------------------------------------



@query("overlap_join", sql("blocks exons", """SELECT b.read, b.part, b.chrom, b.s AS "start", b.e AS "end", x.gene, x.s AS exon_start, x.e AS exon_end
FROM blocks b JOIN exons x ON b.chrom = x.chrom AND b.s <= x.e AND x.s <= b.e"""))
def _(spark, d):
    return lookups.overlap_join(b.blocks(spark, d), b.exons(spark, d), width=64)


@query("assign_reads", sql("blocks exons", """, h AS (SELECT read, MIN(x.gene) AS lo, MAX(x.gene) AS hi FROM blocks b JOIN exons x ON b.chrom = x.chrom AND b.s <= x.e AND x.s <= b.e GROUP BY 1)
SELECT r.read, CASE WHEN lo IS NULL THEN '__no_feature' WHEN lo <> hi THEN '__ambiguous' ELSE CAST(lo AS VARCHAR) END AS gene
FROM (SELECT DISTINCT read FROM blocks) r LEFT JOIN h USING (read)"""))
def _(spark, d):
    return alignments.assign_reads(b.blocks(spark, d), b.exons(spark, d), ["read"], width=64)


def _aligned(spark, d):
    """Line items as alignments: spliced in two stretches when the quantity allows it."""
    q = F.col("l_quantity").cast("bigint")
    spliced = F.concat((q / 2).cast("bigint").cast("string"), F.lit("M10N"), (q - (q / 2).cast("bigint")).cast("string"), F.lit("M"))
    start = F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date")) + 1000
    return b.table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("run"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("name"),
        F.when(F.col("l_tax") == 0, 4).otherwise(0).alias("flag"), F.concat(F.lit("c"), "l_partkey").alias("chrom"),
        start.alias("pos"), (F.col("l_discount") * 400 + 4).cast("int").alias("mapq"),
        F.when(q >= 2, spliced).otherwise(F.concat(q.cast("string"), F.lit("M"))).alias("cigar"),
        F.lit("*").alias("seq"), F.lit("*").alias("qual"),
        F.create_map(F.lit("NH"), F.when(F.col("l_linestatus") == "O", "1").otherwise("2")).alias("tags"))


_SAM_SQL = """, al AS (SELECT l_returnflag AS run, concat_ws('-', l_orderkey, l_linenumber) AS name, l_tax = 0 AS un, concat('c', l_partkey) AS chrom,
date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) + 1000 AS pos, CAST(trunc(l_discount * 400 + 4) AS INT) AS mapq, CAST(l_quantity AS BIGINT) AS q, l_linestatus <> 'O' AS multi FROM lineitem),
bl AS (SELECT run, name, chrom, pos AS s, pos + (CASE WHEN q >= 2 THEN q // 2 ELSE q END) - 1 AS e FROM al WHERE NOT un
  UNION ALL SELECT run, name, chrom, pos + q // 2 + 10, pos + 10 + q - 1 FROM al WHERE NOT un AND q >= 2)"""


@query("alignment_blocks", "WITH" + _SAM_SQL[1:] + """SELECT run, name, chrom, s AS "start", e AS "end" FROM bl""")
def _(spark, d):
    mapped = _aligned(spark, d).filter("flag = 0")
    return alignments.alignment_blocks(mapped).select("run", "name", "chrom", "start", "end")


_FEATURES = _SAM_SQL + """, xo AS (SELECT concat('g', o_orderkey) AS gene, concat('c', o_custkey) AS chrom, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1000 AS s FROM orders),
hi AS (SELECT run, name, MIN(gene) AS lo, MAX(gene) AS hi FROM bl JOIN xo ON bl.chrom = xo.chrom AND bl.s <= xo.s + 3 AND xo.s <= bl.e GROUP BY 1, 2),
rd AS (SELECT run, name, BOOL_AND(un) AS un, BOOL_OR(multi) AS multi, MIN(mapq) FILTER (NOT un) AS mq FROM al GROUP BY 1, 2),
cl AS (SELECT run, CASE WHEN un THEN '__not_aligned' WHEN multi THEN '__alignment_not_unique' WHEN mq < 10 THEN '__too_low_aQual' WHEN lo IS NULL THEN '__no_feature' WHEN lo <> hi THEN '__ambiguous' ELSE lo END AS gene FROM rd LEFT JOIN hi USING (run, name))
SELECT run, gene, COUNT(*) AS count FROM cl GROUP BY 1, 2"""


def _gene_model(spark, d):
    start = F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")) + 1000
    return b.table(spark, d, "orders").select(
        F.concat(F.lit("g"), "o_orderkey").alias("gene"), F.concat(F.lit("c"), "o_custkey").alias("chrom"),
        start.alias("start"), (start + 3).alias("end"))


@query("count_features", "WITH" + _FEATURES[1:])
def _(spark, d):
    return alignments.count_features(_aligned(spark, d), _gene_model(spark, d), width=64)


@query("barcode_histogram", sql("tagged", "SELECT xc, COUNT(*) AS reads FROM tagged WHERE NOT dup GROUP BY xc"))
def _(spark, d):
    return alignments.barcode_histogram(b.tagged(spark, d))


_DGE = """, h AS (SELECT xc, COUNT(*) AS n FROM tagged WHERE NOT dup GROUP BY xc), top AS (SELECT xc FROM h ORDER BY n DESC, xc LIMIT 40),
c AS (SELECT gene, xc AS cell, COUNT(DISTINCT umi) AS count FROM tagged WHERE xc IN (SELECT xc FROM top) GROUP BY 1, 2)"""


@query("digital_expression", sql("tagged", _DGE + "SELECT gene, cell, count FROM c WHERE cell IN (SELECT cell FROM c GROUP BY cell HAVING COUNT(*) >= 3)"))
def _(spark, d):
    return alignments.digital_expression(b.tagged(spark, d), 40, 3)


_MERGED = """, mo AS (SELECT xc, gene, umi, COUNT(*) AS reads FROM tagged GROUP BY 1, 2, 3),
weak AS (SELECT DISTINCT a.xc, a.gene, a.umi FROM mo a JOIN mo z ON a.xc = z.xc AND a.gene = z.gene AND length(a.umi) = length(z.umi) AND a.umi <> z.umi
  AND hamming(a.umi, z.umi) = 1 AND (z.reads > a.reads OR (z.reads = a.reads AND z.umi > a.umi)))
SELECT gene, xc AS cell, COUNT(*) AS count FROM mo a WHERE NOT EXISTS (SELECT 1 FROM weak w WHERE w.xc = a.xc AND w.gene = a.gene AND w.umi = a.umi) GROUP BY 1, 2"""


@query("digital_expression_merged", sql("tagged", _MERGED))
def _(spark, d):
    return alignments.digital_expression(b.tagged(spark, d), 1_000_000, 1, merge=True)


@query("dge_summary", sql("tagged", """SELECT xc, COUNT(*) AS reads, COUNT(DISTINCT concat(gene, '|', umi)) AS transcripts, COUNT(DISTINCT gene) AS genes FROM tagged GROUP BY xc"""))
def _(spark, d):
    return alignments.dge_summary(b.tagged(spark, d))


@query("sort_by_name", "SELECT concat_ws('-', l_orderkey, l_linenumber) AS name, l_partkey AS part FROM lineitem")
def _(spark, d):
    named = b.table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("name"), F.col("l_partkey").alias("part"))
    return ranking.sort_by_name(named)


@query("clip_adapters")
def _(spark, d):
    clipped = reads.clip_adapters(reads.deinterleave(b.turns(spark, d)), _adapters(spark, d))
    return _shape(clipped)


@query("clip_palindromes")
def _(spark, d):
    pairs = lookups.pair_mates(reads.deinterleave(b.turns(spark, d)))
    return reads.clip_palindromes(pairs).select("run", "read_idx", F.length("seq1").alias("len1"), F.length("seq2").alias("len2"))


# ---- files: written from the given tables, read back -----------------------------------------


@query("read_fastq", sql("reads", "SELECT run, CAST(1 AS BIGINT) AS mate, concat('r', read_idx) AS name, length(seq) AS length, md5(seq) AS seq FROM reads"))
def _(spark, d):
    folder = b.scratch(spark)
    table = b.reads(spark, d)
    writers.write_fastq(table, folder)
    back = readers.read_fastq(spark, f"{folder}/*/*/*/*.txt")
    names = table.select("run", "name")
    return back.drop("run").join(names, "name").select(
        "run", F.col("mate").cast("bigint").alias("mate"), "name", F.length("seq").cast("bigint").alias("length"), F.md5("seq").alias("seq"))


@query("read_fastq_paired", """WITH t AS (SELECT conv_id, turn, role, regexp_replace(text, '[^!-~]', '', 'g') AS seq FROM conversations)
SELECT a.role AS name1, z.role AS name2, md5(a.seq) AS seq1, md5(z.seq) AS seq2, COUNT(*) AS pairs
FROM t a JOIN t z ON a.conv_id = z.conv_id AND a.turn % 2 = 0 AND z.turn = a.turn + 1 GROUP BY ALL""")
def _(spark, d):
    """Mates of all pairs in two files each of one folder, in the same order; the pairs that come back are compared."""
    folder = b.scratch(spark)
    pairs = lookups.pair_mates(reads.deinterleave(b.turns(spark, d)))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = settle(pairs.repartitionByRange(width, "run", "read_idx").sortWithinPartitions("run", "read_idx"))
    for mate in (1, 2):
        record = F.concat_ws("\n", F.concat(F.lit("@"), f"name{mate}"), f"seq{mate}", F.lit("+"), f"qual{mate}")
        ordered.select(record.alias("value")).write.text(f"{folder}/parts_{mate}.fastq")
    return readers.read_fastq_paired(spark, [f"{folder}/parts_{mate}.fastq" for mate in (1, 2)]).groupBy(
        "name1", "name2", F.md5("seq1").alias("seq1"), F.md5("seq2").alias("seq2")).agg(F.count("*").alias("pairs"))


def _count_files(spark, d, folder):
    """Headerless count files of every run, written in one pass: the folder of a run is named ``file=htseq_<run>_results.txt``.

    Parts of a run are balanced by size, so a large run has several files and a small one does not have one per task.
    """
    counts = b.run_counts(spark, d).select("gene", "count", F.concat(F.lit("htseq_"), "run", F.lit("_results.txt")).alias("file"))
    writers.write_table(counts.hint("rebalance", "file"), folder, header=False, by=["file"])
    return f"{folder}/file=htseq_*_results.txt"


@query("read_count_files", sql("run_counts", "SELECT run, CAST(gene AS VARCHAR) AS gene, count FROM run_counts"))
def _(spark, d):
    folder = b.scratch(spark)
    return readers.read_count_files(spark, _count_files(spark, d, folder))


def _damaged_files(spark, d, folder):
    """Count files of the runs in which every eleventh gene has no count, every thirteenth two."""
    text = F.when(F.col("gene") % 11 == 0, "NA").when(F.col("gene") % 13 == 0, F.concat_ws("\t", "count", "count")).otherwise(F.col("count").cast("string"))
    lines = b.run_counts(spark, d).select(F.concat_ws("\t", "gene", text).alias("value"), F.concat(F.lit("htseq_"), "run", F.lit("_results.txt")).alias("file"))
    lines.hint("rebalance", "file").write.partitionBy("file").text(folder)
    return f"{folder}/file=htseq_*_results.txt"


_IS_DAMAGED = "(gene % 11 = 0 OR gene % 13 = 0)"


@query("count_file_report", sql("run_counts", f"""SELECT run, CAST(COUNT(*) FILTER (NOT {_IS_DAMAGED}) AS BIGINT) AS rows,
CAST(COUNT(*) FILTER ({_IS_DAMAGED}) AS BIGINT) AS malformed, CAST(0 AS BIGINT) AS skipped FROM run_counts GROUP BY run"""))
def _(spark, d):
    report = readers.count_file_report(spark, _damaged_files(spark, d, b.scratch(spark)))
    return report.groupBy("run").agg(F.sum("rows").alias("rows"), F.sum("malformed").alias("malformed"), F.count_if("skipped").alias("skipped"))


@query("damaged_count_lines", sql("run_counts", f"""SELECT run, concat(gene, chr(9), CASE WHEN gene % 11 = 0 THEN 'NA' ELSE concat(count, chr(9), count) END) AS line
FROM run_counts WHERE {_IS_DAMAGED}"""))
def _(spark, d):
    return readers.damaged_count_lines(spark, _damaged_files(spark, d, b.scratch(spark))).select("run", "line")


@query("stream_damaged", sql("run_counts", f"SELECT run, COUNT(*) AS malformed FROM run_counts WHERE {_IS_DAMAGED} GROUP BY run"))
def _(spark, d):
    folder = b.scratch(spark)
    stream = ingest.stream_damaged(spark, _damaged_files(spark, d, f"{folder}/in"), 3)
    ingest.ingest_counts(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").groupBy("run").agg(F.count("*").alias("malformed"))


@query("read_matrix", sql("counts", "SELECT CAST(gene AS VARCHAR) AS gene, CAST(cell AS VARCHAR) AS cell, count FROM counts"))
def _(spark, d):
    folder = b.scratch(spark)
    cells = [str(r[0]) for r in b.cells(spark, d).select("cell").orderBy("cell").collect()]  # the header line holds every cell by the file's nature
    writers.write_matrix(b.counts(spark, d), folder, cells)
    return readers.read_matrix(spark, f"{folder}/*.gz")


@query("read_matrix_pivot", sql("run_counts", "SELECT CAST(gene AS VARCHAR) AS gene, run AS cell, count FROM run_counts"))
def _(spark, d):
    folder = b.scratch(spark)
    runs = b.run_counts(spark, d).withColumnRenamed("run", "cell")
    writers.write_matrix_pivot(runs, folder, [str(k) for k in range(1, 8)])
    return readers.read_matrix(spark, f"{folder}/*.gz")


@query("read_count_dir", sql("run_counts", "SELECT CAST(gene AS VARCHAR) AS gene, run AS cell, count FROM run_counts"))
def _(spark, d):
    folder = b.scratch(spark)
    runs = b.run_counts(spark, d).withColumnRenamed("run", "cell")
    marked = runs.withColumn("gene", F.col("gene").cast("string")).unionByName(
        runs.groupBy("cell").agg(F.lit("__ambiguous").alias("gene"), F.sum("count").alias("count")))
    for part in (["1", "2", "3"], ["4", "5", "6", "7"]):
        writers.write_matrix_pivot(marked.filter(F.col("cell").isin(part)), f"{folder}/p{part[0]}_counts.txt", part)
    return readers.read_count_dir(spark, folder)


@query("read_dge_files", sql("run_counts", """, m AS (SELECT CAST(n_nationkey AS VARCHAR) AS run, n_name AS id FROM nation)
SELECT CAST(gene AS VARCHAR) AS gene, concat(id, '_1') AS cell, count FROM run_counts JOIN m USING (run)"""))
def _(spark, d):
    folder = b.scratch(spark)
    runs = b.run_counts(spark, d).withColumnRenamed("run", "cell")
    for k in range(1, 8):
        writers.write_matrix_pivot(runs.filter(F.col("cell") == str(k)), f"{folder}/{k}_dge.txt.gz", [str(k)])
    manifest = b.table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("run"), F.col("n_name").alias("id"))
    return readers.read_dge_files(spark, f"{folder}/*_dge.txt.gz", manifest)


@query("read_gene_lengths", sql("annotation", "SELECT CAST(gene AS VARCHAR) AS gene, len FROM annotation"))
def _(spark, d):
    folder = b.scratch(spark)
    writers.write_table(b.annotation(spark, d).select("gene", "len"), folder, header=False)
    return readers.read_gene_lengths(spark, folder).select("gene", F.col("len").cast("bigint").alias("len"))


@query("read_annotation", sql("annotation", """SELECT ensembl, symbol, CAST(gene AS VARCHAR) AS entrez, 'c1' AS chrom, "start", "end" FROM annotation"""))
def _(spark, d):
    folder = b.scratch(spark)
    table = b.annotation(spark, d).select("ensembl", "symbol", F.col("gene").alias("entrez"), F.lit("c1").alias("chrom"), "start", "end")
    writers.write_table(table, folder)
    back = readers.read_annotation(spark, folder)
    return back.withColumns({"start": F.col("start").cast("bigint"), "end": F.col("end").cast("bigint")})


@query("read_manifest", sql("cells", """SELECT id, individual, CAST(cell AS VARCHAR) AS run, factor AS region FROM cells"""))
def _(spark, d):
    folder = b.scratch(spark)
    table = b.cells(spark, d).select(
        F.col("id").alias("ID"), F.col("individual").alias("Individual"), F.lit("e").alias("Experiment"),
        F.col("cell").cast("string").alias("Run"), F.lit("").alias("FASTQ_URI"), F.concat(F.lit(" "), "factor").alias("region"))
    table.write.csv(folder, sep="\t", header=True, emptyValue="", ignoreLeadingWhiteSpace=False)
    return readers.read_manifest(spark, folder).select("id", "individual", "run", "region")


@query("read_gtf", sql("exons", """SELECT concat('g', gene) AS gene, concat('c', chrom) AS chrom, s AS "start", e AS "end", '+' AS strand FROM exons"""))
def _(spark, d):
    folder = b.scratch(spark)
    lines = b.exons(spark, d).select(F.concat_ws(
        "\t", F.concat(F.lit("c"), "chrom"), F.lit("src"), F.lit("exon"), F.col("start").cast("string"), F.col("end").cast("string"),
        F.lit("."), F.lit("+"), F.lit("."), F.concat(F.lit('gene_id "g'), "gene", F.lit('"; level "2";'))).alias("value"))
    lines.write.text(folder)
    back = readers.read_gtf(spark, folder)
    return back.select("gene", "chrom", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "strand")


@query("read_sam", "WITH" + _FEATURES[1:])
def _(spark, d):
    folder = b.scratch(spark)
    table = _aligned(spark, d)
    for flag in ("A", "N", "R"):
        lines = table.filter(F.col("run") == flag).select(F.concat_ws(
            "\t", "name", F.col("flag").cast("string"), "chrom", F.col("pos").cast("string"), F.col("mapq").cast("string"), "cigar",
            F.lit("*"), F.lit("0"), F.lit("0"), "seq", "qual", F.concat(F.lit("NH:i:"), F.col("tags")["NH"])).alias("value"))
        lines.write.text(f"{folder}/{flag}.sam")
    return alignments.count_features(readers.read_sam(spark, f"{folder}/*.sam"), _gene_model(spark, d), width=64)


@query("read_fasta", "SELECT CAST(item_id AS VARCHAR) AS name, upper(regexp_replace(replace(text, '>', ''), '[^!-~]', '', 'g')) AS seq FROM benchmark")
def _(spark, d):
    folder = b.scratch(spark)
    records = _adapters(spark, d).select(F.concat(F.lit(">"), "name", F.lit("\n"), F.translate("seq", ">", "")).alias("value"))
    records.write.text(folder)
    return readers.read_fasta(spark, folder)


@query("read_marker_pairs", sql("pairs", "SELECT phase, CAST(first AS VARCHAR) AS first, CAST(second AS VARCHAR) AS second FROM pairs"))
def _(spark, d):
    folder = b.scratch(spark)
    writers.write_table(b.marker_pairs(spark, d), folder)
    return readers.read_marker_pairs(spark, folder)


@query("stream_counts", sql("run_counts", "SELECT run, CAST(gene AS VARCHAR) AS gene, count FROM run_counts"))
def _(spark, d):
    folder = b.scratch(spark)
    stream = ingest.stream_counts(spark, _count_files(spark, d, f"{folder}/in"), 3)
    ingest.ingest_counts(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query("stream_cell_totals", sql("run_counts", "SELECT run, CAST(SUM(count) AS BIGINT) AS total_counts, COUNT(*) AS total_features FROM run_counts GROUP BY run"))
def _(spark, d):
    folder = b.scratch(spark)
    totals = ingest.stream_cell_totals(ingest.stream_counts(spark, _count_files(spark, d, f"{folder}/in"), 3))
    ingest.write_cell_totals(totals, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")
