"""File scans. Every schema is explicit; wide files are melted from text with their header line,
so the number of columns never becomes a schema."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellweave.context import settle
from cellweave.functions.columns import mate_from_path, run_from_path
from cellweave.operators.filters import drop_summary_rows
from cellweave.operators.lookups import first_per_key, pair_mates
from cellweave.sources import fastq

# The five leading manifest columns; every further column is a factor.
MANIFEST_COLUMNS = ["ID", "Individual", "Experiment", "Run", "FASTQ_URI"]


def _unquote(c: Column) -> Column:
    return F.regexp_replace(c, '^"|"$', "")


def manifest_factors(spark: SparkSession, path: str) -> list[str]:
    """Names of the factor columns, taken from the header line."""
    header = spark.read.text(path).limit(1).first()[0].rstrip("\r")
    return [_plain(name) for name in header.split("\t")[len(MANIFEST_COLUMNS):]]


def _plain(name: str) -> str:
    return name.strip().strip('"')


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Run manifest: ``id, individual, experiment, run, fastq_uri`` and one column per factor.

    Carriage returns and surrounding blanks are removed, so a factor has the levels it shows;
    empty fields are null. Columns are taken by name, never by collapsing tabs.
    """
    factors = manifest_factors(spark, path)
    names = [c.lower() for c in MANIFEST_COLUMNS] + factors
    schema = ", ".join(f"`{n}` string" for n in names)
    table = spark.read.csv(path, sep="\t", header=True, schema=schema, quote='"', enforceSchema=True)
    return table.select(*[
        F.nullif(F.trim(F.regexp_replace(F.col(f"`{n}`"), "\r", "")), F.lit("")).alias(n) for n in names])


def _numbered_lines(spark: SparkSession, paths) -> DataFrame:
    """Text lines with path and global line number, without moving any line.

    Rows of one file block are contiguous in their task, so the line number is the row's own id
    minus the block's first id plus the lines of earlier blocks. Only one row per block is
    shuffled and ordered.
    """
    lines = spark.read.text(paths if isinstance(paths, list) else [paths]).select(
        F.regexp_replace("value", "\r$", "").alias("line"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    blocks = lines.groupBy("path", "block").agg(F.min("row_id").alias("first_id"), F.count("*").alias("n"))
    earlier = W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select(
        "path", "block", "first_id", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return lines.join(offsets, ["path", "block"]).select(
        "path", "line", (F.col("row_id") - F.col("first_id") + F.col("offset")).alias("line_no"))


def read_fastq(spark: SparkSession, paths) -> DataFrame:
    """``reads(run, mate, read_idx, name, seq, qual)``: four lines per record, plain or gz, any split."""
    return read_fastq_checked(spark, paths)[0]


def read_fastq_checked(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """The reads, and ``damaged(path, block, lines)``: lines that form no record, as a truncated last one."""
    records, damaged = fastq.read_records(spark, paths)
    return records.select(
        run_from_path("path", "fastq").alias("run"), mate_from_path("path").cast("int").alias("mate"), "read_idx", "name", "seq", "qual"), damaged


def read_fastq_paired(spark: SparkSession, paths) -> DataFrame:
    """Mates of ``<run>_1`` / ``<run>_2`` files in one row each, paired by record number."""
    return pair_mates(read_fastq(spark, paths))


def parsed_counts(lines: DataFrame) -> DataFrame:
    """``(path, run, gene, count, line)`` of text lines ``(path, line)`` of two-column count files.

    A line has a name and a whole number with one tab between them; any other line that is not blank has no gene and no count.
    """
    fields = F.split(F.regexp_replace("line", "\r$", ""), "\t")
    gene, number = F.trim(_unquote(F.get(fields, F.lit(0)))), F.trim(_unquote(F.get(fields, F.lit(1))))
    whole = number.rlike(r"^[+-]?[0-9]+$") & number.try_cast("bigint").isNotNull()
    good = (F.size(fields) == 2) & (gene != "") & whole
    return lines.filter(F.trim(F.regexp_replace("line", r"\s", "")) != "").select(
        "path", run_from_path("path", "htseq").alias("run"), F.when(good, gene).alias("gene"), F.when(good, number.try_cast("bigint")).alias("count"), "line")


def _count_lines(spark: SparkSession, paths) -> DataFrame:
    lines = spark.read.option("ignoreCorruptFiles", "true").text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    return parsed_counts(lines)


def read_count_files(spark: SparkSession, paths) -> DataFrame:
    """``counts_raw(run, gene, count)`` of headerless two-column files named ``htseq_<run>_results.txt``.

    Unreadable files and lines that hold no count are left out; ``count_file_report`` and ``damaged_count_lines`` name them.
    """
    return _count_lines(spark, paths).filter(F.col("gene").isNotNull()).select("run", "gene", "count")


def damaged_count_lines(spark: SparkSession, paths) -> DataFrame:
    """``(path, run, line)``: lines of count files that ``read_count_files`` leaves out."""
    return _count_lines(spark, paths).filter(F.col("gene").isNull()).select("path", "run", "line")


def count_file_report(spark: SparkSession, paths) -> DataFrame:
    """One row per file: ``path, run, bytes, rows, malformed, skipped``. Spark lists no files of 0 bytes, so they have no row.

    A file is skipped if it gave no line, as a damaged archive does. Lines before a damaged place are kept and counted.
    Only names and sizes are listed for the files, and one row per file and task is shuffled.
    """
    path = F.col("_metadata.file_path")
    listed = spark.read.format("binaryFile").load(paths).select(path.alias("path"), F.col("_metadata.file_size").alias("bytes"))
    lines = _count_lines(spark, paths).groupBy("path").agg(
        F.count("gene").alias("rows"), F.count_if(F.col("gene").isNull()).alias("malformed"), F.count("*").alias("_lines"))
    none = F.lit(0).cast("bigint")
    return listed.join(lines, "path", "left").select(
        "path", run_from_path("path", "htseq").alias("run"), "bytes", F.coalesce("rows", none).alias("rows"),
        F.coalesce("malformed", none).alias("malformed"), F.col("_lines").isNull().alias("skipped"))


def _wide_lines(spark: SparkSession, paths) -> DataFrame:
    """``(path, block, value)`` of wide files with a header line, in the order of a task's blocks.

    A wide file is one block per task or several blocks in order; the header is in the first.
    """
    return spark.read.text(paths if isinstance(paths, list) else [paths]).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")


def _split_header(lines: Iterator[tuple[str, int, bytes]], here: list[str | None]) -> Iterator[tuple[str, bool, bytes]]:
    """``(path, is header, line)`` without blank lines and ends of DOS lines; ``here`` is the path whose header the task saw last."""
    for path, block, line in lines:
        line = line.removesuffix(b"\r")
        if line:
            header = block == 0 and path != here[0]
            if header:
                here[0] = path
            yield path, header, line


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[str, int, bytes]]:
    return zip(batch.column("path").to_pylist(), batch.column("block").to_pylist(), batch.column("value").cast(pa.binary()).to_pylist())


def _headers(lines: DataFrame) -> DataFrame:
    """``(path, header)``: the first line of each file that is not blank."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = [None]
        for batch in batches:
            found = [(path, line.decode("utf-8", "replace")) for path, header, line in _split_header(_rows_of(batch), here) if header]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in found], pa.string()), pa.array([h for _, h in found], pa.string())], names=["path", "header"])

    return lines.filter("block = 0").mapInArrow(first, "path string, header string")


CHARACTERS = 1 << 20  # of wide lines that are cut into fields at once
ONES, TOP = np.uint64(0x0101010101010101), np.uint64(56)  # a word of 0/1 bytes times ONES has their sum in its top byte


def _fields(lines: DataFrame, zeros: bool) -> DataFrame:
    """``(path, gene, fields, at, x)``: field ``at`` (from 1; the gene is 0) of data lines of so many ``fields``; those that read ``0`` only on demand.

    Nearly all of a wide line is zeros: other fields are found in arrays of bytes, and tabs are counted up to them, before anything becomes a row.
    """
    def cut(path: str, held: list[bytes]) -> pa.RecordBatch:
        text = b"\t".join(held) + b"\t"
        symbols = np.frombuffer(text + bytes(-len(text) % 8), np.uint8)
        tabs, plain = symbols == 9, symbols == 48
        words = tabs.view(np.uint64)
        before = np.cumsum(words * ONES >> TOP, dtype=np.int64)

        def number(at: np.ndarray) -> np.ndarray:
            """Number of tabs before a place: those of earlier words, and those of lower bytes of its own."""
            own, eighth = words[at >> 3], (at & 7).astype(np.uint64)
            lower = (own & ((np.uint64(1) << (eighth * np.uint64(8))) - np.uint64(1))) * ONES >> TOP
            return before[at >> 3] - (own * ONES >> TOP).astype(np.int64) + lower.astype(np.int64)

        sizes = np.array([len(line) + 1 for line in held])
        first = number(np.cumsum(sizes) - sizes)
        if zeros:
            places = np.concatenate([[0], np.flatnonzero(tabs[:len(text)])[:-1] + 1])
        else:  # symbols of other fields than a single 0: no tab and no 0, or next to one of its kind
            other = ~(tabs | plain)
            other[1:] |= (tabs[1:] & tabs[:-1]) | (plain[1:] & plain[:-1])
            places = np.flatnonzero(other[:len(text)])
        field, found = np.unique(number(places), return_index=True)
        line = np.searchsorted(first, field, "right") - 1
        inside = field > first[line]
        field, line, places = field[inside], line[inside], places[found][inside]
        values = [text[text.rfind(b"\t", 0, p) + 1:text.find(b"\t", p)].decode("utf-8", "replace") for p in places.tolist()]
        genes = pa.array([x.partition(b"\t")[0].decode("utf-8", "replace") for x in held], pa.string())
        widths = np.diff(np.append(first, number(np.array([len(text) - 1])) + 1))
        return pa.RecordBatch.from_arrays([
            pa.array([path], pa.string()).take(pa.array(np.zeros(len(line), np.int64))), genes.take(pa.array(line)),
            pa.array(widths[line], pa.int32()), pa.array(field - first[line], pa.int32()), pa.array(values, pa.string())],
            names=["path", "gene", "fields", "at", "x"])

    def melt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = [None]
        for batch in batches:
            held, size, of = [], 0, None
            for path, header, value in _split_header(_rows_of(batch), here):
                if held and (path != of or size + len(value) > CHARACTERS):
                    yield cut(of, held)
                    held, size = [], 0
                if not header:
                    held.append(value)
                    size, of = size + len(value), path
            if held:
                yield cut(of, held)

    return lines.mapInArrow(melt, "path string, gene string, fields int, at int, x string")


def read_dge_files(spark: SparkSession, paths, manifest: DataFrame) -> DataFrame:
    """``counts(gene, cell, count)`` of per-run expression files.

    The cell is ``<ID>_<k>`` with ``k`` the column position from 1.
    """
    fields = _fields(_wide_lines(spark, paths), zeros=False).withColumn("run", run_from_path("path", "dge"))
    values = fields.withColumns({"gene": _unquote(F.col("gene")), "count": F.col("x").cast("bigint")}).filter("count > 0")
    ids = first_per_key(manifest, "run", "id", ["id"])
    return values.join(ids, "run", "left").select(
        "gene", F.concat_ws("_", "id", F.col("at").cast("string")).alias("cell"), "count")


def read_matrix(spark: SparkSession, paths, keep_zeros: bool = False) -> DataFrame:
    """Gene x cell matrix to ``counts(gene, cell, count)``; the header may lack the gene field.

    Files with equal headers share one list of names, so names are a row per cell and not one per file and cell.
    """
    lines = _wide_lines(spark, paths)
    shared = settle(_headers(lines).groupBy("header").agg(F.min("path").alias("_names"), F.collect_list("path").alias("_paths")))
    names = shared.select("_names", F.posexplode(F.split("header", "\t")).alias("_place", "cell"))
    files = shared.select("_names", F.size(F.split("header", "\t")).alias("_width"), F.explode("_paths").alias("path"))
    fields = _fields(lines, keep_zeros).join(F.broadcast(files), "path").withColumn(
        "_place", F.when(F.col("_width") == F.col("fields"), F.col("at")).otherwise(F.col("at") - 1))
    values = fields.join(names, ["_names", "_place"], "left").select(
        _unquote(F.col("gene")).alias("gene"), _unquote(F.col("cell")).alias("cell"), F.col("x").cast("double").cast("bigint").alias("count"))
    return values.filter(F.col("count").isNotNull()) if keep_zeros else values.filter("count > 0")


def read_count_dir(spark: SparkSession, folder: str, suffix: str = "counts.txt*") -> DataFrame:
    """All matrices of a folder, bound by gene and cell, without summary rows."""
    return drop_summary_rows(read_matrix(spark, f"{folder}/*{suffix}"))


def read_gene_lengths(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``gene, len`` with the row's order for first-match lookups."""
    table = spark.read.csv(path, sep="\t", schema="gene string, len int")
    return table.withColumn("position", F.monotonically_increasing_id())


def read_annotation(spark: SparkSession, path: str) -> DataFrame:
    """User-supplied annotation: ``ensembl, symbol, entrez, chrom, start, end``."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.csv(
        path, sep="\t", header=True,
        schema="ensembl string, symbol string, entrez string, chrom string, start int, end int")


def read_gtf(spark: SparkSession, path: str, feature: str | None = "exon") -> DataFrame:
    """``exons(gene, chrom, feature, start, end, strand, attributes)`` from a GTF file."""
    columns = ("chrom string, source string, feature string, start int, end int, score string, "
               "strand string, frame string, attrs string")
    table = spark.read.csv(path, sep="\t", comment="#", quote="", schema=columns)
    pairs = F.regexp_extract_all("attrs", F.lit(r'(\w+) "([^"]*)"'), F.lit(0))
    entries = F.transform(pairs, lambda p: F.struct(
        F.regexp_extract(p, r"^(\w+)", 1).alias("key"), F.regexp_extract(p, r'"([^"]*)"', 1).alias("value")))
    distinct = F.aggregate(
        entries, F.create_map().cast("map<string,string>"),
        lambda m, e: F.when(F.map_contains_key(m, e.key), m).otherwise(F.map_concat(m, F.create_map(e.key, e.value))))
    rows = table if feature is None else table.filter(F.col("feature") == feature)
    return rows.select(
        F.regexp_extract("attrs", r'gene_id "([^"]+)"', 1).alias("gene"),
        "chrom", "feature", "start", "end", "strand", distinct.alias("attributes"))


def read_sam(spark: SparkSession, paths) -> DataFrame:
    """``alignments(run, name, flag, chrom, pos, mapq, cigar, seq, qual, tags)``; header lines dropped."""
    lines = spark.read.text(paths if isinstance(paths, list) else [paths]).select(
        F.regexp_replace("value", "\r$", "").alias("value"), F.col("_metadata.file_path").alias("path"))
    # Header lines are @ and two capitals; a read name may also start with @.
    fields = lines.filter(~F.col("value").rlike(r"^@[A-Z][A-Z](\t|$)") & (F.col("value") != "")).withColumn(
        "_f", F.split("value", "\t"))
    tags = F.map_from_entries(F.transform(
        F.slice("_f", F.lit(12), F.greatest(F.size("_f") - 11, F.lit(0))),
        lambda t: F.struct(F.substring(t, 1, 2).alias("key"), F.regexp_extract(t, r"^[^:]*:[^:]*:(.*)$", 1).alias("value"))))
    at = lambda i: F.get("_f", F.lit(i))
    return fields.select(
        run_from_path("path", "sam").alias("run"), at(0).alias("name"), at(1).cast("int").alias("flag"),
        at(2).alias("chrom"), at(3).cast("int").alias("pos"), at(4).cast("int").alias("mapq"),
        at(5).alias("cigar"), at(9).alias("seq"), at(10).alias("qual"), tags.alias("tags"))


def read_marker_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", header=True, schema="phase string, first string, second string")


def read_sectioned_matrix(spark: SparkSession, path: str, meta_rows: int = 10) -> tuple[DataFrame, DataFrame]:
    """``(metadata, counts)`` of a file with metadata rows first, a filler row, then counts.

    Metadata comes as ``(cell, field, value)`` and cells are named by their column position, as
    the file has no cell header. The blank first column and the filler column are dropped.
    """
    lines = _numbered_lines(spark, path).withColumn("_f", F.split("line", "\t"))
    head = lines.filter(F.col("line_no") < meta_rows)
    metadata = head.select(
        F.get("_f", F.lit(1)).alias("field"),
        F.posexplode(F.slice("_f", F.lit(3), F.greatest(F.size("_f") - 2, F.lit(0)))).alias("_at", "value"),
    ).select((F.col("_at") + 1).cast("bigint").alias("cell"), "field", "value")
    body = lines.filter((F.col("line_no") > meta_rows) & (F.col("line") != ""))
    counts = body.select(
        F.get("_f", F.lit(0)).alias("gene"),
        F.posexplode(F.slice("_f", F.lit(3), F.greatest(F.size("_f") - 2, F.lit(0)))).alias("_at", "_x"),
    ).select("gene", (F.col("_at") + 1).cast("bigint").alias("cell"), F.col("_x").cast("bigint").alias("count"))
    return metadata, counts.filter("count > 0")


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``(name, seq)``; a sequence may span lines."""
    records = spark.read.option("lineSep", ">").text(path).filter(F.trim("value") != "")
    name = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    seq = F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"[\r\n]", "")
    return records.select(F.trim(name).alias("name"), F.upper(seq).alias("seq"))

