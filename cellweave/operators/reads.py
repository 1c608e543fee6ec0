"""Read-level operators on ``reads(run, mate, read_idx, name, seq, qual)``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellweave.functions.columns import phred

MAX_ADAPTERS = 10_000


def deinterleave(reads: DataFrame) -> DataFrame:
    """Interleaved records to mates: even record numbers are mate 1, odd ones mate 2."""
    return reads.withColumns({
        "mate": (F.col("read_idx") % 2 + 1).cast("int"),
        "read_idx": F.floor(F.col("read_idx") / 2),
    })


def _cut(reads: DataFrame, start: Column, length: Column) -> DataFrame:
    """Keep ``length`` bases from 1-based ``start`` in sequence and quality alike."""
    return reads.withColumns({
        "seq": F.substring(F.col("seq"), start, length), "qual": F.substring(F.col("qual"), start, length)})


def _below(bound: int) -> Column:
    """Quality symbols under a bound, as a trim set."""
    return F.lit("".join(chr(33 + q) for q in range(max(bound, 0))))


def trim_ends(reads: DataFrame, leading: int = 3, trailing: int = 3) -> DataFrame:
    """Drop bases below the quality bound from both ends; a read without a good base becomes empty.

    Low qualities are a set of symbols, so this is a plain trim of the quality text.
    """
    left = F.ltrim(F.col("qual"), _below(leading))
    start = F.length("qual") - F.length(left) + 1
    return _cut(reads, start, F.length(F.rtrim(left, _below(trailing))))


def trim_sliding(reads: DataFrame, window: int = 4, minimum: int = 15) -> DataFrame:
    """Cut before the first window whose mean quality is below the bound (whole read if none).

    The window sums come from the quality array zipped with its own shifts, in one pass.
    """
    placed = reads.withColumn("_q", phred("qual")).withColumn("_n", F.size("_q") - (window - 1))
    shifts = [F.slice("_q", F.lit(k + 1), F.greatest(F.col("_n"), F.lit(0))).alias(f"s{k}") for k in range(window)]

    def is_bad(w: Column) -> Column:
        values = [w[f"s{k}"] for k in range(window)]
        return sum(values[1:], values[0]) < window * minimum

    first_bad = F.array_position(F.transform(F.arrays_zip(*shifts), is_bad), True)
    keep = F.when(first_bad > 0, first_bad - 1).otherwise(F.length("qual")).cast("int")
    return _cut(placed.withColumn("_keep", keep), F.lit(1), F.col("_keep")).drop("_q", "_n", "_keep")


def filter_min_len(reads: DataFrame, minimum: int = 36) -> DataFrame:
    return reads.filter(F.length("seq") >= minimum)


# Score of one matching base, log10(4); a mismatch costs a tenth of its quality.
# The seed is the first 16 bases.
MATCH_SCORE = 0.602
SEED_BASES = 16


def _seed_places(text: str, pattern: str, seed_mismatches: int) -> list[int]:
    """Places where the pattern's seed fits the text with few enough mismatches.

    With m mismatches allowed, one of m + 1 pieces of the seed must occur unchanged, so only the
    places of these pieces are looked at.
    """
    seed = pattern[:SEED_BASES]
    parts = seed_mismatches + 1
    bounds = [len(seed) * k // parts for k in range(parts + 1)]
    places = set()
    for low, high in zip(bounds, bounds[1:]):
        found = text.find(seed[low:high])
        while found >= 0 and high > low:
            places.add(found - low)
            found = text.find(seed[low:high], found + 1)
    return [at for at in sorted(places) if at >= 0
            and sum(x != y for x, y in zip(text[at:at + len(seed)], seed)) <= seed_mismatches]


def _adapter_start(seq: str, qual: str, adapter: str, seed_mismatches: int, min_score: float) -> int:
    """First place where the adapter lies in the read (the read's length if nowhere)."""
    for at in _seed_places(seq, adapter, seed_mismatches):
        score = 0.0
        for base, wanted, q in zip(seq[at:], adapter, qual[at:]):
            score += MATCH_SCORE if base == wanted else -(ord(q) - 33) / 10
        if score >= min_score:
            return at
    return len(seq)


def _adapter_list(adapters: DataFrame) -> list[str]:
    rows = adapters.select("seq").limit(MAX_ADAPTERS + 1).collect()
    if len(rows) > MAX_ADAPTERS:
        raise ValueError(f"more than {MAX_ADAPTERS} adapters")
    return [r[0] for r in rows]


def clip_adapters(reads: DataFrame, adapters: DataFrame, seed_mismatches: int = 2, min_score: float = 10.0) -> DataFrame:
    """Cut each read where an adapter begins: at most ``seed_mismatches`` in the first 16 bases
    and an alignment score of at least ``min_score``. Reads stay in place (no shuffle)."""
    known = _adapter_list(adapters)

    def clip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cut = [min([_adapter_start(s, q, a, seed_mismatches, min_score) for a in known], default=len(s))
                   for s, q in zip(pdf["seq"], pdf["qual"])]
            yield pdf.assign(
                seq=[s[:c] for s, c in zip(pdf["seq"], cut)], qual=[q[:c] for q, c in zip(pdf["qual"], cut)])

    return reads.mapInPandas(clip, reads.schema)


# Complementary bases.
COMPLEMENT = str.maketrans("ACGTN", "TGCAN")


def _insert_size(seq1: str, seq2: str, seed_mismatches: int, min_score: float) -> int | None:
    """Length of the stretch both mates read through, if they do."""
    other = seq2.translate(COMPLEMENT)[::-1]
    for at in _seed_places(other, seq1, seed_mismatches):
        size = len(other) - at
        if size <= len(seq1):
            same = sum(x == y for x, y in zip(seq1, other[at:]))
            if MATCH_SCORE * same - 3.0 * (size - same) >= min_score:
                return size
    return None


def clip_palindromes(pairs: DataFrame, seed_mismatches: int = 2, min_score: float = 30.0) -> DataFrame:
    """Read-through pairs: when the first L bases of one mate are the reverse complement of the
    first L bases of the other with a high enough score, both mates are cut to L."""

    def clip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            size = [_insert_size(x, y, seed_mismatches, min_score) for x, y in zip(pdf["seq1"], pdf["seq2"])]
            yield pdf.assign(**{c: [t[:n] for t, n in zip(pdf[c], size)] for c in ("seq1", "qual1", "seq2", "qual2")})

    return pairs.mapInPandas(clip, pairs.schema)


def trim_reads(reads: DataFrame, adapters: DataFrame | None = None, paired: bool = False) -> DataFrame:
    """Adapter clip, end trim, sliding window and length filter in this order.

    ``pairing`` is ``p`` when both mates survive, ``u`` when one does, ``s`` for single reads.
    """
    trimmed = reads if adapters is None else clip_adapters(reads, adapters)
    kept = filter_min_len(trim_sliding(trim_ends(trimmed)))
    if not paired:
        return kept.withColumn("pairing", F.lit("s"))
    # A window and not a join with the numbers of mates: reads are trimmed once.
    mates = F.count("*").over(W.partitionBy("run", "read_idx"))
    return kept.filter(F.col("run").isNotNull() & F.col("read_idx").isNotNull()).withColumn("pairing", F.when(mates == 2, "p").otherwise("u"))


def extract_barcodes(pairs: DataFrame, cell_bases: tuple[int, int] = (1, 12), umi_bases: tuple[int, int] = (13, 20)) -> DataFrame:
    """Cell barcode and UMI from positions (1-based, inclusive) of the first mate."""
    def piece(span: tuple[int, int]) -> Column:
        return F.substring("seq1", span[0], span[1] - span[0] + 1)

    return pairs.withColumns({"xc": piece(cell_bases), "umi": piece(umi_bases)})


CHARACTERS = 1 << 21  # of quality text counted at once


def _quality_counts(reads: DataFrame) -> DataFrame:
    """``(run, pos, q, n)`` of parts of the reads: qualities are counted in arrays before they become rows, as there is one per base.

    As in ``phred``, a null text has no quality, and an empty one that of an empty symbol at position 0.
    """

    def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(t) or 1 for t in texts])
        codes = np.frombuffer("".join(t or "\0" for t in texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        pos = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        low = codes.min()
        span = codes.max() - low + 1
        keys = pos * span + codes - low
        if sizes.max() * span <= 4 * len(keys):
            n = np.bincount(keys)
            keys = np.flatnonzero(n)
            n = n[keys]
        else:
            keys, n = np.unique(keys, return_counts=True)
        return keys // span, keys % span + low - 33, n

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, texts = batch.column("run"), batch.column("qual").to_pylist()
            codes = runs.dictionary_encode("encode").indices.to_numpy()
            order = [i for i in np.argsort(codes, kind="stable").tolist() if texts[i] is not None]
            at = 0
            while at < len(order):
                end, held = at, 0
                while end < len(order) and codes[order[end]] == codes[order[at]] and held < CHARACTERS:
                    held += len(texts[order[end]])
                    end += 1
                pos, q, n = counted([texts[i] for i in order[at:end]])
                yield pa.RecordBatch.from_arrays([
                    runs.take(pa.array(np.full(len(pos), order[at]))), pa.array(pos, pa.int32()), pa.array(q, pa.int32()), pa.array(n, pa.int64())],
                    names=["run", "pos", "q", "n"])
                at = end

    kind = reads.schema["run"].dataType.simpleString()
    return reads.select("run", "qual").mapInArrow(make, f"run {kind}, pos int, q int, n long")


def quality_by_position(reads: DataFrame) -> DataFrame:
    """Quartiles and mean quality per run and position.

    Qualities are merged to ``(run, position, quality, n)`` first: at most 94 rows per position.
    """
    merged = _quality_counts(reads).groupBy("run", "pos", "q").agg(F.sum("n").alias("n"))
    return merged.groupBy("run", "pos").agg(
        F.expr("percentile(q, 0.25D, n)").alias("q1"),
        F.expr("percentile(q, 0.5D, n)").alias("median"),
        F.expr("percentile(q, 0.75D, n)").alias("q3"),
        (F.sum(F.col("q") * F.col("n")) / F.sum("n")).alias("mean"),
    )


def base_content(reads: DataFrame) -> DataFrame:
    """Per run: reads, bases, GC and N percent."""
    gc = F.length("seq") - F.length(F.translate("seq", "GCgc", ""))
    n = F.length("seq") - F.length(F.translate("seq", "Nn", ""))
    return reads.groupBy("run").agg(
        F.count("*").alias("reads"),
        F.sum(F.length("seq")).alias("bases"),
        (100.0 * F.sum(gc) / F.sum(F.length("seq"))).alias("gc_pct"),
        (100.0 * F.sum(n) / F.sum(F.length("seq"))).alias("n_pct"),
    )


def length_distribution(reads: DataFrame) -> DataFrame:
    return reads.groupBy("run", F.length("seq").cast("bigint").alias("length")).agg(F.count("*").alias("n"))


def sequence_counts(reads: DataFrame) -> DataFrame:
    """Copies of each distinct sequence in its run; whole sequences are compared."""
    return reads.groupBy("run", "seq").agg(F.count("*").alias("copies"))


def duplicate_levels(reads: DataFrame) -> DataFrame:
    """How many distinct sequences occur how often."""
    return sequence_counts(reads).groupBy("run", "copies").agg(F.count("*").alias("sequences"))


def over_represented(reads: DataFrame, min_pct: float = 0.1) -> DataFrame:
    """Sequences that make up at least ``min_pct`` percent of their run."""
    counted = sequence_counts(reads)
    totals = reads.groupBy("run").agg(F.count("*").alias("_all"))
    share = 100.0 * F.col("copies") / F.col("_all")
    return counted.join(totals, "run").withColumn("pct", share).filter(F.col("pct") >= min_pct).drop("_all")


# Limits between pass, warn and fail per module.
QC_LIMITS = {"median_quality": (25.0, 20.0), "gc_pct": (15.0, 30.0), "n_pct": (5.0, 20.0), "duplicate_pct": (20.0, 50.0)}


def read_qc(reads: DataFrame) -> DataFrame:
    """Long table ``(run, module, value)`` of the per-run quality numbers.

    ``median_quality`` is the lowest per-position median, ``gc_pct`` the distance from 50 percent.
    """
    lowest = quality_by_position(reads).groupBy("run").agg(F.min("median").alias("median_quality"))
    content = base_content(reads)
    copies = sequence_counts(reads).groupBy("run").agg(
        (100.0 * (F.sum("copies") - F.count("*")) / F.sum("copies")).alias("duplicate_pct"))
    wide = content.join(lowest, "run").join(copies, "run").select(
        "run", F.col("median_quality").cast("double").alias("median_quality"),
        F.abs(F.col("gc_pct") - 50.0).alias("gc_pct"), "n_pct", "duplicate_pct")
    return wide.unpivot("run", list(QC_LIMITS), "module", "value")


def qc_status(table: DataFrame) -> DataFrame:
    """Add ``status``: pass, warn or fail by the module's limits."""
    status = F.lit(None).cast("string")
    for module, (warn, fail) in QC_LIMITS.items():
        value = F.col("value") if module != "median_quality" else -F.col("value")
        warn, fail = (warn, fail) if module != "median_quality" else (-warn, -fail)
        level = F.when(value > fail, "fail").when(value > warn, "warn").otherwise("pass")
        status = F.when(F.col("module") == module, level).otherwise(status)
    return table.withColumn("status", status)


def qc_aggregate(table: DataFrame) -> DataFrame:
    """Number of runs per module and status."""
    return qc_status(table).groupBy("module", "status").agg(F.count("*").alias("runs"))


def qc_rollup(manifest: DataFrame, raw: DataFrame, trimmed: DataFrame, aligned: DataFrame, assigned: DataFrame) -> DataFrame:
    """Reads, trimmed, aligned and assigned reads per individual; each table is ``(run, reads)``."""
    joined = manifest.select("individual", "run").distinct()
    for name, table in (("reads", raw), ("trimmed", trimmed), ("aligned", aligned), ("assigned", assigned)):
        joined = joined.join(table.select("run", F.col("reads").alias(f"n_{name}")), "run", "left")
    return joined.groupBy("individual").agg(*[
        F.coalesce(F.sum(f"n_{n}"), F.lit(0)).alias(n) for n in ("reads", "trimmed", "aligned", "assigned")])
