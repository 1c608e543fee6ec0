"""Lookups, merges and id mapping. Small tables are left to Spark's size check to broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellweave.operators.ordering import row_numbers

from cellweave.context import split_count


def first_per_key(table: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """One row per key, the one with the smallest ``order``: a map-side combined aggregate."""
    first = F.min(F.struct(F.col(order).alias("_o"), *[F.col(c) for c in columns]))
    picked = table.groupBy(key).agg(first.alias("_first"))
    return picked.select(key, *[F.col(f"_first.{c}").alias(c) for c in columns])


def attach_cell_id(counts_raw: DataFrame, manifest: DataFrame, order: str | None = None) -> DataFrame:
    """``run`` -> cell ``id`` with first match; unknown runs keep a null cell."""
    lookup = first_per_key(manifest, "run", order or "id", ["id"])
    return counts_raw.join(lookup.withColumnRenamed("id", "cell"), "run", "left")


def cell_factors(cells: DataFrame, manifest: DataFrame, factors: list[str], order: str | None = None) -> DataFrame:
    """Cell table: every factor value of the cell's first manifest row."""
    lookup = first_per_key(manifest, "id", order or factors[0], factors)
    return cells.join(lookup.withColumnRenamed("id", "cell"), "cell", "left")


def unpivot_factors(cell_table: DataFrame, factors: list[str]) -> DataFrame:
    """Long form ``(cell, factor, value)``."""
    return cell_table.unpivot("cell", factors, "factor", "value")


def bind_counts(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts, matched by column name; genes keep their own keys, never positions."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def merge_dge(parts: list[DataFrame]) -> DataFrame:
    """N-way outer merge on gene in long form: absent pairs are simply absent (zero)."""
    return bind_counts(parts).groupBy("gene", "cell").agg(F.sum("count").alias("count"))


def merge_wide(parts: list[DataFrame], key: str = "gene") -> DataFrame:
    """The same merge for frames with one column per cell: full outer joins, then zeros."""
    merged = reduce(lambda a, b: a.join(b, key, "full_outer"), parts)
    return merged.na.fill(0)


def attach_length(genes: DataFrame, lengths: DataFrame, position: str | None = None) -> DataFrame:
    """Length of the first matching row of the length table."""
    first = first_per_key(lengths, "gene", position or "len", ["len"])
    return genes.join(first, "gene", "left")


def map_ids(ids: DataFrame, annotation: DataFrame, column: str, key: str = "id", order: str | None = None) -> DataFrame:
    """First non-null annotation value per id; ids without one get null."""
    known = annotation.filter(F.col(column).isNotNull())
    return ids.join(first_per_key(known, key, order or column, [column]), key, "left")


def convert_ids(ids: DataFrame, annotation: DataFrame, column: str, policy: str = "putNA",
                key: str = "id", order: str | None = None) -> DataFrame:
    """``useFirst`` takes the first match, ``putNA`` answers null for ids with several rows."""
    if policy not in ("putNA", "useFirst"):
        raise ValueError(f"policy must be putNA or useFirst, not {policy!r}")
    first = F.min(F.struct(F.col(order or column).alias("_o"), F.col(column))).alias("_first")
    per_key = annotation.groupBy(key).agg(first, F.count("*").alias("_rows"))
    value = F.col("_first")[column]
    if policy == "putNA":
        value = F.when(F.col("_rows") == 1, value)
    return ids.join(per_key.select(key, value.alias(column)), key, "left")


def duplicated_keys(table: DataFrame, key: str) -> DataFrame:
    return table.groupBy(key).agg(F.count("*").alias("rows")).filter("rows > 1")


def without_keys(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return table.join(keys.select(key), key, "left_anti")


def match_ids(ids: DataFrame, annotation: DataFrame, key: str = "id") -> DataFrame:
    """``matched`` repeats the id when the annotation knows it and is null otherwise."""
    known = annotation.select(key).distinct().withColumn("matched", F.col(key))
    return ids.join(known, key, "left")


def annotate_positions(genes: DataFrame, annotation: DataFrame) -> DataFrame:
    """Keep annotated genes only and add their positions."""
    return genes.join(annotation, "gene", "inner")


def semi(results: DataFrame, genes: DataFrame, key: str = "gene") -> DataFrame:
    return results.join(genes.select(key), key, "left_semi")


def overlap_join(blocks: DataFrame, exons: DataFrame, width: int = 1000, salts: int = 4) -> DataFrame:
    """Alignment blocks that share a base with an exon (closed intervals, strand ignored).

    Both sides are cut into bins and joined on ``(chrom, bin)``. A pair meeting in several bins is
    reported only in the bin where the overlap starts, so no duplicate removal is needed. Blocks
    pile up on busy genes: they are spread over ``salts`` copies of the (far smaller) exon side.
    """
    def binned(df: DataFrame) -> DataFrame:
        low, high = F.floor(F.col("start") / width), F.floor(F.col("end") / width)
        return df.withColumn("_bin", F.explode(F.sequence(low, high)))

    left = binned(blocks).withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in blocks.columns]), F.lit(salts)).cast("int")
    )
    right = binned(
        exons.select("gene", "chrom", F.col("start").alias("start"), F.col("end").alias("end"))
    ).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    right = right.withColumnsRenamed({"start": "exon_start", "end": "exon_end"})
    overlap_start = F.greatest("start", "exon_start")
    return (
        left.join(right, ["chrom", "_bin", "_salt"])
        .filter((F.col("start") <= F.col("exon_end")) & (F.col("exon_start") <= F.col("end")))
        .filter(F.floor(overlap_start / width) == F.col("_bin"))
        .drop("_bin", "_salt")
    )


def gene_pairs(genes: DataFrame, block_rows: int = 2048) -> DataFrame:
    """All pairs ``gene1 < gene2`` of a chosen gene set.

    The result is quadratic by definition. Genes are dealt into hash blocks, a block is one row with its genes, and each
    unordered pair of blocks becomes one join key, so the work is spread over half of blocks x blocks keys. The join is
    never a broadcast: Spark's size estimate knows nothing of the copies of a block.
    """
    chosen = genes.select("gene").distinct()
    blocks = F.greatest(F.lit(1), F.ceil(chosen.agg(F.count("*")).scalar() / block_rows)).cast("int")
    placed = chosen.withColumn("_n", blocks).withColumn("_b", F.pmod(F.xxhash64("gene"), F.col("_n")).cast("int"))
    packed = placed.groupBy("_b").agg(F.first("_n").alias("_n"), F.collect_list("gene").alias("_genes"))
    left = packed.select(F.col("_b").alias("_i"), F.explode(F.sequence(F.col("_b"), F.col("_n") - 1)).alias("_j"), F.col("_genes").alias("_x"))
    right = packed.select(F.explode(F.sequence(F.lit(0), F.col("_b"))).alias("_i"), F.col("_b").alias("_j"), F.col("_genes").alias("_y"))
    ones = left.hint("merge").join(right, ["_i", "_j"]).select("_i", "_j", F.explode("_x").alias("_x"), "_y")
    return ones.select("_i", "_j", "_x", F.explode("_y").alias("_y")).filter("_i < _j OR _x < _y").select(
        F.least("_x", "_y").alias("gene1"), F.greatest("_x", "_y").alias("gene2"))


def pair_members(pairs: DataFrame) -> DataFrame:
    """Distinct genes that occur on either side of a pair."""
    ends = pairs.select(F.explode(F.array("gene1", "gene2")).alias("gene"))
    return ends.distinct()


PAIR_PARTS = 4  # parts of pair rows for one of a usual shuffle


def pair_expression(assay: DataFrame, pairs: DataFrame, value: str = "count") -> DataFrame:
    """Both genes' values per cell for every marker pair seen in the cell; an unseen gene is zero.

    Pairs become a row per side, so values meet their genes in one join. A pair has two rows per cell at most, which partial sums before
    the shuffle would only hold in memory: rows are dealt first, into more parts than a shuffle usually has, as they are twice those of the assay.
    """
    side = F.explode(F.array(
        F.struct(F.col("first").alias("gene"), F.lit(True).alias("_one")), F.struct(F.col("second").alias("gene"), F.lit(False).alias("_one"))))
    ends = pairs.select("phase", "first", "second", side.alias("_e")).select("phase", "first", "second", "_e.*")
    met = assay.select("gene", "cell", F.col(value).alias("_x")).join(ends, "gene").select(
        "phase", "first", "second", "cell", F.when(F.col("_one"), F.col("_x")).alias("x1"), F.when(~F.col("_one"), F.col("_x")).alias("x2"))
    keys = ["phase", "first", "second", "cell"]
    dealt = met.repartition(PAIR_PARTS * split_count(assay.sparkSession), *keys)
    none = F.lit(0).cast("double")
    return dealt.groupBy(*keys).agg(F.coalesce(F.sum("x1"), none).alias("x1"), F.coalesce(F.sum("x2"), none).alias("x2"))


def pair_mates(reads: DataFrame) -> DataFrame:
    """One row per pair: mates of the same run and record number."""
    def side(mate: int) -> DataFrame:
        return reads.filter(F.col("mate") == mate).select(
            "run", "read_idx", *[F.col(c).alias(f"{c}{mate}") for c in ("name", "seq", "qual")])

    return side(1).join(side(2), ["run", "read_idx"])


def assign_batches(df: DataFrame, size: int, key: str, name: str) -> DataFrame:
    """Fixed-size batches, numbered from 1, of the names sorted inside each key."""
    numbered = row_numbers(df, name, keys=[key])
    return numbered.withColumn("batch", F.floor((F.col("row_number") - 1) / size) + 1)


def group_key(cells: DataFrame, factors: list[str]) -> DataFrame:
    """Interaction of all factors as one label."""
    return cells.withColumn("group", F.concat_ws(".", *factors))


def levels(cells: DataFrame, factor: str) -> DataFrame:
    return cells.select(factor).distinct()


def factor_codes(cells: DataFrame, factor: str) -> DataFrame:
    """Level -> 1..k in sorted order. Only the level table is ordered, not the cells."""
    by_level = W.partitionBy(F.lit(0)).orderBy(factor)
    coded = levels(cells, factor).withColumn("code", F.row_number().over(by_level).cast("bigint"))
    return cells.join(coded, factor)


def design_columns(cells: DataFrame, factors: list[str]) -> list[tuple[str, str, str]]:
    """``(column name, factor, level)`` of the one-hot design; the first sorted level is dropped.

    Levels become columns, so their number is checked before they reach the driver.
    """
    columns = []
    for factor in factors:
        found = [r[0] for r in levels(cells, factor).limit(1001).collect()]
        if len(found) > 1000:
            raise ValueError(f"{factor} has more than 1000 levels and cannot be a design factor")
        columns += [(f"{factor}_{level}", factor, level) for level in sorted(found)[1:]]
    return columns


def design_matrix(cells: DataFrame, factors: list[str]) -> DataFrame:
    """``cell``, ``intercept`` and 0/1 columns of the formula ``~ f1 + f2 + ...``."""
    ones = [
        F.when(F.col(factor) == level, 1).otherwise(0).cast("bigint").alias(name)
        for name, factor, level in design_columns(cells, factors)
    ]
    return cells.select("cell", F.lit(1).cast("bigint").alias("intercept"), *ones)
