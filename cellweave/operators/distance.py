"""Pairwise products, distances and correlations between cells (or between genes).

All pairs are the wanted result, so the work is laid out as a blocked matrix product: items are
dealt into hash blocks of bounded size, which are written once; every pair of blocks is read by one task,
which gives finished pairs. Nothing is emitted per shared gene, no row of a pair is shuffled and no block is copied.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.context import distinct_total, scalar, written
from cellweave.operators.ranking import rank_average, restrict_genes

WIDEST, ENTRIES, SPREAD = 4096, 1 << 20, 8  # items and stored values of a block, about; blocks of smaller tables
SLICE, ROWS = 1 << 20, 256  # products added at once, in so many rows
DENSE = 40  # so many steps of a dense product take the time of one entry that is added alone


def _block_pairs(assay: DataFrame, value: str, by: str, over: str, block: int, chunk: int) -> DataFrame:
    """Rows ``(_i, _j, _k, ids and values of both blocks)`` for every unordered pair of blocks."""
    items = assay.select(by).distinct()
    n_blocks = F.greatest(F.lit(1), F.ceil(scalar(items.agg(F.count("*"))) / block)).cast("int")
    n_chunks = F.greatest(F.lit(1), F.ceil(distinct_total(assay, over) / chunk)).cast("int")
    stored = assay.select(
        F.col(by).alias("id"), F.xxhash64(over).alias("at"), F.col(value).cast("double").alias("v"))
    # A zero entry per item in chunk 0 keeps items without shared columns in the result.
    present = items.select(F.col(by).alias("id"), F.lit(None).cast("bigint").alias("at"), F.lit(0.0).alias("v"))
    placed = stored.unionByName(present).withColumns({
        "_n": n_blocks,
        "_b": F.pmod(F.xxhash64("id"), n_blocks).cast("int"),
        "_k": F.coalesce(F.pmod(F.col("at"), n_chunks), F.lit(0)).cast("int"),
    })
    packed = placed.groupBy("_b", "_k").agg(
        F.first("_n").alias("_n"),
        F.collect_list("id").alias("ids"),
        F.collect_list(F.coalesce("at", F.lit(0))).alias("ats"),
        F.collect_list("v").alias("vs"),
    )
    left = packed.withColumn("_j", F.explode(F.sequence(F.col("_b"), F.col("_n") - 1))).select(
        F.col("_b").alias("_i"), "_j", "_k", F.col("ids").alias("ids1"), F.col("ats").alias("ats1"), F.col("vs").alias("vs1"))
    right = packed.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_b")))).select(
        "_i", F.col("_b").alias("_j"), "_k", F.col("ids").alias("ids2"), F.col("ats").alias("ats2"), F.col("vs").alias("vs2"))
    return left.join(right, ["_i", "_j", "_k"])


def _dense(ids, ats, vs, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names, row = np.unique(np.asarray(ids), return_inverse=True)
    matrix = np.zeros((len(names), len(columns)))
    np.add.at(matrix, (row, np.searchsorted(columns, np.asarray(ats))), np.asarray(vs))
    return names, matrix


def _each_block(batches: Iterator[pd.DataFrame]):
    """Dense matrices of both blocks and the index arrays of the pairs to report."""
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            columns = np.unique(np.concatenate([row.ats1, row.ats2]))
            names1, x1 = _dense(row.ids1, row.ats1, row.vs1, columns)
            names2, x2 = _dense(row.ids2, row.ats2, row.vs2, columns)
            if row[0] == row[1]:
                a, b = np.triu_indices(len(names1), 1)
            else:
                a, b = (m.ravel() for m in np.indices((len(names1), len(names2))))
            yield row[2], names1, x1, names2, x2, a, b


def _oriented(names1, names2, a, b) -> dict[str, np.ndarray]:
    first, second = names1[a], names2[b]
    swap = first > second
    return {"i": np.where(swap, second, first), "j": np.where(swap, first, second)}


def _written_blocks(assay: DataFrame, value: str, by: str, over: str, block: int) -> DataFrame:
    """``(b, names, s, ss, row, at, v)``: items of a block with the sums of their values and squares, and their stored values by column.

    There are as few blocks as keep all tasks busy, as every block is read once a block: ``block`` items at least and ``WIDEST`` at most,
    ``ENTRIES`` values at most, but for ``SPREAD`` blocks.
    """
    kind = assay.schema[by].dataType.simpleString()
    items = assay.select(F.col(by).alias("id")).distinct()
    counted = assay.sparkSession.range(1).select(scalar(items.agg(F.count("*"))).alias("items"), scalar(assay.agg(F.count("*"))).alias("values"))
    size = counted.first()
    n = max(1, min(-(-size["items"] // block), SPREAD), -(-size["items"] // max(block, WIDEST)), -(-size["values"] // ENTRIES))
    stored = assay.filter(F.col(value).isNotNull()).select(
        F.col(by).alias("id"), F.xxhash64(over).alias("at"), F.col(value).cast("double").alias("v"))
    # A zero per item keeps items without stored values in the result.
    placed = stored.unionByName(items.select("id", F.lit(0).cast("bigint").alias("at"), F.lit(0.0).alias("v")))
    blocks = placed.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).groupBy("b").applyInPandas(
        _packed, f"b int, names array<{kind}>, s binary, ss binary, row binary, at binary, v binary")
    return written(blocks.repartitionByRange(n, "b"), "blocks")


def _packed(entries: pd.DataFrame) -> pd.DataFrame:
    entries = entries[entries["id"].notna()]
    names, row = np.unique(entries["id"].to_numpy(), return_inverse=True)
    at, v = entries["at"].to_numpy(), entries["v"].to_numpy()
    sums = [np.bincount(row, x, len(names)) for x in (v, v * v)]
    order = np.argsort(at, kind="stable")
    order = order[v[order] != 0]
    parts = [row[order].astype(np.int32), at[order], v[order]]
    return pd.DataFrame({"b": entries["b"].iloc[:1], "names": [names.tolist()]} | {
        name: [x.tobytes()] for name, x in zip(("s", "ss", "row", "at", "v"), sums + parts)}) if len(names) else pd.DataFrame(
        columns=["b", "names", "s", "ss", "row", "at", "v"])


class _Side:
    """Items of one block with the sums of their values and squares, and its stored values as (row, column, value)."""

    def __init__(self, names, s, ss, row, at, v) -> None:
        self.names, self.s, self.ss = np.asarray(names), np.frombuffer(s), np.frombuffer(ss)
        self.entries = (np.frombuffer(row, np.int32).astype(np.int64), np.frombuffer(at, np.int64), np.frombuffer(v))


def _add_products(xy: np.ndarray, one: tuple, two: tuple) -> None:
    """Add the products of entries ``(row, column, value)`` of both sides in equal columns to ``xy``.

    Entries that meet are few in sparse tables and are added one by one; where that takes longer, columns are multiplied as dense blocks.
    """
    row2, at2, v2 = (x[np.argsort(two[1], kind="stable")] for x in two)
    by_row = np.argsort(one[0], kind="stable")
    row1, at1, v1 = (x[by_row] for x in one)
    low = np.searchsorted(at2, at1, "left")
    meet = np.searchsorted(at2, at1, "right") - low
    columns = np.unique(at1[meet > 0])
    if DENSE * int(meet.sum()) > xy.size * len(columns):
        step = max(1, SLICE // (xy.shape[0] + xy.shape[1]))
        for begin in range(0, len(columns), step):
            own = columns[begin:begin + step]
            sides = []
            for rows, at, v, size in ((row1, at1, v1, xy.shape[0]), (row2, at2, v2, xy.shape[1])):
                inside = np.isin(at, own)
                dense = np.zeros((size, len(own)))
                np.add.at(dense, (rows[inside], np.searchsorted(own, at[inside])), v[inside])
                sides.append(dense)
            xy += sides[0] @ sides[1].T
        return
    done = np.concatenate([[0], np.cumsum(meet)])
    first = 0
    while first < len(meet):  # a slice of rows and of a bounded number of products
        last = max(first + 1, int(np.searchsorted(done, done[first] + SLICE, "right")) - 1)
        last = max(first + 1, min(last, int(np.searchsorted(row1, row1[first] + ROWS))))
        times = meet[first:last]
        if total := int(times.sum()):
            other = np.arange(total) - np.repeat(done[first:last] - done[first], times) + np.repeat(low[first:last], times)
            begin, end = row1[first], row1[last - 1] + 1
            place = np.repeat(row1[first:last] - begin, times) * xy.shape[1] + row2[other]
            xy[begin:end] += np.bincount(place, np.repeat(v1[first:last], times) * v2[other], (end - begin) * xy.shape[1]).reshape(end - begin, -1)
        first = last


def _products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of blocks -> products and sums of all pairs of items."""
    for pdf in batches:
        for row in pdf.itertuples(index=False):
            one = _Side(*row[1:7])
            two = one if row[0] == row[7] else _Side(*row[8:14])
            xy = np.zeros((len(one.names), len(two.names)))
            _add_products(xy, one.entries, two.entries)
            for begin in range(0, len(one.names), step := max(1, (1 << 17) // len(two.names))):
                a, b = (m.ravel() for m in np.indices((min(step, len(one.names) - begin), len(two.names))))
                a = a + begin
                if one is two:
                    a, b = a[a < b], b[a < b]
                swap = one.names[a] > two.names[b]
                out = {"i": np.where(swap, two.names[b], one.names[a]), "j": np.where(swap, one.names[a], two.names[b]), "xy": xy[a, b]}
                for name in ("s", "ss"):
                    left, right = getattr(one, name)[a], getattr(two, name)[b]
                    out |= {f"{name}_i": np.where(swap, right, left), f"{name}_j": np.where(swap, left, right)}
                yield pd.DataFrame(out)


def _pairs_with_sums(assay: DataFrame, value: str, by: str, over: str, block: int) -> DataFrame:
    """``(i, j, xy, s_i, ss_i, s_j, ss_j)`` of every unordered pair: a task makes whole pairs, so no row of a pair is shuffled.

    Blocks meet in a Cartesian product of the written blocks: a task reads them from the shared folder, so they take disk once.
    """
    kind = assay.schema[by].dataType.simpleString()
    sums = ", ".join(f"{n} double" for n in ("xy", "s_i", "s_j", "ss_i", "ss_j"))
    blocks = _written_blocks(assay, value, by, over, block)
    left, right = (blocks.toDF(*[f"{c}{k}" for c in blocks.columns]) for k in (1, 2))
    # Of both orders of two blocks one is taken, now this and now that, so that all tasks have about the same to do.
    meet = (F.col("b1") == F.col("b2")) | ((F.col("b1") < F.col("b2")) == ((F.col("b1") + F.col("b2")) % 2 == 0)) & (F.col("b1") != F.col("b2"))
    return left.join(right.hint("shuffle_replicate_nl"), meet).mapInPandas(_products, f"i {kind}, j {kind}, {sums}")


def pair_products(assay: DataFrame, value: str = "value", by: str = "cell", over: str = "gene",
                  block: int = 256, chunk: int = 4096) -> DataFrame:
    """Inner product of every unordered pair: ``(i, j, xy)`` with ``i < j``; ``chunk`` is not needed any more."""
    return _pairs_with_sums(assay, value, by, over, block).select("i", "j", "xy")


def euclidean(assay: DataFrame, genes: DataFrame | None = None, value: str = "value", block: int = 256) -> DataFrame:
    """Euclidean distances between cells, over all genes or a gene subset: ``(i, j, d)``."""
    used = assay if genes is None else restrict_genes(assay, genes)
    squared = F.col("ss_i") + F.col("ss_j") - 2.0 * F.col("xy")
    return _pairs_with_sums(used, value, "cell", "gene", block).select(
        "i", "j", F.sqrt(F.greatest(squared, F.lit(0.0))).alias("d"))


def _correlation(n: Column) -> Column:
    covariance = F.col("xy") - F.col("s_i") * F.col("s_j") / n
    spread_i = F.col("ss_i") - F.col("s_i") * F.col("s_i") / n
    spread_j = F.col("ss_j") - F.col("s_j") * F.col("s_j") / n
    r = covariance / F.sqrt(spread_i * spread_j)
    return F.when(spread_i * spread_j > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def pearson(assay: DataFrame, value: str = "value", by: str = "cell", over: str = "gene", n=None, block: int = 256) -> DataFrame:
    """Correlation of every pair: ``(i, j, r)``; ``n`` counts the columns, zeros included."""
    size = distinct_total(assay, over, n).cast("double")
    pairs = _pairs_with_sums(assay, value, by, over, block).withColumn("_n", size)
    return pairs.select("i", "j", _correlation(F.col("_n")).alias("r"))


def distance_from_r(pairs: DataFrame) -> DataFrame:
    """Correlation distance sqrt(2 (1 - r)); null where the correlation is undefined."""
    distance = F.sqrt(F.greatest(2.0 * (1.0 - F.col("r")), F.lit(0.0)))
    return pairs.select("i", "j", "r", F.when(F.col("r").isNotNull(), distance).alias("d"))


def pearson_distance(assay: DataFrame, genes: DataFrame | None = None, value: str = "value", n=None) -> DataFrame:
    used = assay if genes is None else restrict_genes(assay, genes)
    return distance_from_r(pearson(used, value, n=n))


def spearman(assay: DataFrame, value: str = "value", by: str = "cell", over: str = "gene", n=None) -> DataFrame:
    """Rank correlation. Ranks are shifted so that an unstored zero stays zero; a shift does not
    change a correlation."""
    size = distinct_total(assay, over, n)
    ranked = rank_average(assay, value, by, size)
    shifted = ranked.select(by, over, (F.col("rank") - F.col("zero_rank")).alias("value"))
    return pearson(shifted, "value", by, over, size)


def spearman_distance(assay: DataFrame, genes: DataFrame | None = None, value: str = "value", n=None) -> DataFrame:
    used = assay if genes is None else restrict_genes(assay, genes)
    return distance_from_r(spearman(used, value, n=n))


def leading_lfc(assay: DataFrame, top: int = 500, value: str = "value", block: int = 64, chunk: int = 4096) -> DataFrame:
    """Root mean square of the ``top`` largest gene differences of each pair of cells.

    Each block task keeps the ``top`` squared differences of its gene chunk; chunks are merged
    and cut again, which is exact. A pair with fewer genes than ``top`` has zeros for the rest.
    """

    def differences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, names1, x1, names2, x2, a, b in _each_block(batches):
            squared = (x1[a] - x2[b]) ** 2
            keep = min(top, squared.shape[1])
            largest = np.partition(squared, squared.shape[1] - keep, axis=1)[:, -keep:]
            yield pd.DataFrame({**_oriented(names1, names2, a, b), "largest": list(largest)})

    kind = assay.schema["cell"].dataType.simpleString()
    genes = distinct_total(assay, "gene")
    parts = _block_pairs(assay, value, "cell", "gene", block, chunk).mapInPandas(
        differences, f"i {kind}, j {kind}, largest array<double>")
    merged = parts.groupBy("i", "j").agg(F.flatten(F.collect_list("largest")).alias("all"))
    chosen = F.slice(F.sort_array("all", asc=False), 1, top)
    total = F.aggregate(chosen, F.lit(0.0), lambda acc, v: acc + v)
    return merged.select("i", "j", F.sqrt(total / F.least(F.lit(top), genes)).alias("d"))


def heatmap_distances(distances: DataFrame, cells: DataFrame, factor: str) -> DataFrame:
    """Distance rows with the factor labels of both cells.

    The labels have a row a cell, the distances a row a pair: their size is the root of it, so they are broadcast and no pair is shuffled.
    """
    labels = cells.select("cell", factor)
    left = labels.withColumnsRenamed({"cell": "i", factor: "label_i"})
    right = labels.withColumnsRenamed({"cell": "j", factor: "label_j"})
    return distances.join(F.broadcast(left), "i").join(F.broadcast(right), "j")
