"""Ordered computations that never put one group into one task.

Ranks, medians, quantiles, row numbers and running minima all need rows in order inside a group.
A plain window sends a whole group to one task, which fails when one cell or gene holds a large
share of the rows. Here the value axis is cut into ranges at split points taken from a bounded
hash sample; windows then run inside ``(group, range)`` and small per-range totals link the
ranges. The sample only decides where the cuts are: results are exact for any cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from cellweave.context import scalar, settle_if_floating, split_count

RANGE = "_range"


def _with_range(df: DataFrame, value: Column, tie: Column | None = None) -> DataFrame:
    """Add the index of the value range a row falls into.

    One row is sampled per hash slot with ``min_by`` over fixed-width values, so the sample is a
    plain hash aggregate, has at most ``4 * splits`` rows, and comes out the same on every run.
    """
    splits = split_count(df.sparkSession)
    tie = F.lit(0) if tie is None else tie
    keyed = df.select(value.alias("v"), tie.alias("t"), F.xxhash64(value, tie).alias("h"))
    sample = keyed.groupBy(F.pmod("h", F.lit(4 * splits)).alias("slot")).agg(
        F.min_by("v", "h").alias("v"), F.min_by("t", "h").alias("t")
    )
    ordered = sample.agg(F.sort_array(F.collect_list(F.struct("v", "t"))).alias("all"))
    cuts = ordered.select(
        F.transform(
            F.sequence(F.lit(1), F.lit(splits - 1)),
            lambda i: F.get("all", F.floor(i * F.size("all") / splits).cast("int")),
        ).alias("cuts")
    )
    key = F.struct(value.alias("v"), tie.alias("t"))
    steps = [1]
    while steps[0] * 2 < splits:
        steps.insert(0, steps[0] * 2)
    # Binary search over the cut array: number of cuts that are <= the row's key.
    position = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(F.get("_cuts", at + s - 1) <= key, at + s).otherwise(at),
    )
    return df.withColumn("_cuts", scalar(cuts)).withColumn(RANGE, position).drop("_cuts")


def _link_ranges(ranged: DataFrame, keys: Sequence[str], measure: Column) -> DataFrame:
    """Per (group, range): sum of the measure in earlier ranges and in the whole group."""
    sums = ranged.groupBy(*keys, RANGE).agg(F.sum(measure).alias("_sum"))
    group = list(keys) or [F.lit(0)]
    earlier = W.partitionBy(*group).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    return sums.select(
        *keys,
        RANGE,
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(W.partitionBy(*group)).alias("total"),
    )


def _running(ranged: DataFrame, keys: Sequence[str], order: list[Column], measure: Column, out: str) -> DataFrame:
    linked = ranged.join(_link_ranges(ranged, keys, measure), [*keys, RANGE])
    inside = W.partitionBy(*keys, RANGE).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return linked.withColumn(
        out, F.col("_offset") + F.coalesce(F.sum(measure).over(inside), F.lit(0))
    ).drop("_offset")


def row_numbers(
    df: DataFrame,
    value: str,
    tie: str | None = None,
    keys: Sequence[str] = (),
    out: str = "row_number",
    descending: bool = False,
    total: str | None = None,
) -> DataFrame:
    """1-based position by ``value`` inside ``keys``; equal values follow ``tie`` ascending.

    ``value`` and ``tie`` together must make rows unique inside a group.
    """
    stable = settle_if_floating(df, value)
    main = -F.col(value) if descending else F.col(value)
    second = None if tie is None else F.col(tie)
    order = [main.asc()] + ([] if tie is None else [second.asc()])
    ranged = _with_range(stable, main, second)
    numbered = _running(ranged, keys, order, F.lit(1), out).withColumn(out, F.col(out) + 1).drop(RANGE)
    return numbered.withColumnRenamed("total", total) if total else numbered.drop("total")


def value_ranks(
    df: DataFrame,
    value: str,
    keys: Sequence[str] = (),
    weight: Column | None = None,
    few_values: bool | None = None,
) -> DataFrame:
    """Distinct values per group with multiplicity ``n``, number of smaller rows ``before`` and ``total``.

    Repeated values are merged before the first shuffle, so a value held by most rows costs nothing.
    Integer counts have few distinct values per group (at most the largest count), so they need no
    ranges; pass ``few_values=False`` for integers that are spread out. The caller passes a frame
    whose values are stable (see ``settle``).
    """
    measure = F.count("*") if weight is None else F.sum(weight)
    distinct = df.groupBy(*keys, value).agg(measure.alias("n"))
    if few_values is None:
        few_values = isinstance(df.schema[value].dataType, T.IntegralType)
    if few_values:
        ranged = distinct.withColumn(RANGE, F.lit(0))
        group = W.partitionBy(*(list(keys) or [F.lit(0)]))
        before = F.sum("n").over(group.orderBy(value).rowsBetween(W.unboundedPreceding, -1))
        return ranged.withColumn("before", F.coalesce(before, F.lit(0))).withColumn(
            "total", F.sum("n").over(group)
        )
    ranged = _with_range(distinct, F.col(value))
    return _running(ranged, keys, [F.asc(value)], F.col("n"), "before")


def quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    keys: Sequence[str] = (),
    size: Column | None = None,
    settled: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Exact linear-interpolation quantiles per group; ``weight`` names the column that says how often a row counts.

    ``size`` is the number of values in the group including zeros that the sparse frame leaves
    out; the missing ones are placed at 0 between the negative and the positive values.
    """
    narrow = df.select(*keys, value, *([] if weight is None else [weight]))
    stable = narrow if settled else settle_if_floating(narrow, value)
    ranks = value_ranks(stable, value, keys, None if weight is None else F.col(weight))
    count = F.col("total") if size is None else size.cast("long")
    ranks = ranks.withColumn("_size", count).withColumn("_zeros", F.col("_size") - F.col("total"))
    first = F.col("before") + F.when(F.col(value) > 0, F.col("_zeros")).otherwise(0)
    ranks = ranks.withColumn("_first", first)
    picks = []
    for i, p in enumerate(probs):
        where = (F.col("_size") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(where)), ("hi", F.ceil(where))):
            hit = (F.col("_first") <= at) & (at < F.col("_first") + F.col("n"))
            picks.append(F.max(F.when(hit, F.col(value))).alias(f"_{side}{i}"))
    picked = ranks.groupBy(*keys).agg(F.max("_size").alias("_size"), *picks)
    columns = []
    for i, (p, name) in enumerate(zip(probs, names)):
        where = (F.col("_size") - 1) * F.lit(float(p))
        low = F.coalesce(F.col(f"_lo{i}"), F.lit(0)).cast("double")
        high = F.coalesce(F.col(f"_hi{i}"), F.lit(0)).cast("double")
        columns.append((low + (where - F.floor(where)) * (high - low)).alias(name))
    return picked.select(*keys, *columns)


def median_of(df: DataFrame, value: str) -> Column:
    """Exact median of one column as a scalar."""
    return scalar(quantiles(df, value, [0.5], ["median"]))


def minimum_from_right(ranked: DataFrame, value: str, measure: str, out: str, keys: Sequence[str] = ()) -> DataFrame:
    """Smallest ``measure`` among rows of the group whose ``value`` is not smaller.

    Takes the output of ``value_ranks`` (distinct values with their range).
    """
    group = list(keys) or [F.lit(0)]
    per_range = ranked.groupBy(*keys, RANGE).agg(F.min(measure).alias("_least"))
    later = W.partitionBy(*group).orderBy(F.desc(RANGE)).rowsBetween(W.unboundedPreceding, -1)
    tails = per_range.select(*keys, RANGE, F.min("_least").over(later).alias("_tail"))
    inside = W.partitionBy(*keys, RANGE).orderBy(F.desc(value)).rowsBetween(W.unboundedPreceding, 0)
    return (
        ranked.join(tails, [*keys, RANGE])
        .withColumn(out, F.least(F.min(measure).over(inside), F.col("_tail")))
        .drop("_tail")
    )
