r"""N-gram Jaccard join by grouped prefixes, for the components of the links.

Texts with equal shingle sets are one class. Shingles are ordered by rarity (levels of a fixed-size count
sketch over all texts, then hash; any order is right, a good one is fast). Two classes that reach the threshold
share a shingle among their first n - ceil(t * n) + 1 shingles, and their sizes and the place of the first
shared one bound their overlap. Classes with the same prefix and size are one group; groups meet in the buckets
of prefix shingles.

Links are only wanted up to connection, so each bucket first verifies its members against one member, that with the
smallest place of the shingle (the least altered copy). What is then connected needs no further pairs;
all other pairs of a bucket that pass the bounds are verified, in blocks. Before texts are fetched, pairs of classes
pass a bound on their difference: sets that differ in few shingles differ in few bits of a parity sketch of the whole set.
Nothing is capped or sampled: a component is exact for any data.

Null or blank texts have no shingles and are linked with nothing. Rows may repeat, and doc_id may be null: classes
are made from texts alone, and the smallest doc_id that isn't null names a component. Only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import alone, discard, release, small_batches, stored, table
from cellweave.llm.components import components
from cellweave.llm.shingles import fingerprint, shingle_sets

SLOT_BITS = 22
FREQUENT = 64  # texts per slot from which a shingle's slot has a level above 0
PER_TASK = 16_384  # slots that a task reports, its most frequent
LEVELS = 65_536  # slots that are kept; all others have level 0. Bounds the broadcast, not the result
WORDS = 4
BITS = [f"b{w}" for w in range(WORDS)]  # a bitmap of the prefix: a bit that one has and the other lacks is a shingle not shared
SKETCH_WORDS = 16
SKETCH = [f"s{w}" for w in range(SKETCH_WORDS)]  # a bit is the parity of the shingles of the whole set that fall on it
NAMED_SLOTS = 1 << 20  # bounds the broadcast of slots of asked ids
PASSES = 4  # runs in which candidate pairs are verified
BLOCK = 512  # members of a bucket that meet in one block


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]


def rarity(docs: DataFrame, size: int) -> np.ndarray:
    """Level of every slot: 0, or the binary logarithm of its count of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.int32)
        for batch in batches:
            sets = shingle_sets(_texts(batch), size)
            if sets:
                np.add.at(counts, (np.concatenate(sets) >> np.uint64(64 - SLOT_BITS)).astype(np.int64), 1)
        top = np.flatnonzero(counts > 1)
        if len(top) > PER_TASK:
            top = top[np.argpartition(counts[top], -PER_TASK)[-PER_TASK:]]
        yield pa.RecordBatch.from_arrays([pa.array(top, pa.int64()), pa.array(counts[top], pa.int64())], names=["slot", "n"])

    slots = docs.select("text").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    rows = slots.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "slot").limit(LEVELS).collect()
    levels = np.zeros(1 << SLOT_BITS, np.uint8)
    for row in rows:
        levels[row["slot"]] = row["n"].bit_length()
    return levels


def _sketches(sets: list[np.ndarray]) -> np.ndarray:
    """One row of SKETCH_WORDS numbers per set; two rows differ in at most as many bits as their sets in shingles."""
    bits = 64 * SKETCH_WORDS
    odd = np.zeros((len(sets), bits), bool)
    for row, own in zip(odd, sets):
        row[:] = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd, axis=1).view(np.int64)


def described(docs: DataFrame, size: int, threshold: Fraction, levels: np.ndarray) -> DataFrame:
    """Per row: doc_id, n, cid (128 bits that name the set), gid (the same for prefix and n), the prefix in order and its bits, the sketch."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = shared.value
        for batch in batches:
            sets = shingle_sets(_texts(batch), size)
            prefixes = []
            for own in sets:
                level = table_[(own >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
                keep = len(own) - math.ceil(threshold * len(own)) + 1 if len(own) else 0
                prefixes.append(own[np.argsort(level, kind="stable")[:keep]].view(np.int64))
            groups = [fingerprint(np.append(p, len(s)).view(np.uint64) + np.arange(len(p) + 1, dtype=np.uint64)) for p, s in zip(prefixes, sets)]
            ends = np.cumsum([0, *map(len, prefixes)])
            marks = np.zeros((len(sets), 64 * WORDS), bool)
            if ends[-1]:
                marks[np.repeat(np.arange(len(sets)), np.diff(ends)), np.concatenate(prefixes) & (64 * WORDS - 1)] = True
            marks = np.packbits(marks, axis=1).view(np.int64)
            sketches = _sketches(sets)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([fingerprint(s) if len(s) else None for s in sets], pa.binary()), pa.array(groups, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(prefixes) if prefixes else [], pa.int64())),
                *[pa.array(marks[:, w]) for w in range(WORDS)], *[pa.array(sketches[:, w]) for w in range(SKETCH_WORDS)]],
                names=["doc_id", "n", "cid", "gid", "prefix", *BITS, *SKETCH])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(describe, f"doc_id {kind}, n long, cid binary, gid binary, prefix array<long>, " + ", ".join(f"{b} long" for b in BITS + SKETCH))


def _class_texts(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(cid, text) of the documents named in ``ids``: texts are smaller than their sets of hashes."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids = [fingerprint(s) for s in shingle_sets(_texts(batch), size)]
            yield pa.RecordBatch.from_arrays([pa.array(cids, pa.binary()), batch.column(0)], names=["cid", "text"])

    # At most NAMED_SLOTS slots are broadcast, to keep most unasked texts out of the shuffle; the join that follows is exact.
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(NAMED_SLOTS)).alias("slot")
    near = docs.select("doc_id", "text", slot).join(F.broadcast(ids.select(slot).distinct()), "slot", "left_semi")
    named = near.join(ids.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    return named.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(name, "cid binary, text string")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold, stored."""
    up, down = threshold.numerator, threshold.denominator

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cids = batch.column(0).to_pylist() + batch.column(1).to_pylist()
            texts = batch.column(2).cast(pa.binary()).to_pylist() + batch.column(3).cast(pa.binary()).to_pylist()
            once = dict(zip(cids, texts))
            sets = dict(zip(once, shingle_sets(list(once.values()), size)))
            keep = []
            for one, two in zip(cids, cids[batch.num_rows:]):
                x, y = sets[one], sets[two]
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(down * both >= up * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    needed = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    ids = classes.join(needed, "cid").select("doc_id").distinct()
    texts = stored(_class_texts(docs, ids, size), "class-texts")
    release(docs.sparkSession)
    # A pair's texts meet in one of PASSES runs, each of which shuffles its share of the texts only.
    links = []
    for turn in range(PASSES):
        own = pairs.where(F.pmod(F.xxhash64("a"), F.lit(PASSES)) == turn)
        both = own.join(texts.withColumnsRenamed({"cid": "a", "text": "x"}), "a").join(texts.withColumnsRenamed({"cid": "b", "text": "y"}), "b")
        links.append(stored(both.select("a", "b", "x", "y").mapInArrow(check, "a binary, b binary"), "verified"))
        release(docs.sparkSession)
    discard(texts)
    return reduce(DataFrame.unionByName, links)


def _enough(threshold: Fraction) -> Column:
    """Size bound, positional bound and bitmap bound of two members (n, pos, b*) and (n2, pos2, c*) of a bucket."""
    up, down = threshold.numerator, threshold.denominator
    n, m = F.col("n"), F.col("n2")
    sizes = (n * down >= m * up) & (m * down >= n * up)
    places = (down + up) * F.least(n - F.col("pos"), m - F.col("pos2")) >= up * (n + m)

    def prefix(size: Column) -> Column:
        return size - F.ceil(size * up / down) + 1

    def only(one: str, two: str) -> Column:
        return sum(F.bit_count(F.col(f"{one}{w}").bitwiseAND(F.bitwise_not(F.col(f"{two}{w}")))) for w in range(WORDS))

    shared = F.least(prefix(n) - only("b", "c"), prefix(m) - only("c", "b"))
    rest = F.greatest(n - prefix(n), m - prefix(m))
    return sizes & places & ((down + up) * (shared + rest) >= up * (n + m))


def near(pairs: DataFrame, classes: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs (a, b) of classes whose sketches allow the threshold: the sets differ in at least as many shingles as the sketches in bits."""
    up, down = threshold.numerator, threshold.denominator
    one = classes.select(F.col("cid").alias("a"), F.col("n").alias("n"), *SKETCH)
    two = classes.select(F.col("cid").alias("b"), F.col("n").alias("n2"), *[F.col(s).alias(f"{s}_") for s in SKETCH])
    apart = sum(F.bit_count(F.col(s).bitwiseXOR(F.col(f"{s}_"))) for s in SKETCH)
    return pairs.join(one, "a").join(two, "b").where((down + up) * apart <= (down - up) * (F.col("n") + F.col("n2"))).select("a", "b")


def plausible(pairs: DataFrame, groups: DataFrame, threshold: Fraction) -> DataFrame:
    """Group pairs whose prefixes share enough: beyond its prefix a set adds at most the rest of its size.

    If x's prefix ends first in the order, what x's prefix shares with y lies in y's prefix; so the overlap is at most
    the shared part of the prefixes plus the larger rest.
    """
    up, down = threshold.numerator, threshold.denominator
    one = groups.select("g", F.col("n").alias("n"), F.col("prefix").alias("p"))
    two = groups.select(F.col("g").alias("g2"), F.col("n").alias("n2"), F.col("prefix").alias("p2"))
    most = F.size(F.array_intersect("p", "p2")) + F.greatest(F.col("n") - F.size("p"), F.col("n2") - F.size("p2"))
    kept = pairs.join(one, "g").join(two, "g2").where((down + up) * most >= up * (F.col("n") + F.col("n2")))
    return kept.select(*pairs.columns).distinct()


def star_pairs(entries: DataFrame, threshold: Fraction) -> DataFrame:
    """Every group of a bucket (token, pos, n, g, bits) with the group of smallest place among those of like size."""
    step = math.log(1 / float(threshold))
    placed = entries.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / step))
    best = placed.groupBy("token", "band").agg(F.min(F.struct("pos", "g", "n", *BITS)).alias("best"), F.count("*").alias("m")).where("m > 1")
    best = best.select("token", "band", F.col("best.g").alias("g2"), F.col("best.n").alias("n2"), F.col("best.pos").alias("pos2"),
                       *[F.col(f"best.b{w}").alias(f"c{w}") for w in range(WORDS)])
    return placed.join(best, ["token", "band"]).where((F.col("g") != F.col("g2")) & _enough(threshold)).select("g", "g2").distinct()


def rest_pairs(entries: DataFrame, threshold: Fraction) -> DataFrame:
    """All pairs of groups in a bucket that pass the bounds and aren't connected yet, block against block.

    ``entries``: token, pos, n, g, bits, root; one row per bucket, group and component.
    """
    open_ = entries.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("m")).where("low <> high")
    rows = entries.join(open_.select("token", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "token")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("g", "root"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("token", "own", other, "n", "pos", "g", "root", *BITS)
    # Blocks x and y meet in the cell (x, y), x <= y: both sides are the same rows, which are shuffled once.
    cells = rows.select("token", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "n", "pos", "g", "root", *BITS).repartition(
        "token", "x", "y")
    twin = cells.withColumnsRenamed({"own": "own2", "n": "n2", "pos": "pos2", "g": "g2", "root": "root2"} | {f"b{w}": f"c{w}" for w in range(WORDS)})
    once = (F.col("own") != F.col("own2")) | (F.col("x") == F.col("y"))
    met = cells.join(twin, ["token", "x", "y"]).where(once & (F.col("root") < F.col("root2")) & _enough(threshold))
    return met.select("g", "root", "g2", "root2").distinct()


def linked(docs: DataFrame, size: int = 3, threshold: Fraction = Fraction(9, 10)) -> DataFrame:
    """doc_id, n_shingles, component_id for every row. ``doc_id`` may be of any type with an order."""
    return alone(lambda: _linked(docs, size, threshold))


def _linked(docs: DataFrame, size: int, threshold: Fraction) -> tuple[DataFrame, list[DataFrame]]:
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = stored(described(docs, size, threshold, rarity(docs, size)), "prefixes")
    # Two groups with the same g would only be asked more; groups themselves are told apart by all 128 bits.
    number = F.xxhash64("gid").alias("g")
    classes = stored(rows.where("cid is not null").groupBy("cid").agg(
        F.min("doc_id").alias("doc_id"), F.first(number).alias("g"), F.first("n").alias("n"), *[F.first(s).alias(s) for s in SKETCH]), "classes")
    groups = rows.where("cid is not null").groupBy("gid").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"), *[F.first(b).alias(b) for b in BITS])
    groups = stored(groups.select(number, "n", "prefix", *BITS), "groups")
    narrow = stored(rows.select("doc_id", "n", "cid"), "rows")
    discard(rows)
    release(spark)
    postings = groups.select("g", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "token")).select("token", "pos", "n", "g").repartition("token")
    shared = postings.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token")
    buckets = stored(postings.join(shared, "token").join(groups.select("g", *BITS), "g"), "buckets")
    release(spark)

    heads = classes.groupBy("g").agg(F.min("cid").alias("head"))
    stars = stored(star_pairs(buckets, threshold), "stars")
    release(spark)
    between = stars.join(heads.select("g", F.col("head").alias("one")), "g").join(
        heads.select(F.col("g").alias("g2"), F.col("head").alias("two")), "g2").select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b"))
    inside = classes.join(heads, "g").where("cid <> head").select(F.col("head").alias("a"), F.col("cid").alias("b"))
    pairs = stored(near(between.unionByName(inside).distinct(), classes, threshold), "pairs")
    discard(stars)
    release(spark)
    links = verified(pairs, classes, docs, size, threshold)
    discard(pairs)
    roots = stored(components(links), "roots")

    rooted = classes.select("cid", "g").join(roots.withColumnRenamed("node", "cid"), "cid", "left").select("cid", "g", F.coalesce("root", "cid").alias("root"))
    rooted = stored(rooted, "rooted")
    parts = rooted.select("g", "root").distinct()
    apart = stored(rest_pairs(buckets.join(parts, "g"), threshold), "rest")
    discard(buckets)
    release(spark)
    split = parts.groupBy("g").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("g")
    own = parts.join(split, "g")
    within = own.join(own.withColumnRenamed("root", "root2"), "g").where("root < root2").select("g", "root", F.col("g").alias("g2"), "root2")
    asked = plausible(apart, groups, threshold).unionByName(within).distinct()
    members = rooted.select("g", "root", F.col("cid").alias("a"))
    pairs = asked.join(members, ["g", "root"]).join(
        members.select(F.col("g").alias("g2"), F.col("root").alias("root2"), F.col("a").alias("b")), ["g2", "root2"]).select("a", "b").distinct()
    pairs = stored(near(pairs, classes, threshold), "pairs")
    discard(groups)
    release(spark)
    if not pairs.isEmpty():
        more = verified(pairs, classes, docs, size, threshold)
        roots = stored(components(links.unionByName(more)), "roots")

    named = classes.select("cid", "doc_id").join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = stored(named, "named")
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = named.join(least, "root").select("cid", "component_id")
    out = narrow.select("doc_id", F.col("n").alias("n_shingles"), "cid").join(labels, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")), [narrow, named]


def keep_one(docs: DataFrame, size: int = 3, threshold: Fraction = Fraction(9, 10)) -> DataFrame:
    """One input row of every component: that with the smallest doc_id, null ids last; ties go by the text's hash.

    A row is known by its doc_id and 128 bits of its text, so a doc_id with several texts is several documents. Of rows that repeat both
    one stays. Rows without words are linked with nothing and all stay. Other columns pass through, whatever their names.
    """
    text = F.col("text").cast("string")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"))
    found = stored(linked(docs.select(key.alias("doc_id"), text.alias("text")), size, threshold), "components")
    heads = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n"), F.max("n_shingles").alias("words"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, key.alias("_key"), F.hash(key).alias("_slot"))

    def of(chosen: DataFrame) -> DataFrame:
        chosen = chosen.select(F.col("doc_id").alias("_head"), F.hash("doc_id").alias("_h"))
        return rows.join(chosen, (F.col("_slot") == F.col("_h")) & F.col("_key").eqNullSafe(F.col("_head")), "left_semi")

    repeated = (F.col("n") > 1) & (F.col("words") > 0)
    kept = of(heads.where(~repeated)).unionByName(of(heads.where(repeated)).dropDuplicates(["_key"]))
    return kept.select("_row.*")


def op7_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return linked(table(spark, folder, "documents"))
