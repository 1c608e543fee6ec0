r"""Substring dedup: MinHash banding over paragraphs, exact Jaccard, and removals by connected components.

Texts rarely break where a repeated passage begins, so a paragraph is a content-defined piece: words are cut where the
hash of three words is the least among its neighbours, which depends on the passage alone. A piece is the set of
its five-word shingles. Four bands of two MinHash values meet pieces with a Jaccard similarity of 0.8 with a chance
of 1 - (1 - 0.64)^4 = 0.983, and equal pieces always. In each band bucket every piece is verified against one piece
first; pieces that stay unconnected then meet by signatures (equal parts of their sets, which similar sets always share) and
are verified pair by pair, in blocks, so no link between different pieces is lost to the short cut. A cluster is a component of the links; its first place (by doc_id, then place) stays, all others are copies.
Neighbouring copies of one text are joined to a passage, across a short gap (an altered or very short piece), and
passages of ``min_words`` or more are removed.

A repeated run also holds parts of pieces at its ends, and a changed word spoils a piece. So the ANCHOR words behind every
cut are a second key, matched exactly: each place of a repeated anchor is extended word by word into the words around it,
as far as they equal those around the anchor's first place, and runs of MIN_WORDS or more are copies too. An anchor is
compared with its first place only: a run is missed if the first places of all its anchors belong to other, shorter runs.

Null and short texts have no pieces. Rows equal in doc_id and text are one document. A null doc_id comes first.
Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellweave.llm.common import discard, release, small_batches, stored, table
from cellweave.llm.components import components
from cellweave.llm.shingles import fingerprint, mix, shingle_hashes, word_hashes

NEIGHBOURS = 5  # words on either side among which a cut is the least: pieces have eleven words on average
SHINGLE = 5
BANDS, BAND_ROWS = 4, 2
SIMILAR = 0.8
MIN_WORDS = 25  # of a passage in whole pieces and exact runs
ANCHOR = 8  # words behind a cut that have to be equal
MARGIN = 32  # words on either side of an anchor's cut that are compared; longer runs hold further anchors
GAP = 14  # words of unrepeated text inside a passage
SLOTS = 1 << 24  # bounds the broadcast of slots of repeated pieces to 2 MB
RUN = 1 << 18
BLOCK = 512
_SEEDS = np.random.default_rng(11).integers(1, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def cut_points(words: np.ndarray, bounds: np.ndarray | None = None) -> np.ndarray:
    """Begins of pieces, and the number of words at the end. ``words`` may hold many texts, text i from bounds[i] to bounds[i + 1]."""
    bounds = np.array([0, len(words)]) if bounds is None else bounds
    begins = np.zeros(len(words) + 1, bool)
    begins[bounds] = True
    if len(words) >= 3:
        marks = shingle_hashes(words, 3)
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        inside = np.flatnonzero(owner[:-2] == owner[2:])
        gap = NEIGHBOURS + 2  # between texts, so that no text sees the marks of another
        spread = np.full(len(words) + gap * len(bounds) + NEIGHBOURS, 2**64 - 1, np.uint64)
        at = inside + gap * (owner[inside] + 1)
        spread[at] = marks[inside]
        least = spread[NEIGHBOURS:len(spread) - NEIGHBOURS].copy()
        for k in range(2 * NEIGHBOURS + 1):
            np.minimum(least, spread[k:k + len(least)], out=least)
        begins[inside[spread[at] == least[at - NEIGHBOURS]]] = True
    return np.flatnonzero(begins)


def pieces_of(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins and ends of all pieces of SHINGLE words or more, and the hashes of all shingles, of many texts at once.

    A shingle that runs across two texts belongs to no piece.
    """
    cuts = cut_points(words, bounds)
    long = np.diff(cuts) >= SHINGLE
    return cuts[:-1][long], cuts[1:][long], shingle_hashes(words, SHINGLE)


def _members(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the shingles of every piece, and the piece of each."""
    sizes = ends - SHINGLE + 1 - starts
    owner = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(len(owner)) - (np.cumsum(sizes) - sizes - starts)[owner], owner


def _names(starts: np.ndarray, ends: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """64 bits per piece that name its sequence of shingles."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    at, owner = _members(starts, ends)
    sizes = ends - SHINGLE + 1 - starts
    return np.add.reduceat(mix(shingles[at] + mix((at - starts[owner]).astype(np.uint64))), np.cumsum(sizes) - sizes)


def band_keys(starts: np.ndarray, ends: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """BANDS keys per piece; the lowest bits tell the band."""
    edges = np.stack([starts, ends - SHINGLE + 1], axis=1).ravel()
    padded = np.append(shingles, np.uint64(2**64 - 1))
    keys = np.empty((len(starts), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(starts), band + 1, np.uint64)
        for row in range(BAND_ROWS):
            least = np.minimum.reduceat(mix(padded * _SEEDS[band * BAND_ROWS + row]), edges)[::2]
            key = mix(key * _SEEDS[0] + least)
        keys[:, band] = key // np.uint64(BANDS) * np.uint64(BANDS) + np.uint64(band)
    return keys


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]


def _runs(words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about RUN words, to bound the arrays made from them."""
    at = 0
    while at < len(bounds) - 1:
        end = max(int(np.searchsorted(bounds, bounds[at] + RUN, side="right")) - 1, at + 1)
        yield at, end
        at = end


def keyed(docs: DataFrame) -> DataFrame:
    """(key, name) of every piece and band; a piece that a run of texts holds more than twice is given twice."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, bounds = word_hashes(_texts(batch))
            for a, b in _runs(words, bounds):
                starts, ends, shingles = pieces_of(words[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
                if not len(starts):
                    continue
                names, at, n = np.unique(_names(starts, ends, shingles), return_index=True, return_counts=True)
                order = np.argsort(at)  # reduceat wants pieces in their order
                at, twice = at[order], np.minimum(n[order], 2)
                keys = np.repeat(band_keys(starts[at], ends[at], shingles), twice, axis=0)
                names = np.repeat(names[order], twice * BANDS)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(names.view(np.int64))], names=["key", "name"])

    return docs.select("text").mapInArrow(make, "key long, name long")


def places_of(docs: DataFrame, slots: np.ndarray) -> DataFrame:
    """doc_id, body, first, last, name and the set of shingles of pieces whose name falls in an asked slot."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(slots))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            texts = _texts(batch)
            words, bounds = word_hashes(texts)
            for a, b in _runs(words, bounds):
                starts, ends, shingles = pieces_of(words[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])
                names = _names(starts, ends, shingles)
                chosen = asked[(names % np.uint64(SLOTS)).astype(np.int64)]
                starts, ends, names = starts[chosen], ends[chosen], names[chosen]
                if not len(starts):
                    continue
                row = np.searchsorted(bounds, starts + bounds[a], side="right") - 1
                bodies = {r: xxhash.xxh64_intdigest(texts[r]) - (1 << 63) for r in np.unique(row).tolist()}
                at, owner = _members(starts, ends)
                order = np.lexsort((shingles[at], owner))
                members, owner = shingles[at][order], owner[order]
                fresh = np.append(True, (members[1:] != members[:-1]) | (owner[1:] != owner[:-1]))
                offsets = np.append(0, np.cumsum(np.bincount(owner[fresh], minlength=len(starts)))) * 8
                sets = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(members[fresh])])
                begin = bounds[row] - bounds[a]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(row, pa.int64())), pa.array([bodies[r] for r in row.tolist()], pa.int64()),
                    pa.array(starts - begin, pa.int64()), pa.array(ends - begin, pa.int64()), pa.array(names.view(np.int64)), sets],
                    names=["doc_id", "body", "first", "last", "name", "set"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(make, f"doc_id {kind}, body long, first long, last long, name long, set binary")


def _slots(named: DataFrame) -> np.ndarray:
    """Which of SLOTS slots hold a name."""
    asked = np.zeros(SLOTS // 64, np.int64)
    for r in named.select(F.floor(F.expr(f"pmod(name, {SLOTS})") / 64).cast("int").alias("w"), F.expr("shiftleft(1L, cast(pmod(name, 64) as int))").alias("bit")).groupBy(
            "w").agg(F.bit_or("bit").alias("bits")).collect():  # at most SLOTS / 64 rows
        asked[r["w"]] = r["bits"]
    return np.unpackbits(asked.view(np.uint8), bitorder="little").view(bool)


def _anchors(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all cuts with ANCHOR words of their text behind them, the text of each, and the hashes of those words."""
    cuts = cut_points(words, bounds)[:-1]
    row = np.searchsorted(bounds, cuts, side="right") - 1
    room = cuts + ANCHOR <= bounds[row + 1]
    cuts, row = cuts[room], row[room]
    return cuts, row, shingle_hashes(words, ANCHOR)[cuts] if len(cuts) else np.zeros(0, np.uint64)


def anchor_names(docs: DataFrame) -> DataFrame:
    """(name, n) of the anchors of every run of texts."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, bounds = word_hashes(_texts(batch))
            for a, b in _runs(words, bounds):
                names, n = np.unique(_anchors(words[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a])[2], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n, pa.int64())], names=["name", "n"])

    return docs.select("text").mapInArrow(make, "name long, n long")


def anchor_places(docs: DataFrame, slots: np.ndarray) -> DataFrame:
    """doc_id, body, at, name, and the words around (32 bits each) of anchors whose name falls in an asked slot."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(slots))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.unpackbits(shared.value).view(bool)
        for batch in batches:
            texts = _texts(batch)
            words, bounds = word_hashes(texts)
            for a, b in _runs(words, bounds):
                own, edges = words[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a]
                cuts, row, names = _anchors(own, edges)
                chosen = asked[(names % np.uint64(SLOTS)).astype(np.int64)]
                cuts, row, names = cuts[chosen], row[chosen], names[chosen]
                if not len(cuts):
                    continue
                short = (own >> np.uint64(32)).astype(np.uint32)
                around = np.ascontiguousarray(short[np.clip(cuts[:, None] + np.arange(-MARGIN, MARGIN), 0, len(own) - 1)])
                offsets = (np.arange(len(cuts) + 1) * 8 * MARGIN).astype(np.int32)
                bodies = {r: xxhash.xxh64_intdigest(texts[r + a]) - (1 << 63) for r in np.unique(row).tolist()}
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(row + a, pa.int64())), pa.array([bodies[r] for r in row.tolist()], pa.int64()),
                    pa.array(cuts - edges[row], pa.int64()), pa.array(names.view(np.int64)),
                    pa.array(np.minimum(edges[row + 1] - cuts, MARGIN), pa.int64()),
                    pa.Array.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(around)])],
                    names=["doc_id", "body", "at", "name", "room", "words"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(make, f"doc_id {kind}, body long, at long, name long, room long, words binary")


def exact_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The columns of ``copies`` for runs of ``min_words`` or more that equal the words around the first place of an anchor."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, at2, room, room2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("at", "at2", "room", "room2"))
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, 2 * MARGIN) for c in ("words", "words2"))
            apart = np.ones((len(x), 2 * MARGIN + 2), bool)  # a difference stands behind the last word on both sides
            apart[:, 1:-1] = x != y
            before = np.minimum(np.argmax(apart[:, MARGIN::-1], axis=1), np.minimum(at, at2))
            after = np.minimum(np.argmax(apart[:, MARGIN + 1:], axis=1), np.minimum(room, room2))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("body"), pa.array(at - before, pa.int64()), pa.array(at + after, pa.int64()),
                batch.column("name"), batch.column("kept_doc_id")], names=["doc_id", "body", "first", "last", "cluster", "kept_doc_id"]).filter(
                    pa.array(before + after >= min_words))

    names = stored(anchor_names(docs).groupBy("name").agg(F.sum("n").alias("n")).where("n > 1").select("name"), "anchors")
    release(spark)
    places = stored(anchor_places(docs, _slots(names)).join(names, "name"), "anchor-places")
    release(spark)
    # Stored, so that the join shuffles the places anew and Spark can split a common anchor.
    first = stored(places.groupBy("name").agg(F.min(F.struct("doc_id", "body", "at", "room", "words")).alias("kept")), "anchor-firsts")
    same = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("body") == F.col("kept.body")) & (F.col("at") == F.col("kept.at"))
    pairs = places.join(first, "name").where(~same).select(
        "doc_id", "body", "at", "name", "room", "words", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.at").alias("at2"),
        F.col("kept.room").alias("room2"), F.col("kept.words").alias("words2"))
    found = stored(pairs.mapInArrow(extend, f"doc_id {kind}, body long, first long, last long, cluster long, kept_doc_id {kind}"), "exact-runs")
    discard(names, places, first)
    release(spark)
    return found


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for one, two in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(10 * both >= 8 * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.withColumnsRenamed({"name": "a", "set": "x"}), "a").join(sets.withColumnsRenamed({"name": "b", "set": "y"}), "b")
    return stored(both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long"), "similar")


def _parts(n: np.ndarray) -> np.ndarray:
    """Numbers of parts of a set's signatures, by the set's size (-1: none).

    Sets of s and m >= s elements with a similarity of 0.8 differ in (s + m) / 9 elements at most and m <= 5 s / 4, so one of more
    parts than that is equal. A set meets smaller ones down to 4/5 of its size: it is cut once for every s.
    """
    s = np.maximum(n[:, None] - np.arange(int(n.max()) // 5 + 1), 0)
    parts = np.where(5 * s >= 4 * n[:, None], (s + 5 * s // 4) // 9 + 1, -1)
    power = 1 << np.ceil(np.log2(np.maximum(parts, 1))).astype(np.int64)  # a few numbers only: more parts do no harm
    parts = np.where(parts > 4, np.where(4 * parts <= 3 * power, power * 3 // 4, power), parts)
    parts = np.sort(parts, axis=1)
    parts[:, 1:][parts[:, 1:] == parts[:, :-1]] = -1
    return parts


def signatures(sets: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and the set of each: two sets with a similarity of 0.8 or more always share a key.

    Elements are dealt to parts by hash and every part that is not empty is a key. A set with an empty part is dealt again by
    another hash, and then gives the least of its elements, of which similar sets share one.
    """
    sizes = np.array([len(x) // 8 for x in sets], np.int64)
    members = np.frombuffer(b"".join(sets), np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    parts = _parts(sizes)
    keys, owners = [], []
    scarce = np.zeros(len(sets), bool)
    for k in np.unique(parts[parts > 0]).tolist():
        needs = (parts == k).any(axis=1)
        for level in range(2):
            own, at = members[needs[owner]], owner[needs[owner]]
            part = (mix(own * _SEEDS[2 * level]) >> np.uint64(32)).astype(np.int64) % k
            order = np.argsort(at * k + part, kind="stable")
            cell = (at * k + part)[order]
            begins = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])[:len(cell)])
            sums = np.add.reduceat(mix(own[order] * _SEEDS[2 * level + 1]), begins) if len(begins) else np.zeros(0, np.uint64)
            cell = cell[begins]
            keys.append(mix(sums + mix((cell % k + (k << 20) + (level << 60)).astype(np.uint64))))
            owners.append(cell // k)
            needs = needs & (np.bincount(cell // k, minlength=len(sets)) < k)
        scarce |= needs
    own, at = mix(members[scarce[owner]] ^ _SEEDS[4]), owner[scarce[owner]]
    order = np.lexsort((own, at))
    own, at = own[order], at[order]
    place = np.arange(len(at)) - np.searchsorted(at, at)
    least = place <= sizes[at] - (4 * sizes[at] + 4) // 5
    return np.concatenate([*keys, own[least]]), np.concatenate([*owners, at[least]])


def sketches(sets: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128 parities per set, as two numbers: two sets differ in at least as many elements as their parities do."""
    sizes = np.array([len(x) // 8 for x in sets], np.int64)
    spot = mix(np.frombuffer(b"".join(sets), np.uint64) ^ _SEEDS[5])
    bit, high = np.uint64(1) << (spot & np.uint64(63)), (spot >> np.uint64(6)) & np.uint64(1)
    begins = np.cumsum(sizes) - sizes
    return tuple(np.bitwise_xor.reduceat(np.where(high == side, bit, np.uint64(0)), begins).view(np.int64) for side in (0, 1))


def _rest(buckets: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of pieces of open buckets that aren't connected yet and may be similar.

    A bucket is not paired whole: pieces of open buckets meet by signatures, which lose no similar pair and which pieces that
    share some words rarely have in common. Sizes and sketches drop most other pairs before they are shuffled.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("set").to_pylist()
            if not own:
                continue
            keys, at = signatures(own)
            low, high = sketches(own)
            at = pa.array(at, pa.int64())
            rows = [batch.column("name"), batch.column("root"), pa.array([len(x) // 8 for x in own], pa.int32()), pa.array(low), pa.array(high)]
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *[c.take(at) for c in rows]],
                                             names=["key", "name", "root", "size", "low", "high"])

    rows = buckets.join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
    mixed = F.min("root").alias("_least"), F.max("root").alias("_most")
    open_ = rows.groupBy("key").agg(*mixed).where("_least <> _most").select("key")
    names = rows.join(open_, "key").select("name", "root").distinct()
    signed = stored(names.join(sets, "name").mapInArrow(make, "key long, name long, root long, size int, low long, high long"), "signatures")
    open_ = signed.groupBy("key").agg(*mixed, F.count("*").alias("m")).where("_least <> _most")
    rows = signed.join(open_.select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "key")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = rows.select("key", F.col("own").alias("x"), other.alias("y"), F.col("name").alias("a"), "root", "size", "low", "high")
    right = rows.select("key", F.col("own").alias("y"), other.alias("x"), F.col("name").alias("b"), F.col("root").alias("root2"),
                        F.col("size").alias("size2"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    near = F.expr("a < b and root <> root2 and 5 * size >= 4 * size2 and 5 * size2 >= 4 * size"
                  " and 9 * (bit_count(low ^ low2) + bit_count(high ^ high2)) <= size + size2")
    pairs = stored(left.join(right, ["key", "x", "y"]).where(near).select("a", "b").distinct(), "rest")
    discard(signed)
    return pairs


def copies(docs: DataFrame) -> DataFrame:
    """doc_id, body, first, last, cluster, kept_doc_id of every piece that repeats an earlier one."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # Both uses of the rows take both columns, so they share one shuffle.
    rows = keyed(docs).repartition("key")
    met = rows.groupBy("key").agg(F.min("name").alias("low"), F.max("name").alias("high"), F.count("*").alias("n")).where("n > 1")
    # A bucket of one repeated piece only tells that it repeats; one band of it is enough.
    mixed = (F.col("low") != F.col("high")).alias("mixed")
    buckets = rows.join(met.where(f"low <> high or pmod(key, {BANDS}) = 0").select("key", mixed), "key").distinct()
    found = stored(buckets, "band-buckets")
    release(spark)
    asked = _slots(found)
    names = found.groupBy("name").agg(F.max("mixed").alias("mixed"))
    places = places_of(docs, asked).join(names, "name").withColumn("set", F.when(F.col("mixed"), F.col("set"))).drop("mixed")
    places = stored(places, "places")
    release(spark)

    buckets = found.where("mixed").select("key", "name")
    sets = stored(places.where("set is not null").groupBy("name").agg(F.first("set").alias("set")), "piece-sets")
    best = buckets.groupBy("key").agg(F.min("name").alias("pivot"), F.max("name").alias("high")).where("pivot <> high").select("key", "pivot")
    stars = buckets.join(best, "key").where("name <> pivot").select(F.col("pivot").alias("a"), F.col("name").alias("b")).distinct()
    links = _similar(stars, sets)
    roots = stored(components(links), "roots")
    more = _rest(buckets, roots, sets)
    if not more.isEmpty():
        roots = stored(components(links.unionByName(_similar(more, sets))), "roots")
    clustered = places.drop("set").distinct().join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("cluster", F.coalesce("root", "name")).drop("root", "name")
    clustered = stored(clustered, "clustered")
    discard(found, sets, places)
    release(spark)
    first = clustered.groupBy("cluster").agg(F.min(F.struct("doc_id", "body", "first")).alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    same = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("body") == F.col("kept.body")) & (F.col("first") == F.col("kept.first"))
    return clustered.join(first, "cluster").where(~same).select("doc_id", "body", "first", "last", "cluster", F.col("kept.doc_id").alias("kept_doc_id"))


def passages(found: DataFrame, min_words: int = MIN_WORDS, gap: int = GAP) -> DataFrame:
    """One row per passage to remove: doc_id, start_word, end_word, n_words (in copies), kept_doc_ids, cluster."""
    inside = W.partitionBy("doc_id", "body").orderBy("first", "last")
    reach = found.withColumn("reach", F.max("last").over(inside.rowsBetween(W.unboundedPreceding, -1)))
    begins = F.coalesce(F.col("first") - F.col("reach") > gap, F.lit(True))
    fresh = F.greatest(F.col("last") - F.greatest("first", F.coalesce("reach", "first")), F.lit(0))
    runs = reach.withColumn("begins", begins.cast("int")).withColumn("run", F.sum("begins").over(inside.rowsBetween(W.unboundedPreceding, 0)))
    out = runs.withColumn("fresh", fresh).groupBy("doc_id", "body", "run").agg(
        F.min("first").alias("start_word"), F.max("last").alias("end_word"), F.sum("fresh").cast("long").alias("n_words"),
        F.sort_array(F.collect_set("kept_doc_id")).alias("kept_doc_ids"), F.min("cluster").alias("cluster"))
    return out.where(F.col("n_words") >= min_words).drop("body", "run")


def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return passages(copies(docs).unionByName(exact_runs(docs)))
