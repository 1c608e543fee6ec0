r"""Line dedup: repeated runs of lines by a suffix array over line ids, built by distributed prefix doubling.

Lines with a word get ids; blank lines are not part of a sequence. Only lines that occur twice can be in a repeated
run. Prefix doubling ranks the run of h lines that begins at each place: the rank for 2h lines orders the pairs of
ranks (i, i + h); a pair that occurs once drops out. Ranks are positions in sorted order, counted range by range over
distinct pairs, so no frequent line is a group of its own.

A run counts when it holds ``min_words`` words. For the place i let L be the fewest lines that hold so many; places
whose next L lines are equal lie in one interval of the suffix array with a common prefix of L lines, which two
overlapping ranks of h lines name (h the power of two up to L). In every interval the first place (by doc_id, then
text, then line) stays, and the L lines at all others are deleted; overlapping deletions add up to the maximal runs.
The first copy of every line stays, and runs never cross texts.

Null text has no lines and stays null; a text all of whose lines are deleted becomes empty. Rows equal in doc_id
and text are one document with equal results. A null doc_id comes before others. Only doc_id and text are read or
changed; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellweave.llm.common import BLANKS, discard, let, release, stored, table
from cellweave.operators.ordering import value_ranks

MIN_WORDS = 50
SLOTS = 1 << 20  # bounds the broadcast that keeps unchanged texts out of the shuffle
KEY = ["d1", "d2"]


def _key() -> list[Column]:
    """128 bits that name a document: its doc_id and text."""
    return [F.xxhash64("doc_id", "text").alias("d1"), F.xxhash64(F.lit(7), "doc_id", "text").alias("d2")]


def lines(docs: DataFrame) -> DataFrame:
    """d1, d2, doc_id, pos (place among lines with a word), line (place among all), h1, h2, words."""
    split = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("line"), x.alias("x")))
    solid = F.filter(split, lambda s: s["x"].rlike(f"[^{BLANKS}]"))
    rows = docs.select(*_key(), "doc_id", F.posexplode(solid).alias("pos", "s"))
    words = F.size(F.array_remove(F.split("s.x", f"[{BLANKS}]+", -1), ""))
    return rows.select(*KEY, "doc_id", "pos", F.col("s.line").alias("line"), F.xxhash64("s.x").alias("h1"),
                       F.xxhash64(F.lit(7), F.col("s.x")).alias("h2"), words.alias("words"))


def _ranked(pairs: DataFrame) -> DataFrame:
    """(r1, r2) that occur at least twice with their rank: the number of rows with a smaller pair."""
    counted = stored(pairs.groupBy(F.struct("r1", "r2").alias("pair")).agg(F.count("*").alias("m")), "pairs")
    ranks = value_ranks(counted, "pair", weight=F.col("m"), few_values=False)
    return ranks.where("n > 1").select(F.col("pair.r1").alias("r1"), F.col("pair.r2").alias("r2"), F.col("before").alias("rank"))


def _needed_lines(alive: DataFrame, min_words: int) -> DataFrame:
    """Add ``need``: the fewest lines from here that hold ``min_words`` words; null if unrepeated lines come first."""
    ahead = W.partitionBy(*KEY).orderBy("pos").rowsBetween(0, min_words - 1)  # each line has a word
    look = alive.withColumn("ahead", F.collect_list(F.struct("pos", "words")).over(ahead))

    def count(run: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("words"))
        done = F.aggregate(run, start, lambda a, x: F.when(
            (a["words"] < min_words) & (x["pos"] == run[0]["pos"] + a["n"]),
            F.struct((a["n"] + 1).alias("n"), (a["words"] + x["words"]).alias("words"))).otherwise(a))
        return F.when(done["words"] >= min_words, done["n"])

    return look.withColumn("need", let(F.col("ahead"), count)).drop("ahead", "words")


def repeated_runs(found: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(d1, d2, pos, need): places whose next ``need`` lines repeat an earlier run. ``found`` is a stored frame of lines."""
    twice = found.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    alive = found.join(twice, ["h1", "h2"]).dropDuplicates([*KEY, "pos"])
    alive = stored(_needed_lines(alive.select(*KEY, "doc_id", "pos", "h1", "h2", "words"), min_words), "alive")
    first = _ranked(alive.select(F.col("h1").alias("r1"), F.col("h2").alias("r2")))
    ranked = alive.withColumnsRenamed({"h1": "r1", "h2": "r2"}).join(first, ["r1", "r2"]).select(*KEY, "doc_id", "pos", "need", "rank")
    ranked = stored(ranked, "ranks")
    out, h, old = None, 1, [alive]
    while True:
        second = ranked.select(*KEY, F.col("pos").alias("at"), F.col("rank").alias("tail"))
        ends = ranked.where(f"need >= {h} and need < {2 * h}").withColumn("at", F.col("pos") + F.col("need") - h)
        decided = ends.join(second, [*KEY, "at"])
        inside = decided.groupBy("need", "rank", "tail").agg(F.min(F.struct("doc_id", *KEY, "pos")).alias("first"), F.count("*").alias("n"))
        again = decided.join(inside.where("n > 1"), ["need", "rank", "tail"]).where(
            (F.col("first.d1") != F.col("d1")) | (F.col("first.d2") != F.col("d2")) | (F.col("first.pos") != F.col("pos")))
        again = stored(again.select(*KEY, "pos", "need"), "runs")
        out = again if out is None else out.unionByName(again)
        if ranked.where(f"need >= {2 * h}").isEmpty():
            discard(ranked, *old)
            return out
        ahead = ranked.withColumn("at", F.col("pos") + h).join(second, [*KEY, "at"]).withColumnsRenamed({"rank": "r1", "tail": "r2"}).drop("at")
        ahead = stored(ahead, "doubled")
        longer = stored(ahead.join(_ranked(ahead.select("r1", "r2")), ["r1", "r2"]).select(*KEY, "doc_id", "pos", "need", "rank"), "ranks")
        discard(ranked, ahead)
        release(found.sparkSession)
        ranked, h = longer, 2 * h


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Input columns with the text left after deletions, and ``_lines``, ``_deleted``: counts of lines before and deleted."""
    found = stored(lines(docs.where("text is not null")), "lines")
    release(docs.sparkSession)
    runs = repeated_runs(found, min_words)
    places = runs.select(*KEY, F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("need") - 1)).alias("pos")).distinct()
    gone = found.select(*KEY, "pos", "line").join(places, [*KEY, "pos"]).groupBy(*KEY).agg(F.collect_set("line").alias("_gone"))
    gone = stored(gone, "deleted-lines")
    discard(found)
    release(docs.sparkSession)

    # Most texts lose nothing: only those in a slot of a changed text are shuffled. The join itself is exact.
    keyed = docs.withColumns(dict(zip(["_d1", "_d2"], _key())))
    slot = F.pmod(F.col("d1"), F.lit(SLOTS))
    slots = F.broadcast(gone.select(slot.alias("_slot")).distinct())
    near = F.pmod(F.col("_d1"), F.lit(SLOTS)) == F.col("_slot")
    same = (F.col("_d1") == F.col("d1")) & (F.col("_d2") == F.col("d2"))
    changed = keyed.join(slots, near, "left_semi").join(gone, same, "left").drop("d1", "d2")
    whole = keyed.join(slots, near, "left_anti").withColumn("_gone", F.lit(None).cast("array<int>"))
    rows = changed.unionByName(whole)
    split = F.split("text", "\n", -1)
    left = F.array_join(F.filter(split, lambda x, i: ~F.array_contains("_gone", i)), "\n")
    names = {"text": F.when(F.col("_gone").isNull(), F.col("text")).otherwise(left),
             "_lines": F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(split)),
             "_deleted": F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(F.size("_gone"))}
    return rows.select(*[names.pop(c).alias(c) if c in names else F.col(f"`{c}`") for c in docs.columns],
                       *[names[c].alias(c) for c in ("_lines", "_deleted")])


def keep_first_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Input columns with later copies of repeated runs deleted; a document that was nothing but copies goes.

    Any other columns pass through, whatever their names: they travel inside one struct.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    inner = docs.select("doc_id", "text", row.alias("_row"))
    out = stored(deduplicated(inner, min_words).select("text", "_row", "_deleted"), "deduplicated")  # a filter would be pushed into the projection and repeat its work
    return out.where("_deleted = 0 or text rlike '[^ \\\\t-\\\\r]'").select(
        *[F.col("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = deduplicated(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_lines").cast("long").alias("n_lines"), F.col("_deleted").cast("long").alias("n_deleted"),
                      F.sha2("text", 256).alias("text_sha256"))


OP1_SQL = f"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
a AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS x, unnest(range(0, len(string_split(text, chr(10))))) AS line FROM d),
l AS (SELECT doc_id, text, x, line, row_number() OVER (PARTITION BY doc_id, text ORDER BY line) - 1 AS pos,
  len(list_filter(string_split_regex(x, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS words FROM a WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]')),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id, text ORDER BY pos) AS total FROM l),
r AS (SELECT i.doc_id, i.text, i.pos, min(j.pos) - i.pos + 1 AS need FROM c i JOIN c j
  ON i.doc_id IS NOT DISTINCT FROM j.doc_id AND i.text = j.text AND j.pos >= i.pos AND j.pos < i.pos + {MIN_WORDS}
  AND j.total - i.total + i.words >= {MIN_WORDS} GROUP BY i.doc_id, i.text, i.pos),
k AS (SELECT r.doc_id, r.text, r.pos, need, string_agg(c.x, chr(10) ORDER BY c.pos) AS run FROM r JOIN c
  ON r.doc_id IS NOT DISTINCT FROM c.doc_id AND r.text = c.text AND c.pos >= r.pos AND c.pos < r.pos + need GROUP BY ALL),
s AS (SELECT *, row_number() OVER (PARTITION BY need, run ORDER BY doc_id NULLS FIRST, text, pos) AS copy FROM k),
g AS (SELECT DISTINCT c.doc_id, c.text, c.line FROM s JOIN c ON s.doc_id IS NOT DISTINCT FROM c.doc_id AND s.text = c.text
  AND c.pos >= s.pos AND c.pos < s.pos + need WHERE copy > 1),
n AS (SELECT a.doc_id, a.text, string_agg(a.x, chr(10) ORDER BY a.line) FILTER (g.line IS NULL) AS rest, count(*) AS n_lines, count(g.line) AS n_deleted
  FROM a LEFT JOIN g ON a.doc_id IS NOT DISTINCT FROM g.doc_id AND a.text = g.text AND a.line = g.line GROUP BY ALL)
SELECT x.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_deleted, 0) AS BIGINT) AS n_deleted,
  CASE WHEN x.text IS NULL THEN NULL ELSE sha256(coalesce(rest, '')) END AS text_sha256
FROM documents x LEFT JOIN n ON x.doc_id IS NOT DISTINCT FROM n.doc_id AND x.text = n.text"""
