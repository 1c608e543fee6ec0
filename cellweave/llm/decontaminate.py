r"""Benchmark decontamination by a prefix-filtered containment join (built-in functions only).

An item is a sequence of words; its windows are all runs of ``window`` consecutive words (the whole
item where it is shorter). Tokens are shingles of up to five words. Containment of a whole window
needs every one of its shingles, so one shingle, the rarest by corpus count, is a sufficient prefix.
Only places of prefix shingles are joined; the shingle's place in the window fixes where the window
would begin (positional bound), which must lie inside the text (length bound); then the words are
compared exactly.

Null texts have no words. Items without words have no windows. Repeated items share their windows and
are all reported. Documents are matched by (doc_id, text), nulls included, so rows that repeat both
get equal results. Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import ascii_lower, stored, table

SHINGLE = 5
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SMALL_SIDE = 200_000  # shingles of the benchmark up to which its tables are broadcast


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAPS, -1), "")


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(window_id, words, item_id): every run of ``window`` words; a shorter item is one window."""
    split = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    rows = split.where(F.size("w") > 0).select("item_id", "w", F.explode(starts).alias("s"))
    rows = rows.select("item_id", F.slice("w", F.col("s"), window).alias("words"))
    return rows.select(F.sha2(F.array_join("words", " "), 256).alias("window_id"), "words", "item_id")


def _shingles(words: Column, size: int) -> Column:
    """Hash of every ``size``-word shingle, in order."""
    last = F.size(words) - size
    made = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                       lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return F.when(last >= 0, made)


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= SMALL_SIDE else df


def window_shingles(windows: DataFrame) -> tuple[DataFrame, list[int]]:
    """Every distinct window with the places of its shingles, and the shingle sizes in use (at most five)."""
    distinct = windows.groupBy("window_id").agg(F.first("words").alias("words"))
    sized = distinct.select("window_id", "words", F.least(F.size("words"), F.lit(SHINGLE)).alias("k"))
    sizes = sorted(r[0] for r in sized.select("k").distinct().collect())
    rows = sized.select("window_id", "words", "k", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("k"))).alias("offset"))
    token = F.lit(None).cast("long")
    for k in sizes:
        own = F.xxhash64(*[F.get("words", F.col("offset") + j) for j in range(k)])
        token = F.when(F.col("k") == k, own).otherwise(token)
    return rows.withColumn("token", token), sizes


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """One row per document: doc_id, n_words, spans (start, length in words), n_hit, items (sorted item ids)."""
    windows = stored(item_windows(items, window), "windows")
    shingles, sizes = window_shingles(windows)
    shingles = stored(shingles, "window-shingles")
    n_shingles = shingles.count()
    tokens = shingles.select("k", "token").distinct()

    body = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    keyed = body.select("doc_id", F.xxhash64("text").alias("body"), words_of(F.col("text")).alias("w"))
    found = keyed.select("doc_id", "body", F.lit(0).alias("pos"), F.lit(0).cast("long").alias("token"), F.lit(0).alias("k")).limit(0)
    for k in sizes:
        places = keyed.select("doc_id", "body", F.posexplode(_shingles(F.col("w"), k)).alias("pos", "token"))
        part = places.join(_maybe_broadcast(tokens.where(F.col("k") == k), n_shingles), "token")
        found = part.select("doc_id", "body", "pos", "token", "k") if k == sizes[0] else found.unionByName(part)
    found = stored(found, "shingle-places")

    # Rarity over the whole corpus decides each window's prefix; ties go to the smaller hash.
    counts = found.groupBy("k", "token").agg(F.count("*").alias("n"))
    ranked = shingles.join(counts, ["k", "token"], "left").groupBy("window_id", "k").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "offset")).alias("least"),
        F.first("words").alias("words"))
    prefixes = stored(ranked.where("least.n > 0").select(
        "window_id", "k", "words", F.col("least.token").alias("token"), F.col("least.offset").alias("offset")), "prefixes")
    asked = found.join(_maybe_broadcast(prefixes, n_shingles), ["k", "token"]).select(
        "doc_id", "body", (F.col("pos") - F.col("offset")).alias("start"), "words", "window_id").where("start >= 0")
    asked = asked.groupBy(F.col("doc_id").alias("_id"), "body").agg(
        F.collect_set(F.struct("start", "words", "window_id")).alias("asked"))

    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("body"))
    joined = body.join(asked, same, "left").select(
        "doc_id", F.xxhash64("text").alias("body"), words_of(F.col("text")).alias("w"),
        F.coalesce("asked", F.filter(F.array(F.struct(F.lit(0).alias("start"), F.array(F.lit("")).alias("words"),
                                                      F.lit("").alias("window_id"))), lambda x: F.lit(False))).alias("asked"))
    sure = F.filter("asked", lambda a: (a["start"] + F.size(a["words"]) <= F.size("w")) & F.forall(
        F.sequence(F.lit(0), F.size(a["words"]) - 1), lambda j: F.get("w", a["start"] + j) == F.get(a["words"], j)))
    checked = joined.select("doc_id", "body", F.size("w").cast("long").alias("n_words"), sure.alias("sure"))
    checked = stored(checked.select(
        "doc_id", "body", "n_words",
        F.sort_array(F.transform("sure", lambda a: F.struct(a["start"].alias("start"), F.size(a["words"]).alias("length")))).alias("spans"),
        F.array_distinct(F.transform("sure", lambda a: a["window_id"])).alias("windows")), "contaminated-spans")

    owners = checked.where(F.size("windows") > 0).select("doc_id", "body", F.explode("windows").alias("window_id"))
    owners = owners.join(windows.select("window_id", "item_id").distinct(), "window_id")
    owners = owners.groupBy(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).agg(
        F.sort_array(F.collect_set("item_id")).alias("items"))
    state = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["start"] + s["length"] - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], s["start"] + s["length"]).alias("end")))
    return checked.join(owners, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body")), "left").select(
        "doc_id", "body", "n_words", "spans", state["n"].alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def keep_clean(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """Input rows in which no window of a benchmark item occurs."""
    bad = contamination(docs, items, window).where("n_hit > 0").select(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).distinct()
    here = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_id"]) & (here == bad["_body"]), "left_anti")


def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def _sql_words(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"list_filter(string_split_regex({lowered}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"


OP4_SQL = f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_sql_words('text')} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[s + 1:s + 10], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS r, doc_id, {_sql_words('text')} AS w FROM documents),
g AS (SELECT r, m, s, array_to_string(w[s + 1:s + m], ' ') AS k
  FROM (SELECT r, w, m, unnest(range(0, greatest(len(w) - m + 1, 0))) AS s FROM d, (SELECT DISTINCT m FROM win))),
h AS (SELECT r, s, g.m AS m, item_id FROM g JOIN win USING (m, k)),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + m)) AS p FROM h) GROUP BY r),
o AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN o USING (r)"""
