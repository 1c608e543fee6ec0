"""Quality rules: a threshold table compiled into one projection of ratios (built-in functions only).

Every row is judged alone, so there is no shuffle and no group. Null text counts as the empty
text, nulls and further columns pass through, and repeated rows get equal verdicts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import BLANKS, let, stored, table

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that was for it with as be by on at from this are or an a "
    "der die das und in den von zu mit ist ein eine nicht des dem für auf auch sich "
    "de la le les et des en du un une est que pour dans qui par sur au avec "
    "el los las que y del se por para una con no su al lo como"
).split()

# Rule name, ratio, smallest and largest allowed value (None: open).
RULES: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("words", "n_words", 20, None),
    ("repeated", "repeat_ratio", None, 0.30),
    ("word_length", "mean_word_chars", 2.0, 12.0),
    ("symbols", "symbols_per_word", None, 0.20),
    ("shouting", "shouted_word_ratio", None, 0.50),
    ("stop_words", "stop_word_ratio", 0.04, None),
    ("duplicate_lines", "dup_line_ratio", None, 0.50),
)
WINDOW = 8
PROBES = (0, 2, 5, 7)  # places in a window whose words are hashed to find texts that may repeat one


def _windows(words: Column, make) -> Column:
    """One value per 8-word window, in order; empty for fewer words."""
    last = F.size(words) - WINDOW
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), make)).otherwise(
        F.array().cast("array<long>") if make is None else F.slice(F.transform(F.array(F.lit(0)), make), 1, 0))


def _repeat_words(words: Column) -> Column:
    """Words covered by windows that occur at least twice: sort windows, keep equal neighbours, add up the gaps."""
    keyed = F.sort_array(_windows(words, lambda i: F.struct(
        F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("k"), i.alias("p"))))

    def covered(s: Column) -> Column:
        same = F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["k"] == x["k"], F.lit(False))
                        | F.coalesce(F.get(s, j + 1)["k"] == x["k"], F.lit(False)))
        places = F.sort_array(F.transform(same, lambda x: x["p"]))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0).cast("long"), lambda total, x: total + x))

    return let(keyed, covered)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add counts and ratios. Helper columns are dropped; input columns of the same name are replaced."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(f"[^{BLANKS}]"))
    df = docs.withColumn("_words", F.array_remove(F.split(body, f"[{BLANKS}]+", -1), ""))
    df = df.withColumns({
        "_hashes": _windows(F.col("_words"), lambda i: F.hash(*[F.get("_words", i + k) for k in PROBES])),
        "_lines": lines,
        "_bare": F.char_length(F.regexp_replace(body, "[#*$%&|<>]+", "")),
        "_whole": F.char_length(body),
    })
    # Equal windows agree on the probed words, so only texts with equal probes need the exact comparison.
    twice = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.col("_whole") - F.col("_bare")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.when(twice, _repeat_words(F.col("_words"))).otherwise(F.lit(0)).cast("long"),
        "_stop": F.size(F.filter("_words", lambda w: w.isin(STOP_WORDS))),
        "_shouted": F.size(F.filter("_words", lambda w: w.endswith("!!"))),
        "_n_lines": F.size("_lines"),
    })
    words = F.greatest(F.col("n_words"), F.lit(1))
    return df.withColumns({
        "repeat_ratio": F.col("n_repeat_words") / words,
        "mean_word_chars": F.col("word_chars") / words,
        "symbols_per_word": F.col("n_symbols") / words,
        "shouted_word_ratio": F.col("_shouted") / words,
        "stop_word_ratio": F.col("_stop") / words,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)),
    }).drop("_words", "_hashes", "_lines", "_bare", "_whole", "_stop", "_shouted", "_n_lines")


def broken(rule: tuple[str, str, float | None, float | None]) -> Column:
    """The condition under which a row of the threshold table rejects a text."""
    _, ratio, least, most = rule
    low = F.lit(False) if least is None else F.col(ratio) < F.lit(float(least))
    return low if most is None else low | (F.col(ratio) > F.lit(float(most)))


def judge(docs: DataFrame, text: str = "text", rules: Sequence[tuple] = RULES) -> DataFrame:
    """Input columns, counts, ratios, ``base_failed``, ``failed_rules`` and ``kept``."""
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    names = F.array_compact(F.array(*[F.when(broken(r), F.lit(r[0])) for r in rules]))
    fails = reduce(lambda a, b: a | b, [broken(r) for r in rules], F.lit(False))
    return measure(docs, text).withColumns({
        "base_failed": base, "failed_rules": names, "kept": ~(base | fails)})


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[tuple] = RULES) -> DataFrame:
    """Rows that pass every rule, with the input's columns only.

    A filter would be pushed below the projections and then compute every word again for every use of it, so
    verdicts are written before rows are chosen.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    judged = judge(whole.select("_row", F.col(f"_row.{text}").alias("_text")), "_text", rules)
    return stored(judged.select("_row", "kept"), "verdicts").where("kept").select("_row.*")


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql_words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
OP5_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, {_sql_words('text')} AS words,
  list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
g AS (SELECT r, unnest(range(0, greatest(len(words) - 7, 0))) AS p, words FROM w),
k AS (SELECT r, p, array_to_string(words[p + 1:p + 8], ' ') AS k FROM g),
t AS (SELECT r, p, count(*) OVER (PARTITION BY r, k) AS n FROM k),
c AS (SELECT r, least(8, coalesce(lead(p) OVER (PARTITION BY r ORDER BY p) - p, 8)) AS cover FROM t WHERE n > 1),
s AS (SELECT r, CAST(sum(cover) AS BIGINT) AS n_repeat_words FROM c GROUP BY r),
m AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  len(list_filter(words, lambda x: x LIKE '%!!')) AS n_shouted,
  CAST(len(lines) AS BIGINT) AS n_lines,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  len(list_filter(words, lambda x: x IN ({STOPS}))) AS n_stop,
  coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN s USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, CAST(greatest(n_words, 1) AS DOUBLE) AS z FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars / z < 2.0 OR word_chars / z > 12.0 OR n_symbols / z > 0.2 OR n_shouted / z > 0.5
       OR n_stop / z < 0.04 OR n_dup_lines / CAST(greatest(n_lines, 1) AS DOUBLE) > 0.5) AS kept FROM b"""
