r"""Secret scan: known forms plus sliding-window Shannon entropy (built-in functions only).

Each text is scanned on its own, without a shuffle. Places are code points, end exclusive. A pattern's
places come from the pieces between its matches: lengths of pieces and matches add up to them.
Candidates of the entropy method are long strings of one character class. A window of ``WINDOW``
characters slides over a candidate; with counts c of its characters the entropy is
log2(W) - sum(c log2 c) / W, and a step changes only the counts of the character that enters and the
one that leaves. A candidate is reported from the first to the last window that reaches the threshold of
its class, unless the allow list matches it or a span of a known form touches it.

Null text counts as empty. Only doc_id and text are read, so further columns cannot clash. Repeated
rows get equal rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import let, table

WINDOW = 20
ASSIGN = (r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
          r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
# Kind, pattern, group whose length counts, shortest length. A run of a class that is too short never holds a
# long enough one, so the length of the last two may stand in the pattern.
BASE = (("assign", ASSIGN, 1, 8), ("access", "AKIA[A-Z0-9]{12,}", 0, 16), ("hex", "[0-9a-f]{32,}", 0, 32))
# Kind, candidate strings, alphabet, least entropy of a window in bits.
ENTROPY = (
    ("entropy_hex", "[0-9A-Fa-f]{20,}", "0123456789abcdef", 3.0),
    ("entropy_base64", "[A-Za-z0-9+/_-]{20,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 3.8),
)
# Strings that look random but are not secret: without a digit, without a letter, words and dates in paths, samples.
ALLOW = ("^[A-Za-z+/_-]+$", "^[0-9+/_-]+$", "^([A-Za-z]+|[0-9]{1,4})([/_-]([A-Za-z]+|[0-9]{1,4}))+$", "[Ee]xample|EXAMPLE|[Xx]{6}")


def _matches(text: Column, pattern: str, group: int) -> Column:
    """Array of (start, hit, part) for the leftmost non-overlapping matches."""
    hits = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x)).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))
    hits = F.filter(hits, lambda z: z["hit"].isNotNull())
    nothing = F.array().cast("array<struct<start:int,hit:string,part:string>>")
    placed = F.aggregate(
        hits, F.struct(F.lit(0).alias("at"), nothing.alias("out")),
        lambda a, z: F.struct(
            (a["at"] + z["gap"] + F.char_length(z["hit"])).alias("at"),
            F.concat(a["out"], F.array(F.struct(
                (a["at"] + z["gap"]).alias("start"), z["hit"].alias("hit"), z["part"].alias("part")))).alias("out")),
        lambda a: a["out"])
    return F.when(text.rlike(pattern), placed).otherwise(nothing)


def _span(rank: int, kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"))


def _weight(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def _dense_part(candidate: Column, alphabet: str, least: float) -> Column:
    """(first, last): from the first window that reaches ``least`` bits to the end of the last; nulls if none does."""

    def slide(codes: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            enters = F.get(codes, i)
            leaves = F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(F.lit(-1))
            gain = _weight(F.get(a["counts"], enters) + 1) - _weight(F.get(a["counts"], enters))
            loss = F.when(leaves >= 0, _weight(F.get(a["counts"], leaves)) - _weight(F.get(a["counts"], leaves) - 1)).otherwise(F.lit(0.0))
            total = a["total"] + F.when(enters == leaves, F.lit(0.0)).otherwise(gain - loss)
            counts = F.transform(a["counts"], lambda c, k: c + F.when(k == enters, 1).otherwise(0) - F.when(k == leaves, 1).otherwise(0))
            reached = (i >= WINDOW - 1) & (F.lit(math.log2(WINDOW)) - total / WINDOW >= least)
            return F.struct(
                counts.alias("counts"), total.alias("total"),
                F.coalesce(a["first"], F.when(reached, i - (WINDOW - 1))).alias("first"),
                F.when(reached, i + 1).otherwise(a["last"]).alias("last"))

        none = F.lit(None).cast("int")
        start = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("total"),
                         none.alias("first"), none.alias("last"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step,
                           lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")))

    return let(F.transform(F.split(candidate, ""), lambda c: F.position(c, F.lit(alphabet)) - 1), slide)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, ``base`` and ``spans``: arrays of (start, rank, kind, end) in order of start and rank."""
    df = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("_text"))
    found = []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        long = F.filter(_matches(F.col("_text"), pattern, group), lambda m: F.char_length(m["part"]) >= least)
        found.append(F.transform(long, lambda m: _span(rank, kind, m["start"], m["start"] + F.char_length(m["hit"]))))
    df = df.withColumn("base", F.sort_array(F.concat(*found)))
    more = []
    for rank, (kind, pattern, alphabet, least) in enumerate(ENTROPY, len(BASE)):
        def allowed(m: Column) -> Column:
            out = F.lit(False)
            for one in ALLOW:
                out = out | m["hit"].rlike(one)
            return out

        open_ = F.filter(_matches(F.col("_text"), pattern, 0), lambda m: ~allowed(m) & ~F.exists(
            "base", lambda b: (b["start"] < m["start"] + F.char_length(m["hit"])) & (m["start"] < b["end"])))
        fold = F.lower if alphabet.islower() else (lambda c: c)
        parts = F.transform(open_, lambda m: F.struct(
            m["start"].alias("start"), _dense_part(fold(m["hit"]), alphabet, least).alias("dense")))
        dense = F.filter(parts, lambda p: p["dense"]["first"].isNotNull())
        more.append(F.transform(dense, lambda p: _span(rank, kind, p["start"] + p["dense"]["first"], p["start"] + p["dense"]["last"])))
    return df.withColumn("spans", F.sort_array(F.concat("base", *more))).drop("_text")


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan(table(spark, folder, "documents"))
    counts = [_count(kind) for kind, *_ in BASE]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def _sql_hits(name: str, rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""{name} AS (SELECT r, {rank} AS rank, '{kind}' AS kind, hits[i] AS hit,
  CAST(coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
    + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s, length(hits[i]) AS n
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (SELECT r, string_split_regex(text, '{p}') AS gaps,
    regexp_extract_all(text, '{p}', 0) AS hits, regexp_extract_all(text, '{p}', {group}) AS parts FROM d))
  WHERE length(parts[i]) >= {least})"""


_base = [_sql_hits(f"b{i}", i, *row) for i, row in enumerate(BASE)]
_more = [_sql_hits(f"e{i}", i + len(BASE), kind, pattern, 0, WINDOW) for i, (kind, pattern, _, _) in enumerate(ENTROPY)]
_least = ", ".join(f"({i + len(BASE)}, {least})" for i, (_, _, _, least) in enumerate(ENTROPY))
_allow = " OR ".join(f"regexp_matches(hit, '{p}')" for p in ALLOW)
OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
{', '.join(_base + _more)},
b AS (SELECT r, rank, kind, s, s + n AS e FROM b0 UNION ALL SELECT r, rank, kind, s, s + n FROM b1 UNION ALL SELECT r, rank, kind, s, s + n FROM b2),
c AS (SELECT * FROM (SELECT * FROM e0 UNION ALL SELECT * FROM e1) x WHERE NOT ({_allow})
  AND NOT EXISTS (SELECT 1 FROM b WHERE b.r = x.r AND b.s < x.s + x.n AND x.s < b.e)),
w AS (SELECT r, rank, kind, s, p, CASE WHEN rank = {len(BASE)} THEN lower(substr(hit, p + 1, {WINDOW})) ELSE substr(hit, p + 1, {WINDOW}) END AS part
  FROM (SELECT *, unnest(range(0, n - {WINDOW - 1})) AS p FROM c)),
f AS (SELECT r, rank, kind, s, p, ch, count(*) AS q FROM (SELECT *, unnest(string_split(part, '')) AS ch FROM w) GROUP BY ALL),
h AS (SELECT r, rank, kind, s, p, log2({WINDOW}) - sum(q * log2(q)) / {WINDOW} AS bits FROM f GROUP BY ALL),
x AS (SELECT r, rank, kind, s + min(p) AS s, s + max(p) + {WINDOW} AS e FROM h JOIN (VALUES {_least}) t(rank, least) USING (rank)
  WHERE bits >= least GROUP BY r, rank, kind, h.s),
l AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS base FROM b GROUP BY r),
a AS (SELECT r, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans FROM (SELECT * FROM b UNION ALL SELECT r, rank, kind, s, e FROM x) GROUP BY r)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
  CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN l USING (r) LEFT JOIN a USING (r)"""
