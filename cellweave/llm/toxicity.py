r"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

Labelled rows with crc32(doc_id as text) mod 3 = 1 are held out and never read for learning. Of the others,
remainder 0 teaches the lexicon (words and word beginnings far more frequent in toxic texts), and remainder 2 the
trees (three quarters) and the calibration (one quarter). At most about ``rows`` labelled rows are
used, chosen by a hash of doc_id; everything else covers all rows. Features are shares per word or per byte, so they
don't grow with the text: lexicon densities, second-person proximity, capitals, punctuation, obfuscation.

Null text counts as empty and gets a score. Rows with null doc_id are scored and not held out; labels that are null are
no labels. Without both classes among the learning rows every score is the share of toxic rows (0 without rows).
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import small_batches, stored, table

ROWS = 24_000  # labelled rows that are used at most, about
PREFIX = 4
LEXICON = 2_000  # entries of the lexicon at most
FEATURES = ["word_share", "prefix_share", "word_hits", "prefix_hits", "near_you", "you_share", "capitals", "punctuation", "obfuscated", "stretched", "length"]
# Second-person words of four languages.
YOU = frozenset("you your yours yourself u du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos ti usted ustedes tus vosotros".split())
_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(rb"[A-Za-z][*@$!#0-9]+[A-Za-z]")
_STRETCHED = re.compile(rb"([A-Za-z])\1\1")


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learning_rows(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """text, toxic, part: ``lexicon``, ``trees`` or ``calibration``."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    share = min(1.0, rows / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(share * 1_000_003)).dropDuplicates(["doc_id"])
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    part = F.when(rest == 0, "lexicon").when(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(4)) == 0, "calibration").otherwise("trees")
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", part.alias("part"))


def learn_lexicon(rows: DataFrame) -> tuple[frozenset, frozenset]:
    """Words, and word beginnings, whose share of toxic texts is far above their share of others."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, names, toxic = [], [], []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(_words(text or ""))
                for kind, own in (("word", words), ("prefix", {w[:PREFIX] for w in words if len(w) > PREFIX})):
                    kinds += [kind] * len(own)
                    names += own
                    toxic += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(names, pa.string()), pa.array(toxic, pa.int64())], names=["kind", "name", "toxic"])

    total = rows.agg(F.sum("toxic").alias("bad"), F.count("*").alias("n")).first()
    bad, good = total["bad"] or 0, (total["n"] or 0) - (total["bad"] or 0)
    if not bad or not good:
        return frozenset(), frozenset()
    seen = rows.select("text", "toxic").mapInArrow(tokens, "kind string, name string, toxic long").groupBy("kind", "name").agg(
        F.sum("toxic").alias("a"), F.count("*").alias("n"))
    lift = (F.col("a") / bad) / ((F.col("n") - F.col("a") + 0.5) / good)
    top = seen.where((F.col("a") >= 4) & (lift >= 6)).orderBy(lift.desc(), "kind", "name").limit(LEXICON).collect()
    return (frozenset(r["name"] for r in top if r["kind"] == "word"), frozenset(r["name"] for r in top if r["kind"] == "prefix"))


def text_features(text: str, words: frozenset, prefixes: frozenset) -> list[float]:
    own = _words(text)
    data = text.encode()
    n, size = max(len(own), 1), max(len(data), 1)
    hits = [i for i, w in enumerate(own) if w in words]
    starts = [i for i, w in enumerate(own) if w[:PREFIX] in prefixes and len(w) > PREFIX]
    you = [i for i, w in enumerate(own) if w in YOU]
    near = 0
    if you and (hits or starts):
        places = np.array(you)
        for i in {*hits, *starts}:
            at = int(np.searchsorted(places, i))
            near += any(abs(int(places[k]) - i) <= 5 for k in (at - 1, at) if 0 <= k < len(places))
    letters = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    marks = int(letters[33:48].sum() + letters[58:65].sum())
    return [len(hits) / n, len(starts) / n, math.log1p(len(hits)), math.log1p(len(starts)), near / n, len(you) / n, int(letters[65:91].sum()) / size,
            marks / size, len(_MASKED.findall(data)) / n, len(_STRETCHED.findall(data)) / n, math.log1p(len(own))]


def with_features(df: DataFrame, words: frozenset, prefixes: frozenset) -> DataFrame:
    """Replace the column ``text`` by the features; other columns stay."""
    others = [c for c in df.columns if c != "text"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_features(t or "", words, prefixes) for t in batch.column(batch.num_columns - 1).to_pylist()]
            values = np.array(rows, float).reshape(len(rows), len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(values[:, k]) for k in range(len(FEATURES))]], names=[*others, *FEATURES])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*others).schema] + [f"{f} double" for f in FEATURES])
    return df.select(*others, "text").mapInArrow(make, schema)


def score(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """doc_id, held_out, score for every row of ``docs``."""
    small_batches(docs.sparkSession)
    learning = stored(learning_rows(docs, labels, rows), "labelled")
    parts = {r["part"]: (r["n"], r["bad"]) for r in learning.groupBy("part").agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).collect()}
    out = docs.select("doc_id", held_out().alias("held_out"), "text")
    if any(not 0 < parts.get(p, (0, 0))[1] < parts.get(p, (0, 0))[0] for p in ("trees", "calibration")):
        n, bad = (sum(x) for x in zip((0, 0), *parts.values()))
        return out.select("doc_id", "held_out", F.lit(bad / n if n else 0.0).alias("score"))
    words, prefixes = learn_lexicon(learning.where("part = 'lexicon'"))
    gather = VectorAssembler(inputCols=FEATURES, outputCol="features")
    known = gather.transform(stored(with_features(learning.where("part <> 'lexicon'"), words, prefixes), "features"))
    trees = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=20, maxDepth=3, stepSize=0.3, seed=7).fit(known.where("part = 'trees'"))

    def raw(df: DataFrame) -> DataFrame:
        return trees.transform(df).withColumn("raw", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")

    curve = IsotonicRegression(labelCol="label", featuresCol="raw", predictionCol="smooth").fit(
        raw(known.where("part = 'calibration'")).select("raw", F.col("toxic").cast("double").alias("label")))
    scored = curve.transform(raw(gather.transform(with_features(out, words, prefixes))))
    # Steps of the curve are ties; the trees' own probability orders rows inside a step.
    value = F.least(F.greatest(0.99 * F.col("smooth") + 0.01 * F.col("raw"), F.lit(0.0)), F.lit(1.0))
    return scored.select("doc_id", "held_out", value.alias("score"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    out = score(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))
