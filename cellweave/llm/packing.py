r"""Best-fit packing by minimum bin slack over the histogram of piece lengths.

Texts become token ids plus one end id; sequences longer than the bin are cut from the end into full
pieces, so that only the first piece may be shorter. A packing depends on lengths alone, and there are at
most ``size`` lengths, so the plan is made on their counts: the largest open length opens a bin, a
bitset subset-sum over the open lengths finds the fullest combination for the rest, and the combination is
used as often as the counts allow before it is removed. The plan has a number of rows that depends on
``size`` only, never on the number of documents, and is broadcast. Pieces take their place in it by their
rank among the pieces of the same length; ranks are counted in hash buckets of bounded size.

Null text counts as empty and gives the end id alone. Every input row is a document of its own, repeated rows and
rows with null doc_id too. Only doc_id and text are read, so further columns cannot clash.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cellweave.llm.common import small_batches, stored, table

SIZE = 2048
END = 0
CACHED_WORDS = 1_000_000  # words whose ids a worker keeps; results don't depend on it
_AWKWARD = re.compile(r"\s (?:\s|$)")
_PLAIN = re.compile("[!-~\u00a1-\u024f]+")  # words without white space, of letters all libraries class alike
# Fixed value: how byte-level vocabularies of this family cut text into words.
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LOADED: dict[str, "Encoder"] = {}


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def merge_ranks(path: str) -> dict[bytes, int] | None:
    """Tokens as bytes with their ids, if ids follow the order of merges; else None."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    vocab = model["vocab"]
    if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)) or any(vocab.get(c, 256) > 255 for c in byte):
        return None
    return {bytes(byte[c] for c in token): i for token, i in vocab.items() if i < 256 + len(pairs)}


class Encoder:
    """Token ids of texts, remembering the ids of words.

    New plain words are encoded together by the faster of two libraries with the same vocabulary, and
    the ids are dealt out by their lengths in bytes.

    The byte-level pre-tokenizer always cuts before a blank that has a non-blank on either side, so a text
    is the concatenation of its blank-led words. Texts with a blank between other white space, or with the
    name of a special token, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks, self.joint = merge_ranks(path), None
        if ranks is not None:
            import tiktoken

            self.joint = tiktoken.Encoding("joint", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.bytes_of = np.zeros(max(ranks.values()) + 1, np.int64)
            self.bytes_of[list(ranks.values())] = list(map(len, ranks))
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts = self.sizes = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if self.joint and _PLAIN.fullmatch(w)]
        if plain:
            ids = np.array(self.joint.encode_ordinary(" " + " ".join(plain)), np.uint32)
            ends = np.cumsum(self.bytes_of[ids])
            limits = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in plain), np.int64, len(plain)))
            last = np.searchsorted(ends, limits) + 1
            self._remember(plain, np.diff(last, prepend=0), ids)
        rest = [w for w in words if not (self.joint and _PLAIN.fullmatch(w))]
        if rest:
            ids = self._whole([" " + w for w in rest])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            self._remember(rest, sizes, np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum())))

    def _remember(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.pool = np.concatenate([self.pool, ids])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.place) > CACHED_WORDS:
            self.clear()
        split = [None if _AWKWARD.search(t) or any(s in t for s in self.special) else t.split(" ") for t in texts]
        new = {w for parts in split if parts for w in parts[1:]}.difference(self.place)
        if new:
            self._learn(list(new))
        heads = iter(self._whole([t if parts is None else parts[0] for t, parts in zip(texts, split)]))
        for parts in split:
            head = np.array(next(heads), np.uint32)
            if not parts or len(parts) == 1:
                yield head
                continue
            at = np.fromiter(map(self.place.__getitem__, parts[1:]), np.int64, len(parts) - 1)
            sizes = self.sizes[at]
            ends = np.cumsum(sizes)
            where = np.arange(ends[-1]) + np.repeat(self.starts[at] - (ends - sizes), sizes)
            yield np.concatenate([head, self.pool[where]])


def pieces(docs: DataFrame, path: str, size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = Encoder(path)
        for batch in batches:
            rows, numbers, starts, lengths, sums, kept = [], [], [], [], [], []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for row, ids in enumerate(_LOADED[path].encode(texts)):
                ids = np.append(ids, end).astype("<u4")
                cuts = [0, *range(len(ids) % size or size, len(ids) + 1, size)]
                for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append(row)
                    numbers.append(number)
                    starts.append(a)
                    lengths.append(b - a)
                    sums.append(zlib.crc32(ids[a:b].tobytes()))
                    if with_ids:
                        kept.append(ids[a:b])
            out = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                   pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out, names = [*out, pa.array(kept, pa.list_(pa.int64()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(cut, schema)


def fullest(room: int, counts: dict[int, int]) -> Counter:
    """The multiset of open lengths with the largest sum up to ``room`` (larger lengths are tried first)."""
    reach, steps, full = 1, [], 1 << room
    mask = (full << 1) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left:  # binary splitting: 1, 2, 4, ... copies reach every number of copies
            take = min(copies, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & mask
            left -= take
            copies *= 2
        if reach & full:
            break
    at, chosen = reach.bit_length() - 1, Counter()
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            chosen[length] += take
            at -= length * take
    return chosen


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[Counter, int]]:
    """Combinations of lengths and how often each is used; every counted piece is used once."""
    open_, out = dict(counts), []
    while open_:
        largest = max(open_)
        rest = {**open_, largest: open_[largest] - 1}
        if not rest[largest]:
            del rest[largest]
        chosen = fullest(size - largest, rest) + Counter({largest: 1})
        times = min(open_[x] // n for x, n in chosen.items())
        out.append((chosen, times))
        for x, n in chosen.items():
            open_[x] -= n * times
            if not open_[x]:
                del open_[x]
    return out


def _slots(combinations: list[tuple[Counter, int]]) -> list[tuple]:
    """Per combination and length: ranks from ``low`` to ``high``, uses per bin, first bin, offset of the first use."""
    used, rows, first = Counter(), [], 0
    for chosen, times in combinations:
        offset = 0
        for length in sorted(chosen, reverse=True):
            n = chosen[length]
            rows.append((length, used[length], used[length] + n * times, n, first, offset))
            used[length] += n * times
            offset += n * length
        first += times
    return rows


def pack(cut: DataFrame, size: int = SIZE) -> DataFrame:
    """Add sequence_id and offset to a stored frame of pieces."""
    spark = cut.sparkSession
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``size`` rows
    total = sum(counts.values())
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = max(256, min(100_000, total // (4 * width)))  # of a bucket; ranks are exact for any number
    buckets = spark.createDataFrame([(x, -(-n // rows)) for x, n in counts.items()], "length long, buckets long")
    slots = spark.createDataFrame(_slots(plan(counts, size)), "length long, low long, high long, uses long, first long, at long")
    others = [c for c in cut.columns if c not in ("ids",)]
    marked = cut.join(F.broadcast(buckets), "length").withColumn("bucket", F.pmod(F.xxhash64(*others), "buckets")).drop("buckets")
    sizes = marked.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("length", "bucket", before.alias("before"))
    inside = F.row_number().over(W.partitionBy("length", "bucket").orderBy(*others))
    ranked = marked.withColumn("rank", inside - 1).join(sizes, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).drop("before", "bucket").withColumnRenamed("length", "_length")
    here = (F.col("_length") == F.col("length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = ranked.join(F.broadcast(slots), here)
    turn = F.col("rank") - F.col("low")
    return placed.select(
        *cut.columns, (F.col("first") + F.floor(turn / F.col("uses"))).cast("long").alias("sequence_id"),
        (F.col("at") + (turn % F.col("uses")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, path: str | None = None, size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    return pack(stored(pieces(docs, path or tokenizer_path(), size, end, with_ids), "pieces"), size)


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"))
