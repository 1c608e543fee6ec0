r"""Periodic runs of words by online dyadic square catching.

Words of a text arrive one after another. Every completed block of 2**k words at a multiple of 2**k is a catcher: it waits for
its next copy at a distance q from 2**(k+1) up to 2**(k+2), so at any time two blocks of a level wait at a given place. A square of
period q holds such a block in its first half whole, and the copy in its second half. Blocks have names by doubling (the
names of their halves), and the window ending at the last word is looked up level by level only as long as its halves have been
seen, so ordinary prose costs a few lookups a word. A caught copy is compared backwards; the earliest block of a periodic
stretch catches it, later ones see a whole block agree before them and stay silent. The comparison is finished when the word that
completes the square arrives; from then on every further word advances it, and squares of one stretch and period are one run, which
a word that breaks the period closes. Periods 1 to 3 are compared word by word.

A run is a stretch of words with smallest period q that no neighbouring word extends, of at least max(least, 2 * q) words. A stretch
inside a run whose period divides q is not reported. Words are maximal runs without 0x09-0x0D and 0x20, compared exactly.

Null and empty texts have no runs and collapse to an empty text. Every row is a document of its own, repeated rows and null ids too.
Only doc_id and text are read, so further columns cannot clash. One text is held in a task whole; time grows with n log n for n words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import BLANKS, let, small_batches, table

LEAST = 12
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class SquareCatcher:
    """Runs of a growing sequence of small numbers; ``extend`` appends, ``runs`` gives those closed and those going on."""

    def __init__(self, least: int = LEAST):
        self.least = least
        self.words: list[int] = []
        self.blocks: list[list[int]] = [[], []]  # names of completed blocks, from level 1
        self.names: list[dict] = [{}, {}]
        self.seen: list[dict[int, int]] = [{}, {}]  # last place of a window -> name of an equal block
        self.same = [0, 0, 0, 0]  # words agreeing with that one 1, 2 or 3 before
        self.going: list[tuple[int, int]] = []  # (period, start) of squares reported and not yet broken
        self.due: dict[int, list[tuple[int, int, int]]] = {}
        self.closed: list[tuple[int, int, int]] = []

    def extend(self, words: Iterable[int]) -> None:
        t, same, due = self.words, self.same, self.due
        pairs, seen, pair_blocks = self.names[1], self.seen[1], self.blocks[1]
        one, two, three = same[1:]
        last = t[-1] if t else -1
        for m, word in enumerate(words, len(t)):
            t.append(word)
            if self.going:
                self._advance(m)
            if word == last:
                one += 1
                if one == 1:
                    self._report(1, m - 1)
            else:
                one = 0
            if m > 1 and word == t[m - 2]:
                two += 1
                if two == 2:
                    self._report(2, m - 3)
            else:
                two = 0
            if m > 2 and word == t[m - 3]:
                three += 1
                if three == 3:
                    self._report(3, m - 5)
            else:
                three = 0
            key = last << 32 | word
            name = pairs.get(key) if m else None
            if name is not None:
                seen[m] = name
                self._catch(1, m, name)
                if m - 2 in seen:
                    self._climb(m, name)
            if m & 1:
                if name is None:
                    name = pairs[key] = len(pairs)
                pair_blocks.append(name)
                if m & 3 == 3:
                    self._complete(m)
            if m in due:
                for period, start, agreed in due.pop(m):
                    if t[agreed + 1] == t[agreed + 1 - period] and t[agreed + 1:m + 1] == t[agreed + 1 - period:m + 1 - period]:
                        self._report(period, start)
            last = word
        same[1:] = one, two, three

    def _climb(self, m: int, name: int) -> None:
        """Look up the longer windows ending here while both halves are known."""
        level = 2
        while level < len(self.blocks):
            before = self.seen[level - 1].get(m - (1 << level - 1))
            name = None if before is None else self.names[level].get((before, name))
            if name is None:
                return
            self.seen[level][m] = name
            self._catch(level, m, name)
            level += 1

    def _complete(self, m: int) -> None:
        """Name the blocks of four and more words that end here."""
        level = 2
        while (m + 1) % (1 << level) == 0:
            if level == len(self.blocks):
                self.blocks.append([])
                self.names.append({})
                self.seen.append({})
            halves = self.blocks[level - 1]
            names = self.names[level]
            self.blocks[level].append(names.setdefault((halves[-2], halves[-1]), len(names)))
            level += 1

    def _catch(self, level: int, m: int, name: int) -> None:
        """Compare the two waiting blocks with the window ending here; schedule the end of a square that may follow."""
        t, size, blocks = self.words, 1 << level, self.blocks[level]
        copy = m + 1 - size
        block = (copy - 2 * size) >> level
        for block in (block, block - 1):
            period = copy - (block << level)
            if block < 0 or period >= 4 * size or blocks[block] != name:
                continue
            start = block << level
            if any(p <= size and period % p == 0 and begin <= start for p, begin in self.going):
                continue
            if start and t[start - 1] == t[start + period - 1]:
                if t[start - size:start] == t[start + period - size:start + period]:
                    continue  # the block before has caught this stretch
                low, high = 1, size
                while high - low > 1:
                    middle = (low + high) // 2
                    if t[start - middle:start] == t[start + period - middle:start + period]:
                        low = middle
                    else:
                        high = middle
                start -= low
            self.due.setdefault(start + 2 * period - 1, []).append((period, start, m))

    def _report(self, period: int, start: int) -> None:
        """A square has just been completed: a run goes on, unless one whose period divides this one covers it."""
        if not any(period % p == 0 and begin <= start for p, begin in self.going):
            self.going.append((period, start))

    def _advance(self, m: int) -> None:
        t, broken = self.words, False
        for period, start in self.going:
            if t[m] != t[m - period]:
                broken = True
                self._close(period, start, m)
        if broken:
            self.going = [x for x in self.going if t[m] == t[m - x[0]]]

    def _close(self, period: int, start: int, end: int) -> None:
        if end - start >= max(self.least, 2 * period):
            self.closed.append((start, end - start, period))

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) by start and period; runs going on count as far as they have come."""
        going = [(s, len(self.words) - s, p) for p, s in self.going if len(self.words) - s >= max(self.least, 2 * p)]
        return sorted(self.closed + going, key=lambda r: (r[0], r[2]))


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run repeats: in every run only its first period stays."""
    if not runs:
        return words
    out, at = [], 0
    for begin, end in sorted((start + period, start + length) for start, length, period in runs):
        if end > at:
            out += words[at:max(at, begin)]
            at = end
    return out + words[at:]


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, runs (start, length and period in words, by start and period), and the text without repeated words."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts = [], []
            for text in batch.column(1).to_pylist():
                words = (text or "").encode().split()  # bytes split at ASCII white space only
                codes: dict[bytes, int] = {}
                catcher = SquareCatcher(least)
                catcher.extend([codes.setdefault(w, len(codes)) for w in words])
                runs = catcher.runs()
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                texts.append(b" ".join(kept_words(words, runs)).decode())
            kind = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, kind), pa.array(texts, pa.string())], names=["doc_id", "runs", "collapsed"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(find, f"doc_id {kind}, runs {RUNS}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document by hash is made periodic from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def rewritten(words: Column) -> Column:
        n = F.greatest(F.size(words), F.lit(1))
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        taken = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p)))
        return F.array_join(taken, " ", "")

    text = F.col("text").cast("string")
    words = F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != "")
    return docs.select("doc_id", F.when(h % 10 == 0, let(words, rewritten)).otherwise(text).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(with_planted_runs(table(spark, folder, "documents")))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), -r["start"], -r["period"])))
    digests = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("best"),
                           F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                           F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    best = F.col("best")
    period = -best["col3"]
    return digests.select(
        "doc_id", "n_runs", (-best["col2"]).alias("start"), best["n"].alias("length"), period.alias("period"),
        F.floor(1000 * best["n"] / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
