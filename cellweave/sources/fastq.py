"""FASTQ scan that builds records where their lines lie.

One scan of the text: an Arrow task reads the lines of a file split in order, finds where records begin, and writes whole records. Only the
lines at a split's borders, which belong to a record that begins before it or ends after it, are taken together by
file. Where records begin follows from the lines alone: of the four possible positions only one survives the test that
every record has ``@`` first, ``+`` third and sequence and quality of equal length, for any file that is valid. A split in
which several survive to its end (a few short lines) is handed over whole, and counted in order with the borders.

The records are written once, so that their numbers, which need the sizes of the earlier splits, cost no second scan. What is joined to
them is one row a split, as many as Spark's driver lists anyway.

Records are numbered from 0 inside a file, or inside a folder of part files in the order of their names.

Lines that form no record (a truncated end, a lost line) are given as damaged; records resume at the next
place that passes the test. A gz file is one split, as gz cannot be divided.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.context import settle, written

INNER, HEAD, TAIL, WHOLE, DAMAGED = range(5)
_PARTS = "path string, block long, kind int, at long, name string, seq string, qual string, lines array<string>"
_ARROW = pa.schema([("path", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("at", pa.int64()), ("name", pa.string()),
                    ("seq", pa.string()), ("qual", pa.string()), ("lines", pa.list_(pa.string()))])


def is_record(lines: list[str]) -> bool:
    return lines[0].startswith("@") and lines[2].startswith("+") and len(lines[1]) == len(lines[3])


class Split:
    """Lines of one file split, in portions; gives rows of ``_PARTS``."""

    def __init__(self, path: str, block: int):
        self.path, self.block = path, block
        self.held: list[str] = []  # lines not yet given
        self.open = {0, 1, 2, 3} if block else {0}  # places in ``held`` where a record may begin
        self.tested = 0  # lines that the open places have been tested on
        self.locked, self.found, self.records = not block, not block, 0  # found: the border's lines are given

    def _row(self, kind: int, lines: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"path": self.path, "block": self.block, "kind": kind, "at": -1, "lines": lines}], _ARROW)

    def add(self, lines: list[str]) -> Iterator[pa.RecordBatch]:
        self.held += lines
        while True:
            if not self.locked:
                yield from self._seek()
            if not self.locked or len(self.held) < 4:
                return
            whole = len(self.held) // 4 * 4
            name, seq, plus, qual = (pa.array(self.held[i:whole:4], pa.string()) for i in range(4))
            good = pc.and_(pc.and_(pc.starts_with(name, "@"), pc.starts_with(plus, "+")), pc.equal(pc.utf8_length(seq), pc.utf8_length(qual)))
            bad = pc.index(good, False).as_py()
            n = len(name) if bad < 0 else bad
            if n:
                names = pc.utf8_slice_codeunits(name[:n], 1)
                yield pa.RecordBatch.from_arrays([
                    pa.repeat(self.path, n), pa.array([self.block] * n, pa.int64()), pa.array([INNER] * n, pa.int32()),
                    pa.array(range(self.records, self.records + n), pa.int64()), names, seq[:n], qual[:n], pa.nulls(n, pa.list_(pa.string()))], schema=_ARROW)
                self.records += n
            self.held = self.held[4 * n:]
            if bad < 0:
                return
            self.locked, self.open, self.tested = False, {1, 2, 3}, 0

    def _seek(self) -> Iterator[pa.RecordBatch]:
        """Drop places that a record test refutes; lock when one is left."""
        while len(self.open) > 1 and len(self.held) >= self.tested + 7:
            fits = {p for p in self.open if is_record(self.held[self.tested + p:self.tested + p + 4])}
            # Damage right after several places passed: the first of them stands, and its records end there.
            self.open = fits if fits or not self.tested else {min(self.open)}
            self.tested += 4
        if len(self.open) == 1 and len(self.held) >= self.tested + 7 or not self.open:
            if not self.open:  # none fits: the first lines belong to no record
                yield self._row(DAMAGED if self.found else HEAD, self.held[:4])
                self.found = True  # a record across the border needs no more lines than these
                self.held, self.open, self.tested = self.held[4:], {0, 1, 2, 3}, 0
                yield from self._seek()
                return
            place = self.open.pop()
            if not is_record(self.held[place:place + 4]):
                self.open = set()
                yield from self._seek()
                return
            if place:
                yield self._row(DAMAGED if self.found else HEAD, self.held[:place])
            self.held, self.locked, self.found = self.held[place:], True, True

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            if not self.locked and len(self.held) >= 4:
                fits = [p for p in self.open if p + 4 <= len(self.held) and all(is_record(self.held[i:i + 4]) for i in range(p, len(self.held) - 3, 4))]
                if len(fits) == 1 and self.found:
                    yield self._row(DAMAGED, self.held[:fits[0]])
                    self.held, self.locked = self.held[fits[0]:], True
                    yield from self.add([])
            yield self._row(TAIL if self.found else WHOLE, self.held)
            self.held = []


def _parts(spark: SparkSession, paths) -> DataFrame:
    """Records inside splits, and the lines at their borders."""
    lines = spark.read.text(paths if isinstance(paths, list) else [paths]).select(
        F.regexp_replace("value", "\r$", "").alias("line"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = None
        for batch in batches:
            line, path, block = (batch.column(i) for i in range(3))
            at = 0
            while at < len(batch):  # usually all rows of a batch are of one split
                here = (path[at].as_py(), block[at].as_py())
                same = pc.and_(pc.equal(path[at:], here[0]), pc.equal(block[at:], here[1]))
                first = pc.index(same, False).as_py()
                n = len(same) if first < 0 else first
                if split is None or (split.path, split.block) != here:
                    if split:
                        yield from split.end()
                    split = Split(*here)
                yield from split.add(line[at:at + n].to_pylist())
                at += n
        if split:
            yield from split.end()

    return lines.mapInArrow(build, _PARTS)


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    """Put the border lines of one file together, in order: records across borders, and each split's first record number.

    Part files of one folder follow one another in the order of their names; no record reaches from one into the next.
    """
    out, number = [], 0

    def take(path: str, block: int, lines: list[str], last: bool) -> list[str]:
        """Give the records of the lines, and those between them as damaged; up to three may wait for the next split."""
        nonlocal number
        lost = []
        while len(lines) >= 4:
            if is_record(lines[:4]):
                out.append((path, block, INNER, number, lines[0][1:], lines[1], lines[3], None))
                number += 1
                lines = lines[4:]
            else:
                lost.append(lines[0])
                lines = lines[1:]
        if last:
            lost, lines = lost + lines, []
        if lost:
            out.append((path, block, DAMAGED, -1, None, None, None, lost))
        return lines

    for path, own in pdf.groupby("path", sort=True):
        carried: list[str] = []
        for block, rows in own.groupby("block", sort=True):
            by_kind = dict(list(rows.groupby("kind")))
            for kind in (WHOLE, HEAD):
                for lines in by_kind[kind]["lines"] if kind in by_kind else ():
                    carried += list(lines)
            inside = INNER in by_kind
            carried = take(path, block, carried, inside)
            if inside:
                out.append((path, block, HEAD, number, None, None, None, None))
                number += int(by_kind[INNER]["at"].iloc[0])
            for lines in by_kind[TAIL]["lines"] if TAIL in by_kind else ():
                carried += list(lines)
        take(path, block, carried, True)
    return pd.DataFrame(out, columns=["path", "block", "kind", "at", "name", "seq", "qual", "lines"])


def read_records(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """``(records, damaged)``: ``(path, read_idx, name, seq, qual)`` and ``(path, block, lines)``."""
    parts = written(_parts(spark, paths), "fastq")
    sizes = parts.where(f"kind = {INNER}").groupBy("path", "block").agg(F.count("*").alias("at")).select(
        "path", "block", F.lit(INNER).alias("kind"), "at", F.lit(None).cast("array<string>").alias("lines"))
    borders = parts.where(f"kind IN ({HEAD}, {TAIL}, {WHOLE})").select("path", "block", "kind", "at", "lines").union(sizes)
    source = F.regexp_replace("path", "/part-[^/]*$", "")
    joined = settle(borders.groupBy(source.alias("source")).applyInPandas(_joined, _PARTS))
    first = joined.where(f"kind = {HEAD}").select("path", "block", F.col("at").alias("first"))
    inner = parts.where(f"kind = {INNER}").join(F.broadcast(first), ["path", "block"]).select(
        "path", (F.col("first") + F.col("at")).alias("read_idx"), "name", "seq", "qual")
    across = joined.where(f"kind = {INNER}").select("path", F.col("at").alias("read_idx"), "name", "seq", "qual")
    damaged = parts.where(f"kind = {DAMAGED}").select("path", "block", "lines").union(
        joined.where(f"kind = {DAMAGED}").select("path", "block", "lines"))
    return inner.union(across), damaged
