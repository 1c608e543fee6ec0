r"""Token counts by prefix dynamic programming: the exact count of every prefix of a text, stored as one byte a character.

A byte-level vocabulary of merges is read from its file. Inside a word of the pre-tokenizer the last token of every
prefix is unique: it is the longest token ending there that may follow the last token of the prefix before it. Whether
two tokens may stand side by side is decided by undoing their latest merges at the border: they may, if no merge across
it would have come first. So ``count[j] = count[j - len(token)] + 1`` fills a word from left to right; many words are
filled together, one byte of each at a time, and words longer than ``LONG`` bytes alone. Words of a text add up.

``prefix_counts`` keeps the steps from each prefix to the next; ``tokens_of_prefix`` and ``longest_prefix`` answer how many tokens
the first characters make, and how many characters fit into a budget, from them alone. Counts can fall from one prefix to the
next (a longer prefix may merge better), so the longest prefix within a budget is the last one whose own count fits.

The pre-tokenizer looks ahead in two places, which prefixes must not: white space before a further word, and the
three-letter contractions; both are counted as the cut text would be. Names of special tokens inside a text are one token,
as is the library's default. Letters outside the ranges that all libraries class alike are cut by the library itself.

Null text counts as empty (no bytes, no tokens). Every row is a document of its own, repeated rows and null ids too. Only
doc_id and text are read, so further columns cannot clash. One text is held in a task whole, with a few bytes a character.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import small_batches, table
from cellweave.llm.packing import WORD_PATTERN, tokenizer_path

LIMIT = 512
LONG = 64  # bytes; longer words are filled one at a time
CACHED_WORDS = 500_000  # words whose steps a worker keeps; results don't depend on it
CELLS = 1 << 22  # bytes of words filled together
NEVER = np.int64(1) << 40
_WORDS = regex.compile(WORD_PATTERN)
_BLANK = regex.compile(r"\s+")
_CONTRACTION = regex.compile("'(?:re|ve|ll)")
# Characters whose class is the same in every Unicode version in use: Latin, Greek, Cyrillic, punctuation, kana, Han, Hangul.
_SETTLED = regex.compile("[\x00-ͷЀ-ԯ‐-‧‰-⁞ぁ-ゖァ-ヺ一-龥가-힣]*")
_LOADED: dict[str, "PrefixCounter"] = {}


class Memo:
    """Remembers a function of two numbers for arrays of them; every slot is verified, so a shared slot costs time only."""

    def __init__(self, function, width: int, bits: int = 20):
        self.function, self.width, self.shift = function, width, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int32)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.width + b
        slot = (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift
        out = self.values[slot]
        missed = np.flatnonzero(self.keys[slot] != key)
        if len(missed):
            new, where = np.unique(key[missed], return_inverse=True)
            values = self.function(new // self.width, new % self.width).astype(np.int32)
            out[missed] = values[where]
            slot = (new.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift
            self.keys[slot] = new
            won = self.keys[slot] == new
            self.values[slot[won]] = values[won]
        return out


def _merges(path: str) -> tuple[list[tuple[int, int]], list[bytes]]:
    """Merges in order as pairs of token numbers, and the bytes of every token: bytes come first, then one token a merge."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    number = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    spelled, pairs = [bytes([b]) for b in range(256)], []
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        pairs.append((number[left], number[right]))
        if left + right in number:
            raise ValueError(f"two merges make the token {left + right!r}")
        number[left + right] = len(spelled)
        spelled.append(spelled[pairs[-1][0]] + spelled[pairs[-1][1]])
    return pairs, spelled


class PrefixCounter:
    """Steps of the token count from prefix to prefix, for texts; remembers the steps of words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        self.cut_by_library = library.pre_tokenizer.pre_tokenize_str
        special = [t.content for t in library.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        pairs, spelled = _merges(path)
        self.count = len(spelled)
        self.left, self.right = np.arange(self.count), np.arange(self.count)
        self.left[256:], self.right[256:] = np.array(pairs, np.int64).T if pairs else ([], [])
        keys = self.left[256:] * self.count + self.right[256:]
        order = np.argsort(keys)
        self.pair_keys, self.pair_tokens = keys[order], 256 + order
        self.follows = Memo(self._follows, self.count)
        numbers = np.arange(256, self.count)
        whole = np.ones(self.count, bool)  # tokens that their own bytes give
        whole[256:] = self._follows(self.left[256:], self.right[256:], numbers)
        for t, good in zip(numbers, whole[256:]):
            whole[t] = good and whole[self.left[t]] and whole[self.right[t]]
        self._automaton(spelled, whole)
        self.length = np.fromiter(map(len, spelled), np.int64, self.count)
        self.kind = np.int8 if max(self.length) <= 128 else np.int16
        self.lists = None
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.starts = self.sizes = self.totals = np.zeros(0, np.int64)
        self.blank = self.leads = np.zeros(0, bool)
        self.pool = np.zeros(0, self.kind)

    def _merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The token that a merge makes of a pair, else NEVER."""
        if not len(self.pair_keys):
            return np.full(len(a), NEVER)
        key = a * self.count + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_tokens[at], NEVER)

    def _follows(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge across the border of a and b comes before the merges that made them (or before ``before``)."""
        good, live = np.ones(len(a), bool), np.arange(len(a))
        until = np.full(len(a), NEVER) if before is None else before
        while len(live):
            crossing = self._merged(a, b) < until
            good[live[crossing]] = False
            on = ~crossing & ((a > 255) | (b > 255))
            live, a, b = live[on], a[on], b[on]
            undo = a > b  # the later merge is undone; of equal ones the right one came later
            until = np.where(undo, a, b + 1)  # an equal merge across comes before one to its right, after one to its left
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return good

    def _automaton(self, spelled: list[bytes], whole: np.ndarray) -> None:
        """Prefix tree of the tokens with, per node, the next shorter suffix that is a node, and the longest token ending there."""
        edges: dict[int, int] = {}
        token, depth = [-1], [0]
        for t in np.flatnonzero(whole):
            node = 0
            for byte in spelled[t]:
                key = node << 8 | byte
                if key not in edges:
                    edges[key] = len(token)
                    token.append(-1)
                    depth.append(depth[node] + 1)
                node = edges[key]
            token[node] = int(t)
        shorter, longest, suffix = [0] * len(token), list(token), [-1] * self.count
        for key in sorted(edges, key=lambda key: depth[key >> 8]):
            node, at, byte = edges[key], key >> 8, key & 255
            while at:
                at = shorter[at]
                if at << 8 | byte in edges:
                    shorter[node] = edges[at << 8 | byte]
                    break
            below = longest[shorter[node]]
            if token[node] >= 0:
                suffix[token[node]] = below
            else:
                longest[node] = below
        self.edges = edges
        self.edge_keys = np.array(sorted(edges), np.int64)
        self.edge_ends = np.array([edges[k] for k in sorted(edges)], np.int64)
        self.shorter, self.longest, self.suffix = np.array(shorter), np.array(longest), np.array(suffix)
        self.advance = Memo(self._advance, 256)

    def _advance(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        out, live = np.zeros(len(node), np.int64), np.arange(len(node))
        while len(live):
            key = node << 8 | byte
            at = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
            found = self.edge_keys[at] == key
            out[live[found]] = self.edge_ends[at[found]]
            on = ~found & (node > 0)
            live, node, byte = live[on], self.shorter[node[on]], byte[on]
        return out

    def _fill(self, words: list[bytes]) -> list[np.ndarray]:
        """Counts of all byte prefixes of words of at most LONG bytes, as one array each; the words are given longest first."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        width = int(sizes[0])
        data = np.zeros((len(words), width), np.int64)
        data[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        last = np.full((len(words), width + 1), -1)
        counts = np.zeros((len(words), width + 1), np.int64)
        node = np.zeros(len(words), np.int64)
        for j in range(1, width + 1):
            n = int(np.searchsorted(-sizes, -j, side="right"))  # words with a byte here
            node = self.advance(node[:n], data[:n, j - 1]).astype(np.int64)
            rows, token = np.arange(n), self.longest[node]
            while len(rows):
                before = j - self.length[token]
                previous = last[rows, before]
                good = previous < 0
                inner = np.flatnonzero(~good)
                good[inner] = self.follows(previous[inner], token[inner]) > 0
                done = rows[good]
                last[done, j] = token[good]
                counts[done, j] = counts[done, before[good]] + 1
                rows, token = rows[~good], self.suffix[token[~good]]
        return [counts[i, 1:s + 1] for i, s in enumerate(sizes)]

    def _fill_long(self, word: bytes) -> np.ndarray:
        """The same for one long word, byte by byte."""
        if self.lists is None:
            self.lists = [x.tolist() for x in (self.shorter, self.longest, self.suffix, self.length)]
            self.known: dict[tuple[int, int], bool] = {}
        shorter, longest, suffix, length = self.lists
        edges, known = self.edges, self.known
        last, counts, node = [-1], [0], 0
        for j, byte in enumerate(word, 1):
            while node and node << 8 | byte not in edges:
                node = shorter[node]
            node = edges.get(node << 8 | byte, 0)
            token = longest[node]
            while True:
                before = j - length[token]
                pair = (last[before], token)
                if before and pair not in known:
                    if len(known) > CACHED_WORDS:
                        known.clear()
                    known[pair] = bool(self._follows(np.array(pair[:1]), np.array(pair[1:]))[0])
                if not before or known[pair]:
                    break
                token = suffix[token]
            last.append(token)
            counts.append(counts[before] + 1)
        return np.array(counts[1:], np.int64)

    def _learn(self, words: list[str]) -> None:
        spelled = sorted(((w.encode(), w) for w in words), key=lambda x: -len(x[0]))
        filled, at = [], 0
        while at < len(spelled):
            size = len(spelled[at][0])
            if size > LONG:
                filled.append(self._fill_long(spelled[at][0]))
                at += 1
            else:
                end = at + max(1, CELLS // (size + 1))
                filled += self._fill([b for b, _ in spelled[at:end]])
                at = min(end, len(spelled))
        kept = []
        for (data, word), counts in zip(spelled, filled):
            if len(data) != len(word):  # only ends of characters are prefixes of the text
                starts = np.frombuffer(data, np.uint8) & 0xC0 != 0x80
                counts = counts[np.append(starts[1:], True)]
            if _CONTRACTION.fullmatch(word):  # its first two characters would be two words
                counts = counts.copy()
                counts[1] = counts[0] + 1
            kept.append(counts)
        sizes = np.fromiter(map(len, kept), np.int64, len(kept))
        flat = np.concatenate(kept)
        ends = np.cumsum(sizes)
        steps = np.diff(flat, prepend=0)
        steps[ends[:-1]] = flat[ends[:-1]]
        names = [w for _, w in spelled]
        self.place.update(zip(names, range(len(self.place), len(self.place) + len(names))))
        self.starts = np.concatenate([self.starts, len(self.pool) + ends - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.totals = np.concatenate([self.totals, flat[ends - 1]])
        self.pool = np.concatenate([self.pool, steps.astype(self.kind)])
        lead = [_BLANK.match(w) for w in names]
        self.leads = np.concatenate([self.leads, [m is not None for m in lead]])
        self.blank = np.concatenate([self.blank, [m is not None and m.end() == len(w) for m, w in zip(lead, names)]])

    def _cut(self, text: str) -> list[str]:
        if _SETTLED.fullmatch(text):
            return _WORDS.findall(text)
        return [text[a:b] for _, (a, b) in self.cut_by_library(text)]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Steps of texts in which no special token is looked for."""
        if len(self.place) > CACHED_WORDS:
            self.clear()
        cut = [self._cut(t) for t in texts]
        new = {w for words in cut for w in words}.difference(self.place)
        if new:
            self._learn(list(new))
        out = []
        for words in cut:
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            sizes = self.sizes[at]
            ends = np.cumsum(sizes)
            begins = ends - sizes
            steps = self.pool[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[at] - begins, sizes)]
            for i in np.flatnonzero(self.blank[at[:-1]] & self.leads[at[1:]]):  # cut here, the white space would be one word
                joint = words[i] + words[i + 1][0]
                if joint not in self.place:
                    self._learn([joint])
                place, first = int(begins[i + 1]), self.pool[self.starts[at[i + 1]]]
                change = self.totals[self.place[joint]] - self.totals[at[i]] - first
                steps[place] += change
                if place + 1 < len(steps):
                    steps[place + 1] -= change
            out.append(steps)
        return out

    def steps(self, texts: list[str]) -> list[np.ndarray]:
        """Per text, how much every character changes the number of tokens."""
        out = self._plain(texts)
        for i, text in enumerate(texts):
            if self.special and self.special.search(text):
                out[i] = self._with_special(text)
        return out

    def _with_special(self, text: str) -> np.ndarray:
        parts, at = [], 0
        for found in self.special.finditer(text):
            (steps,) = self._plain([text[at:found.end()]])  # until its last character the name is ordinary text
            inside = found.start() - at
            steps = steps.copy()
            steps[-1] = 1 - int(steps[inside:-1].sum(dtype=np.int64))
            parts.append(steps)
            at = found.end()
        return np.concatenate([*parts, *self._plain([text[at:]])])


def _counter(path: str) -> PrefixCounter:
    if path not in _LOADED:
        _LOADED[path] = PrefixCounter(path)
    return _LOADED[path]


def _last_within(steps: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    fits = np.flatnonzero(np.cumsum(steps, dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, with_prefixes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_tokens, kept_chars (of the longest prefix with at most ``limit`` tokens) and, if asked for, prefixes."""
    path = path or tokenizer_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            totals, kept, tables = [], [], []
            for steps in counter.steps(texts):
                total = int(steps.sum(dtype=np.int64))  # the last prefix is the text
                totals.append(total)
                kept.append(len(steps) if total <= limit else _last_within(steps, limit))
                if with_prefixes:
                    tables.append(steps.astype("<i2").tobytes() if counter.kind is np.int16 else steps.tobytes())
            out = [batch.column(0), batch.column(2), pa.array(totals, pa.int64()), pa.array(kept, pa.int64())]
            names = ["doc_id", "n_bytes", "n_tokens", "kept_chars"]
            if with_prefixes:
                out += [pa.array(tables, pa.binary()), pa.array([counter.kind().nbytes] * len(texts), pa.int32())]
                names += ["prefixes", "step_bytes"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_tokens long, kept_chars long" + ", prefixes binary, step_bytes int" * with_prefixes
    text = F.col("text").cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")
    return docs.select("doc_id", text.alias("text"), size).mapInArrow(count, schema)


def _table(prefixes: bytes, width: int) -> np.ndarray:
    return np.frombuffer(prefixes, f"<i{width}")


def tokens_of_prefix(prefixes: Column, step_bytes: Column, characters: Column) -> Column:
    """Tokens of the first ``characters`` characters; null where the text has fewer, or any part is null."""

    @F.pandas_udf("long")
    def look(prefixes: pd.Series, width: pd.Series, at: pd.Series) -> pd.Series:
        out = []
        for table_, w, n in zip(prefixes, width, at):
            known = table_ is not None and not pd.isna(n) and 0 <= n <= len(table_) // int(w)
            out.append(int(_table(table_, int(w))[:int(n)].sum(dtype=np.int64)) if known else None)
        return pd.Series(out, dtype="Int64")

    return look(prefixes, step_bytes, characters)


def longest_prefix(prefixes: Column, step_bytes: Column, budget: Column) -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens; 0 where nothing fits, null where any part is null."""

    @F.pandas_udf("long")
    def look(prefixes: pd.Series, width: pd.Series, budget: pd.Series) -> pd.Series:
        out = [None if t is None or pd.isna(b) else _last_within(_table(t, int(w)), int(b)) for t, w, b in zip(prefixes, width, budget)]
        return pd.Series(out, dtype="Int64")

    return look(prefixes, step_bytes, budget)


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = prefix_counts(table(spark, folder, "documents"), with_prefixes=False)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), "kept_chars")
