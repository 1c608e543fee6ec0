import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cellweave.llm import packing
from harness import write

ODD = [None, "", " ", "a", "a b  c   d", " lead", "trail ", "trail  ", "x \n y", "\n \n", "tab\t \tx", "it's we'll don't", "<|endoftext|> z",
       "ünï 東京 12 345", "a b " * 4000, "nul \x00x y", "  x   y", "\x1c \x1d x", "a \u00a0b \u00ad c don't we'll 'tis ŉ ǅ ª º x² ½", "dup text here", "dup text here"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_path())


def test_ids_are_the_tokenizers_ids(tokenizer):
    import duckdb

    texts = [t or "" for t in ODD] + [r[0] for r in duckdb.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet' ").fetchall()]
    got = list(packing.Encoder(packing.tokenizer_path()).encode(texts))
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)[:80]


def test_packing_is_whole_and_gapless(spark, tmp_path, tokenizer):
    folder = write(tmp_path, documents={
        "doc_id": pa.array([*range(len(ODD) - 1), None], pa.int64()), "text": pa.array(ODD, pa.string()), "length": ["x"] * len(ODD), "rank": [1] * len(ODD)})
    rows = packing.op9_best_fit_packing(spark, folder).collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    want = []
    for doc, text in zip([*range(len(ODD) - 1), None], ODD):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want += [(doc, i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert Counter(want) == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)


def test_fullest_matches_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        counts = Counter(rng.randint(1, 12) for _ in range(rng.randint(1, 9)))
        room = rng.randint(0, 40)
        sums = {0}
        for x, n in counts.items():
            sums |= {s + x * k for s in sums for k in range(n + 1)}
        got = packing.fullest(room, dict(counts))
        assert sum(x * n for x, n in got.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[x] for x, n in got.items())


def test_plan_uses_every_piece_and_few_bins():
    rng = random.Random(1)
    counts = Counter(rng.randint(1, 2048) for _ in range(20_000))
    combinations = packing.plan(dict(counts))
    used = Counter()
    for chosen, times in combinations:
        assert sum(x * n for x, n in chosen.items()) <= 2048
        for x, n in chosen.items():
            used[x] += n * times
    assert used == counts
    bins, tokens = sum(t for _, t in combinations), sum(x * n for x, n in counts.items())
    assert bins <= -(-tokens // 2048) * 1.01


def test_empty_table(spark, tmp_path):
    write(tmp_path, documents={"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())})
    assert packing.op9_best_fit_packing(spark, str(tmp_path)).collect() == []


def test_ids_come_along(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, len(r.ids)) for r in packing.pack_documents(docs, with_ids=True).collect()) == [(1, 4), (2, 1)]
