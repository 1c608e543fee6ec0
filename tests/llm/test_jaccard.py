import random
from fractions import Fraction

import pyarrow as pa
import pytest

from cellweave.llm import jaccard_join
from cellweave.llm.components import components
from harness import write


def brute(texts, up=90, down=100, size=3):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set())
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and down * len(sets[i] & sets[j]) >= up * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def corpus(seed, count=260):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = " ".join(rng.choice(vocabulary) for _ in range(30))
    texts = [None, "", " \n\t", "one", "ONE", "one two", "one  two", "one two three", "One Two three four", "ünï x y z", "ÜNÏ x y z"]
    while len(texts) < count:
        base = [rng.choice(vocabulary) for _ in range(rng.choice([5, 30, 60, 150]))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                copy.append(rng.choice(vocabulary))
            texts.append((" ".join(copy)).upper() if rng.random() < 0.2 else "\n".join(copy))
        if rng.random() < 0.3:
            texts.append(common + " " + " ".join(base[:20]))
    return texts + ["a b c d e " * 900] * 30


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 8)
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    texts = corpus(seed)
    folder = write(tmp_path, documents={"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string()), "cid": ["x"] * len(texts), "n": [None] * len(texts)})
    got = sorted(tuple(r) for r in jaccard_join.op7_ngram_jaccard_join(spark, folder).collect())
    assert got == [(i, n, c) for i, (n, c) in enumerate(brute(texts))]


@pytest.mark.parametrize("seed", [3, 4])
def test_five_words_match_brute_force(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FREQUENT", 8)
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    texts = corpus(seed)
    folder = write(tmp_path, documents={"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    got = sorted(tuple(r) for r in jaccard_join.linked(spark.read.parquet(f"{folder}/documents.parquet"), 5, Fraction(4, 5)).collect())
    assert got == [(i, n, c) for i, (n, c) in enumerate(brute(texts, 80, 100, 5))]


def test_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    want = brute([r.text for r in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.op7_ngram_jaccard_join(spark, "/root/testdata/sf0.001").collect()}
    assert got == {r.doc_id: (n, rows[c].doc_id) for r, (n, c) in zip(rows, want)}


def test_nulls_repeats_and_empty(spark, tmp_path):
    folder = write(tmp_path, documents={"doc_id": pa.array([None, 5, 5, 3, None, 9], pa.int64()), "text": ["a b c d", "a b c d", "a b c d", "x y z", "q r s t", ""]})
    got = sorted((tuple(r) for r in jaccard_join.op7_ngram_jaccard_join(spark, folder).collect()), key=repr)
    assert got == sorted([(None, 2, 5), (5, 2, 5), (5, 2, 5), (3, 1, 3), (None, 2, None), (9, 0, 9)], key=repr)
    folder = write(tmp_path, documents={"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())})
    assert jaccard_join.op7_ngram_jaccard_join(spark, folder).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3), (300, 200), (200, 250)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a int, b int")).collect()))
    assert {got[i] for i in range(1, 61)} == {1} and {got[i] for i in range(100, 150)} == {100} and got[300] == got[250] == 200
