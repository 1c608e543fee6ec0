import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from cellweave.llm import substring_dedup as sd
from harness import write


def brute(rows):
    """All pairs of pieces by exact Jaccard, components, and the copies that aren't first."""
    places = []
    for doc, text in dict.fromkeys(rows):
        words = (text or "").lower().split()
        hashes, _ = sd.word_hashes([(text or "").encode()])
        cuts = sd.cut_points(hashes)
        for a, b in zip(cuts, cuts[1:]):
            if b - a >= sd.SHINGLE:
                places.append((doc, int(a), int(b), frozenset(tuple(words[i:i + 5]) for i in range(a, b - 4))))
    root = list(range(len(places)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = defaultdict(list)
    for i, p in enumerate(places):
        for s in p[3]:
            by[s].append(i)
    for own in by.values():
        for i in own:
            for j in own:
                if i < j and find(i) != find(j):
                    x, y = places[i][3], places[j][3]
                    if 10 * len(x & y) >= 8 * len(x | y):
                        root[find(j)] = find(i)
    clusters = defaultdict(list)
    for i, p in enumerate(places):
        clusters[find(i)].append(p[:3])
    return {p for own in clusters.values() for p in own if p != min(own)}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(2000)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([20, 55, 80]))] for _ in range(6)]
    texts = [None, "", "a b", " ".join(passages[0])]
    for _ in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 120))]
        for p in rng.sample(passages, rng.randint(0, 2)):
            p = list(p)
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = p
        texts.append("\n".join(words) if rng.random() < 0.3 else " ".join(words).upper())
    return texts + ["same words again and again " * 30, "same words again and again " * 30]


def test_pieces_and_passages(spark, tmp_path):
    texts = corpus(5)
    folder = write(tmp_path, documents={"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string()), "name": ["x"] * len(texts), "first": [0] * len(texts)})
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {(r.doc_id, r["first"], r["last"]) for r in sd.copies(docs).collect()}
    want = brute(list(enumerate(texts)))
    assert len(got ^ want) <= 0.02 * len(want) and got <= want
    spans = sd.op3_substring_dedup(spark, folder).collect()
    assert all(r.n_words >= sd.MIN_WORDS and r.end_word - r.start_word >= r.n_words for r in spans)


def test_planted_passages_are_found_and_clean_texts_left(spark):
    rng = random.Random(9)
    words = lambda n: [rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randint(1, 3) + str(rng.randint(0, 999)) for _ in range(n)]
    planted = [words(52) for _ in range(40)]
    rows = [(i, " ".join(words(70) + planted[i % 40] + words(70))) for i in range(80)] + [(100 + i, " ".join(words(150))) for i in range(40)]
    found = sd.passages(sd.copies(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert len({r.doc_id for r in found}) >= 39 and all(40 <= r.doc_id < 80 and r.kept_doc_ids == [r.doc_id - 40] for r in found)


def test_nulls_repeats_and_empty(spark):
    long = " ".join(f"w{i}" for i in range(90))
    schema = "doc_id long, text string"
    assert sd.copies(spark.createDataFrame([], schema)).collect() == []
    assert sd.copies(spark.createDataFrame([(1, long), (1, long), (None, None)], schema)).collect() == []
    got = sd.passages(sd.copies(spark.createDataFrame([(None, long), (1, long), (2, "x y"), (1, long)], schema))).collect()
    assert [(r.doc_id, r.kept_doc_ids) for r in got] in ([(1, [])], [(1, [None])])


def test_every_exact_run_and_edited_paragraph_is_found(spark, tmp_path):
    rng = random.Random(21)
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    rows, spans, edited = [], {}, []
    for i in range(800):
        size = rng.choice([50, 51, 55, 60])
        run, at = words(size), rng.randint(20, 60)
        rows += [(i, " ".join(words(rng.randint(20, 60)) + run + words(30))), (10_000 + i, " ".join(words(at) + run + words(30)))]
        spans[10_000 + i] = (at, at + size)
    for i in range(20_000, 20_300):
        run = words(60)
        changed = run[:30] + ["changed"] + run[31:]
        rows += [(i, " ".join(words(40) + run + words(40))), (10_000 + i, " ".join(words(40) + changed + words(40)))]
        edited.append(10_000 + i)
    rows += [(50_000 + i, " ".join(words(150))) for i in range(40)]
    folder = write(tmp_path, documents={"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    found = {r.doc_id: (r.start_word, r.end_word, r.n_words, r.kept_doc_ids) for r in sd.op3_substring_dedup(spark, folder).collect()}
    for d, (a, b) in spans.items():  # a piece of similarity 0.8 may reach some words beyond the run
        start, end, n, kept = found[d]
        assert a - 4 <= start <= a and b <= end <= b + 4 and n == end - start and kept == [d - 10_000]
    hit = sum(d in found for d in edited)
    print("edited paragraphs found", hit, "of", len(edited))
    assert hit >= 0.97 * len(edited) and set(found) <= {*spans, *edited}


def test_runs_end_with_their_texts(spark):
    whole = " ".join(f"v{i}" for i in range(30))
    rows = [(1, whole), (2, whole), (3, "a b c " + whole), (4, " ".join(whole.split()[:20]))]
    got = {(r.doc_id, r["first"], r["last"]) for r in sd.exact_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (2, 0, 30) in got and got <= {(2, 0, 30), (3, 3, 33)}
    assert sd.exact_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_similar_sets_share_a_signature():
    rng, sets, similar = np.random.default_rng(1), [], []
    for _ in range(6000):
        m = int(rng.integers(1, 90 if rng.random() < 0.3 else 16))
        x = rng.integers(0, 1 << 63, m, dtype=np.uint64)
        keep = x[int(rng.integers(0, m // 4 + 2)):]
        y = np.unique(np.concatenate([keep, rng.integers(0, 1 << 63, int(rng.integers(0, m // 4 + 2)), dtype=np.uint64)]))
        both = len(np.intersect1d(x, y))
        if len(y) and 10 * both >= 8 * (m + len(y) - both):
            similar.append((len(sets), len(sets) + 1))
            sets += [np.sort(x).tobytes(), y.tobytes()]
    keys, owner = sd.signatures(sets)
    low, high = (s.tolist() for s in sd.sketches(sets))
    own = defaultdict(set)
    for key, at in zip(keys.tolist(), owner.tolist()):
        own[at].add(key)
    assert len(similar) > 1000
    for a, b in similar:
        apart = ((low[a] ^ low[b]) % 2**64).bit_count() + ((high[a] ^ high[b]) % 2**64).bit_count()
        assert own[a] & own[b] and 9 * apart * 8 <= len(sets[a]) + len(sets[b])


def test_pieces_that_share_a_band_only_are_not_paired_whole(spark, tmp_path):
    """300 unlike pieces with some shingles in common meet in one bucket: 44,850 pairs, two of them similar."""
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    sets = [np.append(common, rng.integers(0, 1 << 63, 4, dtype=np.uint64)) for _ in range(298)]
    sets += [np.append(sets[5], np.uint64(7)), np.append(sets[9], np.uint64(8))]
    names = spark.createDataFrame([(i, bytearray(np.sort(s).tobytes())) for i, s in enumerate(sets)], "name long, set binary")
    none = spark.createDataFrame([], "node long, root long")
    got = {tuple(r) for r in sd._rest(names.selectExpr("1L AS key", "name"), none, names).collect()}
    assert {(5, 298), (9, 299)} <= got and len(got) < 20
