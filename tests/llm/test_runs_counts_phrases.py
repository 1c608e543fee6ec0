import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from harness import compare, write
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellweave.llm import collocations, periodic_runs, token_counts

ODD = [None, "", " ", "a", "a b  c   d", " lead", "trail  ", "x \n y", "it's we'll don't've", "<|endoftext|> z <|endoftext|>", "ünï 東京 12 345",
       "nul \x00x y", "\x1c \x1d x \x85 y", "a  b c ก ²", "dup text here", "dup text here", "a " * 30_000, "x" * 50_000]


def documents(texts, **more):
    n = len(texts)
    return {"doc_id": pa.array([*range(n - 1), None], pa.int64()), "text": pa.array(texts, pa.string()),
            "lang": pa.array([None if i % 3 == 0 else "en" for i in range(n)], pa.string()), **more}


def runs_by_definition(t, least):
    out = []
    for q in range(1, len(t) // 2 + 1):
        i = 0
        while i + q < len(t):
            j = i
            while j + q < len(t) and t[j] == t[j + q]:
                j += 1
            w = t[i:j + q]
            if j - i + q >= max(least, 2 * q) and not any(w[p:] == w[:-p] for p in range(1, q)):
                out.append((i, len(w), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_catcher_finds_every_run_in_any_portions():
    rng = random.Random(5)
    for _ in range(1500):
        t, letters = [], rng.choice([1, 2, 2, 3, 5])
        for _ in range(rng.randrange(0, 50)):
            t += t[-rng.randrange(1, 12):] * rng.randrange(1, 4) if t and rng.random() < .3 else [rng.randrange(letters)]
            if len(t) > 80:
                break
        least, at = rng.choice([2, 4, 12]), rng.randrange(len(t) + 1)
        catcher = periodic_runs.SquareCatcher(least)
        catcher.extend(t[:at])
        catcher.extend(t[at:])
        assert catcher.runs() == runs_by_definition(t, least), (t, least)


def expected_runs(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_by_definition(words, 12) if n < 2000 else [(0, n, 1)]  # the one long text repeats a word
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(((-length, s, q) for s, length, q in runs), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *((None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])),
            sha(b"".join(b"%d,%d,%d\n" % r for r in runs)), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_op11_equals_the_definition(spark, tmp_path):
    rng = random.Random(7)
    texts = [" ".join(rng.choice("ab") * rng.randrange(1, 3) for _ in range(rng.randrange(0, 70))) for _ in range(80)]
    texts += ["head " + " ".join(f"w{i}" for i in range(rng.randrange(1, 9))) + " " + "x y z u v "[:rng.choice([4, 6, 10])] * rng.randrange(3, 9) for _ in range(40)]
    texts += ["z " + "one two three four five six seven " * 4 + "end", "A a " * 9, *ODD]
    folder = write(tmp_path, documents=documents(texts, runs=[1] * len(texts), collapsed=["x"] * len(texts)))
    rows = periodic_runs.op11_periodic_runs(spark, folder).collect()
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [expected_runs(i if i < len(texts) - 1 else None, t) for i, t in enumerate(texts)]
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in rows))) == sorted(map(repr, want))
    assert sum(r["n_runs"] > 0 for r in rows) > 20 and any(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts)))


@pytest.fixture(scope="module")
def count():
    tokenizer = Tokenizer.from_file(token_counts.tokenizer_path())
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_every_prefix_has_the_count_of_the_library(count):
    rng = random.Random(3)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'", "re", "ve", "s", "'re", "'s", "12", "3", ".", ",", "!!", "é", "東", "京", "😀", "<|endoftext|>",
             "\x1c", "\x85", "\xa0", "ABC", "ing", "tion", "========", "----", "ก", "²", "_", "x" * 70]
    counter = token_counts.PrefixCounter(token_counts.tokenizer_path())
    for _ in range(700):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 12)))
        (steps,) = counter.steps([text])
        assert np.cumsum(steps).tolist() == [count(text[:i]) for i in range(1, len(text) + 1)], repr(text)


def test_op12_and_questions_equal_the_library(spark, tmp_path, count):
    folder = write(tmp_path, documents=documents(ODD, n_tokens=[1] * len(ODD), prefixes=["x"] * len(ODD)))
    rows = token_counts.op12_token_counts(spark, folder).collect()
    want = [(i if i < len(ODD) - 1 else None, len((t or "").encode()), count(t or ""), count(t or "") > 512) for i, t in enumerate(ODD)]
    assert sorted(map(repr, (tuple(r)[:4] for r in rows))) == sorted(map(repr, want))
    kept = token_counts.prefix_counts(spark.read.parquet(f"{folder}/documents.parquet"), limit=4)
    asked = kept.select("doc_id", "kept_chars", token_counts.tokens_of_prefix("prefixes", "step_bytes", F.lit(3)).alias("three"),
                        token_counts.longest_prefix("prefixes", "step_bytes", F.lit(4)).alias("four")).collect()
    for r in asked:
        text = ODD[-1] if r["doc_id"] is None else ODD[r["doc_id"]] or ""
        assert r["three"] == (count(text[:3]) if len(text) > 2 else None)
        assert r["four"] == r["kept_chars"] == max(i for i in range(min(len(text), 3000) + 1) if count(text[:i]) <= 4)


def phrases_by_definition(texts, langs, least, top=2000):
    n, f = Counter(), Counter()
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for text, lang in zip(texts, langs):
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f.update((lang or "und", *w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    frequent = {p: a for p, a in f.items() if a >= least and len(p) > 2}
    inner = lambda p: ((p[0], *p[i:i + k]) for k in range(2, len(p) - 1) for i in range(1, len(p) - k + 1))
    gone = {q for p, a in frequent.items() for q in inner(p) if 100 * a >= 80 * f[q]}
    by_lang = defaultdict(list)
    for p, a in frequent.items():
        if p not in gone:
            cuts = [(2_000_000 * a // (f[p[:k]] + f[(p[0], *p[k:])]), k) for k in range(2, len(p))]
            score, k = min(cuts)
            by_lang[p[0]].append((-score, -a, " ".join(p[1:]).encode(), f[p[:k]], f[(p[0], *p[k:])]))
    return [(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, v in by_lang.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:top], 1)]


@pytest.mark.parametrize("shards, bits", [(1, 22), (3, 4), (4, 22)])
def test_collocations_equal_the_definition(spark, shards, bits):
    """Also with 16 slots, where every slot is shared."""
    rng = random.Random(11)
    texts = [" ".join(rng.choice(["a", "b", "Of the", "éa", "x\tY", "z.", "q,r", "rare%d" % rng.randrange(40)]) for _ in range(rng.randrange(0, 60))) for _ in range(150)]
    texts += ODD[:-2]
    langs = [rng.choice(["en", "fr", None]) for _ in texts]
    docs = spark.createDataFrame(pd_rows(texts, langs), "doc_id long, text string, lang string, n string, slot string")
    got = collocations.collocations(docs, least=5, shards=shards, slot_bits=bits).collect()
    assert sorted(map(tuple, got)) == sorted(phrases_by_definition(texts, langs, 5))
    assert len(got) > 30


def pd_rows(texts, langs):
    return [(i % 50, t, g, "x", "y") for i, (t, g) in enumerate(zip(texts, langs))]


@pytest.mark.parametrize("bits", [6, 10])
def test_collocations_count_rare_words_before_common_pairs(spark, bits):
    """A rare first word is reached late, when a shared slot has already let the longer phrase start."""
    texts = [f"a{i} b{i % 20} c{i % 20} d{i % 5}" for i in range(300)] * 14
    docs = spark.createDataFrame(pd_rows(texts, ["en"] * len(texts)), "doc_id long, text string, lang string, n string, slot string")
    got = collocations.phrase_counts(docs, least=12, slot_bits=bits).where("length > 0").collect()
    want = Counter(" ".join(t.split()[i:j]) for t in texts for i in range(4) for j in range(i + 1, 5))
    assert {r["phrase"]: r["n"] for r in got} == {p: a for p, a in want.items() if a >= 12}


def test_op13_equals_sql(spark, tmp_path):
    texts = [f"{t} word{i % 7} New York city, new york" for i, t in enumerate(["in the end"] * 120)] + ODD[:-2]
    folder = write(tmp_path, documents=documents(texts, phrase=["x"] * len(texts)))
    assert len(compare(spark, collocations.op13_phrase_collocations, collocations.OP13_SQL, folder, ["documents"])) > 3


def test_scores_are_exact_beyond_64_bits_and_top_is_by_bytes(spark):
    a, l, r = 9_000_000_000_000_001, 9_000_000_000_000_007, 9_000_000_000_000_003
    rows = [("en", "", 0, 5), ("en", "x", 1, l), ("en", "y", 1, r), ("en", "x y", 2, a), ("en", "é", 1, 50), ("en", "z", 1, 50), ("en", "é é", 2, 40), ("en", "z z", 2, 40)]
    got = collocations.scored(spark.createDataFrame(rows, "lang string, phrase string, length int, n long"), top=2).orderBy("rank").collect()
    assert [(r_["phrase"], r_["score"]) for r_ in got] == [("x y", 2_000_000 * a // (l + r)), ("z z", 800_000)]


def test_empty_tables(spark, tmp_path):
    folder = write(tmp_path, documents=documents(["x"]))
    empty = str(tmp_path / "empty")
    spark.read.parquet(f"{folder}/documents.parquet").where("doc_id > 5").write.parquet(f"{empty}/documents.parquet")
    for query in (periodic_runs.op11_periodic_runs, token_counts.op12_token_counts, collocations.op13_phrase_collocations):
        assert query(spark, empty).count() == 0
