import random

import pyarrow as pa

from cellweave.llm import licenses, toxicity
from harness import write


def every_window(text, templates, least):
    """All windows that begin and end at a hit, best first, without overlaps."""
    words = licenses.normalised(text)
    pairs = list(zip(words, words[1:]))
    found = []
    for name, template in templates.items():
        w = licenses.normalised(template)
        own = set(zip(w, w[1:]))
        for i in range(len(pairs)):
            best = None
            for j in range(i, min(len(pairs), i + 4 * len(own))):
                here = set(pairs[i:j + 1])
                dice = 2 * len(here & own) / (len(here) + len(own))
                if pairs[i] in own and pairs[j] in own and dice >= least and (best is None or dice > best[0]):
                    best = (dice, j)
            if best:
                found.append((-best[0], i, i - best[1], name))
    taken, out = set(), []
    for dice, first, length, name in sorted(found):
        span = range(first, first - length + 2)
        if taken.isdisjoint(span):
            taken.update(span)
            out.append((name, -dice, first, span.stop))
    return sorted(out, key=lambda x: x[2])


def test_licenses_match_brute_force():
    rng = random.Random(2)
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.LEAST)
    for _ in range(60):
        words = [rng.choice("the license of under apache a b c".split()) for _ in range(rng.randint(0, 60))]
        for name in rng.sample(sorted(licenses.TEMPLATES), rng.randint(0, 2)):
            t = licenses.TEMPLATES[name].split()
            for _ in range(rng.randint(0, 3)):
                t[rng.randrange(len(t))] = "zzz"
            at = rng.randint(0, len(words))
            words[at:at] = t
        text = " ".join(words)
        assert scanner.scan(text) == every_window(text, licenses.TEMPLATES, licenses.LEAST)


def test_neighbouring_licenses_keep_their_names():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.LEAST, licenses.WHOLE)
    names = lambda text: [f[0] for f in scanner.scan("some words " + text + " more words")]
    assert names("This work is licensed under the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert names("This work is licensed under the GNU General Public License, version 3.") == ["GPL-3.0"]
    assert names("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.") == ["CC-BY-SA-4.0"]
    for name, text in (licenses.TEMPLATES | licenses.WHOLE).items():
        assert names(text) == [name]
    for name, text in licenses.WHOLE.items():
        words = text.split()
        words[30] = words[-20] = "changed"
        assert names(" ".join(words)) == [name]


def test_user_templates(spark):
    own = licenses.templates_of(spark.createDataFrame([("Own", "use it as you like"), (None, "x y"), ("Void", None)], "license string, text string"))
    docs = spark.createDataFrame([(1, "please use it as you like now")], "doc_id long, text string")
    assert own == {"Own": "use it as you like"} and [tuple(r) for r in licenses.find(docs, own).collect()] == [(1, "Own", 1.0, 1, 6)]


def test_license_query(spark, tmp_path):
    texts = [None, "", "x " * 50 + "Licensed under the\nAPACHE license version 2.0 " + "y " * 50, "Released under the MIT License." * 3, "clean words only", "All rights reserved"]
    folder = write(tmp_path, documents={"doc_id": pa.array([1, 2, 3, 4, 5, None], pa.int64()), "text": pa.array(texts, pa.string()), "license": ["x"] * 6})
    got = [tuple(r) for r in licenses.op2_license_scan(spark, folder).collect()]
    assert sorted((r[0] or 0, r[1]) for r in got) == [(0, "Proprietary"), (3, "Apache-2.0"), (4, "MIT"), (4, "MIT"), (4, "MIT")]
    folder = write(tmp_path, documents={"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())})
    assert licenses.op2_license_scan(spark, folder).collect() == []


def test_toxicity_is_accurate_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in toxicity.op8_toxicity(spark, folder).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    held = [(rows[d].score, t, rows[d].predicted) for d, t in labels.items() if rows[d].held_out]
    good = [s for s, t, _ in held if not t]
    auc = sum((s > g) + 0.5 * (s == g) for s, t, _ in held if t for g in good) / (len(good) * sum(t for _, t, _ in held))
    precision = sum(t for _, t, p in held if p) / max(1, sum(p for *_, p in held))
    recall = sum(p for _, t, p in held if t) / sum(t for _, t, _ in held)
    print("auc", auc, "precision", precision, "recall", recall)
    assert auc > 0.95 and precision > 0.9 and recall > 0.75 and all(0 <= r.score <= 1 for r in rows.values())


def test_toxicity_without_labels(spark, tmp_path):
    folder = write(tmp_path, documents={"doc_id": pa.array([1, None, 2], pa.int64()), "text": pa.array(["a", None, ""], pa.string())},
                   labels={"doc_id": pa.array([], pa.int64()), "quality": pa.array([], pa.int32()), "toxic": pa.array([], pa.int32())})
    assert sorted((r.doc_id or 0, r.score, r.predicted) for r in toxicity.op8_toxicity(spark, folder).collect()) == [(0, 0.0, 0), (1, 0.0, 0), (2, 0.0, 0)]
