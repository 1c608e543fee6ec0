import random

from pyspark.sql import functions as F

from cellweave.functions.columns import phred
from cellweave.operators import reads


def test_qualities_are_counted_before_they_become_rows(spark):
    rng = random.Random(4)
    texts = ["".join(chr(rng.randint(33, 126)) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    texts += [None, "", "", "!", "é\U0001f600!", "I" * 3000]
    frame = spark.createDataFrame([(f"r{i % 3}" if i % 7 else None, t) for i, t in enumerate(texts)], "run string, qual string").repartition(2)
    want = frame.select("run", F.posexplode(phred("qual")).alias("pos", "q")).groupBy("run", "pos", "q").agg(F.count("*").alias("n"))
    parts = reads._quality_counts(frame)
    got = parts.groupBy("run", "pos", "q").agg(F.sum("n").alias("n"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    same = spark.createDataFrame([("r", "I" * 50)] * 1000, "run string, qual string").coalesce(1)
    assert reads._quality_counts(same).count() == 50
