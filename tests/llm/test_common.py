import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sitewise.llm import common, textnp


def _reference(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_of_chains_stars_and_random_graphs(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 400)]
    loose = [(rng.randrange(2000, 2600), rng.randrange(2000, 2600)) for _ in range(380)]
    edges = chain + star + [e for e in loose if e[0] != e[1]]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges + [(7, 7), (None, 3)], "a long, b long").repartition(13)
    got = [tuple(r) for r in common.components(df).collect()]
    assert len(got) == len(dict(got)) and dict(got) == _reference(edges)
    assert common.components(df.limit(0)).count() == 0


def test_running_sums_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(common, "ROWS_PER_BUCKET", 10)
    df = spark.range(500).select((F.col("id") % 3).cast("string").alias("g"), F.md5(F.col("id").cast("string")).alias("h"), (F.col("id") % 17).alias("v"))
    df = df.withColumn("g", F.when(F.col("g") != "2", F.col("g")))
    got = common.running_sums(df, "g", ["h"], F.col("v"), 500).collect()
    for g in {r["g"] for r in got}:
        total = 0
        for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["h"]):
            assert r["before"] == total
            total += r["v"]


def test_words_and_shingles():
    texts = ["a bb\tccc", None, "", "  x ", "é\x0bü", "one two three four five"]
    (lo, hi, data, offs), = textnp.text_chunks(pa.array(texts, pa.string()))
    starts, ends, first = textnp.words(data, offs)
    assert [bytes(data[s:e]).decode() for s, e in zip(starts, ends)] == ["a", "bb", "ccc", "x", "é", "ü", "one", "two", "three", "four", "five"]
    assert np.diff(first).tolist() == [3, 0, 0, 1, 2, 5]
    h, at = textnp.shingles(textnp.word_hashes(data, starts, ends), first, 4)
    assert np.diff(at).tolist() == [1, 0, 0, 1, 1, 2] and len(set(h.tolist())) == 5


def test_sliding_min():
    x = np.random.default_rng(1).integers(0, 99, 500).astype(np.uint64)
    for w in (1, 2, 7, 64, 499, 500):
        assert textnp.sliding_min(x, w).tolist() == [x[i:i + w].min() for i in range(500 - w + 1)]
