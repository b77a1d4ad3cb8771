"""CRCs of n-grams against zlib, and the whole draw against plain Python."""
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitewise.llm import importance_resampling as ir
from sitewise.llm import prefix_crc as pc

from .conftest import MESSY


def _words(text):
    raw = bytes(pc.LOWER[np.frombuffer((text or "").encode(), np.uint8)])
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", raw)


def _grams(text, max_n):
    ws = _words(text)
    return [zlib.crc32(b" ".join(ws[i:i + n])) for n in range(1, max_n + 1) for i in range(len(ws) - n + 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aZ0é漢_ .\n", max_size=60), max_size=5), st.integers(1, 4))
def test_every_ngram_crc(texts, max_n):
    raw = [t.encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    crc, row, n_words = pc.ngram_crcs(np.frombuffer(b"".join(raw), np.uint8), offs, max_n)
    assert [crc[row[i]:row[i + 1]].tolist() for i in range(len(texts))] == [_grams(t, max_n) for t in texts]
    assert n_words.tolist() == [len(_words(t)) for t in texts]


def test_long_words_and_many_blocks():
    text = "a" * 70_000 + " b " + "cd" * 4096 + " e" * 30_000
    data = np.frombuffer(text.encode(), np.uint8)
    for n in (1, 3):
        assert pc.ngram_crcs(data, np.array([0, len(data)]), n)[0].tolist() == _grams(text, n)


def test_registers_shift_by_any_length():
    x = np.array([1, 0xDEADBEEF, 77, 0xFFFFFFFF], np.uint32)
    n = np.array([0, 63, 64, 123_456_789])
    got = pc.shift_by(x.copy(), n)
    for k, (v, size) in enumerate(zip(x.tolist(), n.tolist(), strict=True)):
        if size < 1000:
            for _ in range(size):
                v = int(pc.TABLE[v & 255]) ^ (v >> 8)
            assert got[k] == v
    assert (pc.shift_by(pc.shift_by(x.copy(), n), n) == pc.shift_by(x.copy(), 2 * n)).all()


def _brute(rows, target, max_n, buckets, percent, min_words, seed):
    s, t = Counter(), Counter()
    feats = [[g % buckets for g in _grams(r[1], max_n)] for r in rows]
    for f in feats:
        s.update(f)
    for x in target:
        t.update(g % buckets for g in _grams(x, max_n))
    ss, tt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets)))) for b in range(buckets)}
    out = []
    for r, f in zip(rows, feats, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = [k for k, r in enumerate(rows) if len(_words(r[1])) >= min_words]
    able.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0))
    for place, k in enumerate(able, 1):
        out[k].append(place if place <= percent * len(able) // 100 else None)
    return sorted((tuple(x) if len(x) == 5 else (*x, None) for x in out), key=str)


def _drawn(docs, target, **kw):
    out = ir.resample(docs, target, **kw).select("key", "n_features", "weight", "score", "rank")
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.mark.parametrize(("max_n", "buckets"), [(1, 10_000), (2, 97), (3, 100_000)])
def test_draw_equals_brute_force(spark, docs_of, max_n, buckets):
    rows = [*MESSY, *[(100 + i, " ".join(f"w{(i * k) % 23}" for k in range(3 + i % 40)), "en", "a") for i in range(200)]]
    target = ["w1 w2 w3 w4", None, "", "é w5 W1"]
    docs = docs_of(rows).withColumn("key", F.lit("x")).withColumn("buckets", F.lit("x")).withColumn("score", F.lit(1)).withColumn("b", F.lit(1))
    items = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    got = _drawn(docs, items, max_n=max_n, buckets=buckets, percent=30, min_words=5)
    want = _brute(rows, target, max_n, buckets, 30, 5, 2024)
    assert got == want
    ranks = sorted(r[4] for r in got if r[4])
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) > 30


def test_empty_tables(spark, empty, docs_of):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert _drawn(empty, items) == []
    rows = [(i, "some words " * 12, "en", "a") for i in range(20)]
    assert _drawn(docs_of(rows), items.limit(0)) == _brute(rows, [], 1, 10_000, 10, 20, 2024)
