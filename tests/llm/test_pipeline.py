"""The pipeline's run, stage by stage, against plain Python on a planted corpus."""
import itertools
import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from sitewise.llm import packing
from sitewise.llm.common import materialize

from .conftest import LABELS
from .test_brute_force import WORD, _prose, _shingles

INSULTS = ("nincompoop", "scoundrel")


def _corpus():
    """(doc_id, text, lang, source) and labels: toxic rows, near copies, a passage in several rows, three sources."""
    rng = random.Random(12)
    common = [_prose(rng, 1) for _ in range(60)]

    def plain(n):
        return " ".join(rng.choice(common) for _ in range(n))

    passage = _prose(rng, 120)
    texts = [plain(rng.randint(30, 120)) for _ in range(150)]
    texts += [f"{plain(20)} {INSULTS[i % 2]} {plain(20)} {INSULTS[i % 2]} {plain(5)}" for i in range(90)]
    toxic = set(range(150, 240))
    for i in range(0, 40, 4):  # near copies: a word more at the end; exact copies
        texts += [f"{texts[i]} {_prose(rng, 1)}", texts[i]]
    texts += [f"{plain(40)} {passage} {plain(40)}" for _ in range(5)]
    rows = [(i, t, "en", "abc"[i % 3]) for i, t in enumerate(texts)]
    return rows, toxic


def _groups(rows):
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [r for i, r in enumerate(rows) if find(i) == i]


def _without_repeats(rows, match=400):
    raw = [t.encode() for _, t in rows]
    seen = Counter(r[i:i + match] for r in raw for i in range(len(r) - match + 1))
    out = []
    for (d, _), r in zip(rows, raw, strict=True):
        keep = np.ones(len(r), bool)
        for i in range(len(r) - match + 1):
            if seen[r[i:i + match]] > 1:
                keep[i:i + match] = False
        out.append((d, bytes(np.frombuffer(r, np.uint8)[keep]).decode()))
    return out


@pytest.fixture(scope="module")
def stages(spark, docs_of, tmp_path_factory):
    rows, toxic = _corpus()
    sf = str(tmp_path_factory.mktemp("corpus"))
    docs_of(rows).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(r[0], 1, int(r[0] in toxic)) for r in rows[:240]], LABELS).write.parquet(f"{sf}/labels.parquet")
    out = [spark.read.parquet(f"{sf}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], sf), keep=True))
    return sf, toxic, out


def _rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_each_stage(stages):
    _, toxic, (docs, clean, single, cut, mixed, packed) = stages
    got = _rows(clean)
    assert {d for d, _ in _rows(docs)} - {d for d, _ in got} == toxic
    want = _groups(got)
    assert _rows(single) == want and len(want) == len(got) - 20
    want = _without_repeats(want)
    assert _rows(cut) == want and sum(len(t) for _, t in want) < sum(len(t) for _, t in _rows(single)) - 400
    # mixing: whole rows, repeated or dropped, each source near its target
    kept, times = dict(want), Counter(r["doc_id"] for r in mixed.collect())
    assert all(kept[r["doc_id"]] == r["text"] and r["source"] == "abc"[r["doc_id"] % 3] for r in mixed.collect())
    size = {d: len(WORD.findall(t)) for d, t in kept.items()}
    total = sum(size.values())
    for k, weight in enumerate((5, 2, 1)):
        have = sum(n for d, n in size.items() if d % 3 == k)
        words = sum(size[d] * n for d, n in times.items() if d % 3 == k)
        fill = sum(n for d, n in size.items() if d % 3 == 0) * 3
        target = total * weight / 8 if fill >= total * 5 / 8 else None
        assert target is not None and min(target, 3 * have) <= words <= target + max(size.values())
    # packing: every row of the mix once, in batches that keep the budget
    rows = packed.collect()
    assert Counter((r["doc_id"], r["length"]) for r in rows) == Counter((d, size[d]) for d in times.elements())
    room = Counter((r["bucket"], r["batch"], r["bucket_length"]) for r in rows)
    assert all(n * b <= packing.TOKEN_BUDGET for (_, _, b), n in room.items())
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in rows}) == len(rows)
    v, n = np.unique([r["length"] for r in rows], return_counts=True)
    assert set(packing.best_boundaries(v, n, v * n, packing.N_BUCKETS)) == {r["bucket_length"] for r in rows}


def test_run_is_the_stages(spark, stages):
    sf, _, out = stages
    got = corpus_pipeline.run(spark, sf)
    assert got.columns == out[-1].columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, out[-1].collect()))
