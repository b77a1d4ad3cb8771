"""The methods against their definitions: token attribution byte by byte, the
pairwise sum, enumerated subsequences, connected vectors, held-out rejection."""
import itertools
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitewise.llm import cap_filters, quality_fm, quality_rules, suffix_dedup, token_counts, toxicity
from sitewise.llm.common import crc_remainder
from sitewise.llm.textnp import text_chunks

from .conftest import LABELS, MESSY

SF = "/root/testdata/sf0.1"


def _chunk(texts):
    (_, _, data, offs), = text_chunks(pa.array(texts, pa.large_string()))
    return data, offs


# -- token counts: every byte of every token is looked up in the sections ----------------------

@pytest.mark.parametrize("rule", token_counts.RULES)
def test_every_section_counts_its_tokens(docs_of, rule):
    with open(token_counts.VOCABULARY, "rb") as f:
        vocabulary = f.read()
    rng = random.Random(2)
    texts = ["\n\n  \n" * 7 + "Naïve café – 12345 tokens\n" * 3, "x" * 1234 + "é" * 777, "", None, "tail\n\n\n", " ".join("w%d" % rng.randrange(9999) for _ in range(400)) + "\nend", "日本語テキスト" * 120 + "\r\n\tmixed"]
    got = {(r["doc_id"], r["section"]): r for r in token_counts.section_tokens(docs_of(texts), rule=rule).collect()}
    for i, text in enumerate(texts):
        raw = (text or "").encode()
        section = np.zeros(len(raw), int)  # the section of each byte, cut by the definition
        at = (text or "").split("\n")
        pieces = [line + "\n" for line in at[:-1]] + ([at[-1]] if at[-1] else [])
        pieces = [p[k:k + token_counts.PASSAGE_CHARS] for p in pieces for k in range(0, len(p), token_counts.PASSAGE_CHARS)] or [""]
        pos = 0
        for n, piece in enumerate(pieces):
            size = len(piece.encode())
            section[pos:pos + size] = n
            pos += size
        ends = token_counts.token_ends(text, vocabulary).tolist() if text else []
        given, crossing = [0] * len(pieces), [0] * len(pieces)
        for start, end in zip([0, *ends[:-1]], ends):
            own = section[start:end].tolist()
            touched = sorted(set(own))
            given[own[0] if rule == "start" else max(touched, key=lambda s: (own.count(s), -s))] += 1
            if len(touched) > 1:
                for s in touched:
                    crossing[s] += 1
        rows = [got[i, k] for k in range(len(pieces))]
        assert [(r["n_tokens"], r["n_crossing"], r["n_chars"]) for r in rows] == list(zip(given, crossing, map(len, pieces))), i
        assert (i, len(pieces)) not in got


# -- factorisation machine: the identity against the sum over all pairs --------------------------

def test_sum_of_squares_is_the_sum_over_pairs():
    rng = np.random.default_rng(4)
    data, offs = _chunk(["A b, b! #x", "", "one two three one TWO\n3 3", "é ü 日本 &&"])
    prow, pslot, weight, stats = quality_fm.features(data, offs)
    k = 1 << quality_fm.HASH_BITS
    model = {"w0": 0.3, "w": rng.normal(size=k + quality_fm.N_STATS), "v": rng.normal(size=(k + quality_fm.N_STATS, quality_fm.RANK)), "mean": rng.normal(size=quality_fm.N_STATS), "scale": rng.uniform(1, 2, quality_fm.N_STATS)}
    got = quality_fm.fm_scores(prow, pslot, weight, stats, model)
    for row in range(4):
        x = {int(s): float(w) for s, w in zip(pslot[prow == row], weight[prow == row])}
        x |= {k + j: float(v) for j, v in enumerate((stats[row] - model["mean"]) / model["scale"])}
        want = model["w0"] + sum(model["w"][i] * v for i, v in x.items())
        want += sum(float(model["v"][i] @ model["v"][j]) * x[i] * x[j] for i, j in itertools.combinations(x, 2))
        assert abs(got[row] - want) < 1e-9


def _labels_of(spark):
    """Labels that disagree, are null, or are of no document, over the messy rows and more."""
    rows = [(1, 1, 0), (4, 0, 1), (4, 1, 0), (5, None, None), (6, 1, 0), (7, 0, 1), (9, 0, 1), (None, 1, 1), (999, 1, 1), (10, 1, 0), (11, 1, 0), (8, 1, 0)]
    return spark.createDataFrame(rows, LABELS)


def test_classifiers_and_rules_take_messy_rows_with_labels(spark, messy, empty, tmp_path):
    extra = [c for c in ("m", "y", "d", "id", "score", "predicted", "c_m", "fold", "rung", "model")]
    wide = messy.withColumn("lang2", F.lit("x"))
    for c in extra:
        wide = wide.withColumn(c, F.lit("x"))
    wide.write.parquet(f"{tmp_path}/documents.parquet")
    _labels_of(spark).write.parquet(f"{tmp_path}/labels.parquet")
    empty.write.parquet(f"{tmp_path}/none/documents.parquet")
    _labels_of(spark).write.parquet(f"{tmp_path}/none/labels.parquet")
    for op in (quality_fm.op6_quality_fm, toxicity.op9_toxicity):
        rows = op(spark, str(tmp_path)).collect()
        assert len(rows) == len(MESSY) and all(0.0 <= r["score"] <= 1.0 and r["predicted"] in (0, 1) and r["held_out"] is not None for r in rows)
        by = {}
        for r in rows:
            by.setdefault(r["doc_id"], set()).add(r["score"])
        assert len(by[1]) == 1 and by[1] == by[2]  # null and empty score alike
        assert len(by[4]) == 2  # two rows with one text and one with another
        assert op(spark, f"{tmp_path}/none").count() == 0
    rows = quality_rules.rules(messy, _labels_of(spark))
    assert rows.count() == len(MESSY) and rows.where("kept is null or (base_failed and kept)").count() == 0


# -- string kernel: the explicit form against enumerated subsequences ----------------------------

def _subsequences(word):
    """weight of every (letters) met along a pattern in the marked word."""
    marked = "\x01" + word
    out = {}
    for steps in toxicity.PATTERNS:
        for i in range(len(marked) - sum(steps)):
            at = [i + sum(steps[:k]) for k in range(len(steps) + 1)]
            key = "".join(marked[a] for a in at)
            out[key, steps] = out.get((key, steps), 0.0) + toxicity.DECAY ** (sum(steps) - len(steps))
    return out


def _kernel(a, b):
    """Sum over letters, all patterns of one length being one feature."""
    def merged(word):
        out = {}
        for (key, _), w in _subsequences(word).items():
            out[key] = out.get(key, 0.0) + w
        return out
    x, y = merged(a), merged(b)
    return sum(w * y[k] for k, w in x.items() if k in y)


def test_kernel_equals_enumerated_subsequences():
    words = ["idiot", "idxiot", "idiotic", "stone", "banana", "abcabc", "tone"]
    data, offs = _chunk([" ".join(words)])
    letters, bounds, _ = toxicity.instances(data, offs)
    dense = np.zeros((len(words), 1 << toxicity.TABLE_BITS))
    for owner, at, weight in toxicity.features(letters, bounds):
        np.add.at(dense, (owner, at), weight)
    gram = dense @ dense.T
    for i, j in itertools.product(range(len(words)), repeat=2):
        assert abs(gram[i, j] - _kernel(words[i], words[j])) < 1e-9, (words[i], words[j])
    near = gram[0] / np.sqrt(np.diag(gram) * gram[0, 0])
    assert near[1] > 0.35 > max(near[3], near[4], near[5])


# -- embeddings: components and what is kept ------------------------------------------------------

def test_components_of_planted_clusters(spark):
    rng = np.random.default_rng(31)
    centres = rng.normal(size=(40, 48))
    x = np.concatenate([centres + rng.normal(size=centres.shape) * s for s in (0.02, 0.1, 0.2, 0.3)] + [rng.normal(size=(150, 48))]).astype(np.float32)
    ids = rng.permutation(len(x)) * 3 + 5
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    root = {int(i): int(i) for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, j in zip(*np.nonzero(near)):
        a, b = sorted((find(int(ids[i])), find(int(ids[j]))))
        root[b] = a
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in cap_filters.link(df).collect()}
    pairs = [(int(a), int(b)) for a, b in itertools.combinations(ids, 2) if find(int(a)) == find(int(b))]
    together = sum(got[a]["component_id"] == got[b]["component_id"] for a, b in pairs)
    assert together >= 0.9 * len(pairs) and len(pairs) > 100
    for a, b in itertools.combinations(map(int, ids), 2):  # nothing is joined that brute force keeps apart
        if find(a) != find(b):
            assert got[a]["component_id"] != got[b]["component_id"]
    for i in map(int, ids):
        assert got[i]["kept"] == (got[i]["component_id"] == i) and got[got[i]["component_id"]]["component_id"] == got[i]["component_id"] <= i


# -- quality rules: copies are one trial, and a third fold keeps the promise ----------------------

@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
def test_false_rejection_on_a_third_fold(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    third = docs.select("doc_id", F.xxhash64("text").alias("t")).select("doc_id", (crc_remainder("t", 3) == 0).alias("unseen"))
    known = labels.join(third.where("not unseen").select("doc_id"), "doc_id", "left_semi")
    rows = quality_rules.rules(docs, known).join(third, "doc_id").join(labels.where("quality = 1"), "doc_id").where("unseen and not base_failed")
    texts = rows.groupBy("rk").agg(F.min("kept").alias("kept"))
    n, lost = texts.count(), texts.where("not kept").count()
    assert n > 300
    # 1 % promised; three standard errors for the size of the fold
    assert lost / n <= 0.01 + 3 * (0.01 * 0.99 / n) ** 0.5


def test_copies_are_one_trial(spark, docs_of):
    """A thousand copies of one good text are one piece of evidence: no rung is proven by them."""
    text = "a good text of its own with more than twenty words in it so that the base rules let it pass and the cutoffs can be laid through it"
    docs = docs_of([(i, text, "en", "a") for i in range(1000)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1000)], LABELS)
    assert [r["rung"] for r in quality_rules.rules(docs, labels).select("rung").distinct().collect()] == [-1]


# -- the match length of the pipeline's stage ------------------------------------------------------

def test_shorter_passages_and_their_least_words(docs_of):
    rng = random.Random(6)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))

    passage, short = prose(55), prose(45)
    texts = [f"{prose(30)} {passage} {prose(30)}", f"{prose(20)} {passage} {prose(9)}", f"{prose(12)} {short} {prose(8)}", f"{short} {prose(30)}", prose(90), "é " * 400]
    assert 200 < len(passage) < 400 and len(short) >= 200
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs_of(texts), match=200, gram=100, min_words=50).collect()}
    for i in (0, 1):
        assert passage[10:-10] not in got[i]["text"] and len(got[i]["text"].split()) <= len(texts[i].split()) - 50
    assert [got[i]["text"] for i in (2, 3, 4)] == texts[2:5]
    assert len(got[5]["text"]) < 30  # it repeats itself
    assert suffix_dedup.remove_repeats(docs_of(texts)).where("doc_id < 5").select("text").collect() == [(t,) for t in texts[:5]]


# -- scratch tables belong to their caller ---------------------------------------------------------

def test_an_owner_deletes_its_own_tables_only(spark):
    from sitewise.llm.common import Scratch, batches_of, materialize
    outside = materialize(spark.range(5))
    first, second = Scratch(), Scratch()
    with first:
        a = materialize(spark.range(3))
        with second:
            b = materialize(spark.range(4))
        kept = materialize(spark.range(2), keep=True)
    first.drop(spark)
    assert (outside.count(), b.count(), kept.count()) == (5, 4, 2) and first.paths == [] and len(second.paths) == 1
    with pytest.raises(Exception, match="not exist|FileNotFound|PATH_NOT_FOUND"):
        a.count()
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), batches_of(spark, 7):
        assert spark.conf.get(name) == "7"
        raise ValueError
    assert spark.conf.get(name) == before
