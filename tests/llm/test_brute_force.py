"""Operators without a SQL oracle against plain Python on small tables."""
import hashlib
import itertools
import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitewise.llm import cap_filters, jaccard_groups, packing, quality_fm, quality_rules, suffix_dedup, token_counts, toxicity

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


# -- suffix arrays ----------------------------------------------------------------------------

def _cut(texts, match=400):
    raw = [t.encode() for t in texts]
    seen = Counter(r[i:i + match] for r in raw for i in range(len(r) - match + 1))
    out = []
    for r in raw:
        keep = np.ones(len(r), bool)
        for i in range(len(r) - match + 1):
            if seen[r[i:i + match]] > 1:
                keep[i:i + match] = False
        kept = bytes(np.frombuffer(r, np.uint8)[keep])
        spans = int(np.count_nonzero(np.diff(np.concatenate([[1], keep.astype(int), [1]])) == -1))
        out.append((len(r), len(r) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def _planted():
    rng = random.Random(8)
    passage, other = _prose(rng, 130), "ñé" * 150 + _prose(rng, 70)
    texts = [_prose(rng, rng.randint(5, 300)) for _ in range(15)]
    texts += [f"{_prose(rng, 40)} {passage[k:]} {_prose(rng, 40)}" for k in range(0, 300, 30)]
    texts += [_prose(rng, 3) + other + _prose(rng, 9) for _ in range(3)]
    texts += [texts[0], texts[3], "", "ab" * 900, "x" * 399, "y" * 401, passage + passage]
    return texts


@pytest.mark.parametrize("shard_bytes", [1 << 20, 2000])
def test_repeated_bytes(spark, docs_of, monkeypatch, shard_bytes):
    """The second size splits the passages' keys over several shards."""
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", shard_bytes)
    texts = _planted()
    rows = suffix_dedup.with_spans(suffix_dedup.keyed(docs_of(texts)))
    got = rows.select("doc_id", "text", "spans").mapInArrow(suffix_dedup._digest_rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    assert [tuple(r)[1:] for r in sorted(got.collect())] == _cut(texts)


def test_suffix_array_windows():
    rng = random.Random(2)
    for _ in range(20):
        text = bytes(rng.choice(b"ab") for _ in range(rng.randint(20, 200)))
        ctx = [text[rng.randrange(len(text)):] for _ in range(5)] + [b"ab" * 30]
        match = rng.choice([5, 8, 13])
        count = Counter(c[i:i + match] for c in ctx for i in range(len(c) - match + 1))
        assert suffix_dedup.repeated_windows(ctx, match)[2].tolist() == [count[c[i:i + match]] > 1 for c in ctx for i in range(len(c) - match + 1)]


# -- n-gram Jaccard ---------------------------------------------------------------------------

def _shingles(text):
    w = WORD.findall(text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()


def test_jaccard_components(docs_of):
    rng = random.Random(4)
    texts = []
    for _ in range(6):
        base = _prose(rng, rng.randint(30, 80)).split()
        for _ in range(25):  # around the threshold: one to four words changed
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = _prose(rng, 1)
            texts.append(" ".join(w))
    texts += [_prose(rng, n) for n in (1, 2, 3, 4, 5)] * 2 + ["", "A b", "a B"]
    sets = [_shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    want = {i: (len(s), find(i)) for i, s in enumerate(sets)}
    got = jaccard_groups.join(jaccard_groups.keyed(docs_of(texts))).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert sum(r["first"] for r in got) == len({c for _, c in want.values()})


# -- token counts -----------------------------------------------------------------------------

def test_tokens_match_the_json_tokenizer(spark, docs_of):
    from tokenizers import Tokenizer
    folder = os.path.dirname(token_counts.VOCABULARY)
    tok = Tokenizer.from_file(f"{folder}/byte_bpe_50k.json")
    tok.encode_special_tokens = True
    rng = random.Random(6)
    texts = [_prose(rng, 300) + "\n\nÉté 123 – naïve\n" + _prose(rng, 5), "one\ntwo", "a" * 1800, "  \n \n", "日本語" * 300]
    for rule in token_counts.RULES:
        got = token_counts.section_tokens(docs_of(texts), rule=rule).orderBy("doc_id", "section").collect()
        for i, text in enumerate(texts):
            rows = [r for r in got if r["doc_id"] == i]
            assert sum(r["n_tokens"] for r in rows) == len(tok.encode(text, add_special_tokens=False).ids)
            assert rows[0]["start_char"] == 0 and sum(r["n_chars"] for r in rows) == len(text)


def test_boundary_rules():
    ends, bounds = np.array([3, 9, 12, 20]), np.array([0, 4, 12, 14, 20])
    given, crossing = token_counts.attribute(ends, bounds, "start")
    assert given.tolist() == [2, 1, 1, 0] and crossing.tolist() == [1, 1, 1, 1]
    given, _ = token_counts.attribute(ends, bounds, "majority")
    assert given.tolist() == [1, 2, 0, 1]


# -- packing ----------------------------------------------------------------------------------

def test_boundaries_are_optimal():
    rng = random.Random(9)
    for _ in range(20):
        lengths = sorted(rng.sample(range(1, 60), 8))
        count = [rng.randint(1, 9) for _ in lengths]

        def padding(bounds):
            return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, count, strict=True))

        for k in (1, 2, 3, 8):
            got = packing.best_boundaries(np.array(lengths), np.array(count), np.array(lengths) * count, k)
            best = min(padding([*c, lengths[-1]]) for r in range(k) for c in itertools.combinations(lengths[:-1], r))
            assert len(got) <= k and padding(got) == best


def test_batches_keep_the_budget(docs_of):
    rng = random.Random(1)
    docs = docs_of([_prose(rng, rng.randint(1, 120)) for _ in range(300)] + [None, " ", _prose(rng, 400)])
    rows = packing.pack(docs, n_buckets=4, budget=256).collect()
    assert len(rows) == 303 and sum(r["batch"] is None for r in rows) == 2
    batches = Counter((r["bucket"], r["batch"]) for r in rows if r["batch"] is not None)
    size = {r["bucket"]: r["bucket_length"] for r in rows if r["batch"] is not None}
    assert all(n == 1 or n * size[b] <= 256 for (b, _), n in batches.items())
    assert len({(r["bucket"], r["batch"], r["slot"]) for r in rows if r["batch"] is not None}) == 301
    for b in size:  # only a bucket's last batch may have room
        full = [n for (bb, k), n in sorted(batches.items()) if bb == b][:-1]
        assert all(n == max(1, 256 // size[b]) for n in full)


# -- quality rules ----------------------------------------------------------------------------

def test_binomial_bound_and_ladder():
    for k, n, error in ((0, 100, 0.05), (3, 500, 0.01), (20, 400, 0.05)):
        p = quality_rules.upper_bound(k, n, error)
        tail = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(tail - error) < 1e-6
    assert quality_rules.upper_bound(5, 5, 0.05) == 1.0
    rich = {"stratum": "a", "good": 5000, "bad": 500, "false_0": 0, "hit_0": 100, "false_1": 4, "hit_1": 490, "false_2": 900, "hit_2": 500}
    poor = {"stratum": "b", "good": 20, "bad": 5, "false_0": 0, "hit_0": 5, "false_1": 0, "hit_1": 5, "false_2": 0, "hit_2": 5}
    assert quality_rules.choose([rich, poor], 3) == {"a": 1, "b": -1}


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no driver tables")
def test_base_statistics(spark):
    got = {r["doc_id"]: r for r in quality_rules.op4_quality_rules(spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        t, w = r["text"] or "", WORD.findall(r["text"] or "")
        windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        g = got[r["doc_id"]]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        assert (g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"]) == want
        assert g["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))


# -- classifiers ------------------------------------------------------------------------------

@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no driver tables")
@pytest.mark.parametrize(("op", "label", "least"), [(toxicity.op9_toxicity, "toxic", 0.97), (quality_fm.op6_quality_fm, "quality", 0.97)])
def test_held_out_accuracy(spark, op, label, least):
    sf = "/root/testdata/sf0.1"
    rows = op(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    right = rows.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]
    assert right >= least


def test_gapped_insults():
    clean = "the and of this river stone table house garden window mountain silver"
    rng = random.Random(3)
    good = [" ".join(rng.choice(clean.split()) for _ in range(30)) for _ in range(60)]
    bad = [f"{g} {('nincompoop', 'scoundrel')[i % 2]} {g} {('nincompoop', 'scoundrel')[i % 2]}" for i, g in enumerate(good[:45])]
    model = toxicity.train(good + bad, np.array([0.0] * 60 + [1.0] * 45))
    import pyarrow as pa

    from sitewise.llm.textnp import text_chunks

    def best(text):
        (_, _, data, offs), = text_chunks(pa.array([text]))
        letters, bounds, _ = toxicity.instances(data, offs)
        return toxicity.word_scores(letters, bounds, model["table"], model["bias"]).max()

    forms = ["nincompoop", "nin.com-poop", "n i n c o m p o o p", "nincxompoop", "scoundrrel", "scound_rel"]
    assert min(map(best, forms)) > max(map(best, clean.split()))
    empty = toxicity.document_scores(pa.array(["", None, "  "]), model)
    assert len(set(empty.tolist())) == 1 and empty[0] < 0.5


# -- embeddings -------------------------------------------------------------------------------

def test_cap_filters_find_links(spark):
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(60, 32))
    x = np.concatenate([centres + rng.normal(size=centres.shape) * s for s in (0.05, 0.2, 0.3, 0.4)] + [rng.normal(size=(200, 32))])
    x = x.astype(np.float32)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = (u @ u.T >= 0.9) & ~np.eye(len(u), dtype=bool)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["n_links"] for r in cap_filters.link(df).collect()}
    assert all(got[i] <= links[i].sum() for i in got)
    assert sum(got.values()) >= 0.98 * links.sum() > 0


def test_parts_that_linked_sets_share():
    """Two sets that link agree in as many parts as their sizes ask for, at any threshold."""
    rng = np.random.default_rng(5)
    linked = 0
    for percent in (50, 80, 85, 95):
        for _ in range(600):
            x = np.unique(rng.integers(0, 2**63, int(rng.integers(1, 600)), dtype=np.uint64))
            differ = jaccard_groups.most_apart(len(x), len(x), percent) + 2
            kept = rng.permutation(x)[:max(1, len(x) - int(rng.integers(0, differ)))]
            y = np.unique(np.concatenate([kept, rng.integers(0, 2**63, int(rng.integers(0, differ)), dtype=np.uint64)]))
            both = len(np.intersect1d(x, y))
            if 100 * both < percent * (len(x) + len(y) - both) or np.array_equal(x, y):
                continue
            linked += 1
            (a, top_a), (b, top_b) = (jaccard_groups.parts_of(s, percent) for s in (x, y))
            top, apart = max(top_a, top_b), jaccard_groups.most_apart(len(x), len(y), percent)
            need = jaccard_groups.most_apart(top, top, percent) + jaccard_groups.NEED - apart
            if top_a == top_b:
                after = jaccard_groups.next_size(top, percent)
                need += jaccard_groups.most_apart(after, after, percent) + jaccard_groups.NEED - apart
            assert len(np.intersect1d(a, b)) >= need >= jaccard_groups.NEED
    assert linked > 500
