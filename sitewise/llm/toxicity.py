"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear SVM.

Instances are words: lower-cased, punctuation inside them dropped
("id.iot"), runs of single letters joined ("i d i o t").  The kernel counts
common character subsequences of three and four letters, each gap letter
costing a factor DECAY, so an inserted letter ("idxiot") keeps most of a
word's features.  It has a finite explicit form, so after training the
landmarks' weights are folded into one table indexed by hashed subsequence
and a word is scored in time linear in its length.

A labelled document is a bag: a toxic one has some toxic words, a clean one
none.  Training alternates between picking each toxic bag's witnesses and
refitting the SVM; a logistic regression on the bag's best scores gives the
document's probability.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import crc_remainder, documents, in_small_batches, labelled_sample, load, trained
from .textnp import LOWER, SPACE, mix, prefix_hash, span_hash, text_chunks, words

DECAY = 0.5
#: index steps between the letters of a subsequence; a step of 2 skips one letter
PATTERNS = ((1, 1), (2, 1), (1, 2), (2, 2), (1, 1, 1), (2, 1, 1), (1, 2, 1), (1, 1, 2))
TABLE_BITS = 18
N_LANDMARKS = 128
MAX_TRAIN = 1500  # labelled documents of each class the model is fitted on
MAX_TRAIN_CHARS = 10_000  # longer documents are not taken into the sample
MAX_WORD = 40
MIN_BAGS = 3  # documents a word must be the witness of
THRESHOLD = 0.7

_DROP = np.zeros(256, bool)
_DROP[:128] = [not (chr(b).isalnum() or SPACE[b]) for b in range(128)]


def instances(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, first letter of each instance and the end, first instance of
    each row and the end).  Each instance begins with a mark byte 1."""
    low = LOWER[data]
    keep = ~_DROP[low]
    kept = np.concatenate([[0], np.cumsum(keep)])
    low = low[keep]
    offs = kept[offs]
    starts, ends, first = words(low, offs)
    size = ends - starts
    row_head = np.zeros(len(starts) + 1, bool)
    row_head[first] = True
    head = np.ones(len(starts), bool)
    head[1:] = ~((size[1:] == 1) & (size[:-1] == 1)) | row_head[1:-1]
    at = np.concatenate([[0], np.cumsum(size)])  # letters before each word
    n_head = np.concatenate([[0], np.cumsum(head)])
    letters = np.ones(at[-1] + n_head[-1], np.uint8)
    body = np.ones(len(letters), bool)
    bounds = np.append(at[:-1][head] + np.arange(n_head[-1]), len(letters))
    body[bounds[:-1]] = False
    letters[body] = low[~SPACE[low]]
    return letters, bounds, n_head[first]


def features(letters: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(instance, table index, weight) of every subsequence, pattern by pattern."""
    owner = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
    c = letters.astype(np.uint32)
    for steps in PATTERNS:
        span = sum(steps)
        n = len(c) - span
        if n <= 0:
            continue
        h = c[:n].copy()
        at = 0
        for s in steps:
            at += s
            h *= np.uint32(0x01000193)
            h ^= c[at:at + n]
        h *= np.uint32(0x9E3779B1)
        h ^= np.uint32(len(steps))
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        inside = owner[:n] == owner[span:]
        yield owner[:n][inside], (h[inside] >> np.uint32(32 - TABLE_BITS)), DECAY ** (span - len(steps))


def norms(bounds: np.ndarray) -> np.ndarray:
    """Square root of an instance's summed squared weights, from its length."""
    size = np.diff(bounds)
    total = np.zeros(len(size))
    for steps in PATTERNS:
        total += np.maximum(size - sum(steps), 0) * DECAY ** (2 * (sum(steps) - len(steps)))
    return np.sqrt(np.maximum(total, 1.0))


def word_scores(letters: np.ndarray, bounds: np.ndarray, table: np.ndarray, bias: float) -> np.ndarray:
    out = np.zeros(len(bounds) - 1)
    for owner, at, weight in features(letters, bounds):
        out += np.bincount(owner, table[at], len(out)) * weight
    return out / norms(bounds) + bias


def bag_features(score: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per row: best word, second best, log count of words beyond the margin's
    half, and the same in relation to the row's length."""
    n = len(first) - 1
    out = np.zeros((n, 4))
    out[:, :2] = -2.0
    rows = np.flatnonzero(np.diff(first) > 0)
    if len(rows):
        at = first[rows]
        out[rows, 0] = np.maximum.reduceat(score, at)
        owner = np.repeat(np.arange(n), np.diff(first))
        rest = score.copy()
        top = np.flatnonzero(score == out[owner, 0])
        rest[top[np.unique(owner[top], return_index=True)[1]]] = -2.0
        out[rows, 1] = np.maximum.reduceat(rest, at)
        hits = np.add.reduceat((score > 0.0).astype(float), at)
        out[rows, 2] = np.log1p(hits)
        out[rows, 3] = np.log1p(100.0 * hits / np.diff(first)[rows])
    out[:, :2] = np.clip(out[:, :2], -2.0, 2.0)
    return out


# -- training ---------------------------------------------------------------------------------

def _svm(z: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Linear SVM with squared hinge loss by Newton steps on its active set."""
    z1 = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(z1.shape[1])
    reg = np.full(len(w), ridge)
    reg[-1] = 1e-6
    for _ in range(20):
        active = y * (z1 @ w) < 1
        a = z1[active] * cost[active][:, None]
        new = np.linalg.solve(a.T @ z1[active] + np.diag(reg), a.T @ y[active])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weighted logistic regression by damped Newton steps; the last weight is the bias."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    reg = np.full(len(w), ridge * weight.sum())
    reg[-1] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        grad = x1.T @ (weight * (p - y)) + reg * w
        hess = (x1 * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x1 + np.diag(reg + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
    return w


def _explicit(letters, bounds, pick):
    """Dense per-word kernel rows are small: (owner, index, value) lists of chosen words."""
    new = np.full(len(bounds) - 1, -1)
    new[pick] = np.arange(len(pick))
    o, i, v = [], [], []
    for owner, at, weight in features(letters, bounds):
        k = new[owner] >= 0
        o.append(new[owner[k]])
        i.append(at[k])
        v.append(np.full(k.sum(), weight))
    return np.concatenate(o), np.concatenate(i), np.concatenate(v) / norms(bounds)[pick][np.concatenate(o)]


def witnesses(in_tox: np.ndarray, in_clean: np.ndarray, n_tox: float, n_clean: float) -> tuple[np.ndarray, np.ndarray]:
    """Whether words speak for a toxic bag, and their weight, from the bags of
    each class that hold them.  A word all but absent from clean bags does; so
    does one met in some of them (quoted, or by a wrong label) if its odds are
    two to one at least, by two standard errors.  The weight is the odds' share."""
    odds = np.log((in_tox + 0.5) / (n_tox + 1)) - np.log((in_clean + 0.5) / (n_clean + 1))
    error = np.sqrt(1 / (in_tox + 0.5) + 1 / (in_clean + 0.5))
    tox, clean = in_tox / max(n_tox, 1), in_clean / max(n_clean, 1)
    return (in_clean <= 0.02 * in_tox) | (odds - 2 * error >= np.log(2)), tox / np.maximum(tox + clean, 1e-300)


def train(texts: list[str], toxic: np.ndarray, rounds: int = 4) -> dict:
    """Fits table, bias and document weights; deterministic for given rows.
    Without both classes the model scores every document 0; so it does, with a
    warning, where no word is a witness (see ``witnesses``)."""
    none = {"table": np.zeros(1 << TABLE_BITS), "bias": -2.0, "doc": np.zeros(5), "floor": True}
    if not len(texts) or toxic.min() == toxic.max():
        return none
    col = pa.array(texts, pa.large_string())
    # a third of the documents is kept from the words' statistics, for the document weights
    spare = np.arange(len(toxic)) % 3 == 2
    # distinct words with their letters, and (document, word) pairs, chunk by chunk
    seen, some_letters, some_sizes, pairs = [], [], [], []
    done = 0
    for lo, hi, data, offs in text_chunks(col):
        letters, bounds, first = instances(data, offs)
        h = span_hash(prefix_hash(letters), bounds[:-1], bounds[1:])
        uniq, rep, word = np.unique(h, return_index=True, return_inverse=True)
        row = np.repeat(np.arange(lo, hi), np.diff(first))
        pairs.append(np.unique((row * np.int64(1 << 31) + word)[~spare[row]]) + done)
        size = np.diff(bounds)[rep]
        to = np.cumsum(size) - size
        some_letters.append(letters[np.repeat(bounds[:-1][rep] - to, size) + np.arange(size.sum())])
        some_sizes.append(size)
        seen.append(uniq)
        done += len(uniq)
    vocab, rep, merged = np.unique(np.concatenate(seen), return_index=True, return_inverse=True)
    pair = np.concatenate(pairs)
    prow, pword = pair >> 31, merged[pair & ((1 << 31) - 1)]
    size = np.concatenate(some_sizes)
    at = np.cumsum(size) - size
    vb = np.concatenate([[0], np.cumsum(size[rep])])
    vl = np.concatenate(some_letters)[np.repeat(at[rep] - vb[:-1], size[rep]) + np.arange(vb[-1])]
    size = size[rep]
    in_tox = np.bincount(pword, toxic[prow], len(vocab))
    in_clean = np.bincount(pword, 1 - toxic[prow], len(vocab))
    speaks, weight = witnesses(in_tox, in_clean, toxic[~spare].sum(), (1 - toxic[~spare]).sum())
    usable = (size >= 4) & (size <= MAX_WORD)
    score = np.where(usable, np.log((in_tox + 0.05) / (in_clean + 0.5)), -9.0)
    tp = toxic[prow] == 1
    trow, tword = prow[tp], pword[tp]
    order = mix(vocab.copy())
    clean = np.flatnonzero(usable & (in_clean > 0))
    clean = clean[np.argsort(order[clean])]
    hard = np.zeros(0, np.int64)
    model = none
    for k in range(rounds):
        # witnesses: the best words of each toxic bag, two at first, later all beyond the margin
        by = np.lexsort((-score[tword], trow))
        r, w = trow[by], tword[by]
        head = np.ones(len(r), bool)
        head[1:] = r[1:] != r[:-1]
        nth = np.arange(len(r)) - np.flatnonzero(head)[np.cumsum(head) - 1]
        chosen = (nth < 1) | ((nth < 2 if k == 0 else (nth < 6) & (score[w] > 0.3)))
        pos, n_pos = np.unique(w[chosen & (score[w] > -9) & speaks[w]], return_counts=True)
        firm = n_pos >= min(MIN_BAGS, n_pos.max(initial=0))
        pos, n_pos = pos[firm], n_pos[firm]
        if not len(pos):
            warnings.warn("no word tells toxic training documents from clean ones: every document scores 0", RuntimeWarning, stacklevel=2)
            return none
        top = pos[np.argsort(-n_pos, kind="stable")][:4000]
        n_top = np.sort(n_pos)[::-1][:4000]
        neg = np.setdiff1d(np.concatenate([hard, clean[:8000]]), top)
        # landmarks: frequent witnesses and a spread of clean words
        marks = np.concatenate([top[:N_LANDMARKS // 2], neg[np.argsort(order[neg])][:N_LANDMARKS // 2]])
        mo, mi, mv = _explicit(vl, vb, marks)
        used, mi = np.unique(mi, return_inverse=True)  # the landmarks' subsequences; no other enters a kernel
        land = np.zeros((len(marks), len(used)))
        np.add.at(land, (mo, mi), mv)
        both = np.concatenate([top, neg])
        o, i, v = _explicit(vl, vb, both)
        where = np.full(1 << TABLE_BITS, -1, np.int32)
        where[used] = np.arange(len(used))
        i = where[i]
        o, i, v = o[i >= 0], i[i >= 0], v[i >= 0]
        kern = np.zeros((len(both), len(marks)))
        for j in range(len(marks)):
            kern[:, j] = np.bincount(o, land[j, i] * v, len(both))
        inner = land @ land.T
        val, vec = np.linalg.eigh((inner + inner.T) / 2)
        ok = val > 1e-6 * val.max()
        half = vec[:, ok] / np.sqrt(val[ok])
        z = kern @ half
        y = np.concatenate([np.ones(len(top)), -np.ones(len(neg))])
        cost = np.concatenate([np.minimum(n_top, 20.0) * weight[top], np.minimum(in_clean[neg], 20.0)])
        cost[:len(top)] *= cost[len(top):].sum() / cost[:len(top)].sum()
        beta = _svm(z, y, cost)
        table = np.zeros(1 << TABLE_BITS)
        table[used] = (half @ beta[:-1]) @ land
        score = np.where(usable, word_scores(vl, vb, table, beta[-1]), -9.0)
        worst = clean[np.argsort(-score[clean], kind="stable")]
        hard = np.unique(np.concatenate([hard, worst[:2000]]))
        model = {"table": table.astype(np.float32), "bias": float(beta[-1])}
    x = []
    for _, _, data, offs in text_chunks(col):
        letters, bounds, first = instances(data, offs)
        x.append(bag_features(word_scores(letters, bounds, model["table"], model["bias"]), first))
    x = np.concatenate(x)
    some = spare if toxic[spare].min(initial=1) < toxic[spare].max(initial=0) else ~spare
    share = toxic[some].mean()
    model["doc"] = logistic(x[some], toxic[some], np.where(toxic[some] == 1, 0.5 / share, 0.5 / (1 - share)))
    return model


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Trains on at most MAX_TRAIN documents of each class (in md5 order of
    their text, each text once) among labelled rows outside the hold-out fold."""
    fold = crc_remainder("doc_id", 3) != 1
    return trained(labelled_sample(docs, labels, "toxic", fold, MAX_TRAIN, MAX_TRAIN_CHARS), train)


def document_scores(col: pa.Array, model: dict) -> np.ndarray:
    out = np.zeros(len(col))
    if model.get("floor"):
        return out
    for lo, hi, data, offs in text_chunks(col):
        letters, bounds, first = instances(data, offs)
        x = bag_features(word_scores(letters, bounds, model["table"], model["bias"]), first)
        out[lo:hi] = 1 / (1 + np.exp(-np.clip((x * model["doc"][:-1]).sum(1) + model["doc"][-1], -30, 30)))
    return out


def scorer(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = document_scores(b.column("text"), model)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return run


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document.  Null and blank texts score as a document without
    words; repeated rows score alike; a very long text is one chunk of its own."""
    docs = documents(spark, sf_dir)
    model = fit(docs, load(spark, sf_dir, "labels"))
    rows = in_small_batches(docs).select("doc_id", "text", (crc_remainder("doc_id", 3) == 1).alias("held_out"))
    return rows.mapInArrow(scorer(model), "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, without those predicted toxic."""
    model = fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(document_scores(b.column("text"), model) < THRESHOLD))

    return in_small_batches(docs).mapInArrow(run, docs.schema)
