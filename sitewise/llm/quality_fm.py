"""Quality classifier: a factorisation machine over hashed words, structure
statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2))

The last term is every pairwise interaction at low rank, in time linear in
the document's features.  Words enter as hashed relative frequencies;
structure (symbols, repetition, capitals, lines) and the metadata that a text
has of itself (its length) as dense features.  Labels, language, source and
ids are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import crc_remainder, documents, in_small_batches, labelled_sample, load, trained
from .textnp import LOWER, SPACE, mix, text_chunks, word_hashes, words

HASH_BITS = 12
RANK = 8
MAX_TRAIN = 2000  # labelled documents of each class the model is fitted on
MAX_TRAIN_CHARS = 10_000
THRESHOLD = 0.3
N_STATS = 12

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>!{}[]=_~^\\@+"]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _count(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[offs]).astype(float)


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, hashed word, weight) triples and the rows' structure statistics, all scaled to about [0, 1]."""
    starts, ends, first = words(data, offs)
    n_rows, n_words = len(offs) - 1, np.diff(first).astype(float)
    hashes = word_hashes(LOWER[data], starts, ends)
    row = np.repeat(np.arange(n_rows), np.diff(first))
    slot = (hashes >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    pair, count = np.unique(row << HASH_BITS | slot, return_counts=True)
    prow, pslot = pair >> HASH_BITS, pair & ((1 << HASH_BITS) - 1)
    weight = np.sqrt(count)
    norm = np.sqrt(np.bincount(prow, count, n_rows))
    weight = weight / np.maximum(norm, 1.0)[prow]
    size = np.maximum(np.diff(offs), 1).astype(float)
    some = np.maximum(n_words, 1.0)
    letters = np.maximum(_count(_LETTER[data], offs), 1.0)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    distinct = np.bincount(row[np.unique(hashes ^ mix(row.astype(np.uint64) + np.uint64(1)), return_index=True)[1]], minlength=n_rows)
    length = (ends - starts).astype(float)
    one = np.bincount(row, length == 1, n_rows) / some
    ends_odd = np.bincount(row, _SYMBOL[data[ends - 1]], n_rows) / some if len(ends) else np.zeros(n_rows)
    lines = _count(data == 10, offs) + 1
    stats = np.stack([
        np.minimum(_count(_SYMBOL[data], offs) / some, 2.0) / 2, ends_odd,
        _count(_UPPER[data], offs) / letters, _count(_DIGIT[data], offs) / size,
        np.bincount(row, same, n_rows) / some, 1 - distinct / some,
        np.minimum(np.bincount(row, length, n_rows) / some / 20, 1.0), one,
        np.minimum(lines / some, 1.0), _count(~SPACE[data], offs) / size,
        np.minimum(np.log1p(n_words) / 10, 1.5), (n_words == 0).astype(float)], axis=1)
    return prow, pslot, weight, stats


def fm_scores(prow, pslot, weight, stats, model: dict) -> np.ndarray:
    """Margins by the sum-of-squares identity, each row summed by itself: equal
    texts score alike wherever they stand in a batch."""
    n = len(stats)
    x = (stats - model["mean"]) / model["scale"]
    w, v = model["w"], model["v"]
    k = 1 << HASH_BITS
    linear = model["w0"] + np.bincount(prow, w[:k][pslot] * weight, n) + (x * w[k:]).sum(1)
    total = np.zeros(n)
    for f in range(v.shape[1]):
        s = np.bincount(prow, v[:k, f][pslot] * weight, n) + (x * v[k:, f]).sum(1)
        q = np.bincount(prow, (v[:k, f][pslot] * weight) ** 2, n) + (x ** 2 * v[k:, f] ** 2).sum(1)
        total += s * s - q
    return linear + 0.5 * total


def train(texts: list[str], quality: np.ndarray, epochs: int = 12, batch: int = 256, rate: float = 0.02) -> dict:
    """Adam on the weighted logistic loss; deterministic for given rows.  With
    one class only the model is that class's constant."""
    k = 1 << HASH_BITS
    rng = np.random.default_rng(7)
    model = {"w0": 0.0, "w": np.zeros(k + N_STATS), "v": rng.normal(0, 0.01, (k + N_STATS, RANK)), "mean": np.zeros(N_STATS), "scale": np.ones(N_STATS)}
    if not len(texts) or quality.min() == quality.max():
        model["w0"], model["v"] = (3.0 if len(texts) and quality[0] == 1 else -3.0 if len(texts) else 0.0), model["v"] * 0
        return model
    got = [features(d, o) for _, _, d, o in text_chunks(pa.array(texts, pa.large_string()))]
    shift = np.cumsum([0] + [len(g[3]) for g in got])
    prow = np.concatenate([g[0] + s for g, s in zip(got, shift, strict=False)])
    pslot, weight = np.concatenate([g[1] for g in got]), np.concatenate([g[2] for g in got])
    stats = np.concatenate([g[3] for g in got])
    model["mean"], model["scale"] = stats.mean(0), stats.std(0) + 1e-3
    x = (stats - model["mean"]) / model["scale"]
    at = np.searchsorted(prow, np.arange(len(stats) + 1))
    share = quality.mean()
    cost = np.where(quality == 1, 0.5 / share, 0.5 / (1 - share))
    params = [np.zeros(1), model["w"], model["v"]]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(stats))
        for lo in range(0, len(order), batch):
            rows = order[lo:lo + batch]
            cnt = at[rows + 1] - at[rows]
            idx = np.repeat(at[rows] - np.concatenate([[0], np.cumsum(cnt)[:-1]]), cnt) + np.arange(cnt.sum())
            local, slot, val = np.repeat(np.arange(len(rows)), cnt), pslot[idx], weight[idx]
            w0, w, v = params
            xv, xd = val[:, None] * v[slot], x[rows]
            s = np.zeros((len(rows), RANK))
            np.add.at(s, local, xv)
            s += xd @ v[k:]
            q = np.zeros((len(rows), RANK))
            np.add.at(q, local, xv * xv)
            q += (xd ** 2) @ (v[k:] ** 2)
            z = w0[0] + np.bincount(local, w[slot] * val, len(rows)) + xd @ w[k:] + 0.5 * (s * s - q).sum(1)
            g = cost[rows] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - quality[rows]) / len(rows)
            gw, gv = np.zeros_like(w), np.zeros_like(v)
            np.add.at(gw, slot, g[local] * val)
            gw[k:] = g @ xd
            np.add.at(gv, slot, (g[local] * val)[:, None] * (s[local] - xv))
            gv[k:] = xd.T @ (g[:, None] * s) - ((g @ (xd ** 2))[:, None] * v[k:])
            step += 1
            lr = rate * min(1.0, 2.0 * (1 - epoch / epochs))
            for p, grad, a, b in zip(params, (np.array([g.sum()]), gw + 1e-5 * w, gv + 1e-4 * v), m1, m2, strict=True):
                a *= 0.9
                a += 0.1 * grad
                b *= 0.999
                b += 0.001 * grad * grad
                p -= lr * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    model["w0"], model["w"], model["v"] = float(params[0][0]), params[1], params[2]
    return model


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Trains on at most MAX_TRAIN documents of each class (each text once, in
    md5 order) among labelled rows outside the hold-out fold."""
    fold = crc_remainder("doc_id", 5) != 0
    return trained(labelled_sample(docs, labels, "quality", fold, MAX_TRAIN, MAX_TRAIN_CHARS), train)


def scorer(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = np.zeros(b.num_rows)
            for lo, hi, data, offs in text_chunks(b.column("text")):
                z[lo:hi] = fm_scores(*features(data, offs), model)
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return run


def op6_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document.  Null and blank texts score by their structure
    alone; repeated rows score alike; labels that disagree count as 0."""
    docs = documents(spark, sf_dir)
    model = fit(docs, load(spark, sf_dir, "labels"))
    rows = in_small_batches(docs).select("doc_id", "text", (crc_remainder("doc_id", 5) == 0).alias("held_out"))
    return rows.mapInArrow(scorer(model), "doc_id long, held_out boolean, score double, predicted int")
