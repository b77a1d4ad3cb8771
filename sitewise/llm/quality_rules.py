"""Quality rules whose cutoffs are risk-controlled.

Documents have signals (shares of symbols, repetition, capitals and so on)
and are rejected where any passes its cutoff.  A ladder of cutoff sets, from
lax to strict, is laid through the good labelled documents of one fold; on
the other fold each stratum (language) climbs it as far as an exact binomial
upper bound proves that at most RISK of its good documents are rejected.
The bounds hold for all strata together with probability 1 - ERROR: the
strata share ERROR (Bonferroni), and within a stratum the ladder is tested in
order, stopping at the first failure, which needs no further correction.
Of the proven sets the one that rejects the bad documents best is used; a
stratum with too few labels to prove any keeps all that the base rules keep.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_remainder, documents, in_small_batches, load, materialize
from .textnp import SPACE, mix, prefix_hash, shingles, span_hash, text_chunks, words

RISK = 0.01
ERROR = 0.05
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
#: cutoffs as (quantile of the good documents, factor on it)
LADDER = ((1.0, 2.0), (1.0, 1.5), (1.0, 1.2), (1.0, 1.0), (0.9995, 1.0), (0.999, 1.0), (0.998, 1.0), (0.995, 1.0), (0.99, 1.0))
SIGNALS = ("symbol_share", "odd_end_share", "upper_share", "repeat_share", "same_next_share", "dup_line_share", "mean_word")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_ODD = np.zeros(256, bool)
_ODD[[ord(c) for c in "#*$%&|<>!{}[]=_~^\\@+"]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_STATS = "doc_id long, rk long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " + ", ".join(f"{s} double" for s in SIGNALS)


def _per_row(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(mask)])[offs])


def statistics(data: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """Base counts and signals of each row of a chunk, in the order of _STATS."""
    n_rows = len(offs) - 1
    starts, ends, first = words(data, offs)
    n_words = np.diff(first)
    row = np.repeat(np.arange(n_rows), n_words)
    prefix = prefix_hash(data)
    hashes = span_hash(prefix, starts, ends)
    word_chars = _per_row(~SPACE[data] & ((data & 0xC0) != 0x80), offs)
    n_symbols = _per_row(_SYMBOL[data], offs)
    # words inside a window that the row has twice
    long_rows = n_words >= WINDOW
    tok, at = shingles(hashes, first, WINDOW)
    own = np.repeat(np.arange(n_rows), np.diff(at))
    salted = tok ^ mix(own.astype(np.uint64) + np.uint64(1))
    _, inverse, count = np.unique(salted, return_inverse=True, return_counts=True)
    twice = (count[inverse] > 1) & long_rows[own]
    begin = first[own] + np.arange(len(tok)) - at[own]
    cover = np.zeros(len(starts) + WINDOW + 1, np.int64)
    np.add.at(cover, begin[twice], 1)
    np.add.at(cover, begin[twice] + WINDOW, -1)
    n_repeat = np.bincount(row, np.cumsum(cover)[:len(starts)] > 0, n_rows).astype(np.int64)
    # lines with a word, and those among them that stood before
    cuts = np.unique(np.concatenate([offs, np.flatnonzero(data == 10) + 1]))
    l_start, l_end = cuts[:-1], cuts[1:].copy()
    l_end[data[l_end - 1] == 10] -= 1
    has_word = np.searchsorted(starts, l_end) > np.searchsorted(starts, l_start)
    l_start, l_end = l_start[has_word], l_end[has_word]
    l_row = np.searchsorted(offs, l_start, "right") - 1
    line = span_hash(prefix, l_start, l_end) ^ mix(l_row.astype(np.uint64) + np.uint64(1))
    n_lines = np.bincount(l_row, minlength=n_rows)
    n_dup = n_lines - np.bincount(l_row[np.unique(line, return_index=True)[1]], minlength=n_rows)
    some, chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
    odd = np.bincount(row, _ODD[data[ends - 1]], n_rows) if len(ends) else np.zeros(n_rows)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    signals = [n_symbols / chars, odd / some, _per_row(_UPPER[data], offs) / chars, n_repeat / some,
               np.bincount(row, same, n_rows) / some, n_dup / np.maximum(n_lines, 1), word_chars / some]
    return [n_words, word_chars, n_symbols, n_dup, n_repeat, *(np.round(s, 4) for s in signals)]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offs in text_chunks(batch.column(1)):
            cols = statistics(data, offs)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), batch.column(3).slice(lo, hi - lo),
                *(pa.array(c.astype(np.int64)) for c in cols[:5]), *(pa.array(c.astype(float)) for c in cols[5:])],
                names=[f.split()[0] for f in _STATS.split(", ")])


def upper_bound(k: int, n: int, error: float) -> float:
    """Exact (Clopper-Pearson) upper bound of a rate of which k of n were
    seen: the p at which k or fewer have probability ``error``."""
    if k >= n:
        return 1.0
    i = np.arange(k + 1)
    lg = np.array([math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) for j in range(k + 1)])
    lo, hi = k / n, 1.0
    for _ in range(60):
        p = (lo + hi) / 2
        terms = lg + i * math.log(p) + (n - i) * math.log1p(-p) if p < 1 else np.full(k + 1, -np.inf)
        top = terms.max()
        tail = math.exp(top) * np.exp(terms - top).sum() if np.isfinite(top) else 0.0
        lo, hi = (p, hi) if tail > error else (lo, p)
    return hi


def passes(cuts: dict[str, float]) -> "F.Column":
    """No signal above its cutoff."""
    out = F.lit(True)
    for s in SIGNALS:
        out = out & (F.col(s) <= F.lit(float(cuts[s])))
    return out


def choose(strata: list[dict], rungs: int, risk: float = RISK, error: float = ERROR) -> dict:
    """Rung of the ladder for each stratum, -1 for none.  A stratum is a dict
    of stratum, good, bad (documents of the calibration fold), false_k and
    hit_k (good and bad ones that rung k rejects)."""
    out = {}
    for s in strata:
        proven = []
        for k in range(rungs):
            if not s["good"] or upper_bound(int(s[f"false_{k}"]), int(s["good"]), error / len(strata)) > risk:
                break
            proven.append(k)
        # bad documents caught, a good one lost weighing ten times as much; the laxest of equals
        value = [s[f"hit_{k}"] / max(1, s["bad"]) - 10 * s[f"false_{k}"] / s["good"] for k in proven]
        out[s["stratum"]] = proven[int(np.argmax(value))] if proven else -1
    return out


def rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """One row per document: doc_id, rk, base counts, base_failed, rung,
    kept and the signals.

    Null and blank texts have no words and fail the base rules; null is a
    stratum of its own; a document whose labels disagree counts as bad, and so
    does a text whose copies' labels do; rows that repeat an id are judged each
    by its own text.  There are as many
    strata on the driver as languages.
    """
    rows = in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("rk"), F.col(stratum).cast("string").alias("stratum"))
    stats = materialize(rows.mapInArrow(_statistics, _STATS))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    stats = stats.withColumn("base_failed", failed).withColumn("stratum", F.concat(F.lit("="), "stratum")).fillna({"stratum": "null"})
    lab = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = stats.where(~F.col("base_failed")).join(lab.withColumnRenamed("doc_id", "l_id"), F.col("doc_id") == F.col("l_id"))
    # the bound counts independent trials: one a distinct text, its copies in one fold with it
    held = held.groupBy("stratum", "rk").agg(F.min("quality").alias("quality"), *[F.first(s).alias(s) for s in SIGNALS])
    held = materialize(held.withColumn("fold", crc_remainder("rk", 2)))
    levels = sorted({q for q, _ in LADDER})
    good = held.where("fold = 0 and quality = 1").agg(*[F.percentile_approx(s, levels, 100_000).alias(s) for s in SIGNALS]).first()
    if good[0] is None:  # no labelled good documents to lay the ladder through
        return stats.withColumn("rung", F.lit(-1)).withColumn("kept", ~F.col("base_failed"))
    ladder = [{s: good[s][levels.index(q)] * f for s in SIGNALS} for q, f in LADDER]
    isgood, isbad = F.col("quality") == 1, F.col("quality") != 1
    counts = [F.count_if(isgood).alias("good"), F.count_if(isbad).alias("bad")]
    for k, cuts in enumerate(ladder):
        counts += [F.count_if(isgood & ~passes(cuts)).alias(f"false_{k}"), F.count_if(isbad & ~passes(cuts)).alias(f"hit_{k}")]
    strata = [r.asDict() for r in held.where("fold = 1").groupBy("stratum").agg(*counts).orderBy("stratum").collect()]
    chosen = choose(strata, len(LADDER))
    verdict, rung = F.lit(True), F.lit(-1)
    for k, cuts in enumerate(ladder):
        names = [s for s, at in chosen.items() if at == k]
        if names:
            verdict = F.when(F.col("stratum").isin(names), passes(cuts)).otherwise(verdict)
            rung = F.when(F.col("stratum").isin(names), F.lit(k)).otherwise(rung)
    return stats.withColumn("rung", rung).withColumn("kept", ~F.col("base_failed") & verdict)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules(documents(spark, sf_dir), load(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rung", *SIGNALS)
