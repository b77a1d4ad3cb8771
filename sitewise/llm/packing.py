"""Packing into length buckets whose boundaries minimise padding.

Batches pad every document to its bucket's boundary, so the boundaries are
chosen by dynamic programming over the histogram of all lengths, one row for
each length that occurs; inside a bucket a batch holds as many documents as the
token budget has room for.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, materialize, n_words, order_key, running_sums

N_BUCKETS = 16
TOKEN_BUDGET = 16_384


def best_boundaries(longest: np.ndarray, count: np.ndarray, words: np.ndarray, n_buckets: int) -> list[int]:
    """Boundaries (ascending, the last the longest length) of at most
    ``n_buckets`` buckets with the least padding: rows i..j in one bucket cost
    longest[j] * documents - words.  As a function of longest[j] that is a line
    for each i, ever steeper, so the least of them is kept as a lower hull and
    read along it: O(buckets * rows), in whole numbers."""
    order = np.argsort(longest)
    top = longest[order].tolist()
    docs, toks = np.cumsum(count[order]).tolist(), np.cumsum(words[order]).tolist()
    n = len(top)
    if not n:
        return []
    cost = [x * d - t for x, d, t in zip(top, docs, toks, strict=True)]
    cuts = []
    for _ in range(min(n_buckets, n) - 1):
        best, cut = list(cost), np.full(n, -1)
        hull: list[tuple[int, int, int]] = []  # fall, height at 0, last row of the bucket before
        at = 0
        for j in range(1, n):
            fall, height = docs[j - 1], cost[j - 1] + toks[j - 1]
            while len(hull) > 1:
                (f1, h1, _), (f2, h2, _) = hull[-2:]
                if (height - h1) * (f2 - f1) > (h2 - h1) * (fall - f1):
                    break
                hull.pop()
            hull.append((fall, height, j - 1))
            x, at = top[j], min(at, len(hull) - 1)
            while at + 1 < len(hull) and hull[at + 1][1] - hull[at + 1][0] * x <= hull[at][1] - hull[at][0] * x:
                at += 1
            via = hull[at][1] - hull[at][0] * x + x * docs[j] - toks[j]
            if via < best[j]:
                best[j], cut[j] = via, hull[at][2]
        cost = best
        cuts.append(cut)
    bounds, j = [], n - 1
    for cut in reversed(cuts):
        if cut[j] >= 0:
            bounds.append(int(top[j]))
            j = int(cut[j])
    bounds.append(int(top[j]))
    return bounds[::-1]


def pack(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n_buckets: int = N_BUCKETS, budget: int = TOKEN_BUDGET) -> DataFrame:
    """One row per document: doc_id, row_key, length (words), bucket (from 0),
    bucket_length (its boundary), batch (from 0 in its bucket), slot, padding.

    A document longer than the budget has a batch of its own; one without
    words (null or blank text) needs no batch and gets bucket, bucket_length,
    batch and slot null, padding 0.  Rows of equal length and id are told
    apart by their text; identical rows are interchangeable, each has its own
    slot.  An empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), n_words(text).alias("length"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_md5"))
    rows = materialize(rows.withColumn("row_key", order_key("doc_id", "text_md5")).drop("text_md5"))
    hist = rows.where("length > 0").groupBy(F.col("length").alias("longest")).agg(F.count("*").alias("n"), F.sum("length").alias("words"))
    # no more rows than the longest document has words; r of them need r * r / 2 words in the corpus
    hist = hist.orderBy("longest").toPandas()
    bounds = best_boundaries(hist["longest"].to_numpy(), hist["n"].to_numpy(), hist["words"].to_numpy(), n_buckets)
    bucket = F.lit(None).cast("int")
    for k in reversed(range(len(bounds))):
        bucket = F.when(F.col("length") <= bounds[k], F.lit(k)).otherwise(bucket)
    rows = rows.withColumn("bucket", F.when(F.col("length") > 0, bucket))
    room = F.lit(None).cast("long")
    for k, b in enumerate(bounds):
        room = F.when(F.col("bucket") == k, F.lit(b).cast("long")).otherwise(room)
    rows = rows.withColumn("bucket_length", room)
    # rows without words keep out of the numbering, and out of its partitions
    numbered = running_sums(rows.where("length > 0"), "bucket", ["row_key"], F.lit(1).cast("long"), int(hist["n"].sum()) if len(hist) else 0, "nth")
    fits = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.col("bucket_length")).cast("long"))
    numbered = numbered.select("doc_id", "row_key", "length", "bucket", "bucket_length", F.floor(F.col("nth") / fits).cast("long").alias("batch"), (F.col("nth") % fits).cast("int").alias("slot"), (F.col("bucket_length") - F.col("length")).alias("padding"))
    none = rows.where("length = 0").select("doc_id", "row_key", "length", "bucket", "bucket_length", F.lit(None).cast("long").alias("batch"), F.lit(None).cast("int").alias("slot"), F.lit(0).cast("long").alias("padding"))
    return numbered.unionByName(none)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir)).drop("row_key")
