"""Drawing documents that look like a target, by hashed n-gram importance.

Every document is scanned once: :mod:`prefix_crc` gives the CRC of each of
its n-grams, whose remainder is the n-gram's bucket.  The buckets are written
as a table, so both the counts over all documents and, afterwards, each
document's mean gain come from it without reading a text again.  A gain says
how much more frequent a bucket is in the target than in the documents.  The
draw adds Gumbel noise fixed by the id to the weight and takes the highest
scores, which is sampling without repetition in proportion to the weights.

Null and blank texts have no n-grams and weight 0.  Rows that repeat an id
are scored each, with the same noise, and tie; of rows that tie in score and
id any may come first.  A null id draws the noise of an empty id and comes
after other ids.  Empty documents give no rows; an empty target leaves all
gains to the documents' own counts.  Other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, load, materialize
from .prefix_crc import ngram_crcs
from .textnp import text_chunks

BUCKETS = 10_000
MAX_N = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024


def _features(max_n: int, buckets: int):
    """(…, text) → (…, n_words, n_features, buckets): two bytes a feature, four where there are more than 65 536 buckets."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for lo, hi, data, offs in text_chunks(batch.column(at)):
                crc, row, n_words = ngram_crcs(data, offs, max_n)
                held = (crc % np.uint32(buckets)).astype(kind)
                packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer((row * kind.itemsize).astype(np.int64)), pa.py_buffer(held)])
                rest = [c.slice(lo, hi - lo) for i, c in enumerate(batch.columns) if i != at]
                names = [f for i, f in enumerate(batch.schema.names) if i != at]
                yield pa.RecordBatch.from_arrays([*rest, pa.array(n_words.astype(np.int64)), pa.array(np.diff(row).astype(np.int64)), packed.cast(pa.binary())],
                                                 names=[*names, "n_words", "n_features", "buckets"])
    return run, kind


def features(df: DataFrame, key: str, text: str = "text", max_n: int = MAX_N, buckets: int = BUCKETS) -> DataFrame:
    """A written table of key, row_no, n_words, n_features and buckets, one row per row."""
    run, _ = _features(max_n, buckets)
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    out = rows.mapInArrow(run, f"key {dict(rows.dtypes)['key']}, n_words long, n_features long, buckets binary")
    # the number is written with its row, so that later reads agree on it
    return materialize(out.withColumn("row_no", F.monotonically_increasing_id()), batch_rows=1000)


def _packed(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets and bytes of a binary column without nulls."""
    col = col.cast(pa.large_binary())
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return offs - offs[0], data[offs[0]:offs[-1]]


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of the buckets that occur; a task sums its rows first."""
    kind = _features(MAX_N, buckets)[1]

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_packed(batch.column(0))[1].view(kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at])], names=["bucket", "n"])

    return found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(spark: SparkSession, corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed share in the target
    to that in the corpus, floored; one number a bucket, at most ``buckets``
    rows come to the driver."""
    s, t = bucket_counts(corpus, buckets), bucket_counts(target, buckets)
    both = spark.range(buckets).withColumnRenamed("id", "b").join(s.select(F.col("bucket").alias("b"), F.col("n").alias("s")), "b", "left")
    both = both.join(t.select(F.col("bucket").alias("b"), F.col("n").alias("t")), "b", "left").fillna(0)
    both = materialize(both.select("b", F.col("s").cast("double").alias("s"), F.col("t").cast("double").alias("t")))
    sums = both.agg(F.sum("s").alias("s_all"), F.sum("t").alias("t_all"))
    k = F.lit(float(buckets))
    ratio = (F.col("t") + 1.0) * (sums.select(F.col("s_all") + k).scalar()) / ((F.col("s") + 1.0) * (sums.select(F.col("t_all") + k).scalar()))
    out = both.select("b", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("g")).toPandas()
    table = np.zeros(buckets, np.int64)
    table[out["b"].to_numpy()] = out["g"].to_numpy()
    return table


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``found`` with weight, the floored mean gain of its features, for its buckets."""
    kind = _features(MAX_N, len(gain))[1]

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("buckets")
            offs, data = _packed(batch.column(at))
            total = np.concatenate([[0], np.cumsum(gain[data.view(kind)])])[offs // kind.itemsize]
            n = np.diff(offs) // kind.itemsize
            rest = [c for i, c in enumerate(batch.columns) if i != at]
            names = [f for i, f in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(np.where(n > 0, np.diff(total) // np.maximum(n, 1), 0))], names=[*names, "weight"])

    kept = found.select("key", "row_no", "n_words", "n_features", "buckets")
    return kept.mapInArrow(run, f"key {dict(kept.dtypes)['key']}, row_no long, n_words long, n_features long, weight long")


def gumbel(key: str, seed: int = SEED) -> "F.Column":
    """Floored thousandths of Gumbel noise that the key's digest fixes."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` with rank 1, 2, ... for the drawn rows, null for the others.

    Rows are range-partitioned by (score, key, row_no), so neither equal
    scores nor repeated rows gather in a task; a row's rank is its place in
    its partition after the rows of the partitions before.
    """
    able = F.col("n_words") >= min_words
    n_drawn = scored.where(able).count() * percent // 100
    order = [F.col("score").desc(), F.col("key").asc_nulls_last(), F.col("row_no").asc()]
    placed = materialize(scored.where(able).repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    parts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    # one row a partition from here on
    ahead = F.sum("rows").over(Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(F.col("part").alias("p"), F.coalesce(ahead, F.lit(0)).alias("ahead"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    ranked = placed.withColumn("inside", inside).join(parts, F.col("part") == F.col("p"))
    ranked = ranked.withColumn("rank", (F.col("ahead") + F.col("inside")).cast("long"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank"))).select(*scored.columns, "rank")
    return ranked.unionByName(scored.where(~able).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", max_n: int = MAX_N, buckets: int = BUCKETS,
             percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: key, row_no, n_words, n_features, weight, score and rank (null: not drawn)."""
    corpus = features(docs, doc_id, max_n=max_n, buckets=buckets)
    wanted = features(target.select(F.lit(0).alias("item"), "text"), "item", max_n=max_n, buckets=buckets)
    scored = weights(corpus, gains(docs.sparkSession, corpus, wanted, buckets))
    scored = materialize(scored.withColumn("score", F.col("weight") + gumbel("key", seed)))
    return draw(scored, percent, min_words)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(documents(spark, sf_dir), load(spark, sf_dir, "benchmark"))
    return out.select(F.col("key").cast("long").alias("doc_id"), "n_features", "weight", "score", "rank")


ORACLE = rf"""
WITH tb AS (SELECT list_transform(range(256), lambda n: list_reduce([n] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS ws FROM benchmark),
dw AS (SELECT r, w, count(*) AS n FROM (SELECT r, unnest(ws) AS w FROM d) GROUP BY r, w),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(ws) AS w FROM b) GROUP BY w),
v AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
c AS (SELECT w, xor(4294967295, list_reduce([4294967295] || list_transform(range(len(h) // 2), lambda i: CAST('0x' || h[2 * i + 1:2 * i + 2] AS BIGINT)),
  lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1]))) % {BUCKETS} AS k FROM v, tb),
s AS (SELECT k, sum(n) AS s FROM dw JOIN c USING (w) GROUP BY k),
t AS (SELECT k, sum(n) AS t FROM bw JOIN c USING (w) GROUP BY k),
z AS (SELECT coalesce((SELECT sum(s) FROM s), 0) AS ss, coalesce((SELECT sum(t) FROM t), 0) AS tt),
g AS (SELECT k, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (ss + {BUCKETS}.0::DOUBLE) / ((s + 1.0::DOUBLE) * (tt + {BUCKETS}.0::DOUBLE)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (k), z),
m AS (SELECT r, sum(dw.n * gain) AS total FROM dw JOIN c USING (w) JOIN g USING (k) GROUP BY r),
e AS (SELECT doc_id, r, len(ws) AS n_features, CASE WHEN len(ws) = 0 THEN 0 ELSE CAST(floor(total / CAST(len(ws) AS DOUBLE)) AS BIGINT) END AS weight,
  CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN m USING (r)),
f AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM e),
o AS (SELECT *, CASE WHEN n_features >= {MIN_WORDS} THEN row_number() OVER (PARTITION BY n_features >= {MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST, r) END AS place,
  (SELECT count(*) * {PERCENT} // 100 FROM f WHERE n_features >= {MIN_WORDS}) AS most FROM f)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN place <= most THEN CAST(place AS BIGINT) END AS rank FROM o
"""
