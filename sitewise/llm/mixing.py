"""Mixing sources to target weights along a time-varying curriculum.

Every source has a target amount of words and a weight schedule over the
progress t in [0, 1] of training.  Its cumulative demand is the integral of
its schedule scaled to the target; a document whose words lie at a given
place of its source's stream is trained at the progress where the demand
reaches that place (the inverse of the integral).  Sorting by that position
is one range partition.  DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, materialize, n_words, order_key, running_sums

MAX_EPOCHS = 3
CYCLE = (5, 2, 1)
RAMP = 0.8


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight, ramp, target) from per-document sizes.

    Weights follow CYCLE over the sources by code point, null last; the mix
    has as many words as all documents.  A target stops at MAX_EPOCHS times
    its source; what it gives up goes to the others by weight.  In order of
    the share at which each source fills up, the filled ones are a prefix,
    so the common level is the first one that the next source can bear.
    The table has one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    # one row per source from here on: the windows below order sources, not documents
    rank = Window.partitionBy(F.lit(1)).orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    nth = (F.row_number().over(rank) - 1) % len(CYCLE)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in CYCLE]), (nth + 1).cast("int")))
    per = per.withColumn("full_at", F.col("source_size") * F.lit(MAX_EPOCHS) / F.col("weight"))
    fill = Window.partitionBy(F.lit(1)).orderBy("full_at", F.col("source").isNull(), F.col("source").cast("binary"))
    earlier, everyone = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(1))
    per = per.withColumn("gone", F.coalesce(F.sum(F.col("source_size") * MAX_EPOCHS).over(earlier), F.lit(0)))
    per = per.withColumn("left", F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
    per = per.withColumn("level", (F.sum("source_size").over(everyone) - F.col("gone")) / F.col("left"))
    per = per.withColumn("first", F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "level"))).over(everyone))
    per = per.withColumn("target", F.least((F.col("source_size") * MAX_EPOCHS).cast("double"), F.col("first.level") * F.col("weight")))
    # heavy sources fade out of the mix and light ones come in: w(t) = 1 + ramp * (1 - 2t)
    ramp = F.lit(RAMP) * (F.col("weight") - F.lit(2.0)) / F.lit(float(max(CYCLE)))
    return per.select("source", "source_size", "weight", ramp.alias("ramp"), "target")


def progress(place: "F.Column", ramp: "F.Column") -> "F.Column":
    """Inverse of the cumulative demand t + ramp * (t - t*t), the integral of
    1 + ramp * (1 - 2t), for a place in [0, 1]."""
    b = F.lit(1.0) + ramp
    root = F.sqrt(F.greatest(b * b - F.lit(4.0) * ramp * place, F.lit(0.0)))
    return F.when(F.abs(ramp) < 1e-9, place).otherwise(F.lit(2.0) * place / (b + root))


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, row_key, size, source, source_size,
    target, taken (words), copies (times it is read, the last one perhaps cut
    at the words left) and position, the progress of its first reading.

    The source's documents in md5 order are its stream; the mix reads the
    stream round and round until the target is met, so the document where it
    ends gives only the words still wanted and the sum meets the target to
    within a word.  A null text or a source without words has size 0 and
    gives nothing; null is a source of its own; repeated rows count each;
    an empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_md5"), n_words(text).alias("size"))
    rows = materialize(rows.withColumn("row_key", order_key("doc_id", "source", "text_md5")))
    targets = source_targets(rows).withColumnRenamed("source", "t_source")
    stream = running_sums(rows, "source", ["row_key"], F.col("size"), rows.count())
    joined = stream.join(targets, stream["source"].eqNullSafe(targets["t_source"])).drop("t_source")
    want = F.floor("target").cast("long")
    rounds = F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))).otherwise(0).cast("long")
    last = want - rounds * F.col("source_size")
    extra = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), last - F.col("before")))
    out = joined.withColumn("taken", (rounds * F.col("size") + extra).cast("long"))
    out = out.withColumn("copies", (rounds * (F.col("size") > 0).cast("long") + (extra > 0).cast("long")).cast("long"))
    place = F.when(F.col("target") > 0, (F.col("before") + F.col("size") / 2) / F.col("target")).otherwise(F.lit(1.0))
    position = F.when(F.col("taken") > 0, progress(F.least(place, F.lit(1.0)), F.col("ramp")))
    return out.select("doc_id", "row_key", "size", "source", "source_size", "target", "taken", "copies", "before", "ramp", position.alias("position"))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per reading of a document (copy 0, 1, ...), ordered over range
    partitions by the training position of each reading."""
    reads = mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    place = (F.col("copy") * F.col("source_size") + F.col("before") + F.col("size") / 2) / F.col("target")
    reads = reads.withColumn("position", progress(F.least(place, F.lit(1.0)), F.col("ramp")))
    return reads.orderBy("position", "row_key", "copy")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents, all columns, each as often as the mix reads it, in
    training order over range partitions.  A reading that the target would cut
    is kept whole.  Rows that agree in id, source and text come out together
    as often as all of them are read, with the first of their other columns."""
    reads = mix(docs).groupBy("row_key").agg(F.sum("copies").alias("copies"), F.min("before").alias("before"), F.min("size").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("ramp").alias("ramp"))
    reads = reads.where("copies > 0")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), F.md5(F.coalesce(F.col("row.text"), F.lit(""))).alias("text_md5"))
    rows = rows.select("row", order_key("doc_id", "source", "text_md5").alias("key")).dropDuplicates(["key"]).join(reads, F.col("key") == F.col("row_key"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    place = (F.col("copy") * F.col("source_size") + F.col("before") + F.col("size") / 2) / F.col("target")
    rows = rows.withColumn("position", progress(F.least(place, F.lit(1.0)), F.col("ramp")))
    return rows.orderBy("position", "key", "copy").select("row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In training order, over range partitions; documents that are not read come last."""
    out = mix(documents(spark, sf_dir)).orderBy(F.col("position").asc_nulls_last(), "row_key")
    return out.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 6).alias("position"))


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source, md5(concat(coalesce(CAST(doc_id AS VARCHAR), chr(0)), chr(31), coalesce(source, chr(0)), chr(31), md5(coalesce(text, '')))) AS k,
    coalesce(len(regexp_extract_all(text, '[^ \\x09-\\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source COLLATE "binary") - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
-- the sources that stop early, found by trying each level against all sources
lv AS (
  SELECT a.source_size * 3.0 / a.weight AS fills,
    (SELECT sum(source_size) FROM s) - sum(CASE WHEN b.source_size * 3 * a.weight < a.source_size * 3 * b.weight THEN b.source_size * 3 ELSE 0 END) AS words_left,
    sum(CASE WHEN b.source_size * 3 * a.weight < a.source_size * 3 * b.weight THEN 0 ELSE b.weight END) AS weight_left
  FROM w a CROSS JOIN w b GROUP BY a.source, a.source_size, a.weight),
lam AS (SELECT arg_min(CAST(words_left AS DOUBLE) / CAST(weight_left AS DOUBLE), fills) AS level FROM lv
  WHERE CAST(fills AS DOUBLE) >= CAST(words_left AS DOUBLE) / CAST(weight_left AS DOUBLE)),
t AS (SELECT w.*, least(CAST(source_size * 3 AS DOUBLE), level * weight) AS target, {RAMP} * (weight - 2.0) / 5.0 AS ramp FROM w, lam),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.ramp,
    CASE WHEN t.source_size > 0 THEN CAST(floor(t.target) AS BIGINT) // t.source_size ELSE 0 END AS rounds,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
x AS (SELECT *, CAST(rounds * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - rounds * source_size - before)) AS BIGINT) AS taken,
  CASE WHEN target > 0 THEN least(1.0, (before + size / 2) / target) ELSE 1.0 END AS place FROM r)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, taken,
  CASE WHEN taken > 0 THEN round(CASE WHEN abs(ramp) < 1e-9 THEN place
    ELSE 2.0 * place / (1.0 + ramp + sqrt(greatest((1.0 + ramp) * (1.0 + ramp) - 4.0 * ramp * place, 0.0))) END, 6) END AS position
FROM x
"""
