"""Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitewise.session import drop_path, load, scratch_path

WORD = r"[^\x20\x09-\x0D]+"
ROWS_PER_BUCKET = 20_000
BATCH_BYTES = 32 << 20


class Scratch:
    """The tables that operators write while this owner is entered, so that
    their caller can delete its own and no others."""

    _entered: list[Scratch] = []

    def __init__(self):
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        Scratch._entered.append(self)
        return self

    def __exit__(self, *_) -> None:
        Scratch._entered.remove(self)

    def drop(self, spark: SparkSession) -> None:
        """Deletes the tables; what was derived from them is written by now."""
        while self.paths:
            drop_path(spark, self.paths.pop())


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int | None):
    """Inside, Python gets at most ``rows`` rows and 32 MB at a time; the
    caller's own settings are back afterwards.  None changes nothing."""
    want = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES} if rows else {}
    was = {name: spark.conf.get(name, None) for name in want}
    try:
        for name, value in want.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in was.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def materialize(df: DataFrame, keep: bool = False, batch_rows: int | None = None) -> DataFrame:
    """Computes ``df`` once into a Parquet table of the shared checkpoint
    folder and reads it back: lineage is cut, and a lost executor costs the
    tasks it ran, not the work before the table.  ``keep`` withholds the table
    from the entered ``Scratch``; ``batch_rows`` bounds the batches that
    Python functions get, for whole texts."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm")
    with batches_of(spark, batch_rows):
        df.write.parquet(path)
    if Scratch._entered and not keep:
        Scratch._entered[-1].paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def in_small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, with the session told to hand Python at most ``rows`` rows at a
    time: whole texts are long, and the default number of them fills a
    worker.  A smaller setting of the user's stays."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name, "10000")) <= rows:
        conf.set(name, str(rows))
    return df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents")


def n_words(text: str = "text") -> "F.Column":
    """Words of the whole text, 0 for null; stays in the JVM."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def tasks_for(df: DataFrame, n_rows: int, per_task: int) -> int:
    """Partitions that keep per_task rows each, at least the session's count."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_rows / per_task))


def order_key(*cols: str) -> "F.Column":
    """A text order that does not follow the ids: md5 of the columns' text."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols]))


def running_sums(df: DataFrame, group: str, order: list[str], value: "F.Column", n_rows: int, before: str = "before") -> DataFrame:
    """Adds ``before``: the sum of ``value`` over the rows that precede a row
    in its group, by ``order`` whose first column is a uniform hex hash.

    The hash prefix deals each group out to range buckets, so no task holds a
    group: sums inside (group, bucket) by a window, bucket offsets by a second
    window over the small bucket table.
    """
    digits = max(0, math.ceil(math.log(max(1, n_rows / ROWS_PER_BUCKET), 16)))
    rows = df.withColumn("__b", F.substring(F.col(order[0]), 1, digits) if digits else F.lit("")).withColumn("__v", value)
    inside = Window.partitionBy(group, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    if not digits:
        return rows.withColumn(before, F.coalesce(F.sum("__v").over(inside), F.lit(0)).cast("long")).drop("__b", "__v")
    buckets = rows.groupBy(group, "__b").agg(F.sum("__v").alias("__s"))
    ahead = Window.partitionBy(group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(F.col(group).alias("__g"), F.col("__b").alias("__bb"), F.coalesce(F.sum("__s").over(ahead), F.lit(0)).alias("__o"))
    joined = rows.join(buckets, rows[group].eqNullSafe(buckets["__g"]) & (rows["__b"] == buckets["__bb"]))
    return joined.withColumn(before, (F.col("__o") + F.coalesce(F.sum("__v").over(inside), F.lit(0))).cast("long")).drop("__b", "__v", "__g", "__bb", "__o")


def _local_roots(batches):
    """Union-find over one partition's edges; one (node, root) row per node."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > 500_000:  # bounded memory: hand on what is known
            yield _roots(parent, find)
            parent.clear()
    if parent:
        yield _roots(parent, find)


def _roots(parent, find):
    pairs = [(x, find(x)) for x in parent]
    pairs = [(x, r) for x, r in pairs if x != r]
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], names=["u", "v"])


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``edges`` (two long columns): the
    smallest node reachable.

    Union-find inside the partitions leaves each node with a few roots, one a
    task.  A round gives a node the least of them, links its other roots to
    that one, and follows the root's own root; it ends when no node has two
    roots and no root has a root.  The join on a root with many nodes is split
    by AQE, no neighbourhood is collected, each round is a written table.
    Repeated edges, loops and an empty table are fine; null ends are ignored."""
    a, b = edges.columns[:2]
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    e = materialize(e.mapInArrow(_local_roots, "u long, v long"))
    for _ in range(max_rounds):
        own = e.groupBy("u").agg(F.collect_set("v").alias("roots"), F.min("v").alias("m"))
        up = own.select(F.col("u").alias("k"), F.col("m").alias("above"))
        others = F.transform(F.array_remove("roots", F.col("m")), lambda r: F.struct(r.alias("u"), F.col("m").alias("v"), F.lit(True).alias("moved")))
        step = own.select(F.explode(F.concat(F.array(F.struct("u", F.col("m").alias("v"), F.lit(False).alias("moved"))), others)).alias("s")).select("s.*")
        e = step.join(up, F.col("v") == F.col("k"), "left").select("u", F.coalesce("above", "v").alias("v"), (F.col("moved") | F.col("above").isNotNull()).alias("moved"))
        e = materialize(e)
        if e.where("moved").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def crc_remainder(col: str, mod: int) -> "F.Column":
    """crc32 of the column's text modulo ``mod``; null counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, in_fold: "F.Column", per_class: int, max_chars: int) -> DataFrame:
    """(m, text, y) of at most ``per_class`` labelled documents of each
    class inside ``in_fold``, each text of at most ``max_chars`` once, m its
    md5, by which they are chosen.  The choice is made on ids and digests;
    texts are read for the chosen alone, through a join whose small side has
    2 * per_class rows."""
    lab = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(in_fold)
    lab = lab.groupBy("doc_id").agg(F.min(label).alias("y")).select(F.col("doc_id").alias("l_id"), "y")
    short = docs.where(F.length("text") <= max_chars).select(F.col("doc_id").alias("d"), F.md5("text").alias("m"), "text")
    known = short.select("d", "m").join(lab, F.col("d") == F.col("l_id")).groupBy("m").agg(F.min("y").alias("y"), F.min("d").alias("id"))
    known = materialize(known)
    chosen = known.where("y = 0").orderBy("m").limit(per_class).unionByName(known.where("y = 1").orderBy("m").limit(per_class))
    chosen = F.broadcast(chosen.select(F.col("m").alias("c_m"), "id", "y"))
    found = short.join(chosen, (F.col("d") == F.col("id")) & (F.col("m") == F.col("c_m")))
    return found.groupBy("m").agg(F.first("text").alias("text"), F.first("y").cast("double").alias("y"))


def _give_back() -> None:
    """Memory of large arrays that are gone goes back to the machine: the process lives on."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def trained(sample: DataFrame, train) -> dict:
    """``train(texts, labels)`` of a bounded ``labelled_sample``, in md5 order,
    in one task; the model alone, a few arrays of fixed size, comes to the
    driver."""
    def run(batches):
        rows = [r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("m", "text", "y")), strict=True)]
        rows.sort(key=lambda r: r[0])
        model = train([r[1] for r in rows], np.array([r[2] for r in rows], float))
        del rows
        out = pickle.dumps(model)
        del model
        _give_back()
        yield pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], names=["model"])

    found = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(found[0].model) if found else train([], np.zeros(0))


def utf8(texts: list[str]) -> pa.Array:
    return pa.array(texts, pa.large_string())


__all__ = ["Scratch", "WORD", "batches_of", "components", "crc_remainder", "documents", "in_small_batches", "labelled_sample", "load", "materialize", "n_words", "np", "order_key", "running_sums", "tasks_for", "trained", "utf8"]
