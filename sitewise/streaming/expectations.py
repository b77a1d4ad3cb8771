"""Row expectations inside a micro-batch, decided before it commits.

A batch is written once, below a hidden folder of the target, split into kept
and quarantined rows, while observed metrics count the rows that break each
rule.  Only when no ``fail`` rule is broken does one rename make the batch
visible; otherwise the folder goes, the query fails and its checkpoint stays
where it was, so the same files are tried again once they are mended.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sitewise.operators.quality import Rule, passes, raise_on_failures
from sitewise.session import drop_path, path_exists


def broken_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules that a row breaks."""
    return F.array_compact(F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]))


def _move(spark: SparkSession, source: str, target: str) -> None:
    a, b = (spark._jvm.org.apache.hadoop.fs.Path(x) for x in (source, target))
    fs = a.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot rename {source} to {target}")


def expect_stream(stream: DataFrame, target: str, checkpoint: str, rules: Sequence[Rule]) -> None:
    """Append ``stream`` to ``target`` under its expectations.

    ``warn`` rules only count.  Rows that break a ``drop`` rule go to the
    quarantine with the names of all rules they break.  A broken ``fail`` rule
    raises, and nothing of the batch is kept.  A replayed batch that was
    renamed into place already is left alone.  Read with :func:`kept`,
    :func:`quarantined` and :func:`rule_counts`.
    """
    dropping = F.array(*[F.lit(r.name) for r in rules if r.on_violation == "drop"]).cast("array<string>")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        final = f"{target}/rows/batch_id={batch_id}"
        if path_exists(spark, final):
            return
        stage = f"{target}/_stage-{batch_id}-{uuid.uuid4().hex[:12]}"
        seen = Observation()
        marked = batch.withColumn("_broken", broken_rules(rules)).observe(
            seen, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.array_contains("_broken", r.name)).alias(f"fail_{r.name}") for r in rules])
        marked.withColumn("_status", F.when(F.arrays_overlap("_broken", dropping), "quarantined").otherwise("kept")).write.partitionBy("_status").parquet(stage)
        counts, error = seen.get, None
        try:
            raise_on_failures(seen, rules)
        except Exception as e:  # noqa: BLE001 - logged, then raised again
            error = e
        log = [(batch_id, r.name, r.on_violation, counts["n_rows"], counts[f"fail_{r.name}"], error is None) for r in rules]
        spark.createDataFrame(log, "batch_id long, rule string, severity string, n_rows long, n_fail long, committed boolean").coalesce(1).write.parquet(
            f"{target}/counts/batch_id={batch_id}/attempt={uuid.uuid4().hex[:12]}")
        if error:
            drop_path(spark, stage)
            raise error
        _move(spark, stage, final)

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def _rows(spark: SparkSession, target: str, status: str) -> DataFrame:
    return spark.read.parquet(f"{target}/rows").where(F.col("_status") == status)  # prunes to the status' folders


def kept(spark: SparkSession, target: str) -> DataFrame:
    return _rows(spark, target, "kept").drop("_status", "_broken", "batch_id")


def quarantined(spark: SparkSession, target: str) -> DataFrame:
    """Rows that a ``drop`` rule has kept out, with ``_broken``, the rules."""
    return _rows(spark, target, "quarantined").drop("_status", "batch_id")


def rule_counts(spark: SparkSession, target: str) -> DataFrame:
    """batch_id, rule, severity, n_rows, n_fail, committed; failed attempts too."""
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{target}/counts")
