"""Structured Streaming jobs: incremental file ingest and micro-batch
aggregates.

All jobs use ``trigger(availableNow=True)``: process what has landed, then
stop; the checkpoint records which files were read, so a rerun (or a
restart after a lost executor) reads each file exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitewise.functions.clock import utc_instant, utc_wall_clock
from sitewise.functions.money import cents, cents_to_double
from sitewise.sources.files import TS_OPTIONS, with_lineage


def land_files(df: DataFrame, path: str, n_files: int, order: str | None = None, compression: str = "none") -> None:
    """Write ``df`` as ``n_files`` JSON-lines files (a landing zone).
    ``order`` = a column to spread rows by, so files arrive out of order.
    A gzip file is read by one task: give as many as the rows ask for."""
    out = df.repartition(n_files, F.col(order)) if order else df.repartition(n_files)
    out.write.mode("overwrite").options(**TS_OPTIONS).json(path, compression=compression)


def json_stream(spark: SparkSession, path: str, schema: StructType,
                max_files_per_trigger: int | None = None, multiline: bool = False) -> DataFrame:
    r = spark.readStream.schema(schema).options(**TS_OPTIONS).option("multiLine", str(multiline).lower())
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return with_lineage(r.json(path))


def ingest_available_now(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append-only sink, process-what's-there-then-stop."""
    q = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(target))
    q.awaitTermination()


def daily_partials(stream: DataFrame, target: str, checkpoint: str, ts_col: str,
                   group_cols: Sequence[str], value_col: str) -> None:
    """Per micro-batch partial aggregates by (day, group…) written under
    ``batch_id=<id>`` with overwrite: a replayed batch rewrites its own
    folder, so the sink is idempotent.  Readers sum the partials."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy(F.to_date(ts_col).alias("day"), *group_cols)
              .agg(F.count(F.lit(1)).alias("n"),
                   F.sum(cents(F.col(value_col))).alias("value_cents"))
              .write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}"))

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def windowed_counts(stream: DataFrame, target: str, checkpoint: str, ts_col: str,
                    group_cols: Sequence[str], value_col: str, window: str = "1 day") -> None:
    """Event-time tumbling windows: each micro-batch adds its own count and
    value (cents) per (window, group...) under ``batch_id=<id>`` (overwrite, so
    a replayed batch is idempotent).  No state and no watermark, so a row may
    be as late as it likes; read with :func:`read_windows`, which adds up."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # windows are cut on the UTC reading of the wall clock, free of the session zone
        (batch.groupBy(F.window(utc_instant(F.col(ts_col)), window).alias("w"), *group_cols)
              .agg(F.count(F.lit(1)).alias("n"), F.sum(cents(F.col(value_col))).alias("value_cents"))
              .write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}"))

    q = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def read_windows(spark: SparkSession, target: str, group_cols: Sequence[str]) -> DataFrame:
    """Windows summed over all micro-batches."""
    return (spark.read.parquet(target).groupBy(utc_wall_clock(F.col("w.start")).alias("window_start"), *group_cols)
            .agg(F.sum("n").alias("n"), cents_to_double(F.sum("value_cents")).alias("value_sum")))


def read_daily(spark: SparkSession, target: str, group_cols: Sequence[str]) -> DataFrame:
    return (spark.read.parquet(target).groupBy("day", *group_cols)
            .agg(F.sum("n").alias("n"), cents_to_double(F.sum("value_cents")).alias("value_sum")))
