"""Streaming and incremental-ingest queries.

Each query lands the events table as JSON files in a fresh folder under the
session's shared checkpoint folder, runs the incremental job (twice where
the point is idempotency) and returns what the sink holds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewise.functions.clock import epoch_seconds
from sitewise.functions.money import cents, cents_to_double
from sitewise.plans.q_history import SCD2_CHANGES_SQL
from sitewise.plans.registry import query
from sitewise.session import load, scratch_path
from sitewise.sources.files import ledger_append
from sitewise.streaming.ingest import (daily_partials, ingest_available_now, json_stream, land_files,
                                       read_daily, read_windows, windowed_counts)
from sitewise.streaming.scd2_state import read_scd2, scd2_stream

EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")
N_FILES = 8
FILES_PER_BATCH = 4  # two micro-batches per run


class NotIdempotent(Exception):
    pass


def _ingested_summary(df):
    return df.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("user_id").alias("n_users"),
        cents_to_double(F.sum(cents(F.col("value")))).alias("value_sum"))


_SUMMARY_SQL = """
SELECT event_type, COUNT(*) AS n_rows, COUNT(DISTINCT user_id) AS n_users,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
FROM events GROUP BY 1
"""


@query("stream_ingest", _SUMMARY_SQL)
def stream_ingest_q(spark, sf):
    """Events landed as JSON files, ingested by an availableNow file stream
    with a checkpoint; the second run must add 0 rows."""
    base = scratch_path(spark, "stream-ingest")
    land_files(load(spark, sf, "events"), f"{base}/landing", N_FILES)
    schema = spark.createDataFrame([], EVENTS_SCHEMA).schema
    for _ in range(2):
        ingest_available_now(json_stream(spark, f"{base}/landing", schema), f"{base}/bronze", f"{base}/_ckpt")
        if _ == 0:
            n_first = spark.read.parquet(f"{base}/bronze").count()
    n_second = spark.read.parquet(f"{base}/bronze").count()
    if n_second != n_first:
        raise NotIdempotent(f"rerun added {n_second - n_first} rows")
    return _ingested_summary(spark.read.parquet(f"{base}/bronze"))


@query("ledger_append", _SUMMARY_SQL)
def ledger_append_q(spark, sf):
    """Two deliveries (events before / from the midpoint of their time
    range) in folders with blanks and other letters, appended by the file
    ledger; a third run finds nothing new."""
    base = scratch_path(spark, "ledger")
    ev = load(spark, sf, "events")
    secs = epoch_seconds(F.col("ts"))
    mid = ev.agg((F.min(secs) / 2 + F.max(secs) / 2).alias("m")).first()["m"]
    first = F.coalesce(secs < mid, F.lit(False))  # a row without a time is in the second delivery
    schema = spark.createDataFrame([], EVENTS_SCHEMA).schema
    land_files(ev.where(first), f"{base}/landing/with space", N_FILES // 2)
    ledger_append(spark, f"{base}/landing", f"{base}/bronze", schema)
    land_files(ev.where(~first), f"{base}/landing/später + 2", N_FILES // 2)
    ledger_append(spark, f"{base}/landing", f"{base}/bronze", schema)
    if ledger_append(spark, f"{base}/landing", f"{base}/bronze", schema) != 0:
        raise NotIdempotent("third ledger run found new files")
    return _ingested_summary(spark.read.parquet(f"{base}/bronze"))


@query("streaming_daily", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, COUNT(*) AS n,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
FROM events GROUP BY 1, 2
""")
def streaming_daily_q(spark, sf):
    """Daily count and value per event type from a file stream (several
    micro-batches), partial aggregates per batch summed on read."""
    base = scratch_path(spark, "stream-daily")
    land_files(load(spark, sf, "events"), f"{base}/landing", N_FILES)
    schema = spark.createDataFrame([], EVENTS_SCHEMA).schema
    daily_partials(json_stream(spark, f"{base}/landing", schema, max_files_per_trigger=FILES_PER_BATCH),
                   f"{base}/daily", f"{base}/_ckpt", "ts", ["event_type"], "value")
    d = read_daily(spark, f"{base}/daily", ["event_type"])
    return d.select(F.col("day").cast("string").alias("day"), "event_type", F.col("n").cast("long").alias("n"),
                    F.col("value_sum").cast("double").alias("value_sum"))


@query("streaming_window", """
SELECT CAST(date_trunc('day', ts) AS VARCHAR) AS window_start, event_type, COUNT(*) AS n,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
FROM events GROUP BY 1, 2
""")
def streaming_window_q(spark, sf):
    """Daily tumbling event-time windows over a file stream of eight
    micro-batches whose files are in no order of time."""
    base = scratch_path(spark, "stream-window")
    land_files(load(spark, sf, "events"), f"{base}/landing", N_FILES)
    schema = spark.createDataFrame([], EVENTS_SCHEMA).schema
    windowed_counts(json_stream(spark, f"{base}/landing", schema, max_files_per_trigger=1),
                    f"{base}/windows", f"{base}/_ckpt", "ts", ["event_type"], "value", window="1 day")
    w = read_windows(spark, f"{base}/windows", ["event_type"])
    return w.select(F.col("window_start").cast("string").alias("window_start"), "event_type",
                    F.col("n").cast("long").alias("n"), "value_sum")


@query("scd2_stream", SCD2_CHANGES_SQL)
def scd2_stream_q(spark, sf):
    """The SCD 2 history of scd2_changes, kept by a stateful processor from a
    stream whose files arrive out of time order (several micro-batches); the
    state is cut by month."""
    base = scratch_path(spark, "scd2-stream")
    land_files(load(spark, sf, "events"), f"{base}/landing", N_FILES, order="event_type")
    schema = spark.createDataFrame([], EVENTS_SCHEMA).schema
    what = (["user_id"], ["ts", "event_id"], ["event_type"], ["value", "event_id"])
    scd2_stream(json_stream(spark, f"{base}/landing", schema, max_files_per_trigger=FILES_PER_BATCH),
                f"{base}/silver", f"{base}/_ckpt", *what, slice_by=F.date_format("ts", "yyyy-MM"))
    return read_scd2(spark, f"{base}/silver", schema, *what).select(
        "user_id", "event_type", "value", "event_id", "start_at", "end_at", "is_current", "n_rows")
