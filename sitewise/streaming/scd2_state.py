"""SCD 2 kept current from a stream by a stateful processor.

State (RocksDB) holds the feed of each (key, slice) in order, so rows may
come in any order and any number of times.  A micro-batch reads the state of
the keys that it touches and emits the versions that it opens, closes, moves
or takes back, and nothing else; they are appended under the batch's number,
so a replayed batch rewrites its own folder and no other file is touched.
Readers take the last word on each version.

A slice is a piece of the sequence (a month, a range of numbers).  It splits
the feed of a hot key over tasks and bounds what one row of the input makes
the processor read; versions that cross slices are joined when they are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DataType, DateType, StructType, TimestampNTZType, TimestampType

from sitewise.functions.clock import utc_wall_clock
from sitewise.operators.history import scd2_from_changes
from sitewise.sources.files import TS_OPTIONS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FEED = "o string, t string, u string"
_OUT = "key string, slice string, start string, t string, u string, n_rows long, deleted boolean"


def _sortable(c: Column, kind: DataType) -> Column:
    """Order columns in a form that JSON keeps and Python compares."""
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, c) if isinstance(kind, TimestampNTZType) else F.unix_micros(c)
    if isinstance(kind, DateType):
        return F.unix_date(c)
    return c


def _restored(c: Column, kind: DataType) -> Column:
    if isinstance(kind, TimestampNTZType):
        return utc_wall_clock(F.timestamp_micros(c.cast("long")))
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(c.cast("long"))
    if isinstance(kind, DateType):
        return F.date_from_unix_date(c.cast("int"))
    return c.cast(kind)


def versions_of(feed: list[tuple]) -> dict:
    """start → (tracked, untracked of the last row, rows) of rows (order, tracked, untracked) sorted by order."""
    out, start = {}, None
    for o, t, u in feed:
        if start is None or out[start][0] != t:
            start = o
            out[start] = (t, u, 1)
        else:
            out[start] = (t, u, out[start][2] + 1)
    return out


def _place(o: str) -> tuple:
    """Where a row stands in the sequence; NULLs come first."""
    return tuple((v is not None, v) for v in json.loads(o))


class Scd2Processor(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.feed = handle.getListState("feed", _FEED)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        by_order = {_place(o): (o, t, u) for o, t, u in self.feed.get()}
        was = versions_of([(o, *by_order[o][1:]) for o in sorted(by_order)])
        for frame in rows:
            for o, t, u in zip(frame["o"], frame["t"], frame["u"], strict=True):
                at = _place(o)
                # of rows at one place of the sequence the largest stays
                if at not in by_order or (t, u) > by_order[at][1:]:
                    by_order[at] = (o, t, u)
        ordered = sorted(by_order)
        now = versions_of([(o, *by_order[o][1:]) for o in ordered])
        changed = [(by_order[s][0], *v, False) for s, v in now.items() if was.get(s) != v]
        changed += [(by_order[s][0], was[s][0], was[s][1], 0, True) for s in was if s not in now]
        if changed:
            self.feed.put([by_order[o] for o in ordered])
            out = pd.DataFrame(changed, columns=["start", "t", "u", "n_rows", "deleted"])
            out.insert(0, "slice", key[1])
            out.insert(0, "key", key[0])
            yield out

    def close(self) -> None:
        pass


def _json(cols: Sequence[Column]) -> Column:
    return F.to_json(F.struct(*cols), {**TS_OPTIONS, "ignoreNullFields": "false"})


def scd2_stream(stream: DataFrame, silver: str, checkpoint: str, keys: Sequence[str], order_cols: Sequence[str],
                tracked: Sequence[str], untracked: Sequence[str] = (), slice_by: Column | None = None) -> None:
    """Append the changes of versions that ``stream`` makes to ``silver``.

    ``slice_by`` is an expression over the order columns, non-decreasing in
    their order.  Rows with one key and order are one row, the largest by its
    values as JSON, so replays change nothing."""
    spark = stream.sparkSession
    kinds = {f.name: f.dataType for f in stream.schema.fields}
    order = F.concat(F.lit("["), F.concat_ws(",", *[F.regexp_extract(F.to_json(F.array(_sortable(F.col(c), kinds[c]))), r"(?s)^\[(.*)\]$", 1) for c in order_cols]), F.lit("]"))
    rows = stream.select(
        _json([F.col(k) for k in keys]).alias("key"), F.coalesce(slice_by.cast("string") if slice_by is not None else F.lit(""), F.lit("")).alias("slice"),
        order.alias("o"), _json([F.col(c) for c in tracked]).alias("t"), _json([F.col(c) for c in untracked]).alias("u"))
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, ROCKSDB)
    try:
        changes = rows.groupBy("key", "slice").transformWithStateInPandas(Scd2Processor(), _OUT, "Update", "None")
        q = (changes.writeStream.outputMode("update").foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{silver}/batch_id={i}"))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def read_scd2(spark: SparkSession, silver: str, schema: StructType, keys: Sequence[str], order_cols: Sequence[str],
              tracked: Sequence[str], untracked: Sequence[str] = ()) -> DataFrame:
    """The versions, with the columns of :func:`scd2_from_changes`; ``schema``
    is that of the stream."""
    kinds = {f.name: f.dataType for f in schema.fields}
    sub = lambda cols: StructType([schema[c] for c in cols])
    last = spark.read.parquet(silver).groupBy("key", "slice", "start").agg(F.max_by(F.struct("t", "u", "n_rows", "deleted"), "batch_id").alias("v"))
    last = last.where("NOT v.deleted")
    parsed = last.select(
        F.from_json("key", sub(keys), TS_OPTIONS).alias("k"), "slice", F.from_json("start", "array<string>").alias("s"),
        F.from_json("v.t", sub(tracked), TS_OPTIONS).alias("t"), F.from_json("v.u", sub(untracked), TS_OPTIONS).alias("u"), F.col("v.n_rows").alias("n_rows"))
    starts = [f"_start{i}" for i in range(len(order_cols))]
    rows = parsed.select(*[F.col(f"k.{c}").alias(c) for c in keys], *[F.col(f"t.{c}").alias(c) for c in tracked], *[F.col(f"u.{c}").alias(c) for c in untracked],
                         *[_restored(F.get(F.col("s"), F.lit(i)), kinds[c]).alias(starts[i]) for i, c in enumerate(order_cols)], F.col("slice").alias("_slice"), F.col("n_rows").alias("_rows"))
    return scd2_from_changes(rows, keys, starts, tracked, untracked, bucket=F.col("_slice"), count_col="_rows")
