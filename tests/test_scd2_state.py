"""The stateful SCD 2 stream against the batch operator: any order, replays, slices."""
import random

import pytest
from pyspark.sql import functions as F

from sitewise.operators.history import scd2_from_changes
from sitewise.streaming.ingest import json_stream
from sitewise.streaming.scd2_state import read_scd2, scd2_stream, versions_of

SCHEMA = "k string, seq long, v long, file string, at date"


def _rows(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        s = rnd.randrange(60)
        k = rnd.choice(["hot", "hot", "hot", "a", "b", None])
        out.append((k, s, None if s % 13 == 0 else (s * 7 + len(k or "")) // 9 % 3, f"f{s}", None if s % 5 else f"2024-01-{1 + s % 28:02d}"))
    return out


def _versions(df):
    return sorted((tuple(r) for r in df.select("k", "v", "file", "at", "start_at", "end_at", "is_current", "n_rows").collect()), key=str)


@pytest.mark.parametrize("sliced", [False, True])
def test_stream_equals_batch_in_any_order(spark, tmp_path, sliced):
    rows = _rows(160, 5)
    what = (["k"], ["seq"], ["v"], ["file", "at"])
    schema = spark.createDataFrame([], SCHEMA).schema
    for i in range(4):  # shuffled deliveries; the last repeats rows of the first
        part = rows[i * 40:(i + 1) * 40] + (rows[:15] if i == 3 else [])
        df = spark.createDataFrame([(*r[:4], None) for r in part], "k string, seq long, v long, file string, x string")
        dates = spark.createDataFrame([(r[3], r[4]) for r in rows], "file string, d string").distinct()
        df = df.drop("x").join(dates, "file", "left").select("k", "seq", "v", "file", F.col("d").cast("date").alias("at"))
        df.coalesce(1).write.json(f"{tmp_path}/in/{i}")
        scd2_stream(json_stream(spark, f"{tmp_path}/in/*", schema, max_files_per_trigger=1), f"{tmp_path}/silver", f"{tmp_path}/ckpt", *what,
                    slice_by=F.floor(F.col("seq") / 10) if sliced else None)
    feed = spark.read.schema(schema).json(f"{tmp_path}/in/*")
    got = _versions(read_scd2(spark, f"{tmp_path}/silver", schema, *what))
    assert got == _versions(scd2_from_changes(feed, *what, bucket=F.lit(0)))
    assert len(got) > 20


def test_only_changed_versions_are_emitted(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, seq long, v long").schema
    what = (["k"], ["seq"], ["v"])

    def deliver(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{tmp_path}/in/{name}")
        scd2_stream(json_stream(spark, f"{tmp_path}/in/*", schema), f"{tmp_path}/silver", f"{tmp_path}/ckpt", *what)

    deliver("1", [("a", i, i // 10) for i in range(50)] + [("b", 1, 1)])
    before = spark.read.parquet(f"{tmp_path}/silver").count()
    deliver("2", [("a", 50, 4)])  # the open version goes on
    deliver("3", [("a", 50, 4)])  # a replay
    out = spark.read.parquet(f"{tmp_path}/silver")
    assert (before, out.count()) == (6, 7)
    deliver("4", [("a", 15, 9), ("a", 60, 5)])  # the later row opens one; seq 15 keeps the larger of two values
    got = [(r["v"], r["start_at"], r["end_at"]) for r in read_scd2(spark, f"{tmp_path}/silver", schema, *what).where("k = 'a'").orderBy("start_at").collect()]
    assert got == [(0, 0, 10), (1, 10, 15), (9, 15, 16), (1, 16, 20), (2, 20, 30), (3, 30, 40), (4, 40, 60), (5, 60, None)]


def test_versions_of():
    assert versions_of([]) == {}
    assert versions_of([(1, "x", "a"), (2, "x", "b"), (3, "y", "c"), (4, "x", "d")]) == {1: ("x", "b", 2), 3: ("y", "c", 1), 4: ("x", "d", 1)}
