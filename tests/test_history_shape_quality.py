import datetime as dt

import pytest
from pyspark.sql import functions as F

from sitewise.operators.history import scd2_from_changes, scd2_from_snapshots
from sitewise.operators.quality import (ExpectationFailed, Rule, expect, local_day_quarters, raise_on_failures,
                                        reconcile)
from sitewise.operators.shape import complete_grid, latest_per_key, nested_max_sum


def test_scd2_changes_untracked_moves_and_replay_order(spark):
    rows = [("k", 3, 7, "c"), ("k", 1, 5, "a"), ("k", 2, 5, "b")]  # delivered 3, 1, 2
    df = spark.createDataFrame(rows, "key string, seq int, v int, file string")
    h = scd2_from_changes(df, ["key"], ["seq"], ["v"], ["file"], bucket=F.lit(0)).orderBy("start_at").collect()
    assert [(r.v, r.start_at, r.end_at, r.file) for r in h] == [(5, 1, 3, "b"), (7, 3, None, "c")]
    assert [r.is_current for r in h] == [False, True]


def test_scd2_changes_across_buckets_and_replays(spark):
    # values change across bucket boundaries; one row replayed twice
    rows = [("k", s, v) for s, v in [(1, 1), (2, 1), (3, 2), (4, 2), (5, 2), (6, 1), (7, 1), (8, 3)]]
    rows.append(("k", 4, 2))
    df = spark.createDataFrame(rows, "key string, seq int, v int")
    for bucket in (F.lit(0), F.floor(F.col("seq") / 2), F.col("seq")):
        h = scd2_from_changes(df, ["key"], ["seq"], ["v"], [], bucket=bucket).orderBy("start_at").collect()
        assert [(r.v, r.start_at, r.end_at) for r in h] == [(1, 1, 3), (2, 3, 6), (1, 6, 8), (3, 8, None)]


def test_scd2_null_safe_tracked(spark):
    df = spark.createDataFrame([("k", 1, None), ("k", 2, None), ("k", 3, 1)], "key string, seq int, v int")
    h = scd2_from_changes(df, ["key"], ["seq"], ["v"], [], bucket=F.lit(0)).orderBy("start_at").collect()
    assert [(r.v, r.start_at, r.end_at) for r in h] == [(None, 1, 3), (1, 3, None)]


def test_scd2_snapshots_absence_closes(spark):
    snaps = spark.createDataFrame([(1,), (2,), (3,), (4,)], "snap int")
    rows = spark.createDataFrame([("k", 1, "x"), ("k", 2, "x"), ("k", 4, "x")], "key string, snap int, t string")
    h = scd2_from_snapshots(rows, ["key"], "snap", ["t"], snaps).orderBy("start_at").collect()
    assert [(r.start_at, r.end_at) for r in h] == [(1, 3), (4, None)]


def test_nested_max_sum_fixture(spark):
    df = spark.createDataFrame([("s", "e1", 50.0), ("s", "e1", 150.0), ("s", None, 22.0)],
                               "station string, evse string, kw double")
    unit = F.coalesce(F.col("evse"), F.concat(F.lit("conn:"), F.monotonically_increasing_id().cast("string")))
    out = nested_max_sum(df, ["station"], unit, "kw").collect()[0]
    assert float(out.total_max) == 172.0 and out.n_units == 2


def test_zero_grid_fixture(spark):
    facts = spark.createDataFrame([(a, b, c, 1) for a in (1, 2) for b in ("x", "y") for c in ("p", "q")
                                   if (a, b, c) != (2, "y", "q")], "a int, b string, c string, n int")
    base = spark.createDataFrame([(1,), (2,)], "a int")
    g = complete_grid(facts, base, {"b": F.array(F.lit("x"), F.lit("y")), "c": F.array(F.lit("p"), F.lit("q"))},
                      ["a", "b", "c"], {"n": 0})
    rows = g.collect()
    assert len(rows) == 8 and sum(r.is_filled_zero for r in rows) == 1


def test_latest_per_key(spark):
    df = spark.createDataFrame([("u", 1, 1, "a"), ("u", 2, 5, "b"), ("u", 2, 6, "c")], "k string, ts int, id int, v string")
    assert latest_per_key(df, ["k"], ["ts", "id"], ["v"]).collect()[0].v == "c"


def test_day_length_stockholm(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 30),), (dt.date(2025, 10, 26),), (dt.date(2025, 6, 1),)], "d date")
    got = [r.q for r in df.select(local_day_quarters(F.col("d"), "Europe/Stockholm").alias("q")).collect()]
    assert got == [92, 100, 96]


def test_expect_drop_and_fail(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    rules = [Rule("positive", F.col("x") > 0, "drop")]
    out, obs = expect(df, rules)
    assert out.count() == 1
    assert obs.get["fail_positive"] == 2
    rules = [Rule("positive", F.col("x") > 0, "fail", on_null="pass")]
    out, obs = expect(df, rules)
    out.count()
    with pytest.raises(ExpectationFailed):
        raise_on_failures(obs, rules)


def test_reconcile_rules(spark):
    kids = spark.createDataFrame([
        ("exact", "a", 1.0), ("exact", "a", 2.0),
        ("rounding", "b", 1.0), ("rounding", "b", 2.0),
        ("unallocated", "c", 95.0),
        ("noise", "d", 1000000.0),
        ("exact", "e", 1.0),
    ], "rule string, k string, v double")
    parents = spark.createDataFrame([("a", 3.0), ("b", 3.9), ("c", 95.5), ("d", 1000005.0)], "k string, p double")
    r = {x.k: x.within_rule for x in reconcile(kids, parents, ["k"], "v", "p", "rule", rounding_unit=1.0).collect()}
    assert r == {"a": True, "b": True, "c": True, "d": True, "e": False}


def test_snapshot_history_collapses_repeats_and_carries_untracked(spark):
    from sitewise.operators.history import scd2_from_snapshots
    rows = [("k", 1, "a", 10), ("k", 1, "a", 10), ("k", 2, "a", 11), ("k", 3, "b", 12)]
    df = spark.createDataFrame(rows, "id string, snap int, t string, u int")
    got = [tuple(r) for r in scd2_from_snapshots(df, ["id"], "snap", ["t"], untracked=["u"]).orderBy("start_at").collect()]
    assert got == [("k", "a", 11, 1, 3, False, 2), ("k", "b", 12, 3, None, True, 1)]


def test_grid_over_an_empty_and_a_wide_domain(spark):
    from sitewise.operators.shape import expand_domain
    base = spark.range(3)
    wide = spark.range(1000).select(F.concat(F.lit("v"), "id").alias("d"))
    assert expand_domain(base, wide, "d").distinct().count() == 3000
    assert expand_domain(base, wide.limit(0), "d").count() == 0


def test_rounding_rule_follows_the_unit(spark):
    from sitewise.operators.quality import reconcile
    kids = spark.createDataFrame([(1, 10.0, "rounding"), (1, 10.0, "rounding")], "k int, v double, rule string")
    parent = spark.createDataFrame([(1, 20.8)], "k int, p double")
    fits = lambda unit: reconcile(kids, parent, ["k"], "v", "p", "rule", unit).first().within_rule
    assert fits(1.0) and not fits(0.01)
