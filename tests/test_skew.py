"""Skew: one group holds most rows.  The rank machinery must split it over
many buckets (tasks) and stay exact; SCD 2 must split a hot key by day."""

import random

from pyspark.sql import functions as F

from sitewise.operators.history import scd2_from_changes
from sitewise.operators.ranking import order_stats, placed_by_range


def test_hot_group_is_split_and_exact(spark):
    rnd = random.Random(11)
    rows = [("hot", float(rnd.randint(0, 5000))) for _ in range(6000)]
    rows += [(f"g{i}", float(rnd.randint(0, 50))) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, v double")
    st = order_stats(df, ["g"], "v", rows_per_part=500)
    # the hot group's values span several written ranges, each a window partition of its own
    placed = placed_by_range(df.groupBy("g", "v").count(), ["g", "v"], rows_per_part=500)
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    assert placed.where("g = 'hot'").select("_part").distinct().count() >= 4 and max(sizes) <= 1000
    bounds = placed.where("g = 'hot'").groupBy("_part").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("_part").collect()
    assert all(a.hi < b.lo for a, b in zip(bounds, bounds[1:]))
    got = {r.v: (r.n_before, r.n_ties) for r in st.where("g = 'hot'").collect()}
    vals = sorted(v for g, v in rows if g == "hot")
    for v in set(vals):
        assert got[v] == (sum(1 for x in vals if x < v), vals.count(v))


def test_scd2_hot_key_many_days(spark):
    rnd = random.Random(5)
    base = 1_704_067_200  # 2024-01-01 UTC
    rows = [("hot", base + i * 3600, rnd.choice("ab")) for i in range(24 * 20)]  # 20 days, hourly
    df = (spark.createDataFrame(rows, "k string, s long, t string")
               .withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")))
    h = scd2_from_changes(df, ["k"], ["ts"], ["t"]).orderBy("start_at").collect()
    # naive versions
    exp, prev = [], None
    for _, s, t in rows:
        if t != prev:
            exp.append(t)
            prev = t
    assert [r.t for r in h] == exp
    assert all(a.end_at == b.start_at for a, b in zip(h, h[1:])) and h[-1].end_at is None
