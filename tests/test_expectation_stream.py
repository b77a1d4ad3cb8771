"""warn counts, drop quarantines, fail forbids the batch before it commits."""
import pytest
from pyspark.sql import functions as F

from sitewise.operators.quality import Rule
from sitewise.streaming.expectations import expect_stream, kept, quarantined, rule_counts
from sitewise.streaming.ingest import json_stream

def _rules():
    return [Rule("small", F.col("v") < 100, "warn"), Rule("has_key", F.col("k").isNotNull(), "drop"), Rule("even", F.col("v") % 2 == 0, "drop", "pass"), Rule("positive", F.col("v") > 0, "fail")]


@pytest.fixture
def land(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, v long").schema

    def run(name, rows):
        if rows is not None:
            spark.createDataFrame(rows, "k string, v long").coalesce(1).write.mode("overwrite").json(f"{tmp_path}/in/{name}")
        expect_stream(json_stream(spark, f"{tmp_path}/in/*", schema), f"{tmp_path}/out", f"{tmp_path}/ckpt", _rules())
    return run, f"{tmp_path}/out"


def test_three_severities(spark, land):
    run, out = land
    run("1", [("a", 2), ("b", 200), (None, 4), ("c", 3), (None, 5)])
    assert sorted(r.v for r in kept(spark, out).collect()) == [2, 200]
    assert sorted((r.v, tuple(r["_broken"])) for r in quarantined(spark, out).collect()) == [(3, ("even",)), (4, ("has_key",)), (5, ("has_key", "even"))]
    with pytest.raises(Exception, match="positive"):
        run("2", [("d", 8), ("e", -2)])
    assert sorted(r.v for r in kept(spark, out).collect()) == [2, 200]
    with pytest.raises(Exception, match="positive"):
        run("none", None)  # the files are still to be taken in
    run("2", [("d", 8), ("e", 12)])
    assert sorted(r.v for r in kept(spark, out).collect()) == [2, 8, 12, 200]
    run("none", None)
    assert kept(spark, out).count() == 4
    log = {(r.rule, r.committed): (r.n, r.bad) for r in rule_counts(spark, out).groupBy("rule", "committed").agg(F.sum("n_rows").alias("n"), F.sum("n_fail").alias("bad")).collect()}
    assert log["small", True] == (7, 1) and log["has_key", True] == (7, 2) and log["even", True] == (7, 2)
    assert log["positive", False][1] >= 2 and log["positive", True] == (7, 0)
