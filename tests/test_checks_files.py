"""Counters, seed mismatches, timestamps of two formats, complete folders, profiles and plan shapes."""
from pyspark.sql import functions as F

from sitewise.operators.checks import either_timestamp, hierarchy_gap, label_mismatch, with_counters
from sitewise.operators.quality import column_profile
from sitewise.operators.score import expand_runs, score, score_components
from sitewise.sources.files import list_files, rows_of_complete_folders, with_lineage


def test_counters_beside_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, None), (None, None)], "k string, v int")
    got = sorted((tuple(r) for r in with_counters(df, {"n_k": ["k"], "n_kv": ["k", "v"]}).collect()), key=str)
    assert got == sorted([("a", 1, 3, 2), ("a", 1, 3, 2), ("a", 2, 3, 1), (None, 1, 3, 1), (None, None, 3, 2), (None, None, 3, 2)], key=str)


def test_label_mismatch(spark):
    a = spark.createDataFrame([(1, "Ale"), (2, "Boden"), (3, None), (4, "Only a"), (5, "Two  words")], "c int, l string")
    b = spark.createDataFrame([(1, "Ale"), (2, "Bodens"), (3, None), (6, "Only b"), (5, " two words ")], "c int, l string")
    assert sorted((r["code"], r["kind"]) for r in label_mismatch(a, b, "c", "l").collect()) == [(2, "label"), (4, "only_a"), (5, "spelling"), (6, "only_b")]


def test_either_timestamp(spark):
    df = spark.createDataFrame([("2024-03-31 02:30:00",), ("20240331",), ("31 Mar",), (None,)], "t string")
    got = [str(r[0]) for r in df.select(either_timestamp(F.col("t"), "yyyy-MM-dd HH:mm:ss", "yyyyMMdd")).collect()]
    assert got == ["2024-03-31 02:30:00", "2024-03-31 00:00:00", "None", "None"]


def test_only_complete_folders_are_read(spark, tmp_path):
    for name, done in (("updated=1", True), ("updated 2 å", True), ("updated=3", False)):
        spark.range(3).coalesce(1).write.json(f"{tmp_path}/in/{name}")
        if done:
            (tmp_path / "in" / name / "dump.done").write_text("1")
    rows = with_lineage(spark.read.schema("id long").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(f"{tmp_path}/in"))
    listing = list_files(spark, f"{tmp_path}/in")
    kept = rows_of_complete_folders(rows, listing, "dump.done")
    assert kept.count() == 6 and kept.where(F.col("_file").contains("updated=3")).count() == 0
    assert rows_of_complete_folders(rows, listing, "nothing").count() == 0


def test_column_profile(spark):
    df = spark.createDataFrame([("1", 1.0, None), ("2", 1.5, None), ("x", None, None), ("x", 2.0, None)], "a string, b double, c int")
    got = {r["column_name"]: tuple(r)[1:] for r in column_profile(df, max_set=3).collect()}
    assert got == {"a": (4, 0, 3, 2, "1|2|x"), "b": (4, 1, 3, 1, "1.0|1.5|2.0"), "c": (4, 4, 0, 0, "")}
    assert {r["column_name"]: r["n_rows"] for r in column_profile(df.limit(0)).collect()} == {"a": 0, "b": 0, "c": 0}


def test_hierarchy_gap_reads_rows_once(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3), (None, "x", 4)], "r string, n string, v int")
    got = {r["level"]: tuple(r)[1:] for r in hierarchy_gap(df, F.col("v"), {"r": ["r"], "rn": ["r", "n"], "n": ["n"]}).collect()}
    assert got == {"r": (3, 10, 10, 0), "rn": (4, 10, 10, 0), "n": (2, 10, 10, 0)}


def test_a_unit_without_a_metric_row_is_not_scored(spark):
    weights = spark.createDataFrame([("S", "m1", 0.5), ("S", "m2", 0.5)], "scenario string, metric string, weight double")
    variants = spark.createDataFrame([("base", None, None, None, None, None, False), ("swap", "m2", "m3", None, None, None, False)],
                                     "variant string, swap_from string, swap_to string, only_scenario string, alpha double, quantity string, use_cost_factor boolean")
    metrics = spark.createDataFrame([(u, m, 2.0, 0.5) for u in ("a", "b") for m in ("m1", "m2", "m3") if (u, m) != ("b", "m2")], "unit string, metric string, value double, pct_rank double")
    units = spark.createDataFrame([("a",), ("b",), ("c",)], "unit string")
    comps = score_components(expand_runs(weights, variants), metrics, "unit", units)
    assert comps.count() == 3 * 2 * 2
    costs = units.withColumn("cost_factor", F.lit(1.0))
    strategies = spark.createDataFrame([("S", 1.0, "m1")], "scenario string, alpha double, quantity string")
    got = {(r["variant"], r["unit"]): (r["n_components"], r["n_expected"], r["attractiveness"], r["votes"]) for r in score(comps, strategies, variants, metrics.select("unit", "metric", "value"), costs, "unit").collect()}
    assert got[("base", "a")] == (2, 2, 0.5, 1.0) and got[("swap", "b")] == (2, 2, 0.5, 1.0)
    assert got[("base", "b")] == (1, 2, None, None) and got[("base", "c")] == (0, 2, None, None)
    plan = expand_runs(weights, variants)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
