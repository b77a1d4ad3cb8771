import pytest
from pyspark.sql import functions as F

from sitewise.operators.quality import DuplicateKeys, duplicate_audit, record_audit
from sitewise.session import scratch_path

def test_record_audit_appends_and_raises(spark):
    log = scratch_path(spark, "t-audit")
    ok = spark.createDataFrame([(1,), (2,)], "id int")
    dup = spark.createDataFrame([(1,), (1,)], "id int")
    logged = record_audit(duplicate_audit({"ok": (ok, ["id"])}), log, "run1")
    assert logged.count() == 1
    with pytest.raises(DuplicateKeys, match="dup"):
        record_audit(duplicate_audit({"ok": (ok, ["id"]), "dup": (dup, ["id"])}), log, "run2")
    assert spark.read.parquet(log).count() == 3
    assert spark.read.parquet(log).select("run_id").distinct().count() == 2
    assert F is not None


def test_windows_keep_rows_of_any_lateness(spark, tmp_path):
    """Four batches, the newest file first, 200 days apart: nothing is dropped."""
    from pyspark.sql import functions as F

    from sitewise.streaming.ingest import json_stream, read_windows, windowed_counts
    schema = "ts timestamp_ntz, event_type string, value double"
    for i, day in enumerate((200, 5, 120, 60)):
        df = spark.range(50).select(F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, {day})").alias("ts"),
                                    F.lit("a").alias("event_type"), F.lit(1.5).alias("value"))
        df.coalesce(1).write.mode("append").json(f"{tmp_path}/landing")
    st = spark.createDataFrame([], schema).schema
    windowed_counts(json_stream(spark, f"{tmp_path}/landing", st, max_files_per_trigger=1), f"{tmp_path}/w", f"{tmp_path}/c", "ts", ["event_type"], "value")
    got = read_windows(spark, f"{tmp_path}/w", ["event_type"]).collect()
    assert len(got) == 4 and all(r.n == 50 and r.value_sum == 75.0 for r in got)


def test_ledger_knows_files_with_blanks_and_signs(spark, tmp_path):
    from sitewise.sources.files import ledger_append
    schema = spark.createDataFrame([(1,)], "id long").schema
    for name in ("with space", "å+ä", "50%25", "a[b]"):
        spark.range(3).write.json(f"{tmp_path}/landing/{name}")
    n = ledger_append(spark, f"{tmp_path}/landing", f"{tmp_path}/bronze", schema)
    assert n >= 4 and ledger_append(spark, f"{tmp_path}/landing", f"{tmp_path}/bronze", schema) == 0
    assert spark.read.parquet(f"{tmp_path}/bronze").count() == 12
    spark.range(2).write.json(f"{tmp_path}/landing/another one")
    assert ledger_append(spark, f"{tmp_path}/landing", f"{tmp_path}/bronze", schema) >= 1
    assert spark.read.parquet(f"{tmp_path}/bronze").count() == 14
