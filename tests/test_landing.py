"""Landed files: compressed, as many as the rows ask for, two micro-batches."""

import glob
import os

from sitewise.plans import QUERIES, q_checks


def test_stream_enrich_lands_compressed_files_in_two_batches(spark, tmp_path, monkeypatch):
    lines = [(i % 7, 1, 1, i, 2.0, 1.0, 0.0, 0.0, "AN"[i % 2], "F") for i in range(64)] + [(None, 1, 1, 1, 2.0, 1.0, 0.0, 0.0, "A", "F")]
    frame = spark.createDataFrame(lines, q_checks.LINE_SCHEMA.rsplit(",", 1)[0]).selectExpr("*", "timestamp_ntz'2024-01-02 03:04:05' AS l_shipdate")
    frame.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, "OF"[k % 2]) for k in range(6)], "o_orderkey long, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    base = str(tmp_path / "scratch")
    monkeypatch.setattr(q_checks, "scratch_path", lambda spark, tag: base)
    monkeypatch.setattr(q_checks, "LINES_PER_FILE", 5)
    got = {(r[0], r[1]): (r[2], r[3]) for r in QUERIES["stream_enrich"](spark, str(tmp_path)).collect()}
    want = {}
    for key, *_, flag, _ in lines:
        status = "OF"[key % 2] if key is not None and key < 6 else None
        n, qty = want.get((status, flag), (0, 0.0))
        want[status, flag] = (n + 1, qty + 2.0)
    assert got == want
    files = glob.glob(f"{base}/landing/part-*")
    assert len(files) == 14 and all(f.endswith(".json.gz") for f in files)
    assert sorted(os.path.basename(d) for d in glob.glob(f"{base}/agg/batch_id=*")) == ["batch_id=0", "batch_id=1"]
