import os
import struct
import tempfile

import pytest
from pyspark.sql import functions as F

from sitewise.operators.checks import parse_position, parse_wkt_point, tolerant_bool
from sitewise.sources.files import SchemaMismatch, exact_columns, read_seed_csv, rescued_data
from sitewise.sources.geometry import wkb_parts, wkb_segments


def _ls(pts, order="<", code=2):
    return struct.pack(order + "BI", 1 if order == "<" else 0, code) + struct.pack(order + "I", len(pts)) + \
        b"".join(struct.pack(order + "dd", *p) for p in pts)


def _poly(rings):
    body = struct.pack("<BII", 1, 3, len(rings))
    for r in rings:
        body += struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", *p) for p in r)
    return body


def test_wkb_linestring_and_big_endian():
    assert wkb_parts(_ls([(0, 0), (3, 4)])) == [[(0.0, 0.0), (3.0, 4.0)]]
    assert wkb_parts(_ls([(1, 2), (5, 6)], ">")) == [[(1.0, 2.0), (5.0, 6.0)]]


def test_wkb_z_flags_and_multi_and_gpkg():
    # ISO LineString Z (1002): x, y, z per point
    iso = struct.pack("<BI", 1, 1002) + struct.pack("<I", 2) + struct.pack("<ddd", 0, 0, 9) + \
        struct.pack("<ddd", 1, 1, 9)
    assert wkb_parts(iso) == [[(0.0, 0.0), (1.0, 1.0)]]
    # EWKB with SRID and Z flag
    ewkb = struct.pack("<BII", 1, 0x80000002 | 0x20000000, 3006) + struct.pack("<I", 1) + struct.pack("<ddd", 7, 8, 1)
    assert wkb_parts(ewkb) == [[(7.0, 8.0)]]
    multi = struct.pack("<BII", 1, 5, 2) + _ls([(0, 0), (1, 0)]) + _ls([(2, 2), (3, 3)])
    assert len(wkb_parts(multi)) == 2
    gpkg = b"GP" + bytes([0, 0b0000_0011]) + struct.pack("<i", 3006) + b"\x00" * 32 + _ls([(0, 0), (0, 1)])
    assert wkb_parts(gpkg) == [[(0.0, 0.0), (0.0, 1.0)]]
    assert wkb_parts(b"") == []
    assert wkb_parts(struct.pack("<BII", 1, 2, 0)) == []


def test_wkb_segments_distributed(spark):
    sq = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
    df = spark.createDataFrame([(1, bytearray(_poly([sq]))), (2, bytearray(_ls([(0, 0), (3, 0), (3, 1)])))],
                               "id long, geom binary")
    seg = wkb_segments(df, "id", "geom")
    got = {r.id: r.n for r in seg.groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert got == {1: 4, 2: 2}


def test_seed_csv_all_strings_bom(spark):
    d = tempfile.mkdtemp(prefix="seed-")
    p = os.path.join(d, "s.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("﻿kommun_kod, value\n0180,12\n0114,\n")
    df = read_seed_csv(spark, p)
    assert df.columns == ["kommun_kod", "value"]
    rows = sorted(df.collect())
    assert rows[0].kommun_kod == "0114" and all(isinstance(r.value, (str, type(None))) for r in rows)


def test_exact_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert exact_columns(df, ["a", "b"]) is df
    with pytest.raises(SchemaMismatch):
        exact_columns(df, ["a", "c"])


def test_rescued_data(spark):
    df = spark.createDataFrame([('{"a": 1, "zz": "x"}',), ('{"a": 2}',)], "t string")
    got = [r._rescued_data for r in rescued_data(df, "t", ["a"]).orderBy("t").collect()]
    assert got == ['{"zz":"x"}', None]


def test_scalar_parsers(spark):
    df = spark.createDataFrame([("(59.3, 18.1)", "ja", "POINT (674000 6580000)"), ("bad", "maybe", None)],
                               "pos string, flag string, wkt string")
    lat, lon = parse_position(F.col("pos"))
    x, y = parse_wkt_point(F.col("wkt"))
    rows = df.select(lat.alias("lat"), lon.alias("lon"), tolerant_bool(F.col("flag")).alias("b"),
                     x.alias("x"), y.alias("y")).collect()
    assert (rows[0].lat, rows[0].lon, rows[0].b, rows[0].x, rows[0].y) == (59.3, 18.1, True, 674000.0, 6580000.0)
    assert rows[1].lat is None and rows[1].b is None


def test_sheet_export_and_catalog(spark):
    d = tempfile.mkdtemp(prefix="sheet-")
    p = os.path.join(d, "sheet.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("gruppkod,kommun_kod\nA1,0114\nB3,0115\n,\n,Source: footnote\n")
    from sitewise.sources.files import catalog_columns, read_sheet_export
    assert [r.kommun_kod for r in read_sheet_export(spark, p, "gruppkod").collect()] == ["0114", "0115"]
    spark.createDataFrame([(1, "x")], "id int, _hidden string").createOrReplaceTempView("cat_probe")
    cols = {(r.table_name, r.column_name) for r in catalog_columns(spark).collect()}
    assert ("cat_probe", "id") in cols and ("cat_probe", "_hidden") not in cols


def test_level_filter_and_latest_snapshot(spark):
    from sitewise.operators.checks import level_filter
    from sitewise.operators.shape import latest_snapshot
    df = spark.createDataFrame([("00", 1), ("01", 1), ("0114", 1), ("1917", 1), ("0331", 2)], "code string, snap int")
    assert sorted(r.code for r in level_filter(df, "code", 4, ["1917"]).collect()) == ["0114", "0331"]
    assert [r.code for r in latest_snapshot(df, "snap").collect()] == ["0331"]
