import json

import pytest
from pyspark.sql import functions as F

from sitewise.operators.spatial import assign_points, line_midpoints
from sitewise.sources.decode import decode_cells, decode_cube


def test_cube_row_major_with_status(spark):
    doc = {"id": ["a", "b"],
           "dimension": {"a": {"category": {"index": {"x": 0, "y": 1}}},
                         "b": {"category": {"index": ["p", "q", "r"]}}},
           "value": [1, 2, 3, None, 5, 6], "status": {"3": ".."}}
    df = spark.createDataFrame([(json.dumps(doc),)], "value string")
    rows = decode_cube(df).orderBy("pos").collect()
    assert [(r.cell["a"], r.cell["b"]) for r in rows] == [("x", "p"), ("x", "q"), ("x", "r"),
                                                          ("y", "p"), ("y", "q"), ("y", "r")]
    assert rows[3].value is None and rows[3].status == ".."
    assert all(r.cube_complete for r in rows)


def test_cube_index_map_order(spark):
    doc = {"id": ["a"], "dimension": {"a": {"category": {"index": {"late": 1, "early": 0}}}},
           "value": [10, 20], "status": [None, "x"]}
    rows = decode_cube(spark.createDataFrame([(json.dumps(doc),)], "value string")).orderBy("pos").collect()
    assert [r.cell["a"] for r in rows] == ["early", "late"] and rows[1].status == "x"


def test_cells(spark):
    doc = {"Rows": [{"Cell": [{"Column": "ar", "Name": "2024", "Value": "2024", "IsMeasure": False},
                              {"Column": "regkom", "Name": "Stad", "Value": "0180", "IsMeasure": False},
                              {"Column": "itrfslut", "Name": "x", "Value": "12", "IsMeasure": True}]}]}
    r = decode_cells(spark.createDataFrame([(json.dumps(doc),)], "value string")).collect()[0]
    assert r.dims["regkom"] == "0180" and r.labels["regkom_label"] == "Stad" and r.measures["itrfslut"] == "12"


def _square(area, x0, y0, side, hole=None):
    def ring(a, b, s):
        pts = [(a, b), (a + s, b), (a + s, b + s), (a, b + s)]
        return [(area, *pts[i], *pts[(i + 1) % 4]) for i in range(4)]
    e = ring(x0, y0, side)
    if hole:
        e += ring(*hole)
    return e


def test_point_in_polygon_fixture(spark):
    edges = spark.createDataFrame(
        _square(1, 0.0, 0.0, 1000.0, hole=(400.0, 400.0, 200.0)) + _square(2, 1000.0, 0.0, 1000.0),
        "area int, x1 double, y1 double, x2 double, y2 double")
    pts = spark.createDataFrame([
        ("hole", 500.0, 500.0), ("border", 1000.0, 500.0), ("near", -1000.0, 500.0), ("far", -3000.0, 500.0),
        ("in1", 100.0, 100.0)], "pid string, x double, y double")
    out = {r.pid: (r.area, r.method) for r in assign_points(pts, edges, 1000.0, 250.0, 2000.0).collect()}
    assert out["border"] == (2, "contains")      # shared border: one owner
    assert out["in1"] == (1, "contains")
    assert out["hole"] == (1, "nearest")         # in the hole: fallback to the nearest border
    assert out["near"] == (1, "nearest")
    assert "far" not in out                      # beyond 2 km: dropped


def test_line_midpoint_two_parts(spark):
    seg = spark.createDataFrame([("l", 1, 0.0, 0.0, 3.0, 0.0), ("l", 2, 3.0, 0.0, 3.0, 1.0)],
                                "line_id string, seg_no int, x1 double, y1 double, x2 double, y2 double")
    r = line_midpoints(seg).collect()[0]
    assert r.length == pytest.approx(4.0) and (r.mx, r.my) == (pytest.approx(2.0), pytest.approx(0.0))


def test_line_midpoint_zero_length(spark):
    seg = spark.createDataFrame([("l", 1, 5.0, 6.0, 5.0, 6.0)],
                                "line_id string, seg_no int, x1 double, y1 double, x2 double, y2 double")
    r = line_midpoints(seg).collect()[0]
    assert (r.mx, r.my) == (5.0, 6.0)
    assert F is not None


def test_multi_part_line_walks_part_by_part(spark):
    # two parts along x, 0..40 and 100..140: half of 80 is where the first part ends
    seg = spark.createDataFrame([("a", 1, 0, 0.0, 0.0, 20.0, 0.0), ("a", 1, 1, 20.0, 0.0, 40.0, 0.0),
                                 ("a", 2, 0, 100.0, 0.0, 130.0, 0.0), ("a", 2, 1, 130.0, 0.0, 140.0, 0.0)],
                                "line_id string, part int, seg_no int, x1 double, y1 double, x2 double, y2 double")
    r = line_midpoints(seg, order_col=["part", "seg_no"]).collect()[0]
    assert (r.length, r.mx) == (80.0, 40.0)


def test_weighted_year_counts_dated_sections_only(spark):
    from sitewise.operators.spatial import area_traffic
    s = spark.createDataFrame([("a", 1000.0, 10.0, 1.0, True, 2020), ("a", 1000.0, 10.0, 1.0, False, None),
                               ("b", 1000.0, None, None, False, None)],
                              "area string, length_m double, adt double, adt_heavy double, measured boolean, year int")
    got = {r.area: (r.weighted_year, r.vkm, r.n_no_adt) for r in area_traffic(s, s.select("area").distinct()).collect()}
    assert got == {"a": (2020.0, 20.0, 0), "b": (0.0, 0.0, 1)}


def test_a_point_at_exactly_the_radius_is_not_assigned(spark):
    from sitewise.operators.spatial import nearest_border
    e = spark.createDataFrame([("a", 0.0, 0.0, 10.0, 0.0)], "area string, x1 double, y1 double, x2 double, y2 double")
    p = spark.createDataFrame([(1, 5.0, 2000.0), (2, 5.0, 1999.0)], "pid int, x double, y double")
    assert [r.pid for r in nearest_border(p, e, 2000.0).collect()] == [2]
