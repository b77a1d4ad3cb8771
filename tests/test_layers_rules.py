"""Area and section layers, conformed zones, rule tables, deadlines, cells that follow a crowd."""
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitewise.functions.clock import local_instant
from sitewise.operators import cell_tree as ct
from sitewise.operators.layers import area_layer, conform, split_zones, validity_sweep
from sitewise.operators.rules import RuleTableError, classify, reconcile_by_rules
from sitewise.operators.spatial import points_in_polygons
from sitewise.sources import wkb
from sitewise.sources.files import overdue_files


def _ring(*pts):
    return struct.pack("<I", len(pts)) + b"".join(struct.pack("<dd", *p) for p in pts)


def _polygon(*rings):
    return struct.pack("<BII", 1, 3, len(rings)) + b"".join(rings)


SQUARE = _ring((0, 0), (10, 0), (10, 10), (0, 10), (0, 0))
HOLE = _ring((4, 4), (4, 6), (6, 6), (6, 4), (4, 4))


def _decode(*blobs):
    return wkb.decode(np.frombuffer(b"".join(blobs), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in blobs])]))


def test_many_shapes_of_one_batch():
    collection = struct.pack("<BII", 1, 7, 3) + struct.pack("<BI2d", 1, 1, 7, 8) + _polygon(SQUARE, HOLE) + struct.pack("<BII", 1, 4, 2) + struct.pack(">BI2d", 0, 1, 1, 2) + struct.pack("<BI2d", 1, 1, float("nan"), float("nan"))
    multi = struct.pack("<BII", 1, 6, 2) + _polygon(SQUARE) + _polygon(SQUARE, HOLE)
    d = _decode(_polygon(SQUARE, HOLE), b"", collection, multi, _polygon(), struct.pack("<BII", 1, 7, 0))
    assert d.kind.tolist() == [3, 0, 7, 6, 3, 7]
    assert list(zip(d.blob.tolist(), d.geom.tolist(), d.ring.tolist(), d.size.tolist())) == [
        (0, 0, 0, 5), (0, 0, 1, 5), (2, 0, 0, 1), (2, 1, 0, 5), (2, 1, 1, 5), (2, 2, 0, 1), (3, 0, 0, 5), (3, 1, 0, 5), (3, 1, 1, 5)]
    at = np.cumsum(d.size) - d.size
    assert (d.x[at[2]], d.y[at[2]]) == (7, 8) and (d.x[at[5]], d.y[at[5]]) == (1, 2)


def test_bad_blobs_are_named():
    with pytest.raises(wkb.BadGeometry, match="cut short"):
        _decode(_polygon(SQUARE)[:-3], _polygon(SQUARE))
    with pytest.raises(wkb.BadGeometry, match="unknown WKB type"):
        _decode(struct.pack("<BI", 1, 99))
    with pytest.raises(wkb.BadGeometry):
        _decode(struct.pack("<BII", 1, 2, 0xFFFFFFFF))


def test_area_layer(spark):
    rows = [("01-a", "01", _polygon(SQUARE, HOLE)), ("01-b", "01", struct.pack("<BII", 1, 6, 2) + _polygon(SQUARE) + _polygon(HOLE)), ("02-c", "01", None), (" ", "02", _polygon()),
            (None, "02", struct.pack("<BI2d", 1, 1, 0, 0)), ("x", None, _polygon(SQUARE)), ("09-z", "09", _polygon(SQUARE))]
    got = {r["p"]: r for r in area_layer(spark.createDataFrame([(c, p, bytearray(b) if b is not None else None) for c, p, b in rows], "c string, p string, g binary"),
                                         spark.createDataFrame([("01", 400.0), ("02", 10.0), ("03", 5.0)], "p string, area double"), "c", "p", "g").collect()}
    assert tuple(got["01"])[1:] == (3, 3, 0, 1, 1, 1, "MultiPolygon|Polygon", 96.0 + 104.0, 400.0, 0.5, True)
    assert tuple(got["02"])[1:] == (2, 0, 2, 0, 1, 1, "Point|Polygon", 0.0, 10.0, 0.0, True)
    assert tuple(got["03"])[1:7] == (0, 0, 0, 0, 0, 0) and got["03"]["coverage"] == 0.0
    assert got[None]["n_areas"] == 1 and not got[None]["known"] and not got["09"]["known"] and got["09"]["coverage"] is None


def test_validity_sweep_equals_counting_days(spark):
    rnd = random.Random(3)
    rows = []
    for k in ("a", "b", None):
        for _ in range(40):
            a = rnd.randrange(400)
            rows.append((k, a, rnd.choice([None, a + rnd.randrange(-2, 60)])))
    rows += [("empty", 5, 5), ("none", None, 9)]
    epoch = "2020-01-01"
    df = spark.createDataFrame(rows, "k string, a int, b int").select("k", F.date_add(F.lit(epoch).cast("date"), F.col("a")).alias("a"), F.date_add(F.lit(epoch).cast("date"), F.col("b")).alias("b"))
    got = {r["k"]: tuple(r)[1:] for r in validity_sweep(df, ["k"], "a", "b", F.date_add(F.lit(epoch).cast("date"), 200), F.trunc("day", "month")).collect() if r["k"] is not None}
    for k in ("a", "b", "empty", "none"):
        mine = [(a, b) for key, a, b in rows if key == k]
        live = [(a, b) for a, b in mine if a is not None and (b is None or b > a)]
        last = max([b for _, b in live if b is not None] + [a for a, _ in live], default=0)
        n = [sum(a <= d and (b is None or d < b) for a, b in live) for d in range(last + 1)]
        assert got[k] == (len(mine), sum(a <= 200 and (b is None or b > 200) for a, b in live), max(n, default=0), sum(x > 1 for x in n[:last]), sum(b is None for _, b in live), len(mine) - len(live)), k


def test_conformed_chain_and_split_zones(spark):
    units = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, "z")], "unit int, county string")
    own = spark.createDataFrame([(1, "S1", "S2", "ja", 2), (1, "S9", None, "no", 1), (2, " ", "", "maybe", 1), (3, "S1", "S1", "yes", 1)], "unit int, zone string, second string, split string, _ingested_at int")
    county = spark.createDataFrame([("x", "S3"), ("y", "S4")], "county string, zone string")
    dim = split_zones(conform(units, "unit", [("own", own, "unit"), ("county", county, "county")], ["zone", "second", "split"]), "zone", "second", "split", ["S1", "S2", "S3", "S4"])
    got = {r["unit"]: (r["zone"], r["zone_from"], r["level"], r["second"], r["is_split"], r["broken"]) for r in dim.collect()}
    assert got == {1: ("S1", "own", "own", "S2", True, None), 2: ("S3", "county", "own", None, None, "unknown_flag"),
                   3: ("S1", "own", "own", "S1", True, "split_without_second"), 4: (None, None, None, None, False, "unknown_zone")}


def test_first_pattern_decides_and_rules_judge(spark):
    classes = [(2, "like", "a%", "rounding"), (1, "equals", "ab", "exact"), (3, "rlike", "^[bc]$", "suppressed"), (4, "in", "n|m", "noise"), (5, "like", "u%", "unallocated"), (6, "equals", "w", "what")]
    kids = [("ab", 10), ("ab", 5), ("aa", 10), ("aa", 6), ("b", None), ("b", 9), ("c", 11), ("n", 100_000), ("m", 99_000), ("u1", 995), ("u2", 985), ("w", 1), ("none", 1), (None, 1), ("ax", None), ("lone", 4)]
    parents = [("ab", 15), ("aa", 15), ("b", 12), ("c", 10), ("n", 100_001), ("m", 100_000), ("u1", 1000), ("u2", 1000), ("w", 1), ("none", 1), ("ax", 0)]
    r = reconcile_by_rules(spark.createDataFrame(kids, "k string, v long").withColumn("label", F.col("k")), spark.createDataFrame(parents, "k string, p long"), ["k"], "label", "v", "p", classes, unit=1.0, default=None)
    got = {x["k"]: (x["rule"], x["n_null_children"], x["why"]) for x in r.collect()}
    assert got == {"ab": ("exact", 0, "kept"), "aa": ("rounding", 0, "kept"), "b": ("suppressed", 1, "kept"), "c": ("suppressed", 0, "broken"), "n": ("noise", 0, "kept"), "m": ("noise", 0, "broken"),
                   "u1": ("unallocated", 0, "kept"), "u2": ("unallocated", 0, "broken"), "w": ("what", 0, "broken"), "none": (None, 0, "no_rule"), None: (None, 0, "no_parent"), "ax": ("rounding", 1, "broken"), "lone": (None, 0, "no_parent")}
    with pytest.raises(RuleTableError):
        classify(F.col("k"), [(1, "equals", "a", "x"), (1, "like", "b", "y")])
    with pytest.raises(RuleTableError):
        classify(F.col("k"), [(1, "sounds", "a", "x")])


def test_deadlines_around_both_clock_changes(spark):
    days = [(d,) for d in ("2024-03-30", "2024-03-31", "2024-04-01", "2024-10-26", "2024-10-27", "2024-10-28")]
    df = spark.createDataFrame(days, "s string").select("s", F.col("s").cast("date").alias("day"))
    due = {r["s"]: str(r["due"]) for r in df.select("s", local_instant(F.col("day"), "13:00", "Europe/Stockholm", 1).alias("due")).collect()}
    assert due == {"2024-03-30": "2024-03-29 12:00:00", "2024-03-31": "2024-03-30 12:00:00", "2024-04-01": "2024-03-31 11:00:00",
                   "2024-10-26": "2024-10-25 11:00:00", "2024-10-27": "2024-10-26 11:00:00", "2024-10-28": "2024-10-27 12:00:00"}
    odd = df.where("s in ('2024-03-31', '2024-10-27')").select("s", local_instant(F.col("day"), "02:30", "Europe/Stockholm").alias("t")).orderBy("s").collect()
    assert [str(r["t"]) for r in odd] == ["2024-03-31 01:30:00", "2024-10-27 00:30:00"]
    now = F.lit("2024-03-31 11:00:00").cast("timestamp_ntz")
    late = overdue_files(df.select("day"), df.select("day").limit(0), [], "day", now, "Europe/Stockholm")
    assert sorted((str(r["day"]), r["severity"]) for r in late.collect())[2:4] == [("2024-04-01", "warning"), ("2024-10-26", "normal")]


def test_a_crowd_in_one_tile_is_dealt_out(spark):
    rnd = random.Random(7)
    pts = [(i, 0.3 + rnd.random() * 0.01, 0.3 + rnd.random() * 0.01) if i % 10 else (i, rnd.random() * 12 - 1, rnd.random() * 12 - 1) for i in range(6000)]
    pts += [(9000 + i, 5.5, 5.5) for i in range(900)] + [(10_000, None, 1.0), (10_001, 0.0, 0.0), (10_002, 10.0, 10.0)]
    points = spark.createDataFrame(pts, "pid long, x double, y double")
    edges = []
    for a in range(100):
        x, y = a % 10, a // 10
        for lo, hi in ((0, 1), (0.4, 0.6)):
            c = [(x + lo, y + lo), (x + hi, y + lo), (x + hi, y + hi), (x + lo, y + hi)]
            edges += [(a, *map(float, (*c[i], *c[(i + 1) % 4]))) for i in range(4)]
    edges = spark.createDataFrame(edges, "area long, x1 double, y1 double, x2 double, y2 double")
    want = {tuple(r) for r in points_in_polygons(points.where("x is not null"), edges, 1.0, 0.25).collect()}
    for cap in (50, 400):
        got = [tuple(r) for r in ct.points_in_polygons_balanced(points, edges, 1.0, cap).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    tree = ct.cell_tree(points, 50)
    load = [r["count"] for r in tree.located(points, "pid").groupBy("level", "cx", "cy", "salt").count().collect()]
    assert sum(load) == len(pts) - 1 and max(load) <= 100  # 900 points at one place are dealt to salts by hash
    # a task gets about eight leaves: none has three times the median
    tasks = [r["count"] for r in ct.cell_tree(points, ct.balanced_load(points)).located(points, "pid").repartition(4, "level", "cx", "cy", "salt").groupBy(F.spark_partition_id()).count().collect()]
    assert max(tasks) <= 3 * sorted(tasks)[len(tasks) // 2]
    assert ct.points_in_polygons_balanced(points.limit(0), edges, 1.0).count() == 0
