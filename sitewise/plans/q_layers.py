"""Geometry blobs, area and section layers, conformed zones, rules as data."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import functions as F

from sitewise.functions.money import cents, cents_to_double
from sitewise.operators.cell_tree import points_in_polygons_balanced
from sitewise.operators.layers import area_layer, conform, split_zones, validity_sweep
from sitewise.operators.rules import reconcile_by_rules
from sitewise.plans.q_spatial import _GEOM_SQL, CELL, PX, PY, TILE, VSPREAD, tile_edges
from sitewise.plans.registry import query
from sitewise.session import load, materialize
from sitewise.sources import wkb

# Fixed values of the blobs' layout: code of a line, a polygon, a multi line; ISO and EWKB flags.
LINE, POLYGON, MULTI_LINE, MULTI_POLYGON = 2, 3, 5, 6
EWKB_Z, EWKB_M, EWKB_SRID = 0x80000000, 0x40000000, 0x20000000


def _run(points, order, extra):
    return struct.pack(order + "I", len(points)) + b"".join(struct.pack(f"{order}{2 + extra}d", x, y, *[1e6] * extra) for x, y in points)


def _blob(kind: int, parts) -> bytes:
    """The parts as a line or multi line in one of eight spellings."""
    if kind == 7:
        return b""
    order, mark = (">", b"\x00") if kind % 2 else ("<", b"\x01")
    extra = {2: 1, 3: 1, 4: 2}.get(kind, 0)
    code = {2: LINE + 1000, 3: LINE | EWKB_M, 4: LINE | EWKB_Z | EWKB_M | EWKB_SRID}.get(kind, LINE)
    head = mark + struct.pack(order + "I", code) + (struct.pack(order + "I", 3006) if code & EWKB_SRID else b"")
    if kind == 5:
        return mark + struct.pack(order + "II", MULTI_LINE, len(parts)) + b"".join(head + _run(p, order, 0) for p in parts)
    body = head + _run([p for part in parts for p in part], order, extra)
    return b"GP\x00" + bytes([1 << 1]) + struct.pack("<i4d", 3006, 0, 0, 0, 0) + body if kind == 6 else body


def _line_blobs(batches):
    for b in batches:
        out = []
        for kind, points in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            parts = [[(p["x"], p["y"]) for p in points if (p["no"] > 3) == second] for second in (False, True)]
            out.append(_blob(kind, [p for p in parts if p] if kind == 5 else [[(p["x"], p["y"]) for p in points]]))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["line_id", "blob"])


@query("wkb_sections", """
WITH v AS (SELECT l_orderkey AS line_id, l_orderkey % 8 AS kind, l_linenumber AS no, l_partkey, CAST((l_partkey * 7919) % 5000 AS DOUBLE) AS x, CAST((l_partkey * 104729) % 5000 AS DOUBLE) AS y
  FROM lineitem WHERE l_orderkey % 8 <> 7),
p AS (SELECT *, CASE WHEN kind = 5 AND no > 3 THEN 1 ELSE 0 END AS part FROM v),
s AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM p WINDOW w AS (PARTITION BY line_id, part ORDER BY no, l_partkey, x, y))
SELECT line_id, CASE kind WHEN 5 THEN 'MultiLineString' ELSE 'LineString' END AS geometry_type, count(DISTINCT part) AS n_parts, count(*) AS n_points,
  round(sum(coalesce(sqrt((x - px) * (x - px) + (y - py) * (y - py)), 0)), 3) AS length
FROM s GROUP BY line_id, kind
UNION ALL SELECT DISTINCT l_orderkey, NULL, 0, 0, NULL FROM lineitem WHERE l_orderkey % 8 = 7
""")
def wkb_sections_q(spark, sf):
    """Each order's polyline written as a blob, plain in both byte orders,
    with Z (ISO), M and Z and M and an SRID (EWKB), as a multi line, behind a
    GeoPackage header, or empty; decoded to parts, points and length."""
    li = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("line_id"), F.struct(
            F.col("l_linenumber").alias("no"), "l_partkey", ((F.col("l_partkey") * PX) % VSPREAD).cast("double").alias("x"),
            ((F.col("l_partkey") * PY) % VSPREAD).cast("double").alias("y")).alias("p"))
    lines = li.groupBy("line_id").agg(F.array_sort(F.collect_list("p")).alias("points"))
    blobs = materialize(lines.select("line_id", (F.col("line_id") % 8).cast("int").alias("kind"), "points").mapInArrow(_line_blobs, "line_id long, blob binary"))
    segs = wkb.segments(blobs, "line_id", "blob")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    length = segs.groupBy(F.col("id").alias("s_id")).agg(F.round(F.sum(F.sqrt(dx * dx + dy * dy)), 3).alias("length"))
    out = wkb.infos(blobs, "line_id", "blob").join(length, F.col("id") == F.col("s_id"), "left")
    return out.select(F.col("id").alias("line_id"), "geometry_type", "n_parts", "n_points", "length")


def _polygon_blobs(batches):
    """Squares with a square hole; kind 0 polygon, 1 multi polygon of two halves, 2 line, 3 empty polygon."""
    def ring(x0, y0, x1, y1):
        return _run([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)], "<", 0)

    def polygon(*rings):
        return b"\x01" + struct.pack("<II", POLYGON, len(rings)) + b"".join(rings)

    for b in batches:
        out = []
        for kind, x, y, side in zip(*[b.column(i).to_pylist() for i in range(2, 6)], strict=True):
            whole, hole = ring(x, y, x + side, y + side), ring(x + side * 0.4, y + side * 0.4, x + side * 0.6, y + side * 0.6)
            halves = [polygon(ring(x, y, x + side / 2, y + side)), polygon(ring(x + side / 2, y, x + side, y + side))]
            multi = b"\x01" + struct.pack("<II", MULTI_POLYGON, 2) + b"".join(halves)
            out.append([polygon(whole, hole), multi, b"\x01" + struct.pack("<I", LINE) + _run([(x, y), (x + side, y)], "<", 0), polygon()][kind])
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["code", "parent", "blob"])


@query("area_layer", """
WITH s AS (SELECT s_suppkey AS k, s_nationkey AS nation, CAST(10 + s_suppkey % 90 AS DOUBLE) AS side, CASE WHEN s_suppkey % 10 < 6 THEN 0 WHEN s_suppkey % 10 < 8 THEN 1 WHEN s_suppkey % 10 = 8 THEN 2 ELSE 3 END AS kind FROM supplier),
a AS (SELECT *, CASE WHEN k % 41 = 0 THEN '' WHEN k % 37 = 0 THEN 'XX-' || k ELSE lpad(CAST(nation AS VARCHAR), 2, '0') || '-' || k END AS code,
    CASE WHEN k % 29 = 0 THEN NULL ELSE lpad(CAST(nation AS VARCHAR), 2, '0') END AS parent,
    CASE kind WHEN 0 THEN side * side * 0.96 WHEN 1 THEN side * side END AS size FROM s),
g AS (SELECT parent, count(*) AS n_areas, count(DISTINCT code) FILTER (WHERE code <> '') AS n_codes, count(*) FILTER (WHERE code = '') AS n_blank_codes,
    count(*) FILTER (WHERE code LIKE 'XX%' AND parent IS NOT NULL) AS n_prefix, count(*) FILTER (WHERE kind = 3) AS n_empty, count(*) FILTER (WHERE kind = 2) AS n_not_polygon,
    array_to_string(list_sort(list(DISTINCT CASE kind WHEN 1 THEN 'MultiPolygon' WHEN 2 THEN 'LineString' ELSE 'Polygon' END)), '|') AS geometry_types, sum(coalesce(size, 0)) AS total FROM a GROUP BY parent),
n AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS parent, 1000000.0 AS parent_area FROM nation WHERE n_nationkey <> 7)
SELECT coalesce(n.parent, g.parent) AS parent, coalesce(n_areas, 0) AS n_areas, coalesce(n_codes, 0) AS n_codes, coalesce(n_blank_codes, 0) AS n_blank_codes, coalesce(n_prefix, 0) AS n_prefix,
  coalesce(n_empty, 0) AS n_empty, coalesce(n_not_polygon, 0) AS n_not_polygon, coalesce(geometry_types, '') AS geometry_types, round(coalesce(total, 0), 4) AS area_sum,
  CAST(parent_area AS DOUBLE) AS parent_area, round(coalesce(total, 0) / parent_area, 9) AS coverage, n.parent IS NOT NULL AS known
FROM g FULL JOIN n ON g.parent = n.parent
""")
def area_layer_q(spark, sf):
    """A layer of one area a supplier, drawn as polygon with a hole, multi
    polygon, line or empty polygon; some codes are blank or do not begin with
    their nation's, some areas have no nation, one nation is not known."""
    k, two = F.col("s_suppkey"), F.lpad(F.col("s_nationkey").cast("string"), 2, "0")
    rows = load(spark, sf, "supplier").select(
        F.when(k % 41 == 0, "").when(k % 37 == 0, F.concat(F.lit("XX-"), k.cast("string"))).otherwise(F.concat(two, F.lit("-"), k.cast("string"))).alias("code"),
        F.when(k % 29 != 0, two).alias("parent"), F.when(k % 10 < 6, 0).when(k % 10 < 8, 1).when(k % 10 == 8, 2).otherwise(3).alias("kind"),
        ((k * PX) % VSPREAD).cast("double").alias("x"), ((k * PY) % VSPREAD).cast("double").alias("y"), (10 + k % 90).cast("double").alias("side"))
    layer = materialize(rows.mapInArrow(_polygon_blobs, "code string, parent string, blob binary"))
    parents = load(spark, sf, "nation").where("n_nationkey <> 7").select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("parent"), F.lit(TILE * TILE).alias("area"))
    out = area_layer(layer, parents, "code", "parent", "blob")
    return out.withColumn("area_sum", F.round("area_sum", 4)).withColumn("coverage", F.round("coverage", 9))


@query("section_validity", """
WITH r AS (SELECT l_partkey AS section, l_linestatus AS role, l_returnflag AS direction, CAST(l_shipdate AS DATE) AS a,
    CASE WHEN l_quantity < 5 THEN NULL WHEN l_quantity = 13 THEN CAST(l_shipdate AS DATE) - 1 ELSE CAST(l_shipdate AS DATE) + CAST(l_quantity * 20 AS INTEGER) END AS b FROM lineitem),
k AS (SELECT section, role, direction, count(*) AS n_rows, count(*) FILTER (WHERE (b > a OR b IS NULL) AND a <= DATE '1997-06-30' AND (b IS NULL OR b > DATE '1997-06-30')) AS n_current,
    count(*) FILTER (WHERE b IS NULL) AS n_open, count(*) FILTER (WHERE b <= a) AS n_empty FROM r GROUP BY ALL),
live AS (SELECT section, role, direction, a, b FROM r WHERE b IS NULL OR b > a),
cuts AS (SELECT section, role, direction, a AS d FROM live UNION SELECT section, role, direction, b FROM live WHERE b IS NOT NULL),
spans AS (SELECT *, lead(d) OVER (PARTITION BY section, role, direction ORDER BY d) AS e FROM cuts),
valid AS (SELECT s.section, s.role, s.direction, s.d, s.e, count(*) AS n FROM spans s JOIN live l USING (section, role, direction) WHERE l.a <= s.d AND (l.b IS NULL OR l.b > s.d) GROUP BY ALL),
m AS (SELECT section, role, direction, max(n) AS max_overlap, coalesce(sum(CASE WHEN n > 1 THEN e - d END), 0) AS overlap_days FROM valid GROUP BY ALL)
SELECT k.section, k.role, k.direction, n_rows, n_current, CAST(coalesce(max_overlap, 0) AS BIGINT) AS max_overlap, CAST(coalesce(overlap_days, 0) AS BIGINT) AS overlap_days, n_open, n_empty
FROM k LEFT JOIN m ON k.section = m.section AND k.role = m.role AND k.direction = m.direction
""")
def section_validity_q(spark, sf):
    """Dated rows of a section (part) by role and direction: how many are
    current, how many are valid at once at most, on how many days more than
    one is."""
    day = F.to_date("l_shipdate")
    end = F.when(F.col("l_quantity") < 5, None).when(F.col("l_quantity") == 13, F.date_sub(day, 1)).otherwise(F.date_add(day, (F.col("l_quantity") * 20).cast("int")))
    rows = load(spark, sf, "lineitem").select(F.col("l_partkey").alias("section"), F.col("l_linestatus").alias("role"), F.col("l_returnflag").alias("direction"), day.alias("a"), end.alias("b"))
    return validity_sweep(rows, ["section", "role", "direction"], "a", "b", F.to_date(F.lit("1997-06-30")), F.year("day"))


@query("section_rows_per_id", """
WITH n AS (SELECT l_partkey, count(*) AS rows_per_id, sum(l_quantity) AS qty, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS measured FROM lineitem GROUP BY 1)
SELECT rows_per_id, count(*) AS n_ids, CAST(sum(qty) AS DOUBLE) AS qty, CAST(sum(measured) / sum(qty) AS DOUBLE) AS measured_share FROM n GROUP BY 1
""")
def section_rows_per_id_q(spark, sf):
    """How many rows a section has, and the share of flow that was measured."""
    per = load(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("rows_per_id"), F.sum("l_quantity").alias("qty"), F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)).alias("measured"))
    return per.groupBy("rows_per_id").agg(F.count(F.lit(1)).alias("n_ids"), F.sum("qty").alias("qty"), (F.sum("measured") / F.sum("qty")).alias("measured_share"))


@query("dim_conformed", """
WITH c AS (SELECT c_custkey AS unit, c_nationkey AS nation, (SELECT n_regionkey FROM nation WHERE n_nationkey = c_nationkey) AS region, c_custkey % 12 AS m FROM customer),
z AS (SELECT unit, nation, region,
    CASE WHEN m = 1 THEN 'Z' || (unit % 4 + 1) WHEN m IN (2, 3, 4) THEN 'Z' || (unit % 4 + 1) END AS own, m BETWEEN 1 AND 6 AS has_own,
    CASE m WHEN 3 THEN 'Z' || ((unit + 1) % 4 + 1) WHEN 4 THEN 'Z' || (unit % 4 + 1) WHEN 5 THEN 'Z2' ELSE '' END AS second,
    CASE m WHEN 2 THEN 'Ja' WHEN 3 THEN ' TRUE ' WHEN 4 THEN 'y' WHEN 5 THEN 'nej' WHEN 6 THEN 'perhaps' END AS said,
    CASE WHEN nation % 3 = 0 THEN 'Z' || (nation % 4 + 1) END AS of_nation, CASE WHEN region <> 4 THEN 'Z' || (region % 4 + 1) END AS of_region FROM c),
d AS (SELECT unit, coalesce(own, of_nation, of_region) AS zone,
    CASE WHEN own IS NOT NULL THEN 'unit' WHEN of_nation IS NOT NULL THEN 'nation' WHEN of_region IS NOT NULL THEN 'region' END AS zone_from,
    CASE WHEN has_own THEN 'unit' WHEN nation % 3 = 0 THEN 'nation' WHEN region <> 4 THEN 'region' END AS level,
    CASE WHEN second <> '' AND has_own THEN second END AS second_zone,
    CASE WHEN has_own AND said IN ('Ja', ' TRUE ', 'y') THEN true WHEN has_own AND said = 'perhaps' THEN NULL ELSE false END AS is_split FROM z)
SELECT unit, zone, zone_from, level, second_zone, is_split,
  CASE WHEN zone IS NULL THEN 'unknown_zone' WHEN is_split IS NULL THEN 'unknown_flag'
       WHEN is_split AND (second_zone IS NULL OR second_zone = zone) THEN 'split_without_second' WHEN NOT is_split AND second_zone IS NOT NULL THEN 'second_without_split' END AS broken
FROM d
""")
def dim_conformed_q(spark, sf):
    """Customers with a price zone from an ordered chain: the customer's own
    entry, the nation's, the region's; where each came from, a second zone for
    split ones, and rows that contradict themselves.  Entries are dated, the
    newest counts."""
    n = load(spark, sf, "nation")
    units = load(spark, sf, "customer").join(n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("region")), "c_nationkey", "left").select(
        F.col("c_custkey").alias("unit"), F.col("c_nationkey").alias("nation"), "region")
    u, m = F.col("unit"), F.col("unit") % 12
    zone = lambda c: F.concat(F.lit("Z"), (c % 4 + 1).cast("string"))
    second = F.when(m == 3, zone(u + 1)).when(m == 4, zone(u)).when(m == 5, F.lit("Z2")).otherwise(F.lit("  "))
    said = F.when(m == 2, "Ja").when(m == 3, " TRUE ").when(m == 4, "y").when(m == 5, "nej").when(m == 6, "perhaps")
    own = units.where((m >= 1) & (m <= 6)).select("unit", F.when(m <= 4, zone(u)).alias("zone"), second.alias("second_zone"), said.alias("split"), F.lit(2).alias("_ingested_at"))
    stale = own.select("unit", F.lit("Z0").alias("zone"), F.lit("Z0").alias("second_zone"), F.lit("no").alias("split"), F.lit(1).alias("_ingested_at"))
    of_nation = n.where("n_nationkey % 3 = 0").select(F.col("n_nationkey").alias("nation"), zone(F.col("n_nationkey")).alias("zone"))
    of_region = load(spark, sf, "region").where("r_regionkey <> 4").select(F.col("r_regionkey").alias("region"), zone(F.col("r_regionkey")).alias("zone"))
    dim = conform(units, "unit", [("unit", own.unionByName(stale), "unit"), ("nation", of_nation, "nation"), ("region", of_region, "region")], ["zone", "second_zone", "split"])
    out = split_zones(dim, "zone", "second_zone", "split", ["Z1", "Z2", "Z3", "Z4"])
    return out.select("unit", "zone", "zone_from", "level", "second_zone", "is_split", "broken")


@query("spatial_hot", "WITH " + _GEOM_SQL + """,
p AS (SELECT c_custkey AS pid, CASE WHEN c_custkey % 10 = 0 THEN CAST((c_custkey * 7919) % 10000 - 2500 AS DOUBLE) ELSE 2100 + CAST((c_custkey * 7919) % 997 AS DOUBLE) * 0.2 END AS x,
    CASE WHEN c_custkey % 10 = 0 THEN CAST((c_custkey * 104729) % 10000 - 2500 AS DOUBLE) ELSE 1300 + CAST((c_custkey * 104729) % 991 AS DOUBLE) * 0.2 END AS y FROM customer)
SELECT p.pid, g.area FROM p JOIN g ON p.x >= g.x0 AND p.x < g.x0 + 1000 AND p.y >= g.y0 AND p.y < g.y0 + 1000
  AND NOT (p.x >= g.x0 + 400 AND p.x < g.x0 + 600 AND p.y >= g.y0 + 400 AND p.y < g.y0 + 600)
""")
def spatial_hot_q(spark, sf):
    """Customers of whom nine in ten crowd in a fifth of one tile, located
    over a tree of cells that follows the crowd."""
    k = F.col("c_custkey")
    hot = k % 10 != 0
    x = F.when(hot, 2100 + (k * PX % 997).cast("double") * 0.2).otherwise(((k * PX) % 10000 - 2500).cast("double"))
    y = F.when(hot, 1300 + (k * PY % 991).cast("double") * 0.2).otherwise(((k * PY) % 10000 - 2500).cast("double"))
    points = load(spark, sf, "customer").select(k.alias("pid"), x.alias("x"), y.alias("y"))
    return points_in_polygons_balanced(points, tile_edges(spark, sf), CELL)


# Position, kind of pattern, pattern, rule: the first that matches decides.
CLASSES = [
    (1, "equals", "PROMO", "exact"), (2, "like", "ECON%", "rounding"), (3, "rlike", "^S(MALL)$", "suppressed"),
    (4, "in", "STANDARD|SMALL", "noise"), (5, "like", "M%", "unallocated"), (6, "like", "%", "exact"),
]


@query("reconcile_rules", """
WITH l AS (SELECT p_type, p_brand, CAST(round(l_extendedprice * 100) AS BIGINT) AS c, l_returnflag = 'R' AND l_quantity < 2 AS loose FROM lineitem JOIN part ON p_partkey = l_partkey),
b AS (SELECT p_type, p_brand, sum(c) AS c, sum(CASE WHEN loose THEN 0 ELSE c END) AS tight, count(*) AS n FROM l GROUP BY ALL),
k AS (SELECT p_type, p_brand, c, CASE p_type WHEN 'ECONOMY' THEN round(c / 100.0) * 100 WHEN 'SMALL' THEN CASE WHEN n % 5 = 0 THEN NULL ELSE c END
    WHEN 'STANDARD' THEN c + CASE WHEN p_brand LIKE '%1' THEN 7 ELSE -7 END WHEN 'MEDIUM' THEN tight WHEN 'LARGE' THEN c + 1 ELSE c END AS v FROM b),
s AS (SELECT p_type AS label, sum(c) AS total, count(*) AS n_children, count(*) - count(v) AS n_null_children, sum(v) AS v FROM k GROUP BY 1),
j AS (SELECT *, CASE WHEN label <> 'PROMO' THEN total END AS parent FROM s)
SELECT label, CASE label WHEN 'ECONOMY' THEN 'rounding' WHEN 'SMALL' THEN 'suppressed' WHEN 'STANDARD' THEN 'noise' WHEN 'MEDIUM' THEN 'unallocated' ELSE 'exact' END AS rule,
  n_children, n_null_children, CAST(v / 100.0 AS DOUBLE) AS sum_children, CAST(parent / 100.0 AS DOUBLE) AS parent,
  CASE WHEN parent IS NULL THEN 'no_parent'
    WHEN CASE label WHEN 'ECONOMY' THEN abs(v - total) <= 50 * n_children WHEN 'SMALL' THEN v <= total WHEN 'STANDARD' THEN abs(v - total) * 100000 <= total
      WHEN 'MEDIUM' THEN v <= total AND (total - v) * 100 <= total ELSE v = total END THEN 'kept' ELSE 'broken' END AS why
FROM j
""")
def reconcile_rules_q(spark, sf):
    """Sales per part type against their children per brand under rules read
    from a table: exact, rounded, withheld (NULL children), noisy, with a
    remainder; one type's children are wrong by a cent each, one type has no
    published total."""
    li = load(spark, sf, "lineitem").select("l_partkey", cents(F.col("l_extendedprice")).alias("c"), ((F.col("l_returnflag") == "R") & (F.col("l_quantity") < 2)).alias("loose"))
    per = li.groupBy("l_partkey").agg(F.sum("c").alias("c"), F.sum(F.when(F.col("loose"), 0).otherwise(F.col("c"))).alias("tight"), F.count(F.lit(1)).alias("n"))
    part = load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    b = per.join(part, "l_partkey").groupBy("p_type", "p_brand").agg(F.sum("c").alias("c"), F.sum("tight").alias("tight"), F.sum("n").alias("n"))
    kind, c = F.col("p_type"), F.col("c")
    v = (F.when(kind == "ECONOMY", F.round(c / 100.0) * 100).when((kind == "SMALL") & (F.col("n") % 5 == 0), None)
         .when(kind == "STANDARD", c + F.when(F.col("p_brand").endswith("1"), 7).otherwise(-7)).when(kind == "MEDIUM", F.col("tight")).when(kind == "LARGE", c + 1).otherwise(c))
    kids = materialize(b.select("p_type", c, v.cast("long").alias("v")))
    parents = kids.where("p_type <> 'PROMO'").groupBy("p_type").agg(F.sum("c").alias("parent"))
    r = reconcile_by_rules(kids.withColumn("label", kind), parents, ["p_type"], "label", "v", "parent", CLASSES, unit=100.0, default=None)
    return r.select("label", "rule", "n_children", "n_null_children", cents_to_double(F.col("sum_children")).alias("sum_children"), cents_to_double(F.col("parent")).alias("parent"), "why")
