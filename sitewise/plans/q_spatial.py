"""Spatial queries on geometry derived from the driver tables.

Areas: each nation is a 1 km square tile with a 200 m square hole; the
tile's row is its region, its column its rank within the region, so the
25 tiles cover a 5 km × 5 km square and share borders.  Points: customers
at coordinates derived from their key, spread 2.5 km beyond the tiles so
some fall in holes (nearest-border fallback) or too far out (dropped).
Lines ("road sections"): each order is a polyline through vertices derived
from its lines' part keys, in line-number order; its flow is the order's
total quantity.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sitewise.operators.spatial import area_traffic, assign_points, vertex_array, with_midpoint
from sitewise.plans.registry import query
from sitewise.session import load, materialize

# Fixed geometry parameters (metres).
TILE, HOLE_LO, HOLE_HI = 1000.0, 400.0, 600.0
CELL, BAND, MAX_DIST = 1000.0, 250.0, 2000.0
PX, PY, SPREAD, OFFSET = 7919, 104729, 10000, 2500
VSPREAD = 5000


def tile_edges(spark, sf):
    n = load(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("area"),
                                         F.col("n_regionkey").cast("long").alias("rw"))
    n = n.withColumn("cl", F.row_number().over(Window.partitionBy("rw").orderBy("area")) - 1)
    x0, y0 = F.col("cl") * TILE, F.col("rw") * TILE

    def ring(lo, hi):
        xs = [x0 + lo, x0 + hi, x0 + hi, x0 + lo]
        ys = [y0 + lo, y0 + lo, y0 + hi, y0 + hi]
        return [F.struct(xs[i].alias("x1"), ys[i].alias("y1"), xs[(i + 1) % 4].alias("x2"),
                         ys[(i + 1) % 4].alias("y2")) for i in range(4)]

    edges = F.array(*ring(F.lit(0.0), F.lit(TILE)), *ring(F.lit(HOLE_LO), F.lit(HOLE_HI)))
    return n.select("area", F.explode(edges).alias("e")).select(
        "area", *[F.col(f"e.{c}").cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")])


def customer_points(spark, sf):
    c = load(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("pid"),
                    ((F.col("c_custkey") * PX) % SPREAD - OFFSET).cast("double").alias("x"),
                    ((F.col("c_custkey") * PY) % SPREAD - OFFSET).cast("double").alias("y"))


def sections(spark, sf):
    """One row per order polyline: length (mm precision), midpoint (mm),
    flow attributes from the order and its lines."""
    li = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("line_id"), "l_linenumber", "l_partkey", "l_quantity", "l_returnflag",
        ((F.col("l_partkey") * PX) % VSPREAD).cast("double").alias("vx"),
        ((F.col("l_partkey") * PY) % VSPREAD).cast("double").alias("vy"))
    # one shuffle of the lines: vertices and flows per polyline together
    per = li.groupBy("line_id").agg(
        vertex_array(["l_linenumber", "l_partkey"], "vx", "vy").alias("pts"),
        F.sum("l_quantity").alias("adt"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)).alias("adt_heavy"))
    mid = with_midpoint(per, "pts").select("line_id", "length", "mx", "my", "adt", "adt_heavy")
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("line_id"),
                                         (F.col("o_orderstatus") == "F").alias("measured"),
                                         F.year("o_orderdate").cast("long").alias("year"))
    return mid.join(o, "line_id").select(
        "line_id", F.round("length", 3).cast("decimal(18,3)").alias("length_m"), F.round("mx", 3).alias("x"), F.round("my", 3).alias("y"),
        "adt", "adt_heavy", "measured", "year")


_GEOM_SQL = """
t AS (SELECT CAST(n_nationkey AS BIGINT) AS area, CAST(n_regionkey AS BIGINT) AS rw,
             ROW_NUMBER() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS cl FROM nation),
g AS (SELECT area, cl * 1000.0 AS x0, rw * 1000.0 AS y0 FROM t),
edges AS (
  SELECT area, x0 AS x1, y0 AS y1, x0 + 1000 AS x2, y0 AS y2 FROM g
  UNION ALL SELECT area, x0 + 1000, y0, x0 + 1000, y0 + 1000 FROM g
  UNION ALL SELECT area, x0 + 1000, y0 + 1000, x0, y0 + 1000 FROM g
  UNION ALL SELECT area, x0, y0 + 1000, x0, y0 FROM g
  UNION ALL SELECT area, x0 + 400, y0 + 400, x0 + 600, y0 + 400 FROM g
  UNION ALL SELECT area, x0 + 600, y0 + 400, x0 + 600, y0 + 600 FROM g
  UNION ALL SELECT area, x0 + 600, y0 + 600, x0 + 400, y0 + 600 FROM g
  UNION ALL SELECT area, x0 + 400, y0 + 600, x0 + 400, y0 + 400 FROM g)
"""


def _assign_sql(points_cte: str) -> str:
    return f"""
{points_cte},
inside AS (
  SELECT p.pid, MIN(g.area) AS area, COUNT(*) AS n_hits
  FROM p JOIN g ON p.x >= g.x0 AND p.x < g.x0 + 1000 AND p.y >= g.y0 AND p.y < g.y0 + 1000
               AND NOT (p.x >= g.x0 + 400 AND p.x < g.x0 + 600 AND p.y >= g.y0 + 400 AND p.y < g.y0 + 600)
  GROUP BY p.pid),
rest AS (SELECT * FROM p WHERE pid NOT IN (SELECT pid FROM inside)),
d0 AS (SELECT r.pid, r.x, r.y, e.area, e.x1, e.y1, e.x2 - e.x1 AS dx, e.y2 - e.y1 AS dy
       FROM rest r CROSS JOIN edges e),
d1 AS (SELECT *, CASE WHEN dx * dx + dy * dy = 0 THEN 0.0
                      ELSE LEAST(1.0, GREATEST(0.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) END AS tt
       FROM d0),
d AS (SELECT pid, area, sqrt((x - (x1 + tt * dx)) * (x - (x1 + tt * dx)) + (y - (y1 + tt * dy)) * (y - (y1 + tt * dy)))
             AS dist FROM d1),
near AS (SELECT pid, area, dist FROM d WHERE dist < 2000
         QUALIFY ROW_NUMBER() OVER (PARTITION BY pid ORDER BY dist, area) = 1),
assigned AS (
  SELECT pid, area, 'contains' AS method, CAST(NULL AS DOUBLE) AS dist, n_hits FROM inside
  UNION ALL SELECT pid, area, 'nearest', dist, 0 FROM near)
"""


_POINTS_SQL = """p AS (SELECT c_custkey AS pid, CAST((c_custkey * 7919) % 10000 - 2500 AS DOUBLE) AS x,
                CAST((c_custkey * 104729) % 10000 - 2500 AS DOUBLE) AS y FROM customer)"""


@query("spatial_assign", "WITH " + _GEOM_SQL + "," + _assign_sql(_POINTS_SQL) + """
SELECT pid, area, method, ROUND(dist, 6) AS dist, n_hits FROM assigned
""")
def spatial_assign_q(spark, sf):
    """Customers assigned to nation tiles: even-odd containment (holes
    excluded, shared borders owned once), else the nearest border within
    2 km, else dropped."""
    a = assign_points(customer_points(spark, sf), tile_edges(spark, sf), CELL, BAND, MAX_DIST)
    return a.select("pid", "area", "method", F.round("dist", 6).alias("dist"),
                    F.col("n_hits").cast("long").alias("n_hits"))


_SECTIONS_SQL = """
v AS (SELECT l_orderkey AS line_id, CAST((l_partkey * 7919) % 5000 AS DOUBLE) AS vx,
             CAST((l_partkey * 104729) % 5000 AS DOUBLE) AS vy,
             ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS seg_no,
             COUNT(*) OVER (PARTITION BY l_orderkey) AS nv
      FROM lineitem),
s AS (SELECT line_id, seg_no, nv, vx AS x1, vy AS y1,
             COALESCE(LEAD(vx) OVER (PARTITION BY line_id ORDER BY seg_no), vx) AS x2,
             COALESCE(LEAD(vy) OVER (PARTITION BY line_id ORDER BY seg_no), vy) AS y2
      FROM v),
s2 AS (SELECT *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS seg_len FROM s WHERE seg_no < nv OR nv = 1),
s3 AS (SELECT *, COALESCE(SUM(seg_len) OVER (PARTITION BY line_id ORDER BY seg_no
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before,
              SUM(seg_len) OVER (PARTITION BY line_id) AS length FROM s2),
mid AS (SELECT line_id, length,
               x1 + (CASE WHEN seg_len > 0 THEN (length / 2 - before) / seg_len ELSE 0.0 END) * (x2 - x1) AS mx,
               y1 + (CASE WHEN seg_len > 0 THEN (length / 2 - before) / seg_len ELSE 0.0 END) * (y2 - y1) AS my
        FROM s3 WHERE before <= length / 2 AND length / 2 <= before + seg_len
        QUALIFY ROW_NUMBER() OVER (PARTITION BY line_id ORDER BY seg_no) = 1),
la AS (SELECT l_orderkey AS line_id, SUM(l_quantity) AS adt,
              SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS adt_heavy
       FROM lineitem GROUP BY 1),
sec AS (SELECT m.line_id, CAST(ROUND(m.length, 3) AS DECIMAL(18,3)) AS length_m, ROUND(m.mx, 3) AS x,
               ROUND(m.my, 3) AS y, la.adt, la.adt_heavy, o.o_orderstatus = 'F' AS measured,
               CAST(year(o.o_orderdate) AS BIGINT) AS year
        FROM mid m JOIN la USING (line_id) JOIN orders o ON o.o_orderkey = m.line_id)
"""


@query("line_midpoint", "WITH " + _SECTIONS_SQL + """
SELECT line_id, CAST(length_m AS DOUBLE) AS length_m, x AS mx, y AS my FROM sec
""")
def line_midpoint_q(spark, sf):
    """Length and half-length point of every order polyline."""
    s = sections(spark, sf)
    return s.select("line_id", F.col("length_m").cast("double").alias("length_m"),
                    F.col("x").alias("mx"), F.col("y").alias("my"))


def _traffic(spark, sf):
    sec = materialize(sections(spark, sf))  # read by the points, the edges' fallback and the join back
    a = assign_points(sec.select(F.col("line_id").alias("pid"), "x", "y"), tile_edges(spark, sf),
                      CELL, BAND, MAX_DIST)
    return sec, materialize(sec.join(a.select(F.col("pid").alias("line_id"), "area"), "line_id"))


@query("road_traffic", "WITH " + _GEOM_SQL + "," + _SECTIONS_SQL + "," + _assign_sql(
    "p AS (SELECT line_id AS pid, x, y FROM sec)") + """,
j AS (SELECT s.*, a.area FROM sec s JOIN assigned a ON a.pid = s.line_id),
agg AS (SELECT area, COUNT(*) AS n_sections, SUM(length_m) / 1000 AS road_km,
               SUM(length_m * CAST(adt AS DECIMAL(18,2))) / 1000 AS vkm,
               SUM(length_m * CAST(adt_heavy AS DECIMAL(18,2))) / 1000 AS vkm_heavy, MAX(adt) AS max_adt,
               SUM(CASE WHEN measured THEN length_m * CAST(adt AS DECIMAL(18,2)) END) / 1000 AS vkm_measured,
               SUM(length_m * CAST(adt AS DECIMAL(18,2)) * year) / 1000 AS vkm_year,
               COUNT(*) FILTER (WHERE adt IS NULL) AS n_no_adt
        FROM j GROUP BY area)
SELECT t.area, CAST(COALESCE(n_sections, 0) AS BIGINT) AS n_sections,
       CAST(COALESCE(road_km, 0) AS DOUBLE) AS road_km, CAST(COALESCE(vkm, 0) AS DOUBLE) AS vkm,
       CAST(COALESCE(vkm_heavy, 0) AS DOUBLE) AS vkm_heavy, COALESCE(max_adt, 0.0) AS max_adt,
       CASE WHEN COALESCE(vkm, 0) > 0 THEN ROUND(CAST(COALESCE(vkm_measured, 0) AS DOUBLE) / CAST(vkm AS DOUBLE), 9)
            ELSE 0.0 END AS measured_share,
       CASE WHEN COALESCE(vkm, 0) > 0 THEN ROUND(CAST(vkm_year AS DOUBLE) / CAST(vkm AS DOUBLE), 6)
            ELSE 0.0 END AS weighted_year,
       CAST(COALESCE(n_no_adt, 0) AS BIGINT) AS n_no_adt
FROM t LEFT JOIN agg USING (area)
""")
def road_traffic_q(spark, sf):
    """Per nation tile (all 25): sections, road km, vehicle-km (all and
    heavy), max flow, measured share, flow-weighted year — midpoints
    assigned by containment, else nearest border."""
    _, j = _traffic(spark, sf)
    areas = tile_edges(spark, sf).select("area").distinct()
    dec = j.select("area", "length_m", F.col("adt").cast("decimal(18,2)").alias("adt"),
                   F.col("adt_heavy").cast("decimal(18,2)").alias("adt_heavy"), "measured", "year")
    t = area_traffic(dec, areas)
    return t.select("area", "n_sections", F.col("road_km").cast("double").alias("road_km"),
                    F.col("vkm").cast("double").alias("vkm"), F.col("vkm_heavy").cast("double").alias("vkm_heavy"),
                    F.col("max_adt").cast("double").alias("max_adt"),
                    F.round(F.col("measured_share").cast("double"), 9).alias("measured_share"),
                    F.round(F.col("weighted_year").cast("double"), 6).alias("weighted_year"), "n_no_adt")


@query("traffic_conservation", "WITH " + _GEOM_SQL + "," + _SECTIONS_SQL + "," + _assign_sql(
    "p AS (SELECT line_id AS pid, x, y FROM sec)") + """
SELECT COUNT(*) AS n_sections_in, CAST(SUM(length_m) AS DOUBLE) AS length_in,
       COUNT(a.pid) AS n_sections_assigned,
       CAST(COALESCE(SUM(CASE WHEN a.pid IS NOT NULL THEN length_m END), 0) AS DOUBLE) AS length_assigned,
       COUNT(*) - COUNT(a.pid) AS n_sections_dropped
FROM sec LEFT JOIN assigned a ON a.pid = sec.line_id
""")
def traffic_conservation_q(spark, sf):
    """Input vs output totals of the spatial assignment (nothing lost
    except what lies beyond the fallback radius)."""
    sec, j = _traffic(spark, sf)
    left = sec.join(j.select("line_id", F.lit(True).alias("_a")), "line_id", "left")
    return left.agg(F.count(F.lit(1)).alias("n_sections_in"),
                    F.sum("length_m").cast("double").alias("length_in"),
                    F.count("_a").alias("n_sections_assigned"),
                    F.coalesce(F.sum(F.when(F.col("_a"), F.col("length_m"))), F.lit(0)).cast("double")
                     .alias("length_assigned"),
                    (F.count(F.lit(1)) - F.count("_a")).alias("n_sections_dropped"))


@query("road_km_by_band", "WITH " + _SECTIONS_SQL + """
SELECT CAST(floor(y / 500) AS BIGINT) AS band, COUNT(*) AS n_sections,
       CAST(SUM(length_m) / 1000 AS DOUBLE) AS road_km
FROM sec GROUP BY 1
""")
def road_km_by_band_q(spark, sf):
    """Histogram of road km by 500 m north-south band of the midpoint."""
    s = sections(spark, sf)
    return s.groupBy(F.floor(F.col("y") / 500).cast("long").alias("band")).agg(
        F.count(F.lit(1)).alias("n_sections"), (F.sum("length_m") / 1000).cast("double").alias("road_km"))


@query("road_traffic_gaps", "WITH " + _GEOM_SQL + "," + _SECTIONS_SQL + "," + _assign_sql(
    "p AS (SELECT line_id AS pid, x, y FROM sec)") + """,
-- what a source leaves out: no flow for every seventh section, no year for every fifth, flows of a third kind unmeasured
j AS (SELECT a.area, CAST(length_m AS DOUBLE) / 1000 AS km, CASE WHEN line_id % 7 <> 0 THEN adt END AS flow, CASE WHEN line_id % 5 <> 0 THEN year END AS y, measured FROM sec JOIN assigned a ON a.pid = line_id),
kept AS (SELECT area, list({'km': km, 'flow': flow, 'y': y, 'm': measured}) AS rows FROM j GROUP BY area)
SELECT t.area, CAST(coalesce(len(rows), 0) AS BIGINT) AS n_sections, round(coalesce(list_sum([r.km FOR r IN rows]), 0), 3) AS road_km,
  round(coalesce(list_sum([r.km * r.flow FOR r IN rows IF r.flow IS NOT NULL]), 0), 3) AS vkm, CAST(coalesce(len([1 FOR r IN rows IF r.flow IS NULL]), 0) AS BIGINT) AS n_no_adt,
  round(coalesce(list_sum([r.km * r.flow FOR r IN rows IF r.m AND r.flow IS NOT NULL]) / nullif(list_sum([r.km * r.flow FOR r IN rows IF r.flow IS NOT NULL]), 0), 0), 9) AS measured_share,
  -- the mean of the known years, each by the traffic whose year it is
  round(coalesce(list_sum([r.km * r.flow * (r.y - 1990) FOR r IN rows IF r.y IS NOT NULL AND r.flow IS NOT NULL]) / nullif(list_sum([r.km * r.flow FOR r IN rows IF r.y IS NOT NULL AND r.flow IS NOT NULL]), 0) + 1990, 0), 6) AS weighted_year
FROM t LEFT JOIN kept ON kept.area = t.area
""")
def road_traffic_gaps_q(spark, sf):
    """Traffic per nation tile where flows and years are missing: sums skip
    them, the weighted year is of the sections whose year is known."""
    _, j = _traffic(spark, sf)
    gaps = j.select("area", F.col("length_m").cast("double").alias("length_m"), F.when(F.col("line_id") % 7 != 0, F.col("adt")).alias("adt"), "adt_heavy", "measured",
                    F.when(F.col("line_id") % 5 != 0, F.col("year")).alias("year"))
    t = area_traffic(gaps, tile_edges(spark, sf).select("area").distinct())
    return t.select("area", "n_sections", F.round("road_km", 3).alias("road_km"), F.round("vkm", 3).alias("vkm"), "n_no_adt", F.round("measured_share", 9).alias("measured_share"), F.round("weighted_year", 6).alias("weighted_year"))
