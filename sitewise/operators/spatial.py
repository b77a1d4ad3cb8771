"""Planar spatial joins as equi-joins on grid keys.

Geometry is kept as an *edges* table ``(area, x1, y1, x2, y2)`` — every
ring of every polygon, holes included — and a *segments* table for lines
``(line_id, seg_no, x1, y1, x2, y2)``.  No per-row geometry library:

* point in polygon — candidates by bounding box via 2-D grid cells (equi
  join on the cell), then the even-odd ray rule against the candidate
  areas' edges in the point's horizontal band (equi join on area, band);
  half-open straddle ``(y1 > y) != (y2 > y)`` so a point on a border shared
  by two tiling areas belongs to exactly one;
* nearest border — edges exploded over the cells of their box grown by the
  search radius, points joined on their cell, ``min_by`` distance;
* line midpoint — running length per line, the point at half the length.

Each exploded side grows with the geometry, not with the number of points,
and every join is on an equality key, so skewed cells only widen a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cells(lo: Column, hi: Column, size: float) -> Column:
    return F.sequence(F.floor(lo / size).cast("long"), F.floor(hi / size).cast("long"))


def area_boxes(edges: DataFrame, area_col: str = "area") -> DataFrame:
    return edges.groupBy(area_col).agg(
        F.least(F.min("x1"), F.min("x2")).alias("xmin"), F.greatest(F.max("x1"), F.max("x2")).alias("xmax"),
        F.least(F.min("y1"), F.min("y2")).alias("ymin"), F.greatest(F.max("y1"), F.max("y2")).alias("ymax"))


def points_in_polygons(points: DataFrame, edges: DataFrame, cell: float, band: float,
                       pid: str = "pid", area_col: str = "area") -> DataFrame:
    """(pid, area) for every area whose polygon contains the point (even-odd)."""
    boxes = (area_boxes(edges, area_col)
             .withColumn("cx", F.explode(_cells(F.col("xmin"), F.col("xmax"), cell)))
             .withColumn("cy", F.explode(_cells(F.col("ymin"), F.col("ymax"), cell))))
    pts = points.select(pid, "x", "y",
                        F.floor(F.col("x") / cell).cast("long").alias("cx"),
                        F.floor(F.col("y") / cell).cast("long").alias("cy"),
                        F.floor(F.col("y") / band).cast("long").alias("band"))
    cand = (pts.join(boxes, ["cx", "cy"])
               .where((F.col("x") >= F.col("xmin")) & (F.col("x") <= F.col("xmax"))
                      & (F.col("y") >= F.col("ymin")) & (F.col("y") <= F.col("ymax")))
               .select(pid, "x", "y", "band", area_col))
    e = (edges.where(F.col("y1") != F.col("y2"))
              .withColumn("band", F.explode(_cells(F.least("y1", "y2"), F.greatest("y1", "y2"), band))))
    hits = cand.join(e, [area_col, "band"])
    y, x = F.col("y"), F.col("x")
    straddle = (F.col("y1") > y) != (F.col("y2") > y)
    x_cross = F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    crossings = hits.where(straddle & (x < x_cross)).groupBy(pid, area_col).agg(F.count(F.lit(1)).alias("_n"))
    return crossings.where(F.col("_n") % 2 == 1).select(pid, area_col)


def first_owner(contained: DataFrame, pid: str = "pid", area_col: str = "area") -> DataFrame:
    """One owner per point: the lowest area code; ``n_hits`` counts all."""
    return contained.groupBy(pid).agg(F.min(area_col).alias(area_col), F.count(F.lit(1)).alias("n_hits"))


def segment_distance(px: Column, py: Column) -> Column:
    """Distance from (px, py) to the segment (x1, y1)–(x2, y2)."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    len2 = dx * dx + dy * dy
    t = F.when(len2 == 0, F.lit(0.0)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - F.col("x1")) * dx + (py - F.col("y1")) * dy) / len2)))
    qx, qy = F.col("x1") + t * dx, F.col("y1") + t * dy
    return F.sqrt((px - qx) * (px - qx) + (py - qy) * (py - qy))


def nearest_border(points: DataFrame, edges: DataFrame, max_dist: float,
                   pid: str = "pid", area_col: str = "area") -> DataFrame:
    """(pid, area, dist) of the nearest border segment nearer than ``max_dist``;
    ties to the lowest area code; points farther away are absent."""
    e = (edges.withColumn("cx", F.explode(_cells(F.least("x1", "x2") - max_dist,
                                                 F.greatest("x1", "x2") + max_dist, max_dist)))
              .withColumn("cy", F.explode(_cells(F.least("y1", "y2") - max_dist,
                                                 F.greatest("y1", "y2") + max_dist, max_dist))))
    p = points.select(pid, "x", "y", F.floor(F.col("x") / max_dist).cast("long").alias("cx"),
                      F.floor(F.col("y") / max_dist).cast("long").alias("cy"))
    d = p.join(e, ["cx", "cy"]).withColumn("dist", segment_distance(F.col("x"), F.col("y")))
    d = d.where(F.col("dist") < max_dist)
    best = F.min(F.struct("dist", F.col(area_col).alias("a"))).alias("_b")
    return d.groupBy(pid).agg(best).select(pid, F.col("_b.a").alias(area_col), F.col("_b.dist").alias("dist"))


def assign_points(points: DataFrame, edges: DataFrame, cell: float, band: float, max_dist: float,
                  pid: str = "pid", area_col: str = "area") -> DataFrame:
    """Containment first; points in no polygon fall back to the nearest
    border within ``max_dist``; the rest are dropped.  Columns: pid, area,
    method (contains | nearest), dist (NULL for contains), n_hits."""
    own = first_owner(points_in_polygons(points, edges, cell, band, pid, area_col), pid, area_col)
    rest = points.join(own.select(pid), pid, "left_anti")
    near = nearest_border(rest, edges, max_dist, pid, area_col)
    return (own.select(pid, area_col, F.lit("contains").alias("method"), F.lit(None).cast("double").alias("dist"),
                       "n_hits")
               .unionByName(near.select(pid, area_col, F.lit("nearest").alias("method"), "dist",
                                        F.lit(0).cast("long").alias("n_hits"))))


def line_lengths(segments: DataFrame, line_col: str = "line_id") -> DataFrame:
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    seg_len = F.sqrt(dx * dx + dy * dy)
    return segments.withColumn("seg_len", seg_len)


def line_midpoints(segments: DataFrame, line_col: str = "line_id",
                   order_col: str | Sequence[str] = "seg_no") -> DataFrame:
    """(line, length, mx, my): the point at half the total length walking the
    segments in order (of several columns for multi-part lines, such as part
    and number in the part); a zero-length line gives its first point."""
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    s = line_lengths(segments, line_col)
    w = Window.partitionBy(line_col).orderBy(*order)
    s = (s.withColumn("_before", F.coalesce(F.sum("seg_len").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                            F.lit(0.0)))
          .withColumn("length", F.sum("seg_len").over(Window.partitionBy(line_col))))
    half = F.col("length") / 2
    on_seg = (F.col("_before") <= half) & (half <= F.col("_before") + F.col("seg_len"))
    t = F.when(F.col("seg_len") > 0, (half - F.col("_before")) / F.col("seg_len")).otherwise(F.lit(0.0))
    cand = s.where(on_seg).select(line_col, "length", F.struct(*order).alias("_at"),
                                  (F.col("x1") + t * (F.col("x2") - F.col("x1"))).alias("mx"),
                                  (F.col("y1") + t * (F.col("y2") - F.col("y1"))).alias("my"))
    first = F.min(F.struct("_at", "mx", "my")).alias("_m")
    return cand.groupBy(line_col).agg(F.first("length").alias("length"), first).select(
        line_col, "length", F.col("_m.mx").alias("mx"), F.col("_m.my").alias("my"))


def vertex_array(order_cols: list[str], x: str, y: str) -> Column:
    """Aggregate: the line's vertices as an array of (x, y) sorted by
    ``order_cols`` (use inside ``groupBy(line).agg``).  A line's vertex
    count is bounded by its geometry, not by the data volume."""
    pts = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in order_cols],
                                               F.col(x).alias("x"), F.col(y).alias("y"))))
    return F.transform(pts, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))


def with_midpoint(df: DataFrame, pts_col: str) -> DataFrame:
    """Adds ``length``, ``mx``, ``my`` for a polyline given as an ordered
    vertex array, with array functions only: segments by ``zip_with``,
    running lengths by ``aggregate``, the half-length point by ``filter``.
    Each step is its own column so it is evaluated once per row.  A single
    vertex (zero length) gives that vertex."""
    pts = F.col(pts_col)
    n = F.size(pts)
    a = F.slice(pts, 1, F.greatest(n - 1, F.lit(1)))
    b = F.when(n > 1, F.slice(pts, 2, n - 1)).otherwise(F.slice(pts, 1, 1))
    segs = F.zip_with(a, b, lambda p, q: F.struct(
        p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"),
        F.sqrt((q["x"] - p["x"]) * (q["x"] - p["x"]) + (q["y"] - p["y"]) * (q["y"] - p["y"])).alias("len")))
    run = F.aggregate(F.col("_segs"), F.struct(F.lit(0.0).alias("s"), F.array().cast("array<double>").alias("b")),
                      lambda acc, s: F.struct((acc["s"] + s["len"]).alias("s"),
                                              F.concat(acc["b"], F.array(acc["s"])).alias("b")))
    half = F.col("length") / 2
    out = (df.withColumn("_segs", segs).withColumn("_run", run)
             .withColumn("length", F.col("_run.s"))
             .withColumn("_hit", F.element_at(F.filter(
                 F.zip_with("_segs", F.col("_run.b"), lambda s, bf: F.struct(s.alias("g"), bf.alias("bf"))),
                 lambda e: (e["bf"] <= half) & (half <= e["bf"] + e["g"]["len"])), 1)))
    g, bf = F.col("_hit.g"), F.col("_hit.bf")
    t = F.when(g["len"] > 0, (half - bf) / g["len"]).otherwise(F.lit(0.0))
    return (out.withColumn("_t", t)
               .withColumn("mx", g["x1"] + F.col("_t") * (g["x2"] - g["x1"]))
               .withColumn("my", g["y1"] + F.col("_t") * (g["y2"] - g["y1"]))
               .drop("_segs", "_run", "_hit", "_t"))


def area_traffic(sections: DataFrame, areas: DataFrame, area_col: str = "area") -> DataFrame:
    """Per area (all areas, 0 where no section): sections, road km,
    vehicle-km/day (all, heavy), max flow, measured share and flow-weighted
    measurement year (over the sections whose year is known), sections without flow.  ``sections``: area, length_m,
    adt, adt_heavy, measured (bool), year."""
    km = F.col("length_m") / 1000
    vkm = km * F.col("adt")
    agg = sections.groupBy(area_col).agg(
        F.count(F.lit(1)).alias("n_sections"), F.sum(km).alias("road_km"), F.sum(vkm).alias("vkm"),
        F.sum(km * F.col("adt_heavy")).alias("vkm_heavy"), F.max("adt").alias("max_adt"),
        F.sum(F.when(F.col("measured"), vkm)).alias("_vkm_measured"),
        F.sum(vkm * F.col("year")).alias("_vkm_year"),
        F.sum(F.when(F.col("year").isNotNull(), vkm)).alias("_vkm_dated"),
        F.count_if(F.col("adt").isNull()).alias("n_no_adt"))
    out = areas.select(area_col).join(agg, area_col, "left")
    tot = F.coalesce(F.col("vkm"), F.lit(0.0))
    return out.select(
        area_col,
        F.coalesce("n_sections", F.lit(0)).cast("long").alias("n_sections"),
        F.coalesce("road_km", F.lit(0.0)).alias("road_km"),
        tot.alias("vkm"),
        F.coalesce("vkm_heavy", F.lit(0.0)).alias("vkm_heavy"),
        F.coalesce("max_adt", F.lit(0.0)).alias("max_adt"),
        F.when(tot > 0, F.coalesce("_vkm_measured", F.lit(0.0)) / tot).otherwise(F.lit(0.0)).alias("measured_share"),
        F.when(F.col("_vkm_dated") > 0, F.col("_vkm_year") / F.col("_vkm_dated")).otherwise(F.lit(0.0)).alias("weighted_year"),
        F.coalesce("n_no_adt", F.lit(0)).cast("long").alias("n_no_adt"))
