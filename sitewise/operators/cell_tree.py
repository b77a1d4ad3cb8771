"""Point in polygon over an adaptive tree of cells, for points that crowd.

A fixed grid gives a task as many points as its cell holds; a town that holds
most points is then most of the job.  Here the points are counted first, and
a cell with more than ``max_points`` is split into four, down to ``depth``
levels; a cell of the last level that is still too full is dealt out to
several salts.  Edges go to the leaves whose points they can decide (same
band of y, not all to the left), so points and edges meet on (leaf, salt),
whose load is bounded by the measured counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.operators.spatial import area_boxes
from sitewise.session import materialize

BROADCAST_LEAVES = 200_000  # rows of five numbers


@dataclass(frozen=True)
class CellTree:
    """Leaves (level, cx, cy, n, salts) of a square at (x0, y0)."""

    leaves: DataFrame
    x0: float
    y0: float
    side: float
    levels: tuple[int, ...]
    n_leaves: int

    def cell(self, v: str, low: float, level: int) -> Column:
        """Cell number of a coordinate at a level; the last cell holds the far border."""
        many = 1 << level
        return F.least(F.floor((F.col(v) - F.lit(low)) * many / self.side).cast("long"), F.lit(many - 1).cast("long"))

    def small(self) -> DataFrame:
        """The leaves, broadcast if they are as few as measured."""
        return F.broadcast(self.leaves) if self.n_leaves <= BROADCAST_LEAVES else self.leaves

    def located(self, points: DataFrame, pid: str) -> DataFrame:
        """(pid, x, y, level, cx, cy, salt) of every point."""
        at = F.explode(F.array(*[F.struct(F.lit(lv).alias("level"), self.cell("x", self.x0, lv).alias("cx"), self.cell("y", self.y0, lv).alias("cy")) for lv in self.levels]))
        rows = points.where("x IS NOT NULL AND y IS NOT NULL").select(pid, "x", "y", at.alias("at")).select(pid, "x", "y", "at.*")
        rows = rows.join(self.small(), ["level", "cx", "cy"])
        return rows.select(pid, "x", "y", "level", "cx", "cy", F.pmod(F.xxhash64(pid), F.col("salts")).alias("salt"))


def cell_tree(points: DataFrame, max_points: int, depth: int = 10) -> CellTree | None:
    """The tree for ``points`` (x, y); None where there are no points."""
    low = points.agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1")).first()
    if low.x0 is None or low.y0 is None:
        return None
    side = max(low.x1 - low.x0, low.y1 - low.y0) or 1.0
    draft = CellTree(points, low.x0, low.y0, side, (depth,), 0)
    fine = points.where("x IS NOT NULL AND y IS NOT NULL").groupBy(draft.cell("x", low.x0, depth).alias("fx"), draft.cell("y", low.y0, depth).alias("fy")).agg(F.count(F.lit(1)).alias("n"))
    every = F.explode(F.sequence(F.lit(0), F.lit(depth)))
    up = lambda c: F.expr(f"shiftright({c}, {depth} - level)")
    cells = fine.withColumn("level", every).groupBy("level", up("fx").alias("cx"), up("fy").alias("cy")).agg(F.sum("n").alias("n"))
    cells = materialize(cells)
    parents = cells.where(F.col("n") > max_points).select((F.col("level") + 1).alias("level"), F.col("cx").alias("px"), F.col("cy").alias("py"))
    nodes = cells.withColumn("px", F.expr("shiftright(cx, 1)")).withColumn("py", F.expr("shiftright(cy, 1)"))
    nodes = nodes.where("level = 0").unionByName(nodes.where("level > 0").join(parents, ["level", "px", "py"], "left_semi"))
    leaves = nodes.where((F.col("n") <= max_points) | (F.col("level") == depth))
    leaves = materialize(leaves.select("level", "cx", "cy", "n", F.ceil(F.col("n") / max_points).cast("long").alias("salts")))
    levels = tuple(sorted(r.level for r in leaves.select("level").distinct().collect()))  # at most depth + 1
    return CellTree(leaves, low.x0, low.y0, side, levels, leaves.count())


def _span(low: Column, high: Column, size: float) -> Column:
    return F.sequence(F.floor(low / size).cast("long"), F.floor(high / size).cast("long"))


def leaf_edges(tree: CellTree, edges: DataFrame, cell: float, area_col: str = "area") -> DataFrame:
    """(level, cx, cy, salt, area, x1, y1, x2, y2): for each leaf the edges
    that a ray to the right from one of its points can cross.  ``cell`` is
    near the size of an area; areas and leaves are matched on such cells."""
    size = F.lit(tree.side) / F.expr("shiftleft(1L, level)")
    lo = lambda c, zero: F.lit(zero) + F.col(c) * size
    boxed = tree.leaves.select("level", "cx", "cy", "salts", lo("cx", tree.x0).alias("lx"), (lo("cx", tree.x0) + size).alias("hx"), lo("cy", tree.y0).alias("ly"), (lo("cy", tree.y0) + size).alias("hy"))
    near = boxed.withColumn("gx", F.explode(_span(F.col("lx"), F.col("hx"), cell))).withColumn("gy", F.explode(_span(F.col("ly"), F.col("hy"), cell)))
    areas = area_boxes(edges, area_col).withColumn("gx", F.explode(_span(F.col("xmin"), F.col("xmax"), cell))).withColumn("gy", F.explode(_span(F.col("ymin"), F.col("ymax"), cell)))
    pairs = areas.join(near, ["gx", "gy"]).where("xmin <= hx AND xmax >= lx AND ymin <= hy AND ymax >= ly")
    pairs = pairs.select(area_col, "level", "cx", "cy", "salts", "lx", "ly", "hy").distinct()
    out = edges.where("y1 <> y2").join(pairs, area_col).where((F.least("y1", "y2") <= F.col("hy")) & (F.greatest("y1", "y2") >= F.col("ly")) & (F.greatest("x1", "x2") >= F.col("lx")))
    return out.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).select("level", "cx", "cy", "salt", area_col, "x1", "y1", "x2", "y2")


def balanced_load(points: DataFrame) -> int:
    """Points a leaf so that a task of the session's shuffles gets about eight leaves."""
    n = points.count()
    return max(1, math.ceil(n / (8 * int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))))


def points_in_polygons_balanced(points: DataFrame, edges: DataFrame, cell: float, max_points: int | None = None, depth: int = 10,
                                pid: str = "pid", area_col: str = "area") -> DataFrame:
    """(pid, area) for every area whose polygon contains the point, as
    :func:`sitewise.operators.spatial.points_in_polygons`, with tasks of
    bounded load wherever the points crowd."""
    tree = cell_tree(points, max_points or balanced_load(points), depth)
    if tree is None:
        return points.select(pid).limit(0).join(edges.select(area_col).limit(0), F.lit(False))
    key = ["level", "cx", "cy", "salt"]
    hits = tree.located(points, pid).join(leaf_edges(tree, edges, cell, area_col), key)
    x, y = F.col("x"), F.col("y")
    cross = F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    hits = hits.where(((F.col("y1") > y) != (F.col("y2") > y)) & (x < cross))
    odd = hits.groupBy(pid, area_col).agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1")
    return odd.select(pid, area_col)
