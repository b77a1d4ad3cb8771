"""Checks of an area layer and of a dated section layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewise.sources import wkb


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def ring_areas(segments: DataFrame) -> DataFrame:
    """(id, area): the outer rings less the holes.  A ring's area is half the
    sum of its edges' cross products, whatever way it runs; a ring that does
    not close is closed by its first point."""
    last = F.max(F.struct("seq", "x2", "y2"))
    first = F.min(F.struct("seq", "x1", "y1"))
    rings = segments.groupBy("id", "geom", "ring").agg(
        F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")).alias("twice"), first.alias("a"), last.alias("b"))
    closed = F.col("twice") + F.col("b.x2") * F.col("a.y1") - F.col("a.x1") * F.col("b.y2")
    part = F.when(F.col("ring") == 0, F.abs(closed)).otherwise(-F.abs(closed)) / 2
    return rings.groupBy("id").agg(F.sum(part).alias("area"))


def layer_areas(layer: DataFrame, code: str, geometry: str) -> DataFrame:
    """code, geometry_type, is_empty, n_rings, area of every row's geometry; rows that repeat a code add up."""
    shapes = layer.select(F.monotonically_increasing_id().alias("id"), F.col(code).alias("code"), F.col(geometry).alias("blob"))
    segs = wkb.segments(shapes, "id", "blob")
    return wkb.infos(shapes, "id", "blob").join(ring_areas(segs), "id", "left").join(shapes.select("id", "code"), "id")


def area_layer(areas: DataFrame, parents: DataFrame, code: str, parent: str, geometry: str, parent_area: str = "area") -> DataFrame:
    """One row per parent code (NULL: areas without one), from the areas and
    the parents' published sizes: n_areas, n_codes (distinct), n_blank_codes,
    n_prefix (codes that do not begin with their parent's), n_empty,
    n_not_polygon, geometry_types by name, area_sum, parent_area, coverage
    (area_sum over parent_area) and ``known``, whether the parent exists.
    A parent without areas has a row with zeros."""
    g = layer_areas(areas.withColumn("_code", F.struct(F.col(code).alias("c"), F.when(~blank(F.col(parent)), F.col(parent)).alias("p"))), "_code", geometry)
    c, p = F.col("code.c"), F.col("code.p")
    per = g.groupBy(p.alias("_p")).agg(
        F.count(F.lit(1)).alias("n_areas"), F.count_distinct(F.when(~blank(c), c)).alias("n_codes"), F.count_if(blank(c)).alias("n_blank_codes"),
        F.count_if(~blank(c) & p.isNotNull() & ~F.startswith(c, p)).alias("n_prefix"), F.count_if(F.col("is_empty")).alias("n_empty"),
        F.count_if(~F.coalesce(F.col("geometry_type").isin("Polygon", "MultiPolygon"), F.lit(False))).alias("n_not_polygon"),
        F.concat_ws("|", F.array_sort(F.collect_set("geometry_type"))).alias("geometry_types"), F.sum("area").alias("area_sum"))
    sizes = parents.select(F.col(parent).alias("_q"), F.col(parent_area).alias("parent_area"))
    out = per.join(sizes, F.col("_p") == F.col("_q"), "full")
    counts = ["n_areas", "n_codes", "n_blank_codes", "n_prefix", "n_empty", "n_not_polygon"]
    out = out.fillna(0, counts).fillna("", ["geometry_types"]).fillna(0.0, ["area_sum"])
    return out.select(F.coalesce("_q", "_p").alias(parent), *counts, "geometry_types", "area_sum", "parent_area",
                      F.try_divide("area_sum", "parent_area").alias("coverage"), F.col("_q").isNotNull().alias("known"))


def validity_sweep(rows: DataFrame, keys: Sequence[str], valid_from: str, valid_to: str, as_of: Column, bucket: Column) -> DataFrame:
    """One row per key: n_rows, n_current (rows valid at ``as_of``),
    max_overlap (the most rows valid at once), overlap_days (days on which
    more than one was), n_open (no end) and n_empty (rows that end before
    they begin; never valid).

    A row is valid on [from, to), without end if ``to`` is NULL.  Every row is
    two events, +1 and -1; equal days collapse to one event a key and day, and
    the running sum over a key is the number of valid rows.  Keys are swept in
    time slices (``bucket`` over the column ``day``, non-decreasing in it),
    with the sums of whole slices carried over, so that a key with very many
    rows is not one task.
    """
    k = list(keys)
    ok = F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from))
    live = ok & F.col(valid_from).isNotNull()
    base = rows.groupBy(*k).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(live & (F.col(valid_from) <= as_of) & (F.col(valid_to).isNull() | (F.col(valid_to) > as_of))).alias("n_current"),
        F.count_if(live & F.col(valid_to).isNull()).alias("n_open"), F.count_if(~F.coalesce(live, F.lit(False))).alias("n_empty"))
    events = rows.where(live).select(*k, F.explode(F.array(
        F.struct(F.col(valid_from).alias("day"), F.lit(1).alias("d")), F.struct(F.col(valid_to).alias("day"), F.lit(-1).alias("d")))).alias("e")).select(*k, "e.*")
    events = events.where("day IS NOT NULL").groupBy(*k, "day").agg(F.sum("d").alias("d")).withColumn("_b", bucket)
    slices = events.groupBy(*k, "_b").agg(F.sum("d").alias("_s"), F.min("day").alias("_first"))
    over = Window.partitionBy(*k).orderBy("_b")
    slices = slices.select(*k, "_b", F.coalesce(F.sum("_s").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.lead("_first").over(over).alias("_next_slice"))
    inside = Window.partitionBy(*k, "_b").orderBy("day")
    swept = events.withColumn("_run", F.sum("d").over(inside)).withColumn("_next", F.lead("day").over(inside)).join(slices, [*k, "_b"])
    n = F.col("_before") + F.col("_run")
    days = F.date_diff(F.coalesce("_next", "_next_slice"), F.col("day"))
    found = swept.groupBy(*k).agg(F.max(n).alias("max_overlap"), F.sum(F.when(n > 1, days).otherwise(0)).alias("overlap_days"))
    out = base.join(found, k, "left").fillna(0, ["max_overlap", "overlap_days"])
    return out.select(*k, *[F.col(c).cast("long").alias(c) for c in ("n_rows", "n_current", "max_overlap", "overlap_days", "n_open", "n_empty")])


def conform(units: DataFrame, key: str, sources: Sequence[tuple[str, DataFrame, str]], fields: Sequence[str]) -> DataFrame:
    """Every unit with ``fields`` taken from an ordered chain of overrides.

    ``sources``: (name, table, join column) from the strongest to the weakest;
    the join column is one of ``units`` and of the table, which has one row a
    value (the newest by ``_ingested_at`` if it has that column).  A field
    comes from the first source that has it, neither NULL nor blank;
    ``<field>_from`` names that source, and ``level`` the strongest source
    that knows the unit at all.
    """
    out = units
    for name, table, on in sources:
        stamp = F.col("_ingested_at") if "_ingested_at" in table.columns else F.lit(0)
        newest = table.groupBy(on).agg(F.max_by(F.struct(*[F.col(f) if f in table.columns else F.lit(None).cast("string").alias(f) for f in fields]), stamp).alias(f"_{name}"))
        out = out.join(newest, on, "left")
    names = [name for name, *_ in sources]

    def usable(name: str, f: str) -> Column:
        v = F.col(f"_{name}.{f}")
        return F.when(F.trim(v.cast("string")) != "", v)

    picked = []
    for f in fields:
        source = F.coalesce(*[F.when(usable(n, f).isNotNull(), F.lit(n)) for n in names])
        picked += [F.coalesce(*[usable(n, f) for n in names]).alias(f), source.alias(f"{f}_from")]
    level = F.coalesce(*[F.when(F.col(f"_{n}").isNotNull(), F.lit(n)) for n in names])
    return out.select(*units.columns, *picked, level.alias("level"))


# Spellings of yes and no in hand-kept tables (fixed values).
YES, NO = ("true", "1", "yes", "ja", "y", "j"), ("false", "0", "no", "nej", "n", "")


def said_yes(c: Column) -> Column:
    """True or false by the spellings above, false for NULL, NULL for anything else."""
    word = F.lower(F.trim(c))
    return F.when(word.isin(*YES), True).when(word.isin(*NO) | c.isNull(), False)


def split_zones(dim: DataFrame, zone: str, second: str, flag: str, zones: Sequence[str]) -> DataFrame:
    """``dim`` with is_split, the second zone (blank: none) and ``broken``,
    why a row contradicts itself: unknown_zone, unknown_flag,
    split_without_second (or with the same or an unknown one) or
    second_without_split."""
    known = list(zones)
    two = F.when(F.trim(F.col(second)) != "", F.col(second))
    split = said_yes(F.col(flag))
    broken = (F.when(~F.coalesce(F.col(zone).isin(*known), F.lit(False)), "unknown_zone").when(split.isNull(), "unknown_flag")
              .when(split & ~F.coalesce(two.isin(*known) & (two != F.col(zone)), F.lit(False)), "split_without_second")
              .when(~split & two.isNotNull(), "second_without_split"))
    return dim.withColumn("is_split", split).withColumn("broken", broken).withColumn(second, two)
