"""What a column of JSON documents holds, path by path.

Documents become VARIANTs and are taken apart level by level inside one scan:
every object and array is exploded into its members beside itself, to the
depth asked for.  Array positions collapse to ``[]``; objects whose keys are
data (ids, codes) collapse to ``{}`` where the caller names their path.

The profile is built from a table of partials (path, type, digest of the
value, counts).  Partials of two batches are merged by adding them up, so a
growing landing zone is profiled without reading it again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.sources.rescue import found_type

PARTIAL_KEYS = ["path", "type", "digest"]


class DeeperThanAsked(Exception):
    """Documents nest deeper than the profile was told to look."""


def nodes(df: DataFrame, json_col: str, depth: int = 6, maps: Sequence[str] = ()) -> DataFrame:
    """One row per value of any kind in any document: doc (a running number
    that tells documents apart), path, v and ``open``, set on containers
    below the depth that were not taken apart."""
    rows = df.select(F.monotonically_increasing_id().alias("doc"), F.lit("$").alias("path"), F.try_parse_json(F.col(json_col)).alias("v"), F.lit(True).alias("open"))
    rows = rows.where("v IS NOT NULL")
    collapsed = F.array(*[F.lit(m) for m in maps]).cast("array<string>")
    for _ in range(depth):
        path = F.col("path")
        key = lambda e: F.when(F.array_contains(collapsed, path), F.lit("{}")).otherwise(F.concat(F.lit("."), e["key"]))  # noqa: E731, B023
        members = F.coalesce(
            F.transform(F.map_entries(F.try_variant_get("v", "$", "map<string,variant>")), lambda e: F.struct(F.concat(path, key(e)).alias("path"), e["value"].alias("v"), F.lit(True).alias("open"))),  # noqa: B023
            F.transform(F.try_variant_get("v", "$", "array<variant>"), lambda x: F.struct(F.concat(path, F.lit("[]")).alias("path"), x.alias("v"), F.lit(True).alias("open"))),  # noqa: B023
            F.array().cast("array<struct<path:string,v:variant,open:boolean>>"))
        own = F.array(F.struct(path.alias("path"), F.col("v").alias("v"), F.lit(False).alias("open")))
        rows = rows.select("doc", F.explode(F.when(F.col("open"), F.concat(own, members)).otherwise(own)).alias("n")).select("doc", "n.*")
    return rows


def partials(df: DataFrame, json_col: str, depth: int = 6, maps: Sequence[str] = ()) -> DataFrame:
    """path, type, digest, n, n_filled, too_deep: add them up to merge.  The
    digest is that of a leaf's text; containers have none."""
    rows = nodes(df, json_col, depth, maps).withColumn("type", found_type(F.col("v")))
    leaf = ~F.col("type").isin("OBJECT", "ARRAY", "VOID")
    text = F.col("v").cast("string")
    filled = F.when(F.col("type") == "VOID", False).when(leaf, F.trim(F.when(leaf, text)) != "").otherwise(True)
    size = F.coalesce(F.size(F.try_variant_get("v", "$", "map<string,variant>")), F.size(F.try_variant_get("v", "$", "array<variant>")))
    deep = F.col("open") & ~leaf & (F.col("type") != "VOID") & (size > 0)
    return rows.groupBy("path", "type", F.when(leaf, F.md5(F.when(leaf, text))).alias("digest")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(filled).alias("n_filled"), F.count_if(deep).alias("too_deep"))


def merge(*parts: DataFrame) -> DataFrame:
    """The partials of several tables of documents as those of all of them."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(*PARTIAL_KEYS).agg(*[F.sum(c).alias(c) for c in ("n", "n_filled", "too_deep")])


def profile(parts: DataFrame) -> DataFrame:
    """One row per path: n (values), n_filled (neither null nor blank),
    n_distinct (distinct leaf values), types as ``TYPE:count`` by name, and
    too_deep, the containers whose members were not looked at."""
    by_type = parts.groupBy("path", "type").agg(
        F.sum("n").alias("n"), F.sum("n_filled").alias("n_filled"), F.count("digest").alias("n_distinct"), F.sum("too_deep").alias("too_deep"))
    return by_type.groupBy("path").agg(
        F.sum("n").cast("long").alias("n"), F.sum("n_filled").cast("long").alias("n_filled"), F.sum("n_distinct").cast("long").alias("n_distinct"),
        F.concat_ws("|", F.array_sort(F.collect_list(F.concat("type", F.lit(":"), F.col("n").cast("string"))))).alias("types"),
        F.sum("too_deep").cast("long").alias("too_deep"))


def nested_attributes(spark: SparkSession, df: DataFrame, json_col: str, field: str, keep: Sequence[str]) -> DataFrame:
    """A map of maps inside each document, ``{"<group>": {"<code>": value}}``
    below ``field``: one row per (document, group, code) with the value as a
    VARIANT.  A group that is not an object (an empty one is written as a
    list by some sources) has no rows."""
    cols = ", ".join(f"d.`{c}`" for c in keep)
    return spark.sql(
        f"SELECT {cols}, g.key AS `group`, a.key AS code, a.value AS value FROM {{d}} AS d,"
        f" LATERAL variant_explode(try_variant_get(try_parse_json(d.`{json_col}`), '$.{field}', 'variant')) AS g,"
        " LATERAL variant_explode(g.value) AS a WHERE g.key IS NOT NULL AND a.key IS NOT NULL", d=df)
