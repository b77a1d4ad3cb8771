"""Profiling queries: latest snapshot, road-section profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewise.operators.shape import latest_snapshot
from sitewise.plans.q_spatial import _SECTIONS_SQL, sections
from sitewise.plans.registry import query
from sitewise.session import load

TOP_FLOWS = 5


@query("latest_snapshot", """
WITH e AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day FROM events)
SELECT CAST(day AS VARCHAR) AS day, event_type, COUNT(*) AS n_events, COUNT(DISTINCT user_id) AS n_users
FROM e WHERE day = (SELECT MAX(day) FROM e) GROUP BY 1, 2
""")
def latest_snapshot_q(spark, sf):
    """Events of the latest day only (filter by a scalar subquery)."""
    e = load(spark, sf, "events").select("event_type", "user_id", F.to_date("ts").alias("day"))
    last = latest_snapshot(e, "day")
    return last.groupBy(F.col("day").cast("string").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("user_id").alias("n_users"))


@query("section_profile", "WITH " + _SECTIONS_SQL + """
SELECT year, COUNT(*) AS n_sections, COUNT(*) FILTER (WHERE measured) AS n_measured,
       CAST(SUM(length_m) / 1000 AS DOUBLE) AS road_km,
       CAST(SUM(length_m) FILTER (WHERE measured) / 1000 AS DOUBLE) AS road_km_measured,
       MAX(adt) AS max_adt, COUNT(*) FILTER (WHERE length_m = 0) AS n_zero_length
FROM sec GROUP BY year
""")
def section_profile_q(spark, sf):
    """Road-section profile per measurement year: sections, measured share,
    road km, largest flow, zero-length sections."""
    s = sections(spark, sf)
    km = F.col("length_m") / 1000
    return s.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_sections"), F.count_if("measured").alias("n_measured"),
        F.sum(km).cast("double").alias("road_km"),
        F.sum(F.when(F.col("measured"), km)).cast("double").alias("road_km_measured"),
        F.max("adt").alias("max_adt"), F.count_if(F.col("length_m") == 0).alias("n_zero_length"))


@query("top_flows", "WITH " + _SECTIONS_SQL + f"""
SELECT line_id, adt, CAST(length_m AS DOUBLE) AS length_m FROM sec
ORDER BY adt DESC, line_id LIMIT {TOP_FLOWS}
""")
def top_flows_q(spark, sf):
    """The five sections with the largest flow (the limit is the report)."""
    s = sections(spark, sf)
    return (s.orderBy(F.desc("adt"), "line_id").limit(TOP_FLOWS)
             .select("line_id", "adt", F.col("length_m").cast("double").alias("length_m")))
