"""Check and dimension queries: retired codes, hierarchy gaps, set
differences, code decoding, missing-file plans, markers, enrichment."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from sitewise.operators.checks import (decode_codes, hierarchy_gap, in_box, retired_code_check,
                                       set_difference)
from sitewise.operators.ranking import midrank_percentile
from sitewise.operators.shape import calendar_dim
from sitewise.plans.q_ranking import customers_and_suppliers
from sitewise.plans.q_spatial import (_GEOM_SQL, _SECTIONS_SQL, _assign_sql, _traffic, customer_points,
                                      tile_edges)
from sitewise.plans.registry import query
from sitewise.session import load, materialize, scratch_path
from sitewise.sources.files import missing_file_plan
from sitewise.streaming.ingest import json_stream, land_files

# Codes treated as retired in the check, and the code tables.
RETIRED_TYPES = ["error", "signup"]
PRIORITY_NAMES = {
    "1-URGENT": ("urgent", 1), "2-HIGH": ("high", 2), "3-MEDIUM": ("medium", 3),
    "4-NOT SPECIFIED": ("not specified", 4), "5-LOW": ("low", 5),
}
FLAG_NAMES = [("A", "accepted"), ("F", "finished"), ("N", "none"), ("O", "open"), ("P", "pending"),
              ("R", "returned")]
BOX = (-500.0, 5500.0, -500.0, 5500.0)
SPOT_UNITS = [0, 24]


@query("retired_code_check", """
WITH cell AS (SELECT event_type, CASE WHEN value IS NULL THEN 'null' WHEN value = 0 THEN 'zero' WHEN value > 0 THEN 'positive' ELSE 'negative' END AS kind
              FROM events WHERE event_type = ANY(['error', 'signup'])),
wide AS (SELECT event_type, histogram(kind) AS h, count(*) AS n FROM cell GROUP BY event_type)
SELECT event_type, n AS n_cells, CAST(coalesce(h['zero'], 0) AS BIGINT) AS n_zero, CAST(coalesce(h['null'], 0) AS BIGINT) AS n_null,
       CAST(coalesce(h['positive'], 0) AS BIGINT) AS n_positive, CAST(coalesce(h['null'], 0) AS BIGINT) AS n_null_unmarked,
       h['positive'] IS NULL AND h['null'] IS NULL AS holds_nothing
FROM wide
""")
def retired_code_check_q(spark, sf):
    """Event types treated as retired codes must hold nothing."""
    return retired_code_check(load(spark, sf, "events"), "event_type", RETIRED_TYPES, "value")


@query("hierarchy_gap", """
WITH c AS (SELECT c.c_nationkey AS nation, n.n_regionkey AS region, CAST(c.c_acctbal AS DECIMAL(18,2)) AS v
           FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey),
t AS (SELECT SUM(v) AS total FROM c),
r AS (SELECT 'region' AS level, COUNT(*) AS n_groups, SUM(s) AS sum_groups
      FROM (SELECT region, SUM(v) AS s FROM c GROUP BY region)),
n AS (SELECT 'nation' AS level, COUNT(*) AS n_groups, SUM(s) AS sum_groups
      FROM (SELECT nation, SUM(v) AS s FROM c GROUP BY nation))
SELECT level, n_groups, CAST(sum_groups AS DOUBLE) AS sum_groups, CAST(total AS DOUBLE) AS total,
       CAST(sum_groups - total AS DOUBLE) AS gap
FROM (SELECT * FROM r UNION ALL SELECT * FROM n), t
""")
def hierarchy_gap_q(spark, sf):
    """Customer balances: grand total vs the sum over regions and nations."""
    c = load(spark, sf, "customer").join(load(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.select(F.col("c_nationkey").alias("nation"), F.col("n_regionkey").alias("region"),
                 F.col("c_acctbal").cast("decimal(18,2)").alias("v"))
    g = hierarchy_gap(c, F.col("v"), {"region": ["region"], "nation": ["nation"]})
    return g.select("level", "n_groups", F.col("sum_groups").cast("double").alias("sum_groups"),
                    F.col("total").cast("double").alias("total"), F.col("gap").cast("double").alias("gap"))


@query("used_codes_dim", """
WITH used AS (SELECT l_returnflag AS code FROM lineitem UNION SELECT l_linestatus FROM lineitem
              UNION SELECT o_orderstatus FROM orders),
names AS (SELECT * FROM (VALUES ('A', 'accepted'), ('F', 'finished'), ('N', 'none'), ('O', 'open'),
                                ('P', 'pending'), ('R', 'returned')) t(code, code_name))
SELECT u.code, n.code_name, n.code_name IS NOT NULL AS named FROM used u LEFT JOIN names n USING (code)
""")
def used_codes_dim_q(spark, sf):
    """Code dimension from every code used anywhere (UNION distinct), named
    from a fixed list; unnamed codes are flagged."""
    li = load(spark, sf, "lineitem")
    used = (li.select(F.col("l_returnflag").alias("code"))
            .union(li.select(F.col("l_linestatus").alias("code")))
            .union(load(spark, sf, "orders").select(F.col("o_orderstatus").alias("code")))
            .distinct())
    names = spark.createDataFrame(FLAG_NAMES, "code string, code_name string")
    return used.join(names, "code", "left").select("code", "code_name",
                                                   F.col("code_name").isNotNull().alias("named"))


@query("key_set_diff", """
WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey IS NOT NULL),
b AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey IS NOT NULL)
SELECT 'only_in_orders' AS side, COUNT(*) AS n_keys FROM a WHERE k NOT IN (SELECT k FROM b)
UNION ALL
SELECT 'only_in_customer', COUNT(*) FROM b WHERE k NOT IN (SELECT k FROM a)
""")
def key_set_diff_q(spark, sf):
    """Customer keys referenced by orders vs the customer table, both ways."""
    return set_difference(load(spark, sf, "orders"), load(spark, sf, "customer"), "o_custkey", "c_custkey",
                          "orders", "customer")


@query("priority_decode", """
WITH m AS (SELECT * FROM (VALUES ('1-URGENT', 'urgent', 1), ('2-HIGH', 'high', 2), ('3-MEDIUM', 'medium', 3),
                                 ('4-NOT SPECIFIED', 'not specified', 4), ('5-LOW', 'low', 5))
           t(code, priority_name, priority_rank))
SELECT m.priority_name, CAST(m.priority_rank AS BIGINT) AS priority_rank, COUNT(*) AS n_orders
FROM orders o LEFT JOIN m ON m.code = o.o_orderpriority GROUP BY 1, 2
""")
def priority_decode_q(spark, sf):
    """Order-priority codes decoded to name and rank by a literal map."""
    d = decode_codes(F.col("o_orderpriority"), PRIORITY_NAMES)
    o = load(spark, sf, "orders").select(d["f0"].alias("priority_name"), d["f1"].cast("long").alias("priority_rank"))
    return o.groupBy("priority_name", "priority_rank").agg(F.count(F.lit(1)).alias("n_orders"))


@query("missing_file_plan", """
WITH ev AS (SELECT event_type, CAST(ts AS DATE) AS day FROM events),
b AS (SELECT CAST(date_trunc('month', MIN(day)) AS DATE) AS d0,
             CAST(date_trunc('month', MAX(day)) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS d1,
             MAX(day) AS last_day FROM ev),
exp AS (SELECT t.event_type, CAST(d AS DATE) AS day
        FROM (SELECT DISTINCT event_type FROM ev) t,
             (SELECT unnest(generate_series(d0, d1, INTERVAL 1 DAY)) AS d FROM b)),
miss AS (SELECT * FROM exp WHERE (event_type, day) NOT IN (SELECT event_type, day FROM ev))
SELECT event_type, CAST(day AS VARCHAR) AS day, CASE WHEN day < (SELECT last_day FROM b) THEN 'warning'
       ELSE 'normal' END AS severity
FROM miss
""")
def missing_file_plan_q(spark, sf):
    """Every (event type, day) of the data's whole months without events:
    a past gap is a warning, days after the last delivery are normal."""
    ev = load(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"))
    b = ev.agg(F.trunc(F.min("day"), "MM").alias("d0"), F.last_day(F.max("day")).alias("d1"),
               F.max("day").alias("last"))
    types = ev.select("event_type").distinct()
    expected = types.withColumn("day", F.explode(calendar_dim(b.select("d0").scalar(), b.select("d1").scalar())))
    plan = missing_file_plan(expected, ev, ["event_type"], "day", b.select("last").scalar())
    return plan.select("event_type", F.col("day").cast("string").alias("day"), "severity")


@query("marker_semi", """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events),
m AS (SELECT DISTINCT user_id, day FROM e WHERE event_type = 'purchase')
SELECT CAST(e.day AS VARCHAR) AS day, COUNT(*) AS n_events, COUNT(DISTINCT e.user_id) AS n_users
FROM e WHERE (e.user_id, e.day) IN (SELECT user_id, day FROM m) GROUP BY 1
""")
def marker_semi_q(spark, sf):
    """Keep a user-day only if its marker (a purchase) exists — a left
    semi join, like keeping a snapshot folder only once its dump landed."""
    e = load(spark, sf, "events").select("user_id", F.to_date("ts").alias("day"), "event_type")
    m = e.where(F.col("event_type") == "purchase").select("user_id", "day")
    kept = e.join(m, ["user_id", "day"], "left_semi")
    return kept.groupBy(F.col("day").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("n_events"), F.count_distinct("user_id").alias("n_users"))


LINE_SCHEMA = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
               "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
               "l_linestatus string, l_shipdate timestamp_ntz")
LINES_PER_FILE = 500_000


@query("stream_enrich", """
SELECT o.o_orderstatus, l.l_returnflag, COUNT(*) AS n_lines, CAST(SUM(l.l_quantity) AS DOUBLE) AS qty
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2
""")
def stream_enrich_q(spark, sf):
    """Line items arriving as a file stream, enriched by a stream–static
    left join with orders, aggregated per micro-batch and summed.  Files
    land compressed, in two micro-batches whatever their number."""
    base = scratch_path(spark, "stream-enrich")
    lines = load(spark, sf, "lineitem")
    per_batch = max(4, math.ceil(lines.count() / (2 * LINES_PER_FILE)))
    land_files(lines, f"{base}/landing", 2 * per_batch, compression="gzip")
    schema = spark.createDataFrame([], LINE_SCHEMA).schema
    orders = load(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    s = json_stream(spark, f"{base}/landing", schema, max_files_per_trigger=per_batch)
    s = s.select("l_orderkey", "l_returnflag", "l_quantity").join(orders, "l_orderkey", "left").drop("l_orderkey")

    def write(batch, batch_id):
        (batch.groupBy("o_orderstatus", "l_returnflag")
              .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"))
              .write.mode("overwrite").parquet(f"{base}/agg/batch_id={batch_id}"))

    q = (s.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/_ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    a = spark.read.parquet(f"{base}/agg")
    return a.groupBy("o_orderstatus", "l_returnflag").agg(
        F.sum("n_lines").alias("n_lines"), F.sum("qty").cast("double").alias("qty"))


@query("point_validity", """
SELECT COUNT(*) AS n_points,
       COUNT(*) FILTER (WHERE COALESCE(CAST((c_custkey * 7919) % 10000 - 2500 AS DOUBLE) BETWEEN -500 AND 5500
                                       AND CAST((c_custkey * 104729) % 10000 - 2500 AS DOUBLE) BETWEEN -500 AND 5500,
                                       false)) AS n_inside_box
FROM customer
""")
def point_validity_q(spark, sf):
    """Customer points inside the valid bounding box."""
    p = customer_points(spark, sf)
    return p.agg(F.count(F.lit(1)).alias("n_points"),
                 F.count_if(in_box(F.col("x"), F.col("y"), *BOX)).alias("n_inside_box"))


_TM_SQL = """
j AS (SELECT s.*, a.area FROM sec s JOIN assigned a ON a.pid = s.line_id),
per AS (SELECT area, SUM(CAST(length_m AS DOUBLE) / 1000) AS road_km,
               SUM(CAST(length_m AS DOUBLE) / 1000 * adt) AS vkm FROM j GROUP BY area),
cu AS (SELECT c_nationkey AS area, COUNT(*) AS n_cust FROM customer GROUP BY 1),
su AS (SELECT s_nationkey AS area, COUNT(*) AS n_supp FROM supplier GROUP BY 1),
tm AS (SELECT t.area, COALESCE(per.road_km, 0.0) AS road_km, ROUND(COALESCE(per.vkm, 0.0), 3) AS vkm,
              COALESCE(cu.n_cust, 0) AS n_cust, COALESCE(su.n_supp, 0) AS n_supp
       FROM t LEFT JOIN per USING (area) LEFT JOIN cu ON cu.area = t.area LEFT JOIN su ON su.area = t.area)
"""


def _traffic_metrics(spark, sf):
    _, j = _traffic(spark, sf)
    km = F.col("length_m").cast("double") / 1000
    per = j.groupBy("area").agg(F.sum(km).alias("road_km"), F.sum(km * F.col("adt")).alias("vkm"))
    u = customers_and_suppliers(spark, sf).select(F.col("unit").alias("area"), "n_cust", "n_supp")
    areas = tile_edges(spark, sf).select("area").distinct()
    t = areas.join(per, "area", "left").join(u, "area", "left").fillna(0.0, ["road_km", "vkm"])
    return materialize(t)


@query("traffic_metrics", "WITH " + _GEOM_SQL + "," + _SECTIONS_SQL + "," + _assign_sql(
    "p AS (SELECT line_id AS pid, x, y FROM sec)") + "," + _TM_SQL + """,
long AS (
  SELECT area AS unit, 'supply_traffic' AS metric, 'lower' AS better,
         ROUND(CASE WHEN vkm > 0 THEN n_supp / (vkm / 1000) ELSE CAST('Infinity' AS DOUBLE) END, 6) AS value FROM tm
  UNION ALL SELECT area, 'through_traffic', 'higher', ROUND(CASE WHEN n_cust <> 0 THEN vkm / n_cust END, 6) FROM tm
  UNION ALL SELECT area, 'traffic_intensity', 'higher',
         ROUND(CASE WHEN road_km > 0 THEN vkm / ROUND(road_km, 3) ELSE 0.0 END, 6) FROM tm),
k AS (SELECT metric, list(value) FILTER (WHERE value IS NOT NULL) AS vs FROM long GROUP BY metric)
SELECT unit, long.metric, better, value, CASE WHEN value IS NULL THEN NULL WHEN len(vs) = 1 THEN 0.5 ELSE
  (len(list_filter(vs, lambda v: if(better = 'higher', v < value, v > value))) * 2 + len(list_filter(vs, lambda v: v = value)) - 1) / CAST(2 * len(vs) - 2 AS DOUBLE) END AS pct_rank
FROM long JOIN k ON k.metric = long.metric
""")
def traffic_metrics_q(spark, sf):
    """Supply per traffic (+∞ when a tile has no road: treated as fully
    served, ranks worst), through-traffic per customer and traffic
    intensity per nation tile, with midrank positions."""
    t = _traffic_metrics(spark, sf)
    vkm = F.round(F.col("vkm"), 3)
    metrics = [
        ("supply_traffic", "lower", F.when(vkm > 0, F.col("n_supp") / (vkm / 1000)).otherwise(F.lit(float("inf")))),
        ("through_traffic", "higher", F.try_divide(vkm, F.col("n_cust").cast("double"))),
        ("traffic_intensity", "higher", F.when(F.col("road_km") > 0, vkm / F.round("road_km", 3)).otherwise(0.0)),
    ]
    long = None
    for name, better, v in metrics:
        part = t.select(F.col("area").alias("unit"), F.lit(name).alias("metric"), F.lit(better).alias("better"),
                        F.round(v, 6).alias("value"))
        long = part if long is None else long.unionByName(part)
    return midrank_percentile(long, ["metric"], "value", better_col="better")


@query("intensity_top", "WITH " + _GEOM_SQL + "," + _SECTIONS_SQL + "," + _assign_sql(
    "p AS (SELECT line_id AS pid, x, y FROM sec)") + "," + _TM_SQL + """,
vi AS (SELECT area AS unit, CASE WHEN road_km > 0 THEN vkm / ROUND(road_km, 3) ELSE 0.0 END AS intensity FROM tm)
SELECT unit, ROUND(intensity, 6) AS intensity, 'top' AS why FROM (SELECT * FROM vi ORDER BY intensity DESC, unit LIMIT 5)
UNION ALL
SELECT unit, ROUND(intensity, 6), 'spot' FROM vi WHERE unit IN (0, 24)
""")
def intensity_top_q(spark, sf):
    """Top-5 nation tiles by traffic intensity plus fixed spot rows."""
    t = _traffic_metrics(spark, sf)
    v = t.select(F.col("area").alias("unit"),
                 F.when(F.col("road_km") > 0, F.round("vkm", 3) / F.round("road_km", 3)).otherwise(0.0)
                 .alias("intensity"))
    top = v.orderBy(F.desc("intensity"), "unit").limit(5).withColumn("why", F.lit("top"))
    spot = v.where(F.col("unit").isin(*SPOT_UNITS)).withColumn("why", F.lit("spot"))
    return top.unionByName(spot).select("unit", F.round("intensity", 6).alias("intensity"), "why")
