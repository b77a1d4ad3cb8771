"""Landing folders, current versions, counters, seeds and settings over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewise.functions.money import cents, cents_to_double
from sitewise.operators.checks import either_timestamp, in_box, label_mismatch, retired_code_check, with_counters
from sitewise.operators.history import scd2_from_changes
from sitewise.operators.quality import column_profile
from sitewise.plans.q_allocation import _COMBINED_CTE, _combined
from sitewise.plans.q_checks import BOX
from sitewise.plans.q_history import SCD2_CHANGES_SQL
from sitewise.plans.q_spatial import customer_points
from sitewise.plans.registry import query
from sitewise.session import load, materialize, scratch_path
from sitewise.sources.files import list_files, path_field, rows_of_complete_folders, with_lineage
from sitewise.streaming.ingest import ingest_available_now, json_stream


@query("json_arrays", """
SELECT event_type AS zone, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS value_sum, CAST(1 AS BIGINT) AS n_files
FROM events GROUP BY 1, 2
""")
def json_arrays_q(spark, sf):
    """One JSON array a file, a file a zone (event type) and day, taken in by a
    stream twice; zone and day come from the path."""
    base = scratch_path(spark, "json-arrays")
    e = load(spark, sf, "events").withColumn("day", F.to_date("ts").cast("string"))
    docs = e.groupBy("event_type", "day").agg(F.to_json(F.collect_list(F.struct("event_id", "value"))).alias("value"))
    docs.select(F.col("event_type").alias("zone"), "day", "value").repartition("zone").write.partitionBy("zone", "day").text(f"{base}/landing")
    schema = spark.createDataFrame([], "event_id long, value double").schema
    for _ in range(2):
        ingest_available_now(json_stream(spark, f"{base}/landing/*/*", schema, multiline=True), f"{base}/bronze", f"{base}/_ckpt")
    rows = spark.read.parquet(f"{base}/bronze").withColumn("zone", path_field(r"/zone=([^/]+)/")).withColumn("day", path_field(r"/day=([^/]+)/"))
    return rows.groupBy("zone", "day").agg(F.count(F.lit(1)).alias("n_rows"), cents_to_double(F.sum(cents(F.col("value")))).alias("value_sum"), F.count_distinct("_file").alias("n_files"))


@query("marker_folders", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_customers FROM orders WHERE year(o_orderdate) % 2 = 0 GROUP BY 1
""")
def marker_folders_q(spark, sf):
    """Orders landed in a folder a year; only folders whose delivery has ended,
    which a marker file says, are read."""
    base = scratch_path(spark, "markers")
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    o.repartition("year").write.partitionBy("year").json(f"{base}/landing")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for r in o.where("year % 2 = 0").select("year").distinct().collect():  # one marker a folder, as a delivery's last act
        p = jvm.org.apache.hadoop.fs.Path(f"{base}/landing/year={r.year}/dump.done")
        out = p.getFileSystem(conf).create(p)
        out.write(bytearray(b"done"))
        out.close()
    rows = with_lineage(spark.read.schema("o_orderkey long, o_custkey long").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(f"{base}/landing"))
    whole = rows_of_complete_folders(rows, list_files(spark, f"{base}/landing"), "dump.done")
    return whole.groupBy(path_field(r"/year=(\d+)/").cast("long").alias("year")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("o_custkey").alias("n_customers"))


@query("current_versions", "WITH h AS (" + SCD2_CHANGES_SQL + """)
SELECT event_type, count(*) AS n_users, max(start_at) AS newest, CAST(sum(n_rows) AS BIGINT) AS n_rows FROM h WHERE end_at IS NULL GROUP BY 1
""")
def current_versions_q(spark, sf):
    """Users by their current event type: open versions of the history only."""
    ev = load(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    h = scd2_from_changes(ev, ["user_id"], ["ts", "event_id"], ["event_type"], ["value", "event_id"]).where("end_at IS NULL")
    return h.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_users"), F.max("start_at").alias("newest"), F.sum("n_rows").alias("n_rows"))


@query("two_formats", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, count(*) FILTER (WHERE o_orderkey % 9 <> 4) AS n_read, count(*) FILTER (WHERE o_orderkey % 9 = 4) AS n_unread,
  CAST(sum(CASE WHEN o_orderkey % 9 <> 4 THEN dayofyear(o_orderdate) END) AS BIGINT) AS days
FROM orders GROUP BY 1
""")
def two_formats_q(spark, sf):
    """Dates written in one of two formats, or as neither, read back."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    text = F.when(k % 9 == 4, F.date_format(d, "dd MMM")).when(k % 2 == 0, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(d, "yyyyMMdd"))
    rows = load(spark, sf, "orders").select(F.year("o_orderdate").cast("long").alias("year"), text.alias("written"))
    at = either_timestamp(F.col("written"), "yyyy-MM-dd HH:mm:ss", "yyyyMMdd")
    rows = rows.withColumn("at", at)
    return rows.groupBy("year").agg(F.count("at").alias("n_read"), F.count_if(F.col("at").isNull()).alias("n_unread"), F.sum(F.dayofyear("at")).alias("days"))


_HAVING = """
SELECT o_custkey AS custkey, o_orderstatus AS status, count(*) AS n, min(o_orderdate) AS first_at FROM {orders}
GROUP BY ALL HAVING n >= 3 AND count(DISTINCT o_orderpriority) > 2
"""


@query("grouped_having", _HAVING.replace("{orders}", "orders"))
def grouped_having_q(spark, sf):
    """GROUP BY ALL with a HAVING over an alias and another aggregate."""
    return spark.sql(_HAVING, orders=load(spark, sf, "orders"))


@query("uniqueness_counters", """
SELECT l_orderkey, l_partkey, count(*) AS n_lines, any_value(n_same_pair) AS n_same_pair, any_value(n_same_order) AS n_same_order
FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_partkey) AS n_same_pair, count(*) OVER (PARTITION BY l_orderkey) AS n_same_order FROM lineitem)
WHERE n_same_pair > 1 OR n_same_order >= 7 GROUP BY 1, 2
""")
def uniqueness_counters_q(spark, sf):
    """Lines that repeat a part in their order, or stand in a large one, by
    counters put beside every line."""
    li = with_counters(load(spark, sf, "lineitem").select("l_orderkey", "l_partkey"), {"n_same_pair": ["l_orderkey", "l_partkey"], "n_same_order": ["l_orderkey"]})
    return li.where("n_same_pair > 1 OR n_same_order >= 7").groupBy("l_orderkey", "l_partkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.max("n_same_pair").alias("n_same_pair"), F.max("n_same_order").alias("n_same_order"))


@query("label_mismatch", """
WITH a AS (SELECT n_nationkey AS code, n_name AS label FROM nation WHERE n_nationkey % 6 <> 5),
b AS (SELECT n_nationkey AS code, CASE n_nationkey % 4 WHEN 1 THEN '  ' || lower(n_name) WHEN 2 THEN n_name || ' land' WHEN 3 THEN NULL ELSE n_name END AS label FROM nation WHERE n_nationkey % 7 <> 6)
SELECT n_nationkey AS code, a.label AS label_a, b.label AS label_b,
  CASE WHEN b.code IS NULL THEN 'only_a' WHEN a.code IS NULL THEN 'only_b' WHEN n_nationkey % 4 = 1 THEN 'spelling' ELSE 'label' END AS kind
FROM nation LEFT JOIN a ON a.code = n_nationkey LEFT JOIN b ON b.code = n_nationkey
WHERE (a.code IS NOT NULL OR b.code IS NOT NULL) AND (a.code IS NULL OR b.code IS NULL OR n_nationkey % 4 <> 0)
""")
def label_mismatch_q(spark, sf):
    """Two seeds of nations that disagree: a code that one lacks, another
    label, another spelling."""
    k, name = F.col("n_nationkey"), F.col("n_name")
    n = load(spark, sf, "nation")
    a = n.where(k % 6 != 5).select(k.alias("code"), name.alias("label"))
    other = F.when(k % 4 == 1, F.concat(F.lit("  "), F.lower(name))).when(k % 4 == 2, F.concat(name, F.lit(" land"))).when(k % 4 == 0, name)
    return label_mismatch(a, n.where(k % 7 != 6).select(k.alias("code"), other.alias("label")), "code", "label")


@query("retired_codes_marked", """
WITH c AS (SELECT event_type, CASE WHEN event_id % 3 = 0 THEN value * 0 WHEN event_type = 'signup' AND event_id % 50 = 1 THEN value END AS v,
  CASE WHEN event_type = 'error' OR event_id % 4 = 0 THEN '..' END AS s FROM events WHERE event_type IN ('error', 'signup'))
SELECT event_type, count(*) AS n_cells, count(*) FILTER (WHERE v = 0) AS n_zero, count(*) FILTER (WHERE v IS NULL) AS n_null, count(*) FILTER (WHERE v > 0) AS n_positive,
  count(*) FILTER (WHERE v IS NULL AND s IS NULL) AS n_null_unmarked, count(*) FILTER (WHERE v > 0 OR (v IS NULL AND s IS NULL)) = 0 AS holds_nothing FROM c GROUP BY 1
""")
def retired_codes_marked_q(spark, sf):
    """Retired codes whose empty cells are marked '..': one holds nothing, the
    other has values and unmarked gaps."""
    e = load(spark, sf, "events")
    v = F.when(F.col("event_id") % 3 == 0, F.col("value") * 0).when((F.col("event_type") == "signup") & (F.col("event_id") % 50 == 1), F.col("value"))
    s = F.when((F.col("event_type") == "error") | (F.col("event_id") % 4 == 0), "..")
    return retired_code_check(e.select("event_type", v.alias("v"), s.alias("s")), "event_type", ["error", "signup"], "v", "s")


@query("landed_profile", """
WITH l AS (SELECT o_orderstatus AS status, CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END AS customer, CAST(CAST(o_orderkey % 4 AS DOUBLE) / 2 AS DOUBLE) AS part, CAST(year(o_orderdate) AS INTEGER) AS version FROM orders)
SELECT 'status' AS column_name, count(*) AS n_rows, count(*) - count(status) AS n_null, count(DISTINCT status) AS n_distinct, count(status) AS n_not_integer, string_agg(DISTINCT status, '|' ORDER BY status) AS value_set FROM l
UNION ALL SELECT 'customer', count(*), count(*) - count(customer), count(DISTINCT customer), count(*) FILTER (WHERE customer = 'n/a'), NULL FROM l
UNION ALL SELECT 'part', count(*), count(*) - count(part), count(DISTINCT part), count(*) FILTER (WHERE part <> floor(part)), '0.0|0.5|1.0|1.5' FROM l
UNION ALL SELECT 'version', count(*), count(*) - count(version), count(DISTINCT version), 0, string_agg(DISTINCT CAST(version AS VARCHAR), '|' ORDER BY CAST(version AS VARCHAR)) FROM l
""")
def landed_profile_q(spark, sf):
    """Profile of landed columns, the version from the path among them: values
    that are no integers where integers are expected, small sets spelled out."""
    base = scratch_path(spark, "profile")
    k = F.col("o_orderkey")
    o = load(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("status"), F.when(k % 11 == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        ((k % 4).cast("double") / 2).alias("part"), F.year("o_orderdate").alias("version"))
    o.repartition("version").write.partitionBy("version").parquet(f"{base}/landing")
    return column_profile(spark.read.parquet(f"{base}/landing"), ["status", "customer", "part", "version"], max_set=12)


@query("structural_summary", """
SELECT (SELECT count(*) FROM customer) AS n_points, (SELECT count(*) FROM (SELECT c_mktsegment, c_nationkey, c_acctbal FROM customer GROUP BY ALL HAVING count(*) > 1)) AS n_duplicated,
  (SELECT count(*) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')) AS n_unknown_codes, (SELECT count(*) FROM customer WHERE c_acctbal <= 0 OR c_acctbal IS NULL) AS n_without_value,
  (SELECT count(*) FROM customer WHERE NOT (c_custkey * 7919 % 10000 - 2500 BETWEEN -500 AND 5500 AND c_custkey * 104729 % 10000 - 2500 BETWEEN -500 AND 5500)) AS n_outside_box,
  (SELECT count(*) FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)) AS n_without_orders
""")
def structural_summary_q(spark, sf):
    """One row of structural facts: duplicated attributes, codes that no table
    knows, missing values, points outside the valid box, customers nothing refers to."""
    c, o = load(spark, sf, "customer"), load(spark, sf, "orders")
    known = spark.createDataFrame([(p,) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")], "o_orderpriority string")
    codes = o.where("o_orderpriority IS NOT NULL").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).join(known, "o_orderpriority", "left_anti")
    twice = c.groupBy("c_mktsegment", "c_nationkey", "c_acctbal").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    outside = customer_points(spark, sf).where(~in_box(F.col("x"), F.col("y"), *BOX))
    orphans = c.join(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")
    one = c.agg(F.count(F.lit(1)).alias("n_points"), F.count_if(F.col("c_acctbal").isNull() | (F.col("c_acctbal") <= 0)).alias("n_without_value"))
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return one.select("n_points", n(twice).alias("n_duplicated"), F.coalesce(codes.agg(F.sum("n")).scalar(), F.lit(0)).alias("n_unknown_codes"), "n_without_value",
                      n(outside).alias("n_outside_box"), n(orphans).alias("n_without_orders"))


@query("snapshot_coverage", """
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, user_id FROM events),
ours AS (SELECT event_type, max(day) AS day FROM d WHERE event_type <> 'view' OR day < (SELECT max(day) FROM d) GROUP BY 1),
n AS (SELECT o.event_type, o.day, count(*) FILTER (WHERE d.user_id % 4 > 0) AS listed FROM ours o JOIN d ON d.event_type = o.event_type AND d.day = o.day GROUP BY ALL),
p AS (SELECT event_type, day, count(*) AS published FROM d WHERE day = (SELECT max(day) FROM d) GROUP BY ALL)
SELECT coalesce(n.event_type, p.event_type) AS event_type, CAST(n.day AS VARCHAR) AS listed_day, CAST(p.day AS VARCHAR) AS published_day, listed, published,
  CASE WHEN n.day IS NULL THEN 'not listed' WHEN p.day IS NULL THEN 'not published' WHEN n.day <> p.day THEN 'other snapshot' WHEN listed > published THEN 'above'
    WHEN 100 * (published - listed) > 20 * published THEN 'too few' ELSE 'ok' END AS verdict
FROM n FULL JOIN p ON p.event_type = n.event_type
""")
def snapshot_coverage_q(spark, sf):
    """Our latest snapshot of each event type against the published count:
    comparable only if both are of one day, never above, at most 20 % short."""
    d = load(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"), "user_id")
    last = d.agg(F.max("day")).scalar()
    mine = d.where((F.col("event_type") != "view") | (F.col("day") < last))
    # of each type the rows of its newest day: counted by day first, then the newest picked
    n = mine.groupBy("event_type", "day").agg(F.count_if(F.col("user_id") % 4 > 0).alias("listed")).groupBy("event_type").agg(F.max(F.struct("day", "listed")).alias("m"))
    p = d.where(F.col("day") == last).groupBy("event_type").agg(F.max("day").alias("p_day"), F.count(F.lit(1)).alias("published"))
    j = n.select("event_type", F.col("m.day").alias("l_day"), F.col("m.listed").alias("listed")).join(p, "event_type", "full")
    verdict = (F.when(F.col("l_day").isNull(), "not listed").when(F.col("p_day").isNull(), "not published").when(F.col("l_day") != F.col("p_day"), "other snapshot")
               .when(F.col("listed") > F.col("published"), "above").when(100 * (F.col("published") - F.col("listed")) > 20 * F.col("published"), "too few").otherwise("ok"))
    return j.select("event_type", F.col("l_day").cast("string").alias("listed_day"), F.col("p_day").cast("string").alias("published_day"), "listed", "published", verdict.alias("verdict"))


@query("scorecard_settings", "WITH RECURSIVE " + _COMBINED_CTE + """,
five AS (SELECT list(n_nationkey) AS top FROM (SELECT n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS n FROM nation ORDER BY n DESC, n_nationkey LIMIT 5))
SELECT n_p1, variant, count(DISTINCT unit) AS n_units, count(*) AS n_seats, count(*) FILTER (WHERE list_contains(top, unit)) AS seats_top,
  count(*) FILTER (WHERE list_contains(top, unit)) * 10 >= 4 * count(*) AS h_top_40pct, min(seat_no) FILTER (WHERE list_contains(top, unit)) AS first_top_seat
FROM combined, five GROUP BY n_p1, variant
""")
def scorecard_settings_q(spark, sf):
    """For every slider setting and variant: units with a seat, seats of the
    five nations with most customers, whether they take 40 %."""
    seats = materialize(_combined(spark, sf))
    per = load(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("long").alias("unit")).agg(F.count(F.lit(1)).alias("n"))
    top = per.orderBy(F.desc("n"), "unit").limit(5).select("unit", F.lit(True).alias("top"))
    s = seats.join(top, "unit", "left")
    mine = F.count_if("top")
    return s.groupBy("n_p1", "variant").agg(
        F.count_distinct("unit").alias("n_units"), F.count(F.lit(1)).alias("n_seats"), mine.alias("seats_top"), (mine * 10 >= 4 * F.count(F.lit(1))).alias("h_top_40pct"),
        F.min(F.when(F.col("top"), F.col("seat_no"))).alias("first_top_seat"))


@query("metric_details", """
WITH c AS (SELECT c_nationkey AS unit, count(*) AS n, count(*) FILTER (WHERE c_acctbal > 0) AS x, avg(c_acctbal) AS m FROM customer GROUP BY 1)
SELECT CAST(unit AS BIGINT) AS unit, format('{} of {} customers ({:.1f} %)', x, n, 100.0 * x / n) AS detail,
  CASE WHEN x > 0 THEN format('mean balance {:.2f}, {:05d}', m, x) END AS detail_mean FROM c
""")
def metric_details_q(spark, sf):
    """Texts that document a metric, written from its parts."""
    c = load(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("long").alias("unit")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") > 0).alias("x"), F.avg("c_acctbal").alias("m"))
    return c.select("unit", F.format_string("%d of %d customers (%.1f %%)", "x", "n", 100.0 * F.col("x") / F.col("n")).alias("detail"),
                    F.when(F.col("x") > 0, F.format_string("mean balance %.2f, %05d", "m", "x")).alias("detail_mean"))
