"""Analysis queries: version diffs, need vs supply, reports, robustness."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewise.functions.clock import epoch_seconds
from sitewise.functions.money import cents, cents_to_double
from sitewise.operators.ranking import order_stats, rank_column, spearman
from sitewise.operators.allocate import allocate_seats
from sitewise.operators.shrink import eb_shrink
from sitewise.plans.q_ranking import (_METRICS_SQL, _PARAMS_SQL, _SEATS_SQL, _score_chain, customers_and_suppliers, finished_orders,
                                      score_votes)
from sitewise.plans.registry import query
from sitewise.session import load, materialize

TOP_MOVERS = 10
REPORT_TOP = 5
# Weights in tenths (1.3, 0.8 and 0.6) so weighted counts are exact: integer sums divided once.
NEED_W_FIRST, NEED_W_SECOND, SUPPLY_PER_SUPPLIER = 13, 8, 10.0
DEMAND_W = 6


def _versions(spark, sf):
    """Revenue per supplier in two versions: lines shipped before / from the
    midpoint of the ship-date range."""
    li = load(spark, sf, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice")
    secs = epoch_seconds(F.col("l_shipdate"))
    mid = li.agg((F.min(secs) / 2 + F.max(secs) / 2).alias("m")).scalar()
    rev = cents(F.col("l_extendedprice"))
    per = li.groupBy("l_suppkey").agg(F.sum(F.when(secs < mid, rev)).alias("a"),
                                      F.sum(F.when(secs >= mid, rev)).alias("b"))
    per = materialize(per.select(F.col("l_suppkey").alias("unit"),
                                 cents_to_double(F.coalesce("a", F.lit(0))).alias("rev_a"),
                                 cents_to_double(F.coalesce("b", F.lit(0))).alias("rev_b")))
    per = rank_column(per, [], "rev_a", descending=True, out_col="rank_a")
    per = rank_column(per, [], "rev_b", descending=True, out_col="rank_b")
    d = F.col("rev_b") - F.col("rev_a")
    pct = F.abs(d) / F.col("rev_a") * 100
    band = (F.when(F.col("rev_a") == 0, "new").when(pct < 1, "<1%").when(pct < 5, "1-5%")
             .when(pct < 20, "5-20%").otherwise(">=20%"))
    return materialize(per.withColumn("delta", F.round(d, 2)).withColumn("band", band)
                       .withColumn("rank_shift", F.abs(F.col("rank_a") - F.col("rank_b"))))


_VERSIONS_SQL = """
li AS (SELECT l_suppkey, epoch(l_shipdate) AS s, CAST(l_extendedprice AS DECIMAL(18,2)) AS rev FROM lineitem),
m AS (SELECT MIN(s) / 2 + MAX(s) / 2 AS m FROM li),
per AS (SELECT l_suppkey AS unit,
               CAST(COALESCE(SUM(rev) FILTER (WHERE s < m.m), 0) AS DOUBLE) AS rev_a,
               CAST(COALESCE(SUM(rev) FILTER (WHERE s >= m.m), 0) AS DOUBLE) AS rev_b
        FROM li, m GROUP BY 1),
ver AS (SELECT *, RANK() OVER (ORDER BY rev_a DESC) AS rank_a, RANK() OVER (ORDER BY rev_b DESC) AS rank_b,
               ROUND(rev_b - rev_a, 2) AS delta,
               CASE WHEN rev_a = 0 THEN 'new' WHEN abs(rev_b - rev_a) / rev_a * 100 < 1 THEN '<1%'
                    WHEN abs(rev_b - rev_a) / rev_a * 100 < 5 THEN '1-5%'
                    WHEN abs(rev_b - rev_a) / rev_a * 100 < 20 THEN '5-20%' ELSE '>=20%' END AS band
        FROM per)
"""


@query("two_version_diff", "WITH " + _VERSIONS_SQL + """
SELECT unit, rev_a, rev_b, delta, band, CAST(rank_a AS BIGINT) AS rank_a, CAST(rank_b AS BIGINT) AS rank_b,
       CAST(abs(rank_a - rank_b) AS BIGINT) AS rank_shift FROM ver
""")
def two_version_diff_q(spark, sf):
    """Supplier revenue, earlier vs later half of the ship dates: change,
    change band, rank in each version and rank shift."""
    v = _versions(spark, sf)
    return v.select("unit", "rev_a", "rev_b", "delta", "band", F.col("rank_a").cast("long").alias("rank_a"),
                    F.col("rank_b").cast("long").alias("rank_b"), F.col("rank_shift").cast("long").alias("rank_shift"))


@query("two_version_summary", "WITH " + _VERSIONS_SQL + """
SELECT COUNT(*) AS n_units, COUNT(*) FILTER (WHERE rev_a <> rev_b) AS n_changed,
       ROUND(SUM(abs(delta)), 2) AS sum_abs_delta, ROUND(CORR(rank_a, rank_b), 10) AS spearman,
       CAST(MAX(abs(rank_a - rank_b)) AS BIGINT) AS max_rank_shift
FROM ver
""")
def two_version_summary_q(spark, sf):
    v = _versions(spark, sf)
    return v.agg(F.count(F.lit(1)).alias("n_units"),
                 F.count_if(F.col("rev_a") != F.col("rev_b")).alias("n_changed"),
                 F.round(F.sum(F.abs(F.col("delta").cast("decimal(18,2)"))).cast("double"), 2).alias("sum_abs_delta"),
                 F.round(F.corr(F.col("rank_a").cast("double"), F.col("rank_b").cast("double")), 10).alias("spearman"),
                 F.max("rank_shift").cast("long").alias("max_rank_shift"))


@query("top_movers", "WITH " + _VERSIONS_SQL + f"""
SELECT unit, delta, rev_a, rev_b FROM ver ORDER BY abs(delta) DESC, unit LIMIT {TOP_MOVERS}
""")
def top_movers_q(spark, sf):
    """Top-10 suppliers by absolute revenue change (the limit is the report)."""
    v = _versions(spark, sf)
    return v.orderBy(F.abs("delta").desc(), "unit").limit(TOP_MOVERS).select("unit", "delta", "rev_a", "rev_b")


@query("usage_gap", f"""
WITH c AS (SELECT c_nationkey AS unit, COUNT(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE') AS a,
                  COUNT(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS b FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS unit, COUNT(*) AS ns FROM supplier GROUP BY 1),
d AS (SELECT CAST(n.n_nationkey AS BIGINT) AS unit,
             CAST({NEED_W_FIRST} * COALESCE(a, 0) + {NEED_W_SECOND} * COALESCE(b, 0) AS DOUBLE) / 10 AS need,
             CAST(COALESCE(ns, 0) AS DOUBLE) * {SUPPLY_PER_SUPPLIER} AS supply
      FROM nation n LEFT JOIN c ON c.unit = n.n_nationkey LEFT JOIN s ON s.unit = n.n_nationkey),
r AS (SELECT *, need - supply AS gap, RANK() OVER (ORDER BY need - supply DESC) AS gap_rank,
             RANK() OVER (ORDER BY need) AS rn, RANK() OVER (ORDER BY supply) AS rs FROM d)
SELECT unit, ROUND(need, 6) AS need, ROUND(supply, 6) AS supply, ROUND(gap, 6) AS gap,
       CAST(gap_rank AS BIGINT) AS gap_rank, ROUND(CORR(rn, rs) OVER (), 10) AS spearman
FROM r
""")
def usage_gap_q(spark, sf):
    """Need (1.3 × automobile + 0.8 × machinery customers) minus supply
    (10 per supplier) per nation, ranked, with the need/supply Spearman."""
    c = load(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("long").alias("unit")).agg(
        F.count_if(F.col("c_mktsegment") == "AUTOMOBILE").alias("a"),
        F.count_if(F.col("c_mktsegment") == "MACHINERY").alias("b"))
    u = customers_and_suppliers(spark, sf).select("unit", "n_supp").join(c, "unit", "left")
    d = u.select("unit",
                 ((F.lit(NEED_W_FIRST) * F.coalesce("a", F.lit(0)) + F.lit(NEED_W_SECOND) * F.coalesce("b", F.lit(0)))
                  .cast("double") / 10.0).alias("need"),
                 (F.col("n_supp").cast("double") * F.lit(SUPPLY_PER_SUPPLIER)).alias("supply"))
    d = materialize(d.withColumn("gap", F.col("need") - F.col("supply")))
    r = rank_column(d, [], "gap", descending=True, out_col="gap_rank")
    rho = spearman(d, [], "need", "supply").scalar()
    return r.select("unit", F.round("need", 6).alias("need"), F.round("supply", 6).alias("supply"),
                    F.round("gap", 6).alias("gap"), F.col("gap_rank").cast("long").alias("gap_rank"),
                    F.round(rho, 10).alias("spearman"))


@query("rank_report", f"""
WITH c AS (SELECT c_nationkey AS unit, COUNT(*) AS n_cust FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS unit, COUNT(*) AS n_supp FROM supplier GROUP BY 1),
d AS (SELECT CAST(n.n_nationkey AS BIGINT) AS unit, COALESCE(n_cust, 0) AS n_cust, COALESCE(n_supp, 0) AS n_supp
      FROM nation n LEFT JOIN c ON c.unit = n.n_nationkey LEFT JOIN s ON s.unit = n.n_nationkey),
r AS (SELECT *, RANK() OVER (ORDER BY n_cust DESC) AS rk_cust, RANK() OVER (ORDER BY n_supp DESC) AS rk_supp,
             PERCENT_RANK() OVER (ORDER BY n_cust) AS pr_cust FROM d)
SELECT unit, n_cust, n_supp, CAST(rk_cust AS BIGINT) AS rk_cust, CAST(rk_supp AS BIGINT) AS rk_supp, pr_cust
FROM r WHERE rk_cust <= {REPORT_TOP} OR rk_supp <= {REPORT_TOP}
""")
def rank_report_q(spark, sf):
    """Nations in the top 5 by customers or by suppliers, with percent_rank."""
    u = customers_and_suppliers(spark, sf).select("unit", "n_cust", "n_supp")
    r = rank_column(u, [], "n_cust", descending=True, out_col="rk_cust")
    r = rank_column(r, [], "n_supp", descending=True, out_col="rk_supp")
    st = order_stats(u.select(F.col("n_cust").cast("double").alias("v")), [], "v")
    pr = st.select(F.col("v"), F.when(F.col("n_total") > 1, F.col("n_before") / (F.col("n_total") - 1))
                   .otherwise(F.lit(0.0)).alias("pr_cust"))
    r = r.withColumn("v", F.col("n_cust").cast("double")).join(pr, "v").drop("v")
    return r.where((F.col("rk_cust") <= REPORT_TOP) | (F.col("rk_supp") <= REPORT_TOP)).select(
        "unit", "n_cust", "n_supp", F.col("rk_cust").cast("long").alias("rk_cust"),
        F.col("rk_supp").cast("long").alias("rk_supp"), "pr_cust")


@query("rank_robustness", "WITH " + _METRICS_SQL + """,
r AS (SELECT unit, metric, RANK() OVER (PARTITION BY metric ORDER BY value DESC) AS rk FROM metrics
      WHERE metric IN ('growth', 'growth_raw'))
SELECT COUNT(*) AS n_units, ROUND(AVG(abs(a.rk - b.rk)), 10) AS mean_shift,
       CAST(MAX(abs(a.rk - b.rk)) AS BIGINT) AS max_shift
FROM r a JOIN r b ON a.unit = b.unit AND a.metric = 'growth' AND b.metric = 'growth_raw'
""")
def rank_robustness_q(spark, sf):
    """How far ranks move between the shrunk and the raw growth share."""
    m = materialize(eb_shrink(materialize(finished_orders(spark, sf)), "region", "x", "n")
                    .select("unit", F.round("value", 10).alias("value"), F.round("raw", 10).alias("raw")))
    g = rank_column(m.select("unit", "value"), [], "value", descending=True, out_col="rk_a")
    r = rank_column(m.select("unit", "raw"), [], "raw", descending=True, out_col="rk_b")
    j = g.select("unit", "rk_a").join(r.select("unit", "rk_b"), "unit")
    s = F.abs(F.col("rk_a") - F.col("rk_b"))
    return j.agg(F.count(F.lit(1)).alias("n_units"), F.round(F.avg(s), 10).alias("mean_shift"),
                 F.max(s).cast("long").alias("max_shift"))


@query("hypothesis_scorecard", "WITH RECURSIVE " + _METRICS_SQL + "," + _PARAMS_SQL + "," + _SEATS_SQL + """,
want AS (SELECT list(value) AS vs FROM metrics WHERE metric = 'demand'),
top AS (SELECT list(unit) AS units FROM metrics, want WHERE metric = 'demand' AND len(list_filter(vs, lambda v: v > value)) < 5),
held AS (SELECT scenario, variant, list(seats.unit) AS got FROM seats GROUP BY ALL)
SELECT scenario, variant, len(list_distinct(got)) AS n_units_with_seat, len(got) AS n_seats, len(list_filter(got, lambda x: list_contains(units, x))) AS seats_top_demand,
  CAST(list_max(map_values(list_aggregate(got, 'histogram'))) AS BIGINT) AS max_seats_one_unit, len(list_filter(got, lambda x: list_contains(units, x))) >= 0.4 * len(got) AS h_top_demand_40pct
FROM held, top
""")
def hypothesis_scorecard_q(spark, sf):
    """Per run: units with a seat, seats to the top-5 demand nations, and
    whether they take at least 40 % of the seats."""
    _, sc, metrics = _score_chain(spark, sf)
    seats = allocate_seats(score_votes(spark, sf, sc), ["scenario", "variant"], "unit", "votes",
                           n_seats=50, cap=10)
    m = metrics.where(F.col("metric") == "demand").select("unit", "value")
    top = rank_column(m, [], "value", descending=True, out_col="rk").where(F.col("rk") <= REPORT_TOP) \
        .select("unit", F.lit(True).alias("_top"))
    per = seats.groupBy("scenario", "variant", "unit").agg(F.count(F.lit(1)).alias("n")).join(top, "unit", "left")
    top_seats = F.coalesce(F.sum(F.when(F.col("_top"), F.col("n"))), F.lit(0))
    return per.groupBy("scenario", "variant").agg(
        F.count(F.lit(1)).alias("n_units_with_seat"), F.sum("n").cast("long").alias("n_seats"),
        top_seats.cast("long").alias("seats_top_demand"), F.max("n").cast("long").alias("max_seats_one_unit"),
        (top_seats >= F.lit(0.4) * F.sum("n")).alias("h_top_demand_40pct"))


@query("ev_demand", f"""
WITH o AS (SELECT c.c_nationkey AS unit, year(o.o_orderdate) AS y, o.o_orderstatus AS st
           FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey),
fy AS (SELECT MAX(year(o_orderdate)) AS y FROM orders),
e AS (SELECT unit,
             COUNT(*) FILTER (WHERE o.y = fy.y AND st = 'F') AS first_y,
             COUNT(*) FILTER (WHERE o.y = fy.y AND st = 'O') AS second_y,
             COUNT(*) FILTER (WHERE o.y = fy.y) AS tot_y,
             COUNT(*) FILTER (WHERE o.y = fy.y - 2 AND st = 'F') AS first_prev,
             COUNT(*) FILTER (WHERE o.y = fy.y - 2) AS tot_prev
      FROM o, fy GROUP BY unit)
SELECT CAST(n.n_nationkey AS BIGINT) AS unit,
       CAST(COALESCE(first_y, 0) AS BIGINT) AS first_y, CAST(COALESCE(second_y, 0) AS BIGINT) AS second_y,
       ROUND(CAST(10 * COALESCE(first_y, 0) + {DEMAND_W} * COALESCE(second_y, 0) AS DOUBLE) / 10, 6) AS demand,
       ROUND(CASE WHEN tot_y > 0 THEN first_y / tot_y END - CASE WHEN tot_prev > 0 THEN first_prev / tot_prev END, 10)
         AS share_change
FROM nation n LEFT JOIN e ON e.unit = n.n_nationkey
""")
def ev_demand_q(spark, sf):
    """Latest-year demand first + 0.6 × second kind (status F and O orders
    per customer nation) and the change in the first kind's share against
    two years earlier."""
    o = load(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), "o_orderstatus")
    fy = o.agg(F.max("y")).scalar()
    per_c = o.groupBy("o_custkey").agg(
        F.count_if((F.col("y") == fy) & (F.col("o_orderstatus") == "F")).alias("f"),
        F.count_if((F.col("y") == fy) & (F.col("o_orderstatus") == "O")).alias("s"),
        F.count_if(F.col("y") == fy).alias("t"),
        F.count_if((F.col("y") == fy - 2) & (F.col("o_orderstatus") == "F")).alias("fp"),
        F.count_if(F.col("y") == fy - 2).alias("tp"))
    cust = load(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("unit"))
    e = (per_c.join(cust, per_c.o_custkey == cust.c_custkey).groupBy("unit")
              .agg(*[F.sum(c).alias(c) for c in ("f", "s", "t", "fp", "tp")]))
    n = load(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("unit")).join(e, "unit", "left")
    f, s = F.coalesce("f", F.lit(0)), F.coalesce("s", F.lit(0))
    share = (F.try_divide(F.col("f").cast("double"), F.col("t").cast("double"))
             - F.try_divide(F.col("fp").cast("double"), F.col("tp").cast("double")))
    return n.select("unit", f.cast("long").alias("first_y"), s.cast("long").alias("second_y"),
                    F.round((F.lit(10) * f + F.lit(DEMAND_W) * s).cast("double") / 10.0, 6).alias("demand"),
                    F.round(share, 10).alias("share_change"))


@query("user_day_avg", """
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, SUM(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY 1, 2)
SELECT user_id, COUNT(*) AS n_days, ROUND(AVG(CAST(v AS DOUBLE)), 6) AS avg_daily_value FROM d GROUP BY 1
""")
def user_day_avg_q(spark, sf):
    """Average over days of each user's daily value sum (sum per snapshot,
    then mean per site)."""
    d = load(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).alias("v"))
    return d.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_days"),
                                    F.round(F.avg(F.col("v").cast("double")), 6).alias("avg_daily_value"))


@query("turn_ratio", """
WITH a AS (SELECT conv_id, role, SUM(length(text)) AS n FROM conversations GROUP BY 1, 2)
SELECT u.conv_id, CAST(u.n AS BIGINT) AS user_chars, CAST(s.n AS BIGINT) AS assistant_chars,
       ROUND(CASE WHEN s.n <> 0 THEN u.n / s.n END, 10) AS ratio
FROM a u JOIN a s ON s.conv_id = u.conv_id AND u.role = 'user' AND s.role = 'assistant'
""")
def turn_ratio_q(spark, sf):
    """Per conversation: user characters / assistant characters (ratio of
    two role sums by a self-join on the pair key), over whole texts."""
    a = load(spark, sf, "conversations").groupBy("conv_id", "role").agg(
        F.sum(F.length("text")).alias("n"))
    u = a.where(F.col("role") == "user").select("conv_id", F.col("n").alias("user_chars"))
    s = a.where(F.col("role") == "assistant").select("conv_id", F.col("n").alias("assistant_chars"))
    j = u.join(s, "conv_id")
    return j.select("conv_id", F.col("user_chars").cast("long").alias("user_chars"),
                    F.col("assistant_chars").cast("long").alias("assistant_chars"),
                    F.round(F.try_divide(F.col("user_chars").cast("double"), F.col("assistant_chars").cast("double")),
                            10).alias("ratio"))


@query("segment_summary", """
SELECT CAST(c_nationkey AS BIGINT) AS unit, COUNT(DISTINCT c_mktsegment) AS n_segments,
       string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments,
       CAST(any_value(n_name) AS VARCHAR) IS NOT NULL AS named
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY 1
""")
def segment_summary_q(spark, sf):
    """Per nation: its market segments as a sorted, comma-joined summary."""
    c = load(spark, sf, "customer").join(load(spark, sf, "nation"),
                                         F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return c.groupBy(F.col("c_nationkey").cast("long").alias("unit")).agg(
        F.count_distinct("c_mktsegment").alias("n_segments"),
        F.concat_ws(",", F.array_sort(F.collect_set("c_mktsegment"))).alias("segments"),
        F.any_value("n_name").isNotNull().alias("named"))


@query("evse_impact", """
WITH u AS (
  SELECT l_orderkey,
         CASE WHEN l_returnflag = 'N' THEN 'line:' || CAST(l_linenumber AS VARCHAR) ELSE l_returnflag END AS unit,
         MAX(CAST(l_extendedprice AS DECIMAL(18,2))) AS mx, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS sm
  FROM lineitem GROUP BY 1, 2),
o AS (SELECT l_orderkey, SUM(mx) AS rule_total, SUM(sm) AS naive_total FROM u GROUP BY 1)
SELECT COUNT(*) AS n_orders, COUNT(*) FILTER (WHERE rule_total = naive_total) AS n_equal,
       COUNT(*) FILTER (WHERE rule_total < naive_total) AS n_rule_lower,
       COUNT(*) FILTER (WHERE rule_total > naive_total) AS n_rule_higher,
       CAST(SUM(rule_total) AS DOUBLE) AS rule_total, CAST(SUM(naive_total) AS DOUBLE) AS naive_total
FROM o
""")
def evse_impact_q(spark, sf):
    """Impact of the max-per-unit rule against the naive sum per order."""
    li = load(spark, sf, "lineitem")
    unit = F.when(F.col("l_returnflag") == "N",
                  F.concat(F.lit("line:"), F.col("l_linenumber").cast("string"))).otherwise(F.col("l_returnflag"))
    p = cents(F.col("l_extendedprice"))
    u = li.groupBy("l_orderkey", unit.alias("unit")).agg(F.max(p).alias("mx"), F.sum(p).alias("sm"))
    o = u.groupBy("l_orderkey").agg(F.sum("mx").alias("r"), F.sum("sm").alias("n"))
    return o.agg(F.count(F.lit(1)).alias("n_orders"), F.count_if(F.col("r") == F.col("n")).alias("n_equal"),
                 F.count_if(F.col("r") < F.col("n")).alias("n_rule_lower"),
                 F.count_if(F.col("r") > F.col("n")).alias("n_rule_higher"),
                 cents_to_double(F.sum("r")).alias("rule_total"), cents_to_double(F.sum("n")).alias("naive_total"))
