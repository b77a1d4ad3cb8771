"""Seat allocation queries (single, two-stage, robustness, consistency)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewise.operators.allocate import (allocate_combined, allocate_seats,
                                         combined_summary, robustness)
from sitewise.plans.registry import query
from sitewise.session import load

# Model parameters (fixed values used by the allocation queries)
N_SEATS = 50
CAP = 10
CAP_SUPPLIERS = 3
STEP = 5
N_P1_DEFAULT = 35
UNIT_KW = 600.0
VARIANTS = [("base", 1.0), ("first14", 1.4)]


def _votes(spark, sf, table, key):
    return (load(spark, sf, table)
            .groupBy(F.col(key).cast("long").alias("unit"))
            .agg(F.count(F.lit(1)).alias("votes")))


def _with_variants(df):
    arr = F.array(*[F.struct(F.lit(v).alias("variant"), F.lit(fd).alias("first_divisor"))
                    for v, fd in VARIANTS])
    return df.withColumn("_v", F.explode(arr)).select("*", "_v.*").drop("_v")


def _seat_cols():
    return ["seat_no", "unit", F.col("j").cast("long").alias("j"), "divisor", "quotient", "votes"]


_ALONE_SQL = """
hand AS (
  SELECT run, most, d1, 0::BIGINT AS seat_no, [0::BIGINT FOR x IN units] AS held, {'q': 0.0::DOUBLE, 'v': 0.0::DOUBLE, 'neg': 0::BIGINT, 'd': 0.0::DOUBLE} AS won FROM ballot
  UNION ALL
  SELECT run, most, d1, seat_no + 1, [held[i] + if(i = -best.neg, 1, 0) FOR i IN range(1, len(held) + 1)], best
  FROM (SELECT h.run, h.most, h.d1, seat_no, held, list_max([{'q': if(held[i] < h.most, v[i] / if(held[i] = 0, h.d1, 2 * held[i] + 1), -1.0)::DOUBLE, 'v': v[i]::DOUBLE, 'neg': -i,
          'd': if(held[i] = 0, h.d1, 2 * held[i] + 1)::DOUBLE} FOR i IN range(1, len(held) + 1)]) AS best
        FROM hand h JOIN ballot b ON b.run = h.run WHERE seat_no < 50)
  WHERE best.q > 0),
seats AS (SELECT h.run, seat_no, units[-won.neg] AS unit, held[-won.neg] AS j, won.d AS divisor, won.q AS quotient, won.v AS votes FROM hand h JOIN ballot b ON b.run = h.run WHERE seat_no > 0)
"""


@query("allocate_seats", """
WITH RECURSIVE n AS (SELECT CAST(n_nationkey AS BIGINT) AS unit, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS c, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS s FROM nation),
ballot AS (SELECT 'customers' AS run, 10 AS most, 1.0::DOUBLE AS d1, list(unit ORDER BY unit) AS units, list(c ORDER BY unit) AS v FROM n
  UNION ALL SELECT 'suppliers', 3, 1.0, list(unit ORDER BY unit), list(s ORDER BY unit) FROM n),
""" + _ALONE_SQL + """
SELECT run, seat_no, unit, j, divisor, quotient, CAST(votes AS BIGINT) AS votes FROM seats
""")
def allocate_seats_q(spark, sf):
    """Customers per nation (cap 10) and suppliers per nation (cap 3, the
    cap binds and integer votes tie), 50 seats each, pure Sainte-Laguë."""
    votes = (_votes(spark, sf, "customer", "c_nationkey").withColumn("run", F.lit("customers"))
             .withColumn("cap", F.lit(CAP))
             .unionByName(_votes(spark, sf, "supplier", "s_nationkey").withColumn("run", F.lit("suppliers"))
                          .withColumn("cap", F.lit(CAP_SUPPLIERS))))
    seats = allocate_seats(votes, ["run"], "unit", "votes", n_seats=N_SEATS, cap="cap", first_divisor=1.0)
    return seats.select("run", *_seat_cols())


def _first_seats(spark, sf):
    v1 = _with_variants(_votes(spark, sf, "customer", "c_nationkey"))
    return allocate_seats(v1, ["variant"], "unit", "votes", n_seats=N_SEATS, cap=CAP,
                          first_divisor="first_divisor")


def _combined(spark, sf):
    v2 = _with_variants(_votes(spark, sf, "supplier", "s_nationkey"))
    return allocate_combined(_first_seats(spark, sf), v2, ["variant"], "unit", "votes",
                             n_target=N_SEATS, step=STEP, cap=CAP, first_divisor="first_divisor")


# Seat by seat: the recursion carries, per slider setting and variant, how many seats every
# nation holds, and gives the next seat to the nation with the largest quotient at that moment.
_COMBINED_CTE = """
nat AS (SELECT list(k ORDER BY k) AS units, list(c ORDER BY k) AS cust, list(s ORDER BY k) AS supp FROM (
  SELECT CAST(n_nationkey AS BIGINT) AS k, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS c,
         (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS s FROM nation)),
seat AS (
  SELECT CAST(n1 AS BIGINT) AS n_p1, variant, d1, CAST(0 AS BIGINT) AS seat_no, [CAST(0 AS BIGINT) FOR u IN units] AS held,
         {'q': 0.0::DOUBLE, 'v': 0::BIGINT, 'neg': 0::BIGINT, 'd': 0.0::DOUBLE} AS won
  FROM nat, range(0, 51, 5) r(n1), (VALUES ('base', 1.0::DOUBLE), ('first14', 1.4::DOUBLE)) x(variant, d1)
  UNION ALL
  SELECT n_p1, variant, d1, seat_no + 1, [held[i] + CASE WHEN i = -best.neg THEN 1 ELSE 0 END FOR i IN range(1, len(held) + 1)], best
  FROM (
    SELECT t.*, list_max([
        {'q': CASE WHEN held[i] >= 10 THEN -1.0::DOUBLE ELSE CAST(votes[i] AS DOUBLE) / CASE held[i] WHEN 0 THEN d1 ELSE 2 * held[i] + 1 END END,
         'v': votes[i], 'neg': -i, 'd': CAST(CASE held[i] WHEN 0 THEN d1 ELSE 2 * held[i] + 1 END AS DOUBLE)}
        FOR i IN range(1, len(held) + 1)]) AS best
    FROM (SELECT seat.*, CASE WHEN seat_no < n_p1 THEN cust ELSE supp END AS votes FROM seat, nat) t WHERE seat_no < 50)
  WHERE best.q > 0),
combined AS (
  SELECT n_p1, variant, seat_no, CASE WHEN seat_no <= n_p1 THEN 'first' ELSE 'second' END AS part, units[-won.neg] AS unit,
         held[-won.neg] AS j, won.d AS divisor, won.q AS quotient
  FROM seat, nat WHERE seat_no > 0)
"""


@query("allocate_combined_station", "WITH RECURSIVE " + _COMBINED_CTE + "SELECT * FROM combined")
def allocate_combined_station_q(spark, sf):
    """Two-stage allocation: first strategy = customers per nation, second =
    suppliers per nation; cap 10, settings 0, 5, …, 50; two variants."""
    return _combined(spark, sf).select("n_p1", "variant", "seat_no", "part", "unit",
                                       F.col("j").cast("long").alias("j"), "divisor", "quotient")


@query("allocate_combined", "WITH RECURSIVE " + _COMBINED_CTE + """
SELECT n_p1, variant, unit, count(*) FILTER (WHERE part = 'first') AS n_part1, count(*) FILTER (WHERE part = 'second') AS n_part2,
       min(seat_no) AS first_seat, count(seat_no) AS n_seats,
       (SELECT count(*) FROM combined c WHERE c.n_p1 = g.n_p1 AND c.variant = g.variant) AS run_seats,
       n_p1 = 35 AS is_default, CAST(600.0 * count(seat_no) AS DOUBLE) AS kw_new
FROM (SELECT DISTINCT n_p1, variant, unnest(units) AS unit FROM seat, nat) g LEFT JOIN combined USING (n_p1, variant, unit)
GROUP BY n_p1, variant, unit
""")
def allocate_combined_q(spark, sf):
    """Combined summary on the full grid setting × variant × nation."""
    units = load(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("unit"))
    out = combined_summary(units, _combined(spark, sf), [v for v, _ in VARIANTS], "variant", "unit",
                           N_SEATS, STEP, N_P1_DEFAULT, unit_kw=UNIT_KW)
    return out.select("n_p1", "variant", "unit", "n_part1", "n_part2", "first_seat", "n_seats",
                      "run_seats", "is_default", "kw_new")


@query("combined_consistency", "WITH RECURSIVE " + _COMBINED_CTE + """,
-- either strategy alone: the largest quotients of one pool
alone AS (
  SELECT who, variant, unit, count(*) AS n FROM (
    SELECT who, variant, units[i] AS unit, row_number() OVER (
        PARTITION BY who, variant ORDER BY votes[i] / CASE j WHEN 1 THEN d1 ELSE 2 * j - 1 END DESC, votes[i] DESC, i, j) AS nth
    FROM (SELECT 'all_first' AS who, units, cust AS votes FROM nat UNION ALL SELECT 'all_second', units, supp FROM nat),
         (VALUES ('base', 1.0::DOUBLE), ('first14', 1.4::DOUBLE)) x(variant, d1), range(1, 26) a(i), range(1, 11) b(j)
    WHERE votes[i] > 0)
  WHERE nth <= 50 GROUP BY ALL),
ends AS (SELECT CASE n_p1 WHEN 50 THEN 'all_first' ELSE 'all_second' END AS who, variant, unit, count(*) AS n FROM combined WHERE n_p1 IN (0, 50) GROUP BY ALL)
SELECT coalesce(e.who, o.who) AS endpoint, coalesce(e.variant, o.variant) AS variant,
       count(*) FILTER (WHERE e.n IS DISTINCT FROM o.n) AS n_units_differ,
       CAST(coalesce(sum(e.n), 0) AS BIGINT) AS n_seats_combined, CAST(coalesce(sum(o.n), 0) AS BIGINT) AS n_seats_own
FROM ends e FULL JOIN alone o ON e.who = o.who AND e.variant = o.variant AND e.unit = o.unit
GROUP BY 1, 2
""")
def combined_consistency_q(spark, sf):
    """n1 = n must equal the first strategy alone, n1 = 0 the second alone."""
    comb = _combined(spark, sf)
    v2 = _with_variants(_votes(spark, sf, "supplier", "s_nationkey"))
    own2 = allocate_seats(v2, ["variant"], "unit", "votes", n_seats=N_SEATS, cap=CAP,
                          first_divisor="first_divisor")
    own1 = _first_seats(spark, sf)

    def per_unit(df):
        return df.groupBy("variant", "unit").agg(F.count(F.lit(1)).alias("n"))

    def endpoint(name, c, o):
        j = per_unit(c).alias("a").join(per_unit(o).alias("b"), ["variant", "unit"], "full")
        return j.select(F.lit(name).alias("endpoint"), "variant",
                        F.coalesce("a.n", F.lit(0)).alias("n_combined"),
                        F.coalesce("b.n", F.lit(0)).alias("n_own"))

    d = (endpoint("all_first", comb.where(F.col("n_p1") == N_SEATS), own1)
         .unionByName(endpoint("all_second", comb.where(F.col("n_p1") == 0), own2)))
    return d.groupBy("endpoint", "variant").agg(
        F.count_if(F.col("n_combined") != F.col("n_own")).cast("long").alias("n_units_differ"),
        F.sum("n_combined").cast("long").alias("n_seats_combined"),
        F.sum("n_own").cast("long").alias("n_seats_own"))


@query("allocation_robustness", """
WITH RECURSIVE n AS (SELECT CAST(n_nationkey AS BIGINT) AS unit, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS c FROM nation),
ballot AS (SELECT concat('a', a, 'd', d) AS run, 10 AS most, d AS d1, list(unit ORDER BY unit) AS units, list(c::DOUBLE ** a ORDER BY unit) AS v
  FROM n, (SELECT unnest([0.5::DOUBLE, 1.0]) AS a), (SELECT unnest([1.0::DOUBLE, 1.4]) AS d) GROUP BY a, d),
""" + _ALONE_SQL + """,
per AS (SELECT n.unit, (SELECT count(*) FROM seats s WHERE s.run = b.run AND s.unit = n.unit) AS got FROM n, ballot b)
SELECT unit, count(*) FILTER (WHERE got > 0) AS n_variants_with_seat, min(got) AS min_seats, max(got) AS max_seats, CAST(sum(got) AS BIGINT) AS total_seats, min(got) > 0 AS robust_all FROM per GROUP BY unit
""")
def allocation_robustness_q(spark, sf):
    """Seats per nation across variants α ∈ {0.5, 1} × first divisor
    {1.0, 1.4} on customers per nation."""
    variants = [("a05_d10", 0.5, 1.0), ("a05_d14", 0.5, 1.4), ("a10_d10", 1.0, 1.0), ("a10_d14", 1.0, 1.4)]
    arr = F.array(*[F.struct(F.lit(v).alias("variant"), F.lit(a).alias("alpha"),
                             F.lit(fd).alias("first_divisor")) for v, a, fd in variants])
    base = (load(spark, sf, "customer").groupBy(F.col("c_nationkey").cast("long").alias("unit"))
            .agg(F.count(F.lit(1)).alias("n")))
    votes = (base.withColumn("_v", F.explode(arr)).select("*", "_v.*").drop("_v")
             .withColumn("votes", F.pow(F.col("n").cast("double"), F.col("alpha"))))
    seats = allocate_seats(votes, ["variant"], "unit", "votes", n_seats=N_SEATS, cap=CAP,
                           first_divisor="first_divisor")
    units = load(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("unit"))
    return robustness(seats, units, "variant", "unit", len(variants))

