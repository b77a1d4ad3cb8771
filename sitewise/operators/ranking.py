"""Rank statistics without one task per group.

A plain ``RANK() OVER (PARTITION BY g ORDER BY v)`` sorts every row of a
group in one task; with one group holding a third of the rows that task is
the whole job.  Here ranks come from a *frequency table* instead:

1. ``groupBy(g, v).count()`` — map-side combined, so ties collapse before
   the shuffle;
2. the table is range-partitioned by (g, v), so a large group spans as many
   partitions as it needs, in order of value;
3. prefix sums run inside each (group, partition) and over the small table
   of (group, partition) totals.

Values keep their type: nothing is cast, so longs beyond 2^53 do not tie.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitewise.session import materialize


ROWS_PER_PART = 200_000


def placed_by_range(df: DataFrame, order_cols: Sequence[str], rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``df`` with ``_part``, the number of its range of ``order_cols``; as
    many ranges as its measured rows need.  The rows are written before, so
    the sampling for the ranges does not compute them again, and the numbers
    are written with them, so later reads agree on them."""
    df = materialize(df)
    parts = max(1, math.ceil(df.count() / rows_per_part))
    return materialize(df.repartitionByRange(parts, *order_cols).withColumn("_part", F.spark_partition_id()))


def order_stats(df: DataFrame, group_cols: Sequence[str], value_col: str, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Per distinct non-null (group, value): ``n_ties``, ``n_before`` (rows
    with a smaller value in the group) and ``n_total`` (non-null rows)."""
    g = list(group_cols)
    freq = df.where(F.col(value_col).isNotNull()).groupBy(*g, value_col).agg(F.count(F.lit(1)).alias("_n"))
    placed = placed_by_range(freq, [*g, value_col], rows_per_part)
    ahead = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*g, "_part").orderBy(value_col).rowsBetween(*ahead)
    totals = placed.groupBy(*g, "_part").agg(F.sum("_n").alias("_rows"))
    across = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    totals = (totals.withColumn("_earlier", F.coalesce(F.sum("_rows").over(across.orderBy("_part").rowsBetween(*ahead)), F.lit(0)))
                    .withColumn("n_total", F.sum("_rows").over(across).cast("long")).drop("_rows"))
    placed = placed.withColumn("_here", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    same = F.col("_part") == F.col("_t__part")
    for c in g:  # a null group is a group
        same = same & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    out = placed.join(totals.select(*[F.col(c).alias(f"_t_{c}") for c in [*g, "_part"]], "_earlier", "n_total"), same)
    return out.select(*g, value_col, F.col("_n").cast("long").alias("n_ties"),
                      (F.col("_earlier") + F.col("_here")).cast("long").alias("n_before"), "n_total")


def with_order_stats(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """``df`` with the order statistics of each row's value, null for a null value."""
    g = list(group_cols)
    st = order_stats(df, g, value_col)
    names = {c: f"_s_{c}" for c in [*g, value_col]}
    same = F.col(value_col) == F.col(names[value_col])
    for c in g:
        same = same & F.col(c).eqNullSafe(F.col(names[c]))
    return df.join(st.withColumnsRenamed(names), same, "left").drop(*names.values())


def midrank_percentile(df: DataFrame, group_cols: Sequence[str], value_col: str,
                       better_col: str | None = None, out_col: str = "pct_rank",
                       with_counts: bool = False) -> DataFrame:
    """Percentile position 0 (worst) … 1 (best); ties share the midrank.

    Rows worse than this one, plus half of its ties, over all others; where
    ``better_col`` says ``lower`` the worse rows are those with larger values
    (an infinite one is worst).  N = 1 gives 0.5 (the one unit sits in the
    middle).  NULL values get NULL.
    """
    out = with_order_stats(df, group_cols, value_col)
    larger = F.col("n_total") - F.col("n_before") - F.col("n_ties")
    worse = F.when(F.col(better_col) == "lower", larger).otherwise(F.col("n_before")) if better_col else F.col("n_before")
    pct = F.when(F.col("n_total") == 1, F.lit(0.5)).otherwise(
        (worse + (F.col("n_ties") - 1) / 2.0) / (F.col("n_total") - 1))
    out = out.withColumn(out_col, pct.cast("double"))
    return out.withColumn("n_before", worse) if with_counts else out.drop("n_ties", "n_before", "n_total")


def rank_column(df: DataFrame, group_cols: Sequence[str], value_col: str,
                descending: bool = False, out_col: str = "rnk", nulls: str | None = "last") -> DataFrame:
    """SQL ``RANK()`` (ties share the lowest rank) computed from
    :func:`order_stats`; ``descending`` ranks the largest value 1.  NULL
    values rank after all others (``nulls="last"``), before them
    (``"first"``) or not at all (None)."""
    g = list(group_cols)
    out = with_order_stats(df, g, value_col)
    ahead = F.col("n_total") - F.col("n_before") - F.col("n_ties") if descending else F.col("n_before")
    rank = ahead + 1
    if nulls is not None:
        # one row a group: its rows with and without a value
        sizes = df.groupBy(*g).agg(F.count(value_col).alias("_known"), F.count_if(F.col(value_col).isNull()).alias("_null"))
        if g:
            same = F.lit(True)
            for c in g:
                same = same & F.col(c).eqNullSafe(F.col(f"_z_{c}"))
            out = out.join(sizes.withColumnsRenamed({c: f"_z_{c}" for c in g}), same).drop(*[f"_z_{c}" for c in g])
        else:
            out = out.withColumn("_known", sizes.select("_known").scalar()).withColumn("_null", sizes.select("_null").scalar())
        rank = (F.coalesce(rank, F.col("_known") + 1) if nulls == "last"
                else F.coalesce(rank + F.col("_null"), F.lit(1)))
    return out.withColumn(out_col, rank.cast("long")).drop("n_ties", "n_before", "n_total", "_known", "_null")


def percentile_cont(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    p: float, out_col: str) -> DataFrame:
    """Exact interpolated percentile per group (SQL ``percentile`` /
    ``quantile_cont``) from :func:`order_stats`: one row per group."""
    g = list(group_cols)
    st = order_stats(df.select(*g, value_col), g, value_col)
    pos = F.lit(p) * (F.col("n_total") - 1)
    lo, hi = F.floor(pos), F.ceil(pos)
    covers = lambda k: (F.col("n_before") <= k) & (k < F.col("n_before") + F.col("n_ties"))
    agg = (st.where(covers(lo) | covers(hi))
             .groupBy(*g)
             .agg(F.max(F.when(covers(lo), F.col(value_col))).alias("_lo"),
                  F.max(F.when(covers(hi), F.col(value_col))).alias("_hi"),
                  F.max(pos - lo).alias("_f")))
    return agg.select(*g, (F.col("_lo") + F.col("_f") * (F.col("_hi") - F.col("_lo"))).alias(out_col))


def spearman(df: DataFrame, group_cols: Sequence[str], a_col: str, b_col: str,
             out_col: str = "spearman") -> DataFrame:
    """Correlation of the RANKs of two columns (rank ties at the minimum,
    as ``corr(rank…)`` in SQL).  One row per group."""
    g = list(group_cols)
    r = rank_column(df, g, a_col, out_col="_ra", nulls=None)
    r = rank_column(r, g, b_col, out_col="_rb", nulls=None)
    agg = F.corr(F.col("_ra").cast("double"), F.col("_rb").cast("double")).alias(out_col)
    return r.groupBy(*g).agg(agg) if g else r.agg(agg)
