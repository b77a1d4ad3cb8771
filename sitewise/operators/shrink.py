"""Empirical-Bayes shrinkage of unit shares towards their parent share.

Method of moments: the spread of unit shares around their parent's share,
minus the expected binomial sampling variance, estimates the between-unit
variance τ²; the prior strength is ``k = p(1-p)/τ² - 1`` (floored at 0) with
``p`` the overall share.  ``τ² <= 0`` means no real spread: ``k`` is NULL
and every unit takes its parent share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def moment_prior(df: DataFrame, x_col: str, n_col: str, parent_share_col: str):
    """(tau2, k) as scalar-subquery columns over units with n > 0."""
    x, n, pc = F.col(x_col), F.col(n_col), F.col(parent_share_col)
    base = df.where(n > 0)
    tau2 = base.agg(
        (F.avg(F.pow(x / n - pc, 2)) - F.avg(pc * (1 - pc) / n)).alias("tau2")).scalar()
    p_nat = df.agg(F.try_divide(F.sum(x), F.sum(n)).alias("p")).scalar()
    k = F.when(tau2 > 0, F.greatest(p_nat * (1 - p_nat) / tau2 - 1, F.lit(0.0)))
    return tau2, k, p_nat


def eb_shrink(units: DataFrame, parent_col: str, x_col: str = "x", n_col: str = "n",
              out_col: str = "value") -> DataFrame:
    """Per unit: parent share ``p_c``, overall share ``p_nat``, τ², ``k``,
    the shrunk share ``(x + k·p_c)/(n + k)`` (``p_c`` when k is NULL) and the
    raw share ``x/n`` (NULL for n = 0)."""
    x, n = F.col(x_col).cast("double"), F.col(n_col).cast("double")
    u = units.withColumn(x_col, x).withColumn(n_col, n)
    parents = u.groupBy(parent_col).agg(
        F.try_divide(F.sum(x_col), F.sum(n_col)).alias("p_c"))
    u = u.join(parents, parent_col, "left")
    tau2, k, p_nat = moment_prior(u, x_col, n_col, "p_c")
    u = u.withColumn("p_nat", p_nat).withColumn("tau2", tau2).withColumn("k", k)
    shrunk = F.when(F.col("k").isNull(), F.col("p_c")).otherwise(
        F.try_divide(F.col(x_col) + F.col("k") * F.col("p_c"), F.col(n_col) + F.col("k")))
    return (u.withColumn(out_col, shrunk)
             .withColumn("raw", F.try_divide(F.col(x_col), F.col(n_col))))
