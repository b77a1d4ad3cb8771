"""Weighted scoring over strategy × variant runs.

A *run* is a strategy (weights per metric, α, quantity metric) crossed with
a robustness variant that may swap one metric for another, override α or
the quantity, or switch the cost factor off; a variant restricted to one
strategy (``only_scenario``) runs only there.  All parameter tables are
small literal frames; they ride along as generators/one-row scalars or as
joins on their keys, never as a cartesian product of data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.operators.ranking import rank_column


def normalise_weights(weights: DataFrame, group_col: str = "scenario",
                      raw_col: str = "weight_raw", out_col: str = "weight") -> DataFrame:
    """``w / Σ w`` per group (W8)."""
    tot = weights.groupBy(group_col).agg(F.sum(raw_col).alias("weight_sum"))
    return weights.join(tot, group_col).withColumn(out_col, F.col(raw_col) / F.col("weight_sum"))


def expand_runs(weights: DataFrame, variants: DataFrame) -> DataFrame:
    """Component rows per run: (scenario, variant, component, metric_used,
    weight).  ``weights``: scenario, metric, weight; ``variants``: variant,
    swap_from, swap_to, only_scenario (NULL = all).  Both are parameter
    tables, so the scenarios' names ride along as one array."""
    names = weights.agg(F.array_sort(F.collect_set("scenario"))).scalar()
    runs = variants.withColumn("scenario", F.explode(names))
    runs = runs.where(F.col("only_scenario").isNull() | (F.col("only_scenario") == F.col("scenario")))
    comp = weights.join(runs, "scenario")
    return comp.select(
        "scenario", "variant", F.col("metric").alias("component"),
        F.when(F.col("metric") == F.col("swap_from"), F.col("swap_to")).otherwise(F.col("metric"))
         .alias("metric_used"),
        "weight")


def score_components(runs: DataFrame, metrics: DataFrame, unit_col: str, units: DataFrame | None = None) -> DataFrame:
    """contribution = weight × percentile position of the metric used.

    One row for every unit and component of a run, whether or not the unit
    has the metric: a missing one leaves value and contribution NULL.
    ``units`` lists the units (default: those with any metric)."""
    m = metrics.select(unit_col, F.col("metric").alias("metric_used"), "value", "pct_rank")
    units = metrics if units is None else units
    # the runs are a parameter table (strategies × variants × weights): one array
    every = runs.agg(F.collect_list(F.struct(*runs.columns))).scalar()
    rows = units.select(unit_col).distinct().withColumn("_run", F.explode(every)).select(unit_col, "_run.*")
    return (rows.join(m, [unit_col, "metric_used"], "left")
                .withColumn("contribution", F.col("weight") * F.col("pct_rank")))


def score(components: DataFrame, strategies: DataFrame, variants: DataFrame,
          quantities: DataFrame, costs: DataFrame, unit_col: str,
          digits: tuple[int, int] | None = None) -> DataFrame:
    """Attractiveness Σ contribution and votes = quantity^α × a ÷ cost.

    ``n_expected`` counts the components that the run's weights ask for.  A
    unit that lacks a metric, by a NULL or by a missing row, has fewer
    ``n_components`` and neither attractiveness nor votes; one without the
    quantity or a cost has no votes.  Callers reject them
    (:func:`sitewise.operators.quality.expect`).  ``digits`` rounds
    attractiveness and votes, so that ties in their ranks (:func:`with_ranks`)
    do not hang on the order of summation.

    ``strategies``: scenario, alpha, quantity; ``variants``: variant, alpha,
    quantity, use_cost_factor, only_scenario; ``quantities``: unit, metric,
    value; ``costs``: unit, cost_factor.
    """
    s = components.groupBy("scenario", "variant", unit_col).agg(
        F.sum("contribution").alias("attractiveness"),
        F.count("contribution").alias("n_components"), F.count(F.lit(1)).alias("n_expected"))
    s = s.withColumn("attractiveness", F.when(F.col("n_components") == F.col("n_expected"), F.col("attractiveness")))
    if digits:
        s = s.withColumn("attractiveness", F.round("attractiveness", digits[0]))
    st = strategies.select("scenario", F.col("alpha").alias("_sa"), F.col("quantity").alias("_sq"))
    va = variants.select("variant", F.col("alpha").alias("_va"), F.col("quantity").alias("_vq"),
                         "use_cost_factor")
    b = (s.join(st, "scenario").join(va, "variant")
          .withColumn("alpha", F.coalesce("_va", "_sa"))
          .withColumn("quantity", F.coalesce("_vq", "_sq"))
          .drop("_va", "_sa", "_vq", "_sq"))
    q = quantities.select(unit_col, F.col("metric").alias("quantity"), F.col("value").alias("quantity_value"))
    b = (b.join(q, [unit_col, "quantity"], "left").join(costs, unit_col, "left")
          .withColumn("cost_factor", F.when(F.col("use_cost_factor"), F.col("cost_factor"))
                                      .otherwise(F.lit(1.0)).cast("double"))
          .drop("use_cost_factor"))
    b = b.withColumn("votes", F.pow(F.col("quantity_value"), F.col("alpha")) * F.col("attractiveness")
                     / F.col("cost_factor"))
    if digits:
        b = b.withColumn("votes", F.round("votes", digits[1]))
    return b


def with_ranks(scores: DataFrame) -> DataFrame:
    """The two ranks of a unit in its run; seats need none, so they are apart."""
    run = ["scenario", "variant"]
    ranked = rank_column(scores, run, "attractiveness", descending=True, out_col="attractiveness_rank")
    return rank_column(ranked, run, "votes", descending=True, out_col="votes_rank")
