"""Rules kept as data: patterns that name a rule, predicates that decide it.

Both tables are parameters (tens of rows), so they are read once and compiled
into one expression: which rule a label falls under (the first pattern that
matches, in order), and whether a row keeps that rule.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class RuleTableError(Exception):
    """The table of rules contradicts itself."""


def matches(col: Column, kind: str, pattern: str) -> Column:
    """Kinds of pattern: equals, like, rlike, in (values with a bar between)."""
    kinds = {"equals": lambda: col == pattern, "like": lambda: col.like(pattern), "rlike": lambda: col.rlike(pattern), "in": lambda: col.isin(*pattern.split("|"))}
    if kind not in kinds:
        raise RuleTableError(f"unknown kind of pattern {kind}")
    return kinds[kind]()


def classify(label: Column, classifier: Sequence[tuple[int, str, str, str]], default: str | None = None) -> Column:
    """Rule of a label from (position, kind, pattern, rule) rows: the row of
    the least position that matches decides.  NULL labels match nothing."""
    if len({c[0] for c in classifier}) != len(classifier):
        raise RuleTableError("two patterns have one position")
    out = F.lit(default)
    for _, kind, pattern, rule in sorted(classifier, reverse=True):
        out = F.when(matches(label, kind, pattern), F.lit(rule)).otherwise(out)
    return out


def judged(rule: Column, predicates: Mapping[str, str]) -> Column:
    """Whether a row keeps its rule: the SQL predicate of the rule's name over
    the row's columns.  An unknown rule or a NULL predicate is not kept."""
    out = F.lit(False)
    for name, predicate in predicates.items():
        out = F.when(rule == name, F.coalesce(F.expr(predicate), F.lit(False))).otherwise(out)
    return out


#: Tolerances of the classes: figures that must agree, that were rounded to
#: ``unit`` each, that were partly withheld, that have a remainder without a
#: place (at most 1 %), and that had noise added (at most 0.001 %).
RECONCILE_PREDICATES = {
    "exact": "n_null_children = 0 AND diff = 0",
    "rounding": "n_null_children = 0 AND abs(diff) <= unit / 2 * n_children",
    "suppressed": "diff <= 0 AND (n_null_children > 0 OR diff = 0)",
    "unallocated": "n_null_children = 0 AND diff <= 0 AND abs(diff) <= 0.01 * abs(parent)",
    "noise": "n_null_children = 0 AND abs(diff) <= 0.00001 * abs(parent)",
}


def reconcile_by_rules(children: DataFrame, parents: DataFrame, keys: Sequence[str], label_col: str, child_col: str, parent_col: str,
                       classifier: Sequence[tuple[int, str, str, str]], predicates: Mapping[str, str] = RECONCILE_PREDICATES,
                       unit: float = 1.0, default: str | None = "exact") -> DataFrame:
    """Sums of the children against the published parent of each key, judged
    by the rule that the key's label falls under.

    keys, label, rule, n_children, n_null_children, sum_children, parent,
    diff, within_rule and ``why`` (kept, broken, no_parent, no_rule).  Labels
    that differ within a key are judged apart.  NULL children count as
    withheld, which only a rule that says so allows.
    """
    k = list(keys)
    sums = children.groupBy(*k, F.col(label_col).alias("label")).agg(
        F.count(F.lit(1)).alias("n_children"), F.count_if(F.col(child_col).isNull()).alias("n_null_children"), F.sum(child_col).alias("sum_children"))
    out = sums.join(parents.select(*k, F.col(parent_col).alias("parent")), k, "left")
    out = out.withColumn("diff", F.coalesce("sum_children", F.lit(0)) - F.col("parent")).withColumn("unit", F.lit(unit))
    out = out.withColumn("rule", classify(F.col("label"), classifier, default))
    out = out.withColumn("within_rule", F.col("parent").isNotNull() & judged(F.col("rule"), predicates))
    why = F.when(F.col("parent").isNull(), "no_parent").when(F.col("rule").isNull(), "no_rule").when(F.col("within_rule"), "kept").otherwise("broken")
    return out.withColumn("why", why).drop("unit")
