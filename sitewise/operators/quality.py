"""Row expectations, completeness and reconciliation checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class ExpectationFailed(Exception):
    """Raised when a rule with ``on_violation='fail'`` has failing rows."""


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column
    on_violation: str = "warn"  # warn | drop | fail
    on_null: str = "fail"  # how a NULL predicate counts: fail | pass


def passes(rule: Rule) -> Column:
    return F.coalesce(rule.predicate, F.lit(rule.on_null == "pass"))


def expect(df: DataFrame, rules: Sequence[Rule], name: str = "expectations"):
    """Apply expectations in one pass.

    Returns ``(df_out, observation)``: ``drop`` rules filter, all rules are
    counted by a ``DataFrame.observe`` metric (``fail_<rule>``).  After the
    caller's action, :func:`raise_on_failures` checks the ``fail`` rules —
    write to a staging location first and publish only if it passes.
    """
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("n_rows")]
    metrics += [F.count_if(~passes(r)).alias(f"fail_{r.name}") for r in rules]
    out = df.observe(obs, *metrics)
    for r in rules:
        if r.on_violation == "drop":
            out = out.where(passes(r))
    return out, obs


def raise_on_failures(obs: Observation, rules: Sequence[Rule]) -> dict:
    got = obs.get
    bad = [r.name for r in rules if r.on_violation == "fail" and got.get(f"fail_{r.name}", 0) > 0]
    if bad:
        raise ExpectationFailed(f"failed expectations: {', '.join(bad)}")
    return got


def expectation_report(df: DataFrame, rules: Sequence[Rule],
                       key_rules: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One row per rule: rule, severity, n_rows, n_fail, n_pass.

    Row rules are counted in one aggregate; a key-uniqueness rule counts the
    rows whose key occurs more than once from a keyed aggregate (partial
    combine; no join back to the rows).
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(~passes(r)).alias(r.name) for r in rules]
    one = df.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.on_violation).alias("severity"),
                 F.col(r.name).cast("long").alias("n_fail")) for r in rules]))
    rows = one.select("n_rows", stack.alias("s")).select("s.rule", "s.severity", "n_rows", "s.n_fail")
    for name, keys in (key_rules or {}).items():
        dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                 .agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("n_fail"),
                      F.sum("_n").alias("n_rows")))
        rows = rows.unionByName(dup.select(F.lit(name).alias("rule"), F.lit("fail").alias("severity"),
                                           F.col("n_rows").cast("long").alias("n_rows"),
                                           F.col("n_fail").cast("long").alias("n_fail")))
    return rows.withColumn("n_rows", F.col("n_rows").cast("long")).withColumn(
        "n_pass", F.col("n_rows") - F.col("n_fail"))


def local_day_quarters(day: Column, tz: str) -> Column:
    """Quarter-hours in the local calendar day ``day`` of time zone ``tz``:
    92 on the spring-forward day, 100 on the fall-back day, else 96."""
    start = F.convert_timezone(F.lit(tz), F.lit("UTC"), day.cast("timestamp_ntz"))
    end = F.convert_timezone(F.lit(tz), F.lit("UTC"), F.date_add(day, 1).cast("timestamp_ntz"))
    secs = F.timestamp_diff("SECOND", start, end)  # NTZ difference: no session time zone involved
    return (secs / 900).cast("long")


def local_date(ts: Column, tz: str) -> Column:
    """Local calendar date of a UTC wall-clock timestamp."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), ts.cast("timestamp_ntz")))


def reconcile(children: DataFrame, parents: DataFrame, keys: Sequence[str], child_col: str,
              parent_col: str, rule_col: str, rounding_unit: float = 0.01) -> DataFrame:
    """Σ children vs the published parent total per key, judged by ``rule``.

    ``rule_col`` names the rule of each child row (constant per key): exact (diff = 0), rounding
    (|diff| <= half a ``rounding_unit`` per child: the unit is that of the published figures), suppressed (diff <= 0),
    unallocated (diff <= 0 and |diff| <= 1 % of the parent), noise
    (|diff| <= 0.001 % of the parent); a missing parent fails.
    """
    k = list(keys)
    s = children.groupBy(*k, rule_col).agg(F.count(F.lit(1)).alias("n_children"),
                                 F.count_if(F.col(child_col).isNull()).alias("n_null_children"),
                                 F.sum(child_col).alias("sum_children"))
    j = s.join(parents.select(*k, F.col(parent_col).alias("parent")), k, "left")
    j = j.withColumn("diff", F.col("sum_children") - F.col("parent")).withColumn("rule", F.col(rule_col))
    d, p, n = F.col("diff"), F.col("parent"), F.col("n_children")
    within = (F.when(F.col("parent").isNull(), F.lit(False))
               .when(F.col("rule") == "exact", d == 0)
               .when(F.col("rule") == "rounding", F.abs(d) <= F.lit(rounding_unit / 2) * n)
               .when(F.col("rule") == "suppressed", d <= 0)
               .when(F.col("rule") == "unallocated", (d <= 0) & (F.abs(d) <= F.lit(0.01) * F.abs(p)))
               .when(F.col("rule") == "noise", F.abs(d) <= F.lit(0.00001) * F.abs(p)))
    return j.withColumn("within_rule", F.coalesce(within, F.lit(False)))


def cross_source_diff(a: DataFrame, b: DataFrame, keys: Sequence[str], a_col: str, b_col: str) -> DataFrame:
    """Full outer comparison of two sources on keys: both present, diff = 0."""
    k = list(keys)
    j = a.select(*k, a_col).join(b.select(*k, b_col), k, "full")
    return (j.withColumn("diff", F.col(a_col) - F.col(b_col))
             .withColumn("both_present", F.col(a_col).isNotNull() & F.col(b_col).isNotNull())
             .withColumn("same", F.coalesce(F.col("diff") == 0, F.lit(False))))


def duplicate_audit(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per table: rows, distinct keys, duplicate keys Σ(n-1) over n > 1 and
    the number of keys occurring more than once."""
    out = None
    for name, (df, keys) in tables.items():
        per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        row = per.agg(F.sum("_n").cast("long").alias("n_rows"),
                      F.count(F.lit(1)).cast("long").alias("n_keys"),
                      F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0)).cast("long")
                       .alias("n_duplicate_rows"),
                      F.count_if(F.col("_n") > 1).cast("long").alias("n_duplicated_keys"))
        row = row.select(F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_cols"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def column_profile(df: DataFrame, cols: Sequence[str] | None = None, max_set: int = 0) -> DataFrame:
    """Per column: rows, NULLs, distinct non-null values, and values that are
    no integer (texts and fractions; of a number or text column).  With
    ``max_set`` also the values themselves, sorted, where they are as few.

    Each column is read and aggregated by its values on its own, so a scan
    reads that column alone and no row is multiplied."""
    out = None
    for c in cols or df.columns:
        per = df.select(F.col(c).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        text = F.col("v").cast("string")
        odd = F.col("v").isNotNull() & ~F.coalesce(text.try_cast("double") == F.floor(text.try_cast("double")), F.lit(False))
        few = F.when(F.count("v") <= max_set, F.concat_ws("|", F.array_sort(F.collect_set(F.when(F.lit(max_set > 0), text))))) if max_set else F.lit(None).cast("string")
        one = per.agg(F.lit(c).alias("column_name"), F.sum("n").alias("n_rows"), F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
                      F.count("v").alias("n_distinct"), F.sum(F.when(odd, F.col("n")).otherwise(0)).alias("n_not_integer"), few.alias("value_set"))
        one = one.select("column_name", *[F.coalesce(F.col(k), F.lit(0)).cast("long").alias(k) for k in ("n_rows", "n_null", "n_distinct", "n_not_integer")], "value_set")
        out = one if out is None else out.unionByName(one)
    return out


class DuplicateKeys(Exception):
    """Raised by :func:`record_audit` when tables have duplicate keys."""


def record_audit(audit: DataFrame, log_path: str, run_id: str, strict: bool = True) -> DataFrame:
    """Append a duplicate audit (one row per table) to a run log in the
    shared folder, stamped with the run id and time; with ``strict`` raise
    naming every table that has duplicate keys.  Returns the logged rows."""
    rows = audit.withColumn("run_id", F.lit(run_id)).withColumn("logged_at", F.current_timestamp())
    rows.write.mode("append").parquet(log_path)
    logged = rows.sparkSession.read.parquet(log_path).where(F.col("run_id") == run_id)
    if strict:
        bad = [r.table_name for r in logged.where(F.col("n_duplicate_rows") > 0).select("table_name").collect()]
        if bad:
            raise DuplicateKeys(f"duplicate keys in: {', '.join(sorted(bad))}")
    return logged
