"""Smaller checks and code-level helpers used by the warehouse queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.session import materialize

TRUE_WORDS = ("true", "t", "1", "yes", "y", "ja", "j")
FALSE_WORDS = ("false", "f", "0", "no", "n", "nej")


def tolerant_bool(c: Column, blank: bool | None = False) -> Column:
    """Lenient boolean parse; a blank text is ``blank`` (seeds leave a flag
    empty for no), anything unknown is NULL (and then fails a NOT NULL
    expectation)."""
    s = F.lower(F.trim(c))
    return F.when(s == "", F.lit(blank).cast("boolean")).when(s.isin(*TRUE_WORDS), F.lit(True)).when(s.isin(*FALSE_WORDS), F.lit(False))


def parse_position(c: Column) -> tuple[Column, Column]:
    """"(lat,lon)" → (lat, lon) as doubles; malformed parts are NULL."""
    parts = F.split(F.regexp_replace(c, r"[()\s]", ""), ",")
    return (F.try_element_at(parts, F.lit(1)).try_cast("double"), F.try_element_at(parts, F.lit(2)).try_cast("double"))


def parse_wkt_point(c: Column) -> tuple[Column, Column]:
    """"POINT (x y)" → (x, y)."""
    inner = F.regexp_extract(c, r"POINT\s*\(\s*([^)]*)\)", 1)
    parts = F.split(F.trim(inner), r"\s+")
    return (F.try_element_at(parts, F.lit(1)).try_cast("double"), F.try_element_at(parts, F.lit(2)).try_cast("double"))


def decode_codes(code: Column, mapping: Mapping[str, tuple]) -> Column:
    """Code → struct of attributes from a literal map (small fixed lookup)."""
    keys = list(mapping)
    width = len(next(iter(mapping.values())))
    entries = []
    for k in keys:
        entries += [F.lit(k), F.struct(*[F.lit(v).alias(f"f{i}") for i, v in enumerate(mapping[k])])]
    m = F.create_map(*entries)
    assert width > 0
    return F.element_at(m, code)


def in_box(x: Column, y: Column, xmin: float, xmax: float, ymin: float, ymax: float) -> Column:
    """Bounding-box validity; NULL coordinates are invalid."""
    return F.coalesce(x.between(xmin, xmax) & y.between(ymin, ymax), F.lit(False))


def retired_code_check(df: DataFrame, code_col: str, codes: Sequence[str], value_col: str,
                       status_col: str | None = None, suppressed: str = "..") -> DataFrame:
    """Retired codes must hold nothing: no positive value and every NULL
    marked as suppressed.  One row per retired code present."""
    v = F.col(value_col)
    marked = F.col(status_col).eqNullSafe(suppressed) if status_col else F.lit(False)
    # one label a cell, then a count of each
    kind = (F.when(v.isNull() & marked, "marked").when(v.isNull(), "unmarked")
             .when(v == 0, "zero").when(v > 0, "positive").otherwise("negative"))
    names = ["marked", "unmarked", "zero", "positive", "negative"]
    cells = df.where(F.col(code_col).isin(*codes)).withColumn("_kind", kind)
    per = cells.groupBy(code_col).pivot("_kind", names).count().fillna(0)
    return per.select(
        code_col, sum((F.col(k) for k in names), F.lit(0)).cast("long").alias("n_cells"), F.col("zero").alias("n_zero"),
        (F.col("marked") + F.col("unmarked")).alias("n_null"), F.col("positive").alias("n_positive"),
        F.col("unmarked").alias("n_null_unmarked"), ((F.col("positive") == 0) & (F.col("unmarked") == 0)).alias("holds_nothing"))


def hierarchy_gap(df: DataFrame, value: Column, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Total vs the sum over each grouping level: one row per level with the
    number of groups and the gap to the grand total (exact for decimals)."""
    # one read of the rows: the sums of the finest groups, from which every level follows
    finest = list(dict.fromkeys(c for cols in levels.values() for c in cols))
    sums = materialize(df.groupBy(*finest).agg(F.sum(value).alias("s")))
    total = sums.agg(F.sum("s")).scalar()
    out = None
    for name, cols in levels.items():
        per = sums.groupBy(*cols).agg(F.sum("s").alias("s"))
        row = per.agg(F.lit(name).alias("level"), F.count(F.lit(1)).alias("n_groups"),
                      F.sum("s").alias("sum_groups"))
        row = row.withColumn("total", total).withColumn("gap", F.col("sum_groups") - F.col("total"))
        out = row if out is None else out.unionByName(row)
    return out


def with_counters(df: DataFrame, counters: Mapping[str, Sequence[str]]) -> DataFrame:
    """``df`` with, for each named counter, how many rows share a row's values
    of the columns (NULL equals NULL).  The counts are aggregated first and
    joined back, so a value that most rows share is not one task."""
    out = df
    for name, cols in counters.items():
        same = [F.col(c) for c in cols]
        per = df.groupBy(*[c.alias(f"_k{i}") for i, c in enumerate(same)]).agg(F.count(F.lit(1)).alias(name))
        on = F.lit(True)
        for i, c in enumerate(cols):
            on = on & out[c].eqNullSafe(per[f"_k{i}"])
        out = out.join(per, on).drop(*[f"_k{i}" for i in range(len(cols))])
    return out


def label_mismatch(a: DataFrame, b: DataFrame, code: str, label: str) -> DataFrame:
    """Codes of two seeds whose labels differ, or that one seed lacks: code,
    label_a, label_b, kind (only_a, only_b, label, spelling).  ``spelling``:
    alike but for letters' case, blanks around and runs of blanks."""
    x = a.select(F.col(code).alias("code"), F.col(label).alias("label_a"), F.lit(True).alias("_a"))
    y = b.select(F.col(code).alias("code"), F.col(label).alias("label_b"), F.lit(True).alias("_b"))
    both = x.join(y, "code", "full")
    plain = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    kind = (F.when(F.col("_b").isNull(), "only_a").when(F.col("_a").isNull(), "only_b").when(F.col("label_a").eqNullSafe(F.col("label_b")), None)
            .when(plain(F.col("label_a")).eqNullSafe(plain(F.col("label_b"))), "spelling").otherwise("label"))
    return both.withColumn("kind", kind).where("kind IS NOT NULL").select("code", "label_a", "label_b", "kind")


def either_timestamp(c: Column, *formats: str) -> Column:
    """The first of the formats that reads the text, as wall clock; NULL if none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats])


def set_difference(a: DataFrame, b: DataFrame, a_key: str, b_key: str, a_name: str, b_name: str) -> DataFrame:
    """Two-sided difference of key sets (null-safe ``NOT IN`` both ways as
    anti joins): side, n_keys."""
    ka = a.select(F.col(a_key).alias("k")).where(F.col("k").isNotNull()).distinct()
    kb = b.select(F.col(b_key).alias("k")).where(F.col("k").isNotNull()).distinct()
    only_a = ka.join(kb, "k", "left_anti").agg(F.count(F.lit(1)).alias("n_keys")).withColumn(
        "side", F.lit(f"only_in_{a_name}"))
    only_b = kb.join(ka, "k", "left_anti").agg(F.count(F.lit(1)).alias("n_keys")).withColumn(
        "side", F.lit(f"only_in_{b_name}"))
    return only_a.unionByName(only_b).select("side", "n_keys")


def level_filter(df: DataFrame, code_col: str, code_length: int, retired: Sequence[str] = ()) -> DataFrame:
    """Keep one level of a code hierarchy by code length, without retired
    codes (e.g. four-digit municipality codes, minus a merged one)."""
    c = F.col(code_col)
    keep = F.length(c) == code_length
    if retired:
        keep = keep & ~c.isin(*retired)
    return df.where(keep)
