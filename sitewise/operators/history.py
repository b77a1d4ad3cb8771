"""SCD type 2 history from a change feed and from full snapshots.

Change feed (:func:`scd2_from_changes`): a key gets a new version only when
a *tracked* column changes (null-safe); changes in untracked columns update
the open version in place (the version carries the newest untracked values).

The sequential part — "is this row different from the previous row of the
same key?" — is a prefix scan.  Instead of one window per key (a hot key
would be one task), rows are windowed per (key, bucket), where the bucket is
a coarse slice of the sequence (e.g. the day); the one value that crosses a
bucket boundary — the previous bucket's last row, or its last version start
— comes from a per-(key, bucket) summary table whose per-key length is the
number of buckets, not the number of rows.

Snapshots (:func:`scd2_from_snapshots`): one row per key and snapshot; a key
absent from a snapshot is closed there, a reappearance opens a new version.
Per key there is at most one row per snapshot, so a per-key window is
bounded by the number of snapshots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType


def _struct(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def scd2_from_changes(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                      tracked: Sequence[str], untracked: Sequence[str] = (),
                      bucket: Column | None = None, count_col: str | None = None) -> DataFrame:
    """Versions: keys, tracked…, untracked… (newest in the version),
    ``start_at``/``end_at`` (first order column of the version's first row /
    of the next version's first row), ``is_current``, ``n_rows``.

    Rows with the same key and order values are collapsed to one (the
    largest by value), so a replayed delivery adds nothing.  ``count_col``
    holds the number of rows that a row stands for (default 1 each); a
    ``bucket`` may name a column that is not among the others.
    """
    k, o, t, u = list(keys), list(order_cols), list(tracked), list(untracked)
    first = o[0]
    if bucket is not None:
        b = bucket
    elif isinstance(df.schema[first].dataType, (DateType, TimestampType, TimestampNTZType)):
        b = F.to_date(F.col(first))  # day slices of a temporal sequence
    else:
        b = F.lit(0)  # numeric sequence: pass a bucket (e.g. floor(seq / width)) to split hot keys
    # collapse exact replays of the same sequence position
    u_own = [c for c in u if c not in o]  # untracked columns that are not order columns
    n_each = F.col(count_col) if count_col else F.lit(1)
    rows = (df.withColumn("_b", b).groupBy(*k, *o).agg(F.max(_struct([*t, *u_own])).alias("_v"), F.max("_b").alias("_b"), F.max(n_each).alias("_n"))
              .select(*k, *o, "_b", "_n", *[F.col(f"_v.{c}").alias(c) for c in [*t, *u_own]])
              .withColumn("_o", _struct(o))
              .withColumn("_t", _struct(t)))

    # previous tracked value: inside the bucket by lag, across buckets from the summary
    wb = Window.partitionBy(*k, "_b").orderBy(*o)
    rows = rows.withColumn("_prev_in", F.lag("_t").over(wb))
    summ = rows.groupBy(*k, "_b").agg(F.max(F.struct("_o", "_t")).alias("_last"))
    wk = Window.partitionBy(*k).orderBy("_b")
    summ = summ.select(*k, "_b", F.lag(F.col("_last._t")).over(wk).alias("_prev_b"))
    rows = rows.join(summ, [*k, "_b"])
    prev = F.coalesce(F.col("_prev_in"), F.col("_prev_b"))
    rows = rows.withColumn("_chg", prev.isNull() | ~prev.eqNullSafe(F.col("_t")))

    # version start of each row: last change at or before it
    rows = rows.withColumn(
        "_vs_in", F.last(F.when(F.col("_chg"), F.col("_o")), ignorenulls=True)
                   .over(wb.rowsBetween(Window.unboundedPreceding, 0)))
    cs = rows.groupBy(*k, "_b").agg(F.max(F.when(F.col("_chg"), F.col("_o"))).alias("_lc"))
    cs = cs.select(*k, "_b", F.last("_lc", ignorenulls=True)
                   .over(wk.rowsBetween(Window.unboundedPreceding, -1)).alias("_vs_prev"))
    rows = rows.join(cs, [*k, "_b"]).withColumn("_vs", F.coalesce("_vs_in", "_vs_prev"))

    ver = rows.groupBy(*k, "_vs").agg(
        F.max(F.struct("_o", "_t", _struct(u_own).alias("_u") if u_own else F.lit(None).alias("_u")))
         .alias("_lastrow"),
        F.sum("_n").alias("n_rows"),
        F.min(F.when(F.col("_chg"), F.col("_b"))).alias("_b"))  # bucket of the version's first row

    # end = next version's start: lead inside the bucket, else the next bucket's first
    wv = Window.partitionBy(*k, "_b").orderBy("_vs")
    ver = ver.withColumn("_next_in", F.lead("_vs").over(wv))
    vb = ver.groupBy(*k, "_b").agg(F.min("_vs").alias("_first"))
    vb = vb.select(*k, "_b", F.lead("_first").over(wk).alias("_next_b"))
    ver = ver.join(vb, [*k, "_b"]).withColumn("_next", F.coalesce("_next_in", "_next_b"))
    return ver.select(
        *k,
        *[F.col(f"_lastrow._t.{c}").alias(c) for c in t],
        *[F.col(f"_lastrow._o.{c}" if c in o else f"_lastrow._u.{c}").alias(c) for c in u],
        F.col("_vs").getField(first).alias("start_at"),
        F.col("_next").getField(first).alias("end_at"),
        F.col("_next").isNull().alias("is_current"),
        F.col("n_rows").cast("long").alias("n_rows"))


def scd2_from_snapshots(snap_rows: DataFrame, keys: Sequence[str], snap_col: str,
                        tracked: Sequence[str], snapshots: DataFrame | None = None,
                        untracked: Sequence[str] = ()) -> DataFrame:
    """Versions from full snapshots: keys, tracked…, ``start_at`` (first
    snapshot of the version), ``end_at`` (first snapshot where the key is
    absent or changed; NULL = current), ``n_snapshots``.

    ``snapshots`` lists every snapshot taken (default: those present in
    ``snap_rows``); it is small — one row per snapshot.  Rows that repeat a
    key in a snapshot collapse to the largest by value.  ``untracked``
    columns open no version; a version carries their newest values.
    """
    k, t, u = list(keys), list(tracked), list(untracked)
    snap_rows = (snap_rows.groupBy(*k, snap_col).agg(F.max(_struct([*t, *u])).alias("_v"))
                 .select(*k, snap_col, *[F.col(f"_v.{c}").alias(c) for c in [*t, *u]]))
    snaps = snapshots if snapshots is not None else snap_rows.select(snap_col).distinct()
    snaps = snaps.select(snap_col).distinct().withColumn(
        "_idx", F.row_number().over(Window.orderBy(snap_col)))
    r = snap_rows.join(snaps, snap_col).withColumn("_t", _struct(t))
    w = Window.partitionBy(*k).orderBy("_idx")
    r = (r.withColumn("_pidx", F.lag("_idx").over(w))
          .withColumn("_pt", F.lag("_t").over(w)))
    chg = F.col("_pidx").isNull() | (F.col("_pidx") != F.col("_idx") - 1) | ~F.col("_pt").eqNullSafe(F.col("_t"))
    r = r.withColumn("_vid", F.sum(chg.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    v = r.groupBy(*k, "_vid").agg(F.first("_t").alias("_t"), F.min("_idx").alias("_i0"),
                                  F.max(F.struct("_idx", *u)).alias("_new"),
                                  F.max("_idx").alias("_i1"), F.count(F.lit(1)).alias("n_snapshots"))
    s0 = snaps.select(F.col("_idx").alias("_i0"), F.col(snap_col).alias("start_at"))
    s1 = snaps.select((F.col("_idx") - 1).alias("_i1"), F.col(snap_col).alias("end_at"))
    out = v.join(s0, "_i0").join(s1, "_i1", "left")
    return out.select(*k, *[F.col(f"_t.{c}").alias(c) for c in t], *[F.col(f"_new.{c}").alias(c) for c in u],
                      "start_at", "end_at",
                      F.col("end_at").isNull().alias("is_current"),
                      F.col("n_snapshots").cast("long").alias("n_snapshots"))
