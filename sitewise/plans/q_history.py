"""SCD 2 history queries over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewise.operators.history import scd2_from_changes, scd2_from_snapshots
from sitewise.plans.registry import query
from sitewise.session import load


SCD2_CHANGES_SQL = """
WITH e AS (
  SELECT user_id, ts, event_id, event_type, value,
         LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_type,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
c AS (
  SELECT *, SUM(CASE WHEN rn = 1 OR prev_type IS DISTINCT FROM event_type THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS vid
  FROM e),
v AS (
  SELECT user_id, vid, MIN(ts) AS start_at, ANY_VALUE(event_type) AS event_type,
         FIRST(value ORDER BY ts DESC, event_id DESC) AS value,
         FIRST(event_id ORDER BY ts DESC, event_id DESC) AS event_id,
         COUNT(*) AS n_rows
  FROM c GROUP BY user_id, vid)
SELECT user_id, event_type, value, event_id, start_at,
       LEAD(start_at) OVER (PARTITION BY user_id ORDER BY start_at) AS end_at,
       LEAD(start_at) OVER (PARTITION BY user_id ORDER BY start_at) IS NULL AS is_current,
       n_rows
FROM v
"""


@query("scd2_changes", SCD2_CHANGES_SQL)
def scd2_changes_q(spark, sf):
    """Type-2 history of each user's event type (tracked); the value and
    event id are untracked and follow the newest event of the version."""
    ev = load(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    h = scd2_from_changes(ev, ["user_id"], ["ts", "event_id"], ["event_type"], ["value", "event_id"])
    return h.select("user_id", "event_type", "value", "event_id", "start_at", "end_at", "is_current", "n_rows")


@query("scd2_snapshots", """
WITH s AS (SELECT user_id, CAST(ts AS DATE) AS d, FIRST(event_type ORDER BY ts DESC, event_id DESC) AS t
           FROM events GROUP BY 1, 2),
snaps AS (SELECT d, ROW_NUMBER() OVER (ORDER BY d) AS idx FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)),
p AS (SELECT s.*, sn.idx FROM s JOIN snaps sn USING (d)),
l AS (SELECT *, LAG(idx) OVER (PARTITION BY user_id ORDER BY idx) AS pidx,
             LAG(t) OVER (PARTITION BY user_id ORDER BY idx) AS pt FROM p),
c AS (SELECT *, SUM(CASE WHEN pidx IS NULL OR pidx <> idx - 1 OR pt IS DISTINCT FROM t THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS vid FROM l),
v AS (SELECT user_id, vid, ANY_VALUE(t) AS event_type, MIN(idx) AS i0, MAX(idx) AS i1, COUNT(*) AS n
      FROM c GROUP BY 1, 2)
SELECT v.user_id, v.event_type, CAST(s0.d AS VARCHAR) AS start_at, CAST(s1.d AS VARCHAR) AS end_at,
       s1.d IS NULL AS is_current, v.n AS n_snapshots
FROM v JOIN snaps s0 ON s0.idx = v.i0 LEFT JOIN snaps s1 ON s1.idx = v.i1 + 1
""")
def scd2_snapshots_q(spark, sf):
    """Daily snapshots of the users seen that day (their last event type);
    absence from a day closes the version, a return opens a new one."""
    ev = load(spark, sf, "events")
    snap = (ev.groupBy("user_id", F.to_date("ts").alias("d"))
              .agg(F.max(F.struct("ts", "event_id", "event_type")).alias("_l"))
              .select("user_id", "d", F.col("_l.event_type").alias("event_type")))
    h = scd2_from_snapshots(snap, ["user_id"], "d", ["event_type"],
                            snapshots=ev.select(F.to_date("ts").alias("d")))
    return h.select("user_id", "event_type", F.col("start_at").cast("string").alias("start_at"),
                    F.col("end_at").cast("string").alias("end_at"), "is_current", "n_snapshots")
