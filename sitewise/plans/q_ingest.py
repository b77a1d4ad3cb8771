"""Landing, expectations, rescue, profiles and publishing over the driver tables."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sitewise.functions.clock import epoch_seconds
from sitewise.functions.money import cents, cents_to_double
from sitewise.operators.quality import ExpectationFailed, Rule
from sitewise.operators.schema_profile import merge, nested_attributes, partials, profile
from sitewise.plans.q_stream import EVENTS_SCHEMA
from sitewise.plans.registry import query
from sitewise.session import load, scratch_path
from sitewise.sources.files import overdue_files
from sitewise.sources.publish import current, publish
from sitewise.sources.rescue import typed_rescue
from sitewise.streaming.expectations import expect_stream, kept, quarantined, rule_counts
from sitewise.streaming.ingest import json_stream, land_files


class NotAtomic(Exception):
    """A delivery that must have been refused was not."""


def _middle(ev):
    """Seconds of the middle of the events' time range, as a scalar."""
    secs = epoch_seconds(F.col("ts"))
    return ev.agg((F.min(secs) / 2 + F.max(secs) / 2).alias("m")).scalar()


def event_rules():
    c = F.col
    return [
        Rule("value_at_most_100", c("value") <= 100, "warn"),
        Rule("not_an_error", c("event_type") != "error", "drop"),
        Rule("even_user", c("user_id") % 2 == 0, "warn"),
        Rule("not_tiny", c("value") >= 1, "drop"),
        Rule("value_present", c("value").isNotNull(), "fail"),
    ]


def _expected_events(spark, sf, tag):
    base = scratch_path(spark, tag)
    land_files(load(spark, sf, "events"), f"{base}/landing", 4)
    schema = spark.createDataFrame([], EVENTS_SCHEMA).schema
    expect_stream(json_stream(spark, f"{base}/landing", schema, max_files_per_trigger=2), f"{base}/silver", f"{base}/_ckpt", event_rules())
    return f"{base}/silver"


@query("expectation_warn", """
WITH r(rule, severity, bad) AS (
  SELECT 'value_at_most_100', 'warn', count(*) FILTER (WHERE value > 100 OR value IS NULL) FROM events
  UNION ALL SELECT 'not_an_error', 'drop', count(*) FILTER (WHERE event_type = 'error' OR event_type IS NULL) FROM events
  UNION ALL SELECT 'even_user', 'warn', count(*) FILTER (WHERE user_id % 2 <> 0 OR user_id IS NULL) FROM events
  UNION ALL SELECT 'not_tiny', 'drop', count(*) FILTER (WHERE value < 1 OR value IS NULL) FROM events
  UNION ALL SELECT 'value_present', 'fail', count(*) FILTER (WHERE value IS NULL) FROM events)
SELECT rule, severity, (SELECT count(*) FROM events) AS n_rows, bad AS n_fail, true AS committed FROM r
""")
def expectation_warn_q(spark, sf):
    """Observed metrics of every rule, summed over the stream's micro-batches;
    rows that break only warnings stay."""
    log = rule_counts(spark, _expected_events(spark, sf, "expect-warn"))
    return log.groupBy("rule", "severity").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_fail").alias("n_fail"), F.min("committed").alias("committed"))


@query("expectation_drop", """
WITH e AS (SELECT *, CASE WHEN event_type = 'error' OR value < 1 THEN 'quarantined' ELSE 'kept' END AS status,
  concat_ws(',', CASE WHEN value > 100 THEN 'value_at_most_100' END, CASE WHEN event_type = 'error' THEN 'not_an_error' END,
    CASE WHEN user_id % 2 <> 0 THEN 'even_user' END, CASE WHEN value < 1 THEN 'not_tiny' END) AS broken FROM events)
SELECT status, event_type, CASE status WHEN 'kept' THEN '' ELSE broken END AS broken, count(*) AS n_rows,
  CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS value_sum, count(DISTINCT event_id) AS n_events
FROM e GROUP BY ALL
""")
def expectation_drop_q(spark, sf):
    """Rows that break a drop rule are in the quarantine with the rules they
    break, the others in the table."""
    path = _expected_events(spark, sf, "expect-drop")
    rows = kept(spark, path).withColumn("status", F.lit("kept")).withColumn("broken", F.lit(""))
    out = quarantined(spark, path).withColumn("status", F.lit("quarantined")).withColumn("broken", F.concat_ws(",", "_broken")).drop("_broken")
    return rows.unionByName(out).groupBy("status", "event_type", "broken").agg(
        F.count(F.lit(1)).alias("n_rows"), cents_to_double(F.sum(cents(F.col("value")))).alias("value_sum"), F.count_distinct("event_id").alias("n_events"))


@query("expectation_fail", """
WITH m AS (SELECT min(epoch(date_trunc('second', ts))) / 2 + max(epoch(date_trunc('second', ts))) / 2 AS mid FROM events),
e AS (SELECT *, coalesce(epoch(date_trunc('second', ts)) < mid, false) AS first FROM events, m)
SELECT 'refused' AS stage, event_type, count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS value_sum FROM e WHERE first GROUP BY 2
UNION ALL SELECT 'mended', event_type, count(*), CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) FROM e GROUP BY 2
""")
def expectation_fail_q(spark, sf):
    """A first delivery is kept; a second one, some of whose values are
    negative, breaks a fail rule and leaves the table as it was; mended and
    sent again it is kept, and nothing twice."""
    base = scratch_path(spark, "expect-fail")
    ev = load(spark, sf, "events")
    first = F.coalesce(epoch_seconds(F.col("ts")) < _middle(ev), F.lit(False))
    schema = spark.createDataFrame([], EVENTS_SCHEMA).schema
    rules = [Rule("value_not_negative", F.col("value") >= 0, "fail")]

    def run():
        expect_stream(json_stream(spark, f"{base}/landing/*", schema), f"{base}/silver", f"{base}/_ckpt", rules)

    def seen(stage):
        return kept(spark, f"{base}/silver").groupBy(F.lit(stage).alias("stage"), "event_type").agg(
            F.count(F.lit(1)).alias("n_rows"), cents_to_double(F.sum(cents(F.col("value")))).alias("value_sum"))

    second = ev.where(~first)
    land_files(ev.where(first), f"{base}/landing/first", 2)
    run()
    land_files(second.withColumn("value", F.when(F.col("event_id") % 10 == 0, -F.col("value") - 1).otherwise(F.col("value"))), f"{base}/landing/second", 2)
    try:
        run()
    except (StreamingQueryException, ExpectationFailed) as e:
        if "value_not_negative" not in str(e):
            raise
    else:
        raise NotAtomic("a batch that breaks a fail rule was kept")
    refused = spark.createDataFrame(seen("refused").toPandas(), "stage string, event_type string, n_rows long, value_sum double")  # one row a type, read before the table changes
    land_files(second, f"{base}/landing/second", 2)
    run()
    return refused.unionByName(seen("mended"))


RESCUE_SCHEMA = "event_id bigint, user struct<id: bigint, name: string>, value double, tags array<bigint>, at timestamp_ntz"


@query("rescued_typed", """
WITH e AS (SELECT *, event_id % 13 = 3 AS broken FROM events),
x AS (
  SELECT '$.value' AS path, 'STRING' AS found, event_id FROM e WHERE NOT broken AND event_id % 7 = 1
  UNION ALL SELECT '$.user.note', 'STRING', event_id FROM e WHERE NOT broken AND event_id % 11 = 2
  UNION ALL SELECT '$.tags[1]', 'STRING', event_id FROM e WHERE NOT broken AND event_id % 17 = 4
  UNION ALL SELECT '$.user', 'ARRAY', event_id FROM e WHERE NOT broken AND event_id % 19 = 5
  UNION ALL SELECT '$.at', 'STRING', event_id FROM e WHERE NOT broken AND event_id % 23 = 6
  UNION ALL SELECT '$.event_id', 'DOUBLE', event_id FROM e WHERE NOT broken AND event_id % 29 = 7
  UNION ALL SELECT '$', 'BROKEN', event_id FROM e WHERE broken)
SELECT path, found, count(*) AS n_rescued, CAST(sum(event_id) AS BIGINT) AS ids FROM x
WHERE NOT (path = '$.user.note' AND event_id % 19 = 5) GROUP BY 1, 2
UNION ALL SELECT '(typed)', 'event_id', count(*), CAST(sum(event_id) AS BIGINT) FROM e WHERE NOT broken AND event_id % 29 <> 7
UNION ALL SELECT '(typed)', 'value', count(*), CAST(sum(event_id) AS BIGINT) FROM e WHERE NOT broken AND event_id % 7 <> 1
UNION ALL SELECT '(typed)', 'user.id', count(*), CAST(sum(event_id) AS BIGINT) FROM e WHERE NOT broken AND event_id % 19 <> 5
UNION ALL SELECT '(typed)', 'tags', count(*), CAST(sum(event_id) AS BIGINT) FROM e WHERE NOT broken AND event_id % 17 <> 4
UNION ALL SELECT '(typed)', 'at', count(*), CAST(sum(event_id) AS BIGINT) FROM e WHERE NOT broken AND event_id % 23 <> 6
""")
def rescued_typed_q(spark, sf):
    """Events landed as JSON with values of wrong types, fields that nobody
    declared, an array where an object should be, a text that is no time, a
    fraction where an integer should be, and records cut off; read by the
    declared schema, each misfit is kept with its path and type."""
    e = load(spark, sf, "events").where("event_id IS NOT NULL")
    odd = lambda m, r: F.col("event_id") % m == r
    text = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)  # noqa: E731 - quoted and escaped
    user = F.concat(F.lit('{"id":'), F.col("user_id").cast("string"), F.when(odd(11, 2), F.concat(F.lit(',"note":'), text(F.col("event_type")))).otherwise(F.lit("")), F.lit("}"))
    doc = F.concat(
        F.lit('{"event_id":'), F.when(odd(29, 7), F.concat(F.col("event_id").cast("string"), F.lit("e-1"))).otherwise(F.col("event_id").cast("string")),
        F.lit(',"user":'), F.when(odd(19, 5), F.lit("[1]")).otherwise(user),
        F.lit(',"value":'), F.when(odd(7, 1), text(F.concat(F.lit("v"), F.col("value").cast("string")))).otherwise(F.col("value").cast("string")),
        F.lit(',"tags":['), F.col("user_id").cast("string"), F.when(odd(17, 4), F.lit(',"x"')).otherwise(F.lit(",7")),
        F.lit('],"at":'), F.when(odd(23, 6), F.lit('"soon"')).otherwise(text(F.col("ts").cast("string"))), F.lit("}"))
    cut = F.when(odd(13, 3), F.substring("doc", 1, 9)).otherwise(F.col("doc"))
    landed = e.select("event_id", doc.alias("doc")).select(F.col("event_id").alias("id"), cut.alias("doc"))
    r = typed_rescue(landed, "doc", spark.createDataFrame([], RESCUE_SCHEMA).schema)
    ok = {"event_id": F.col("event_id").isNotNull(), "value": F.col("value").isNotNull(), "user.id": F.col("user.id").isNotNull(),
          "tags": F.coalesce(F.size("tags") == 2, F.lit(False)) & F.forall("tags", lambda t: t.isNotNull()), "at": F.col("at").isNotNull()}
    typed = F.array_compact(F.array(*[F.when(c, F.struct(F.lit("(typed)").alias("path"), F.lit(n).alias("found"))) for n, c in ok.items()]))
    seen = F.concat(F.transform("_rescued", lambda x: F.struct(x["path"].alias("path"), x["found"].alias("found"))), typed)
    return r.select("id", F.explode(seen).alias("s")).groupBy("s.path", "s.found").agg(F.count(F.lit(1)).alias("n_rescued"), F.sum("id").alias("ids"))


@query("schema_profile", """
WITH e AS (SELECT *, event_id % 5 = 0 AS as_text, event_id % 3 = 0 AS no_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
p AS (
  SELECT '$' AS path, count(*) AS n, count(*) AS n_filled, 0 AS n_distinct, 'OBJECT:' || count(*) AS types FROM e
  UNION ALL SELECT '$.what', count(*), count(*) FILTER (WHERE NOT no_type), count(DISTINCT event_type) FILTER (WHERE NOT no_type),
    concat('STRING:', count(*) FILTER (WHERE NOT no_type), '|VOID:', count(*) FILTER (WHERE no_type)) FROM e
  UNION ALL SELECT '$.who', count(*), count(*), count(DISTINCT CASE WHEN as_text THEN 'u' || user_id ELSE CAST(user_id AS VARCHAR) END),
    concat('BIGINT:', count(*) FILTER (WHERE NOT as_text), '|STRING:', count(*) FILTER (WHERE as_text)) FROM e
  UNION ALL SELECT '$.props', count(*), count(*), 0, 'OBJECT:' || count(*) FROM e
  UNION ALL SELECT '$.props.k', count(*), count(*), count(DISTINCT k), 'BIGINT:' || count(*) FROM e
  UNION ALL SELECT '$.seen', count(*), count(*), 0, 'ARRAY:' || count(*) FROM e
  UNION ALL SELECT '$.seen[]', count(*) * 2, count(*) * 2, 0, 'OBJECT:' || count(*) * 2 FROM e
  UNION ALL SELECT '$.seen[].day', count(*) * 2, count(*) * 2, (SELECT count(DISTINCT d) FROM (SELECT day(ts) AS d FROM e UNION SELECT 99)), 'BIGINT:' || count(*) * 2 FROM e
  UNION ALL SELECT '$.by', count(*), count(*), 0, 'OBJECT:' || count(*) FROM e
  UNION ALL SELECT '$.by{}', count(*), count(*), count(DISTINCT event_type), 'STRING:' || count(*) FROM e)
SELECT path, CAST(n AS BIGINT) AS n, CAST(n_filled AS BIGINT) AS n_filled, CAST(n_distinct AS BIGINT) AS n_distinct, types, CAST(0 AS BIGINT) AS too_deep FROM p
""")
def schema_profile_q(spark, sf):
    """What landed event documents hold, path by path, from the merged
    partials of two deliveries: types, filled and distinct values; a map whose
    keys are user ids is one path."""
    e = load(spark, sf, "events")
    who = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit('"u'), F.col("user_id").cast("string"), F.lit('"'))).otherwise(F.col("user_id").cast("string"))
    what = F.when(F.col("event_id") % 3 == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    doc = F.concat(F.lit('{"what":'), what, F.lit(',"who":'), who, F.lit(',"props":'), F.col("props"),
                   F.lit(',"seen":[{"day":'), F.dayofmonth("ts").cast("string"), F.lit('},{"day":99}],"by":{"'), F.col("user_id").cast("string"), F.lit('":"'), F.col("event_type"), F.lit('"}}'))
    docs = e.select("event_id", doc.alias("doc"))
    parts = [partials(docs.where(F.col("event_id") % 2 == i), "doc", maps=["$.by"]) for i in (0, 1)]
    return profile(merge(*parts))


@query("nested_attributes", """
SELECT o_orderstatus AS "group", o_orderpriority AS code, count(*) AS n_documents, CAST(sum(n) AS BIGINT) AS n_filled,
  count(DISTINCT n) AS n_distinct, max(n) AS largest
FROM (SELECT o_custkey, o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) GROUP BY 1, 2
""")
def nested_attributes_q(spark, sf):
    """One document a customer with a map of maps, status → priority → number
    of orders, taken apart twice; a customer of some without the first status
    has a list there, as an empty object is often written."""
    per = load(spark, sf, "orders").groupBy("o_custkey", "o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    inner = per.groupBy("o_custkey", "o_orderstatus").agg(F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "n"))).alias("m"))
    outer = inner.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", F.to_json("m")))).alias("m"))
    body = F.concat_ws(",", F.transform(F.map_entries("m"), lambda x: F.concat(F.lit('"'), x["key"], F.lit('":'), x["value"])))
    docs = outer.select("o_custkey", F.concat(F.lit('{"id":1,"attr":{"none":[],'), body, F.lit("}}")).alias("doc"))
    a = nested_attributes(spark, docs, "doc", "attr", ["o_custkey"])
    n = F.expr("try_variant_get(value, '$', 'bigint')")
    return a.groupBy("group", "code").agg(F.count_distinct("o_custkey").alias("n_documents"), F.sum(n).alias("n_filled"),
                                          F.count_distinct(n).alias("n_distinct"), F.max(n).alias("largest"))


class _ByHand(Exception):
    """Stands for a rule or a crash that stops a publication."""


@query("publish_versions", """
WITH o AS (SELECT *, o_orderkey % 2 = 0 AS early FROM orders),
v AS (
  SELECT 1 AS version, 'per_status' AS t, o_orderstatus AS k, count(*) AS n FROM o WHERE early GROUP BY 3
  UNION ALL SELECT 1, 'per_priority', o_orderpriority, count(*) FROM o WHERE early GROUP BY 3
  UNION ALL SELECT 2, 'per_status', o_orderstatus, count(*) FROM o GROUP BY 3
  UNION ALL SELECT 2, 'per_priority', o_orderpriority, count(*) FROM o GROUP BY 3)
SELECT CAST(version AS INTEGER) AS version, version = 2 AS is_current, t AS table_name, k, n FROM v
""")
def publish_versions_q(spark, sf):
    """Two tables published as one version, then again with more orders; a
    third publication breaks a rule and a fourth dies between its tables.
    Readers see the second version, and the first where they ask for it."""
    target = scratch_path(spark, "publish")
    orders = load(spark, sf, "orders")

    def tables(rows):
        return {name: rows.groupBy(F.col(c).alias("k")).agg(F.count(F.lit(1)).alias("n")) for name, c in (("per_status", "o_orderstatus"), ("per_priority", "o_orderpriority"))}

    def same_total(staged):
        totals = {name: df.agg(F.sum("n")).first()[0] for name, df in staged.items()}
        if len(set(totals.values())) > 1:
            raise _ByHand(f"totals differ: {totals}")

    publish(spark, target, tables(orders.where(F.col("o_orderkey") % 2 == 0)), same_total)
    publish(spark, target, tables(orders), same_total)
    broken = tables(orders) | {"per_status": tables(orders)["per_status"].limit(1)}
    dying = tables(orders) | {"per_priority": orders.select(F.raise_error(F.lit("lost between two tables")).cast("string").alias("k"), F.lit(1).alias("n"))}
    for attempt in (broken, dying):
        try:
            publish(spark, target, attempt, same_total)
        except Exception:  # noqa: BLE001 - any failure must leave the version as it was
            continue
        raise NotAtomic("a broken version was published")
    newest, first = current(spark, target), current(spark, target, 1)
    out = None
    for p, is_current in ((first, False), (newest, True)):
        for name in p.tables:
            part = p.table(name).select(F.lit(p.number).alias("version"), F.lit(is_current).alias("is_current"), F.lit(name).alias("table_name"), "k", "n")
            out = part if out is None else out.unionByName(part)
    return out


TZ = "Europe/Stockholm"


@query("file_deadlines", """
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
landed AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0),
miss AS (SELECT day FROM days WHERE day NOT IN (SELECT day FROM landed)),
p AS (SELECT * FROM miss, (VALUES ('11:00', 660), ('11:59', 719), ('12:00', 720), ('13:00', 780)) t(probe, minutes)),
d AS (SELECT *, ((CAST(day - 1 AS TIMESTAMP) + INTERVAL 13 HOUR) AT TIME ZONE 'Europe/Stockholm') AT TIME ZONE 'UTC' AS due,
        CAST(day - 1 AS TIMESTAMP) + to_minutes(minutes) AS now FROM p)
SELECT probe, month(day - 1) AS month, CASE WHEN now >= due THEN 'warning' ELSE 'normal' END AS severity, count(*) AS n_files,
  CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day
FROM d GROUP BY 1, 2, 3
""")
def file_deadlines_q(spark, sf):
    """Days without a landed file, each judged at four UTC times of the day
    before: overdue from 13:00 Stockholm time, which is 11:00 or 12:00 UTC."""
    o = load(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    landed = o.where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 3 == 0)).select("day")
    probes = F.explode(F.array(*[F.lit(p) for p in ("11:00", "11:59", "12:00", "13:00")]))
    expected = o.select("day").distinct().withColumn("probe", probes)
    present = landed.distinct().withColumn("probe", probes)
    minutes = F.substring("probe", 1, 2).cast("int") * 60 + F.substring("probe", 4, 2).cast("int")
    now = F.timestamp_add("MINUTE", minutes, F.date_sub("day", 1).cast("timestamp_ntz"))
    late = overdue_files(expected, present, ["probe"], "day", now, TZ)
    return late.groupBy("probe", F.month(F.date_sub("day", 1)).cast("long").alias("month"), "severity").agg(
        F.count(F.lit(1)).alias("n_files"), F.min("day").cast("string").alias("first_day"), F.max("day").cast("string").alias("last_day"))
