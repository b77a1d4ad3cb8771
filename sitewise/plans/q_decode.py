"""Decoder queries: dense cubes, cell lists, VARIANT fields, attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from sitewise.operators.checks import parse_position
from sitewise.sources.decode import (cube_complete, decode_cells, decode_cube, decode_dense, document_attributes,
                                     variant_fields)
from sitewise.sources.files import rescued_data
from sitewise.plans.registry import query
from sitewise.session import load, materialize

MATRIX_SIDE = 8  # embeddings are 64 floats, read as an 8 × 8 row-major matrix


def _matrix_codes():
    axis = F.transform(F.sequence(F.lit(0), F.lit(MATRIX_SIDE - 1)), lambda x: x.cast("string"))
    return F.array(axis, axis)


@query("decode_cube", """
SELECT vec_id, CAST((pos - 1) // 8 AS BIGINT) AS i, CAST((pos - 1) % 8 AS BIGINT) AS j, CAST(v AS DOUBLE) AS value
FROM (SELECT vec_id, generate_subscripts(embedding, 1) AS pos, unnest(embedding) AS v FROM embeddings)
""")
def decode_cube_q(spark, sf):
    """Each embedding as a dense row-major 8 × 8 cube → (vec_id, i, j, value)."""
    e = load(spark, sf, "embeddings").select("vec_id", "embedding", _matrix_codes().alias("codes"))
    cells = decode_dense(e, "embedding", "codes", keep=["vec_id"])
    return cells.select("vec_id", F.element_at("codes", 1).cast("long").alias("i"),
                        F.element_at("codes", 2).cast("long").alias("j"),
                        F.col("value").cast("double").alias("value"))


@query("cube_completeness", """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n_values, CAST(64 AS BIGINT) AS n_cells,
       len(embedding) = 64 AS complete
FROM embeddings
""")
def cube_completeness_q(spark, sf):
    """Cell count = product of dimension sizes = values returned, per cube."""
    e = load(spark, sf, "embeddings").select("vec_id", "embedding", _matrix_codes().alias("codes"))
    return e.select("vec_id", F.size("embedding").cast("long").alias("n_values"),
                    F.aggregate(F.transform("codes", lambda c: F.size(c).cast("long")), F.lit(1).cast("long"),
                                lambda a, x: a * x).alias("n_cells"),
                    cube_complete(F.col("embedding"), F.col("codes")).alias("complete"))


@query("decode_cells", """
SELECT conv_id, turn, role, upper(role) AS role_label, CAST(length(text) AS BIGINT) AS n_chars
FROM conversations
""")
def decode_cells_q(spark, sf):
    """Each conversation turn landed as a cell-list record (dimensions
    conv_id, turn, role with a label; measure n_chars over the whole text)
    and decoded back into typed columns."""
    c = load(spark, sf, "conversations")

    def cell(col, val, name, measure):
        return F.struct(F.lit(col).alias("Column"), name.alias("Name"), val.cast("string").alias("Value"),
                        F.lit(measure).alias("IsMeasure"))

    rec = F.to_json(F.struct(F.array(F.struct(F.array(
        cell("conv_id", F.col("conv_id"), F.col("conv_id").cast("string"), False),
        cell("turn", F.col("turn"), F.col("turn").cast("string"), False),
        cell("role", F.col("role"), F.upper("role"), False),
        cell("n_chars", F.length("text"), F.lit("characters"), True)).alias("Cell"))).alias("Rows")))
    landed = c.select(rec.alias("value"))
    d = decode_cells(landed)
    return d.select(F.col("dims")["conv_id"].cast("long").alias("conv_id"),
                    F.col("dims")["turn"].cast("long").alias("turn"),
                    F.col("dims")["role"].alias("role"),
                    F.col("labels")["role_label"].alias("role_label"),
                    F.col("measures")["n_chars"].cast("long").alias("n_chars"))


@query("variant_fields", """
WITH f AS (SELECT k AS key, json_extract(props, '$."' || k || '"') AS v
           FROM (SELECT props, unnest(json_keys(props)) AS k FROM events))
SELECT key, COUNT(*) AS n_rows, COUNT(DISTINCT CAST(v AS VARCHAR)) AS n_distinct,
       MIN(CAST(v AS BIGINT)) AS min_value, MAX(CAST(v AS BIGINT)) AS max_value,
       CAST(SUM(CAST(v AS BIGINT)) AS BIGINT) AS sum_value
FROM f GROUP BY key
""")
def variant_fields_q(spark, sf):
    """Field inventory of events.props parsed as VARIANT (lateral unnest)."""
    f = variant_fields(spark, load(spark, sf, "events").select("props"), "props")
    v = F.try_variant_get(F.col("value"), "$", "bigint")
    return f.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows"),
                                F.count_distinct(F.col("value").cast("string")).alias("n_distinct"),
                                F.min(v).alias("min_value"), F.max(v).alias("max_value"),
                                F.sum(v).cast("long").alias("sum_value"))


@query("attribute_inventory", """
WITH u AS (
  UNPIVOT (SELECT p_partkey, CAST(p_name AS VARCHAR) AS p_name, CAST(p_brand AS VARCHAR) AS p_brand,
                  CAST(p_type AS VARCHAR) AS p_type, CAST(p_size AS VARCHAR) AS p_size,
                  CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part)
  ON p_name, p_brand, p_type, p_size, p_retailprice INTO NAME attribute VALUE value_text)
SELECT attribute, COUNT(value_text) AS n_filled, COUNT(DISTINCT value_text) AS n_distinct FROM u GROUP BY attribute
""")
def attribute_inventory_q(spark, sf):
    """Per attribute of part: rows where it is filled, distinct values —
    from the row as a JSON document exploded to (attribute, value)."""
    a = document_attributes(spark, load(spark, sf, "part"), ["p_partkey"])
    return a.groupBy("attribute").agg(F.count("value_text").alias("n_filled"),
                                      F.count_distinct("value_text").alias("n_distinct"))


@query("decode_cube_json", """
SELECT y AS year, s AS status, p AS priority, count(o_orderkey) AS n_orders
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS y FROM orders) CROSS JOIN (SELECT DISTINCT coalesce(o_orderstatus, '?') AS s FROM orders)
  CROSS JOIN (SELECT DISTINCT coalesce(o_orderpriority, '?') AS p FROM orders)
  LEFT JOIN orders ON year(o_orderdate) = y AND coalesce(o_orderstatus, '?') = s AND coalesce(o_orderpriority, '?') = p
GROUP BY 1, 2, 3
""")
def decode_cube_json_q(spark, sf):
    """Orders per status and priority landed as one json-stat2 document a
    year (status categories as an object, priorities as a list) and decoded
    back, zero cells included.  The categories are those of the data."""
    o = load(spark, sf, "orders").groupBy(
        F.year("o_orderdate").alias("year"), F.coalesce("o_orderstatus", F.lit("?")).alias("status"), F.coalesce("o_orderpriority", F.lit("?")).alias("priority")).agg(F.count(F.lit(1)).alias("n"))
    o = materialize(o)
    # a dimension of a cube is a list in its document
    status, priority = (o.agg(F.array_sort(F.collect_set(c))).scalar() for c in ("status", "priority"))
    at = (F.array_position(status, F.col("status")) - 1) * F.size(priority) + F.array_position(priority, F.col("priority"))
    per = o.select("year", at.alias("at"), "n").groupBy("year").agg(F.map_from_entries(F.collect_list(F.struct("at", "n"))).alias("m"))
    per = per.select("*", status.alias("status"), priority.alias("priority"))
    status, priority = F.col("status"), F.col("priority")
    values = F.transform(F.sequence(F.lit(1).cast("long"), (F.size(status) * F.size(priority)).cast("long")), lambda i: F.coalesce(F.col("m")[i], F.lit(0)))
    index = F.map_from_entries(F.transform(status, lambda s, i: F.struct(s.alias("k"), i.alias("v"))))
    dims = F.struct(
        F.struct(F.lit("status").alias("label"), F.struct(index.alias("index")).alias("category")).alias("status"),
        F.struct(F.lit("priority").alias("label"), F.struct(priority.alias("index")).alias("category")).alias("priority"))
    landed = per.select("year", F.to_json(F.struct(F.array(F.lit("status"), F.lit("priority")).alias("id"), dims.alias("dimension"), values.alias("value"))).alias("value"))
    c = decode_cube(landed, keep=["year"])
    return c.select(F.col("year").cast("long").alias("year"), F.col("cell")["status"].alias("status"), F.col("cell")["priority"].alias("priority"),
                    F.col("value").cast("long").alias("n_orders"))


@query("position_parse", """
SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal / 128 END AS lat,
       CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 5 <> 0 THEN c_acctbal / 64 END AS lon
FROM customer
""")
def position_parse_q(spark, sf):
    """Positions written as "(lat, lon)" and parsed back; some have no
    longitude, some are no positions."""
    c = load(spark, sf, "customer")
    lat, lon = (F.col("c_acctbal") / n for n in (128, 64))
    text = (F.when(F.col("c_custkey") % 7 == 0, F.lit("unknown"))
             .when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("("), lat.cast("string"), F.lit(")")))
             .otherwise(F.concat(F.lit("("), lat.cast("string"), F.lit(", "), lon.cast("string"), F.lit(")"))))
    a, b = parse_position(F.col("position"))
    return c.select("c_custkey", text.alias("position")).select("c_custkey", a.alias("lat"), b.alias("lon"))


@query("rescued_fields", """
SELECT event_type, count(*) AS n_rows, count(CASE WHEN value > 50 THEN 1 END) AS n_rescued,
       CAST(sum(CASE WHEN value > 50 THEN user_id END) AS BIGINT) AS rescued_users
FROM events GROUP BY event_type
""")
def rescued_fields_q(spark, sf):
    """Events landed as JSON, those of a high value with a field that the
    schema does not declare; it is kept as rescued data."""
    e = load(spark, sf, "events")
    doc = F.to_json(F.struct("event_id", "event_type", F.when(F.col("value") > 50, F.col("user_id")).alias("watched_by")))
    r = rescued_data(e.select("event_type", doc.alias("doc")), "doc", ["event_id", "event_type"])
    return r.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_rescued_data").alias("n_rescued"),
        F.sum(F.get_json_object("_rescued_data", "$.watched_by").cast("long")).alias("rescued_users"))
