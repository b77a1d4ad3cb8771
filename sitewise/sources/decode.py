"""Decoders for statistical cubes, cell-list records and nested documents.

Everything runs on executors: one landed document per row, decoded with
``from_json`` / VARIANT functions and generators (``posexplode``), so a
directory of thousands of cube files is decoded in parallel, never on the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CUBE_SCHEMA = ("struct<id:array<string>, dimension:map<string,struct<label:string,"
               "category:struct<index:string,label:map<string,string>>>>, "
               "value:array<double>, status:string>")

CELLS_SCHEMA = ("struct<Rows:array<struct<Cell:array<struct<Column:string, Name:string, "
                "Value:string, IsMeasure:boolean>>>>, Errors:string>")


def category_codes(index_json: Column) -> Column:
    """Ordered category codes of one dimension: ``index`` is either an
    object code → position (ordered by position) or a list of codes."""
    as_map = F.from_json(index_json, "map<string,int>")
    by_pos = F.transform(
        F.array_sort(F.transform(F.map_entries(as_map),
                                 lambda e: F.struct(e["value"].alias("p"), e["key"].alias("c")))),
        lambda s: s["c"])
    as_list = F.from_json(index_json, "array<string>")
    return F.when(F.ltrim(index_json).startswith("{"), by_pos).otherwise(as_list)


def strides(sizes: Column) -> Column:
    """Row-major strides: suffix products of the dimension sizes."""
    return F.transform(sizes, lambda s, i: F.aggregate(
        F.slice(sizes, i + 2, F.size(sizes)), F.lit(1).cast("long"), lambda acc, x: acc * x.cast("long")))


def cube_complete(value: Column, codes: Column) -> Column:
    """Cell count = product of dimension sizes = number of values."""
    prod = F.aggregate(F.transform(codes, lambda c: F.size(c).cast("long")), F.lit(1).cast("long"),
                       lambda a, x: a * x)
    return prod == F.size(value).cast("long")


def decode_dense(df: DataFrame, value_col: str, codes_col: str, keep: Sequence[str] = (),
                 status: Column | None = None) -> DataFrame:
    """One row per cell of a dense row-major cube.

    ``codes_col`` is ``array<array<string>>`` (categories per dimension in
    dimension order); the output carries ``pos``, ``value``, ``codes``
    (the cell's category per dimension) and, if given, the cell status
    (``status`` is a map keyed by position text, or a list).  A cube whose
    value count is not the product of its dimension sizes fails the job:
    its values would land in wrong cells.
    """
    whole = F.when(cube_complete(F.col(value_col), F.col(codes_col)), F.col(value_col)).otherwise(F.raise_error(
        F.concat(F.lit("cube has "), F.size(value_col).cast("string"), F.lit(" values for its categories"))))
    base = df.select(*keep, F.col(codes_col).alias("_codes"), whole.alias("_vals"),
                     *([status.alias("_status")] if status is not None else []))
    base = base.withColumn("_sizes", F.transform("_codes", lambda c: F.size(c)))
    base = base.withColumn("_strides", strides(F.col("_sizes")))
    cells = base.select(*keep, "_codes", "_sizes", "_strides",
                        *(["_status"] if status is not None else []),
                        F.posexplode("_vals").alias("pos", "value"))
    coords = F.transform("_codes", lambda c, i: F.element_at(
        c, (F.floor(F.col("pos") / F.element_at("_strides", i + 1)) % F.size(c) + 1).cast("int")))
    out = cells.withColumn("codes", coords)
    if status is not None:
        st = F.col("_status")
        out = out.withColumn("status", F.when(
            F.ltrim(st).startswith("{"),
            F.element_at(F.from_json(st, "map<string,string>"), F.col("pos").cast("string")))
            .otherwise(F.element_at(F.from_json(st, "array<string>"), (F.col("pos") + 1).cast("int"))))
    return out.drop("_codes", "_sizes", "_strides", "_status")


def decode_cube(docs: DataFrame, text_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """json-stat2 documents (one per row) → one row per cell with a
    ``cell`` map dimension id → category code, ``value`` and ``status``."""
    c = docs.select(*keep, F.from_json(F.col(text_col), CUBE_SCHEMA).alias("_c"))
    c = c.select(*keep, F.col("_c.id").alias("_ids"), F.col("_c.value").alias("_vals"),
                 F.col("_c.status").alias("_st"),
                 F.transform(F.col("_c.id"), lambda d: category_codes(
                     F.element_at(F.col("_c.dimension"), d)["category"]["index"])).alias("_codes"))
    c = c.withColumn("cube_complete", cube_complete(F.col("_vals"), F.col("_codes")))
    cells = decode_dense(c, "_vals", "_codes", keep=[*keep, "_ids", "cube_complete"], status=F.col("_st"))
    return cells.withColumn("cell", F.map_from_arrays("_ids", "codes")).drop("_ids", "codes")


def decode_cells(docs: DataFrame, text_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Cell-list records (``{Rows:[{Cell:[{Column, Name, Value, IsMeasure}]}]}``)
    → one row per record with ``dims`` (column → code), ``labels``
    (``<column>_label`` → name, dimensions only) and ``measures`` (column →
    raw value text)."""
    d = docs.select(*keep, F.from_json(F.col(text_col), CELLS_SCHEMA).alias("_d"))
    rows = d.select(*keep, F.posexplode("_d.Rows").alias("row_no", "_r"))
    cells = F.col("_r.Cell")
    dims = F.filter(cells, lambda x: ~F.coalesce(x["IsMeasure"], F.lit(False)))
    meas = F.filter(cells, lambda x: F.coalesce(x["IsMeasure"], F.lit(False)))
    return rows.select(
        *keep, "row_no",
        F.map_from_entries(F.transform(dims, lambda x: F.struct(x["Column"], x["Value"]))).alias("dims"),
        F.map_from_entries(F.transform(dims, lambda x: F.struct(F.concat(x["Column"], F.lit("_label")),
                                                                 x["Name"]))).alias("labels"),
        F.map_from_entries(F.transform(meas, lambda x: F.struct(x["Column"], x["Value"]))).alias("measures"))


def variant_fields(spark: SparkSession, df: DataFrame, json_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Lateral unnest of a JSON/VARIANT column: one row per top-level field
    with ``key``, ``pos`` and the field value as VARIANT (``value``)."""
    cols = ", ".join([f"d.`{c}`" for c in keep] + ["e.pos", "e.key", "e.value"])
    return spark.sql(
        f"SELECT {cols} FROM {{d}} AS d, LATERAL variant_explode(try_parse_json(d.`{json_col}`)) AS e", d=df)


def document_attributes(spark: SparkSession, df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Every non-key column of a row as one (key…, attribute, value-text)
    row: ``to_json(struct)`` → VARIANT → ``variant_explode``."""
    attrs = [c for c in df.columns if c not in key_cols]
    j = df.select(*key_cols, F.to_json(F.struct(*attrs)).alias("_doc"))
    f = variant_fields(spark, j, "_doc", key_cols)
    return f.select(*key_cols, F.col("key").alias("attribute"),
                    F.col("value").cast("string").alias("value_text"))
