"""JSON records read by a declared schema, with everything that does not fit
kept as (path, type found, value).

A record is parsed once to a VARIANT and compared with the schema field by
field, into structs and arrays: a value of another type, a field that is not
declared at any level, a value of the right type that the column cannot hold
(a number out of range, a text that is no date) and a record that is no JSON
at all.  Nothing is guessed: a text that looks like a number is rescued from
a number column, not converted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType, StringType, StructType, TimestampNTZType, TimestampType)

ENTRY = "struct<path:string,found:string,value:string>"

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_NUMBER = (FloatType, DoubleType, DecimalType)
_TEXT = (StringType, DateType, TimestampType, TimestampNTZType)


def _fits(found: Column, kind: DataType) -> Column:
    if isinstance(kind, _WHOLE):
        return found == "BIGINT"
    if isinstance(kind, _NUMBER):
        return found.isin("BIGINT", "DOUBLE", "FLOAT") | found.startswith("DECIMAL")
    if isinstance(kind, _TEXT):
        return found == "STRING"
    if isinstance(kind, BooleanType):
        return found == "BOOLEAN"
    raise TypeError(f"no rule for columns of type {kind.simpleString()}")


def found_type(v: Column) -> Column:
    """OBJECT, ARRAY or the leaf's type, a decimal without its digits."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _entry(v: Column, path: Column) -> Column:
    return F.array(F.struct(path.alias("path"), found_type(v).alias("found"), F.to_json(v).alias("value")).cast(ENTRY))


def _none() -> Column:
    return F.array().cast(f"array<{ENTRY}>")


def _read(v: Column, path: Column, kind: DataType) -> tuple[Column, Column]:
    """(value of type ``kind`` or NULL, rescued entries) of a variant that may be NULL."""
    absent = v.isNull() | F.is_variant_null(v)
    if isinstance(kind, StructType):
        fields = F.try_variant_get(v, "$", "map<string,variant>")
        parts = {f.name: _read(F.element_at(fields, f.name), F.concat(path, F.lit(f".{f.name}")), f.dataType) for f in kind.fields}
        names = F.array(*[F.lit(f.name) for f in kind.fields])
        extra = F.filter(F.map_entries(fields), lambda e: ~F.array_contains(names, e["key"]))
        more = F.flatten(F.transform(extra, lambda e: _entry(e["value"], F.concat(path, F.lit("."), e["key"]))))
        value = F.struct(*[val.alias(name) for name, (val, _) in parts.items()])
        rescued = F.concat(more, *[r for _, r in parts.values()])
        return F.when(fields.isNotNull(), value), F.when(absent, _none()).when(fields.isNull(), _entry(v, path)).otherwise(rescued)
    if isinstance(kind, ArrayType):
        items = F.try_variant_get(v, "$", "array<variant>")

        def item(x: Column, i: Column) -> tuple[Column, Column]:
            return _read(x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), kind.elementType)

        value = F.transform(items, lambda x, i: item(x, i)[0])
        rescued = F.flatten(F.transform(items, lambda x, i: item(x, i)[1]))
        return value, F.when(absent, _none()).when(items.isNull(), _entry(v, path)).otherwise(rescued)
    value = F.when(_fits(F.schema_of_variant(v), kind), F.try_variant_get(v, "$", kind.simpleString()))
    return value, F.when(absent | value.isNotNull(), _none()).otherwise(_entry(v, path))


def typed_rescue(df: DataFrame, text_col: str, schema: StructType, rescued_col: str = "_rescued") -> DataFrame:
    """``df`` without ``text_col``, with the columns of ``schema`` and
    ``rescued_col``, an array of (path, found, value), empty where all fits.
    A text that is not JSON gives NULL columns and one entry of type BROKEN;
    a NULL text gives NULL columns and no entry."""
    doc = F.col("_doc")
    value, rescued = _read(doc, F.lit("$"), schema)
    broken = F.array(F.struct(F.lit("$").alias("path"), F.lit("BROKEN").alias("found"), F.col(text_col).alias("value")).cast(ENTRY))
    rescued = F.when(F.col(text_col).isNull(), _none()).when(doc.isNull(), broken).otherwise(rescued)
    keep = [c for c in df.columns if c != text_col]
    out = df.withColumn("_doc", F.try_parse_json(F.col(text_col))).select(*[F.col(f"`{c}`") for c in keep], value.alias("_value"), rescued.alias(rescued_col))
    return out.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"_value.{f.name}").alias(f.name) for f in schema.fields], rescued_col)
