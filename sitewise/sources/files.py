"""Landed-file ingestion: lineage, ledgers, seeds, schema checks, plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitewise.functions.clock import local_instant
from sitewise.session import materialize, path_exists


class SchemaMismatch(Exception):
    pass


# Microsecond timestamps in landed JSON (the default format keeps milliseconds).
TS_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def with_lineage(df: DataFrame) -> DataFrame:
    """File lineage columns from the hidden ``_metadata`` struct."""
    return (df.withColumn("_file", F.col("_metadata.file_path"))
              .withColumn("_file_modified", F.col("_metadata.file_modification_time"))
              .withColumn("_ingested_at", F.current_timestamp()))


def path_field(pattern: str, group: int = 1, col: str = "_file") -> Column:
    """A value carried by the file path (zone, snapshot, period)."""
    return F.regexp_extract(F.col(col), pattern, group)


def exact_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Fail at plan time when columns are missing or extra."""
    got, want = set(df.columns), set(expected)
    if got != want:
        raise SchemaMismatch(f"missing {sorted(want - got)}, extra {sorted(got - want)}")
    return df


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Distributed listing (path, modification time, length) — the binary
    file source reads no content when only metadata columns are selected."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").load(path)
            .select("path", "modificationTime", "length"))


def plain_path(c: Column) -> Column:
    """One spelling for a file's path: listings give it plain, ``_metadata``
    percent-encoded, and the slashes after the scheme vary."""
    decoded = F.url_decode(F.regexp_replace(c, r"\+", "%2B"))  # a plus is itself in a path
    return F.regexp_replace(decoded, "^([a-z0-9]+):/+", "$1:/")


def listed_path(c: Column) -> Column:
    return F.regexp_replace(c, "^([a-z0-9]+):/+", "$1:/")


def new_files(listing: DataFrame, ledger: DataFrame, ledger_col: str = "_file") -> DataFrame:
    """Files of ``listing`` not yet in the ledger, a column of ``_metadata``
    paths (``left_anti``, no collect of the ledger)."""
    done = ledger.select(plain_path(F.col(ledger_col)).alias("_done")).distinct()
    return listing.join(done, listed_path(F.col("path")) == F.col("_done"), "left_anti")


def ledger_append(spark: SparkSession, source_dir: str, target: str, schema: StructType,
                  fmt: str = "json", glob: str = "*.json", options: dict | None = None) -> int:
    """Append the files of ``source_dir`` that the target has not seen.

    The ledger is the target's own ``_file`` column.  The first run reads the
    folder whole; later ones read it filtered to the new files by a semi join
    on the path, so no file name reaches the driver.  Re-running adds
    nothing.  Returns the number of files appended.
    """
    listing = list_files(spark, source_dir, glob)
    reader = (spark.read.schema(schema).options(**TS_OPTIONS).options(**(options or {})).format(fmt)
              .option("recursiveFileLookup", "true").option("pathGlobFilter", glob))
    rows = with_lineage(reader.load(source_dir))
    if path_exists(spark, target):
        todo = materialize(new_files(listing, spark.read.parquet(target).select("_file")).select("path"))
        n = todo.count()
        if n:
            mine = todo.select(listed_path(F.col("path")).alias("_todo"))
            rows = rows.join(mine, plain_path(F.col("_file")) == F.col("_todo"), "left_semi")
    else:
        n = listing.count()
    if n:
        rows.write.mode("append").parquet(target)
    return n


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Seed CSV: every column a string, BOM and blanks stripped from the
    header, identifier-only header names (else fail), '' kept as ''."""
    df = (spark.read.option("header", "true").option("inferSchema", "false")
          .option("encoding", "UTF-8").option("emptyValue", "").csv(path))
    import re
    names = [c.replace("﻿", "").strip() for c in df.columns]
    bad = [n for n in names if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", n)]
    if bad:
        raise SchemaMismatch(f"seed header is not identifiers: {bad}")
    return df.toDF(*names)


def folder_of(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def complete_folders(listing: DataFrame, marker: str) -> DataFrame:
    """(folder, completed_at) of the folders of a ``list_files`` listing that
    hold the marker, a file that a delivery writes last (not an empty one,
    which listings leave out)."""
    done = listing.where(F.element_at(F.split("path", "/"), -1) == marker)
    return done.groupBy(folder_of(listed_path(F.col("path"))).alias("folder")).agg(F.min("modificationTime").alias("completed_at"))


def rows_of_complete_folders(df: DataFrame, listing: DataFrame, marker: str, file_col: str = "_file") -> DataFrame:
    """Rows of files in complete folders; a folder whose delivery is still
    under way gives none.  A semi join on the folder, no listing on the driver."""
    folders = complete_folders(listing, marker).select("folder")
    return df.join(folders, folder_of(plain_path(F.col(file_col))) == F.col("folder"), "left_semi")


def missing_file_plan(expected: DataFrame, present: DataFrame, keys: Sequence[str],
                      day_col: str, today: Column) -> DataFrame:
    """Every expected (day, key…) without a landed file: a gap in the past
    is a ``warning``; today/tomorrow not yet published is ``normal``."""
    miss = expected.join(present.select(*keys, day_col).distinct(), [*keys, day_col], "left_anti")
    return miss.withColumn("severity", F.when(F.col(day_col) < today, "warning").otherwise("normal"))


def overdue_files(expected: DataFrame, present: DataFrame, keys: Sequence[str], day_col: str, now: Column,
                  tz: str, publish_at: str = "13:00", days_before: int = 1) -> DataFrame:
    """Every expected (day, key…) without a landed file, with ``due_at``, the
    UTC wall clock at which it is published at the earliest, and severity:
    ``warning`` once ``now`` (UTC wall clock) has reached it, else ``normal``.

    A day's file is due at ``publish_at`` local time of ``tz``, ``days_before``
    days earlier, so the deadline moves by an hour in UTC with the clock
    changes and never falls on another local hour."""
    miss = expected.join(present.select(*keys, day_col).distinct(), [*keys, day_col], "left_anti")
    miss = miss.withColumn("due_at", local_instant(F.col(day_col), publish_at, tz, days_before))
    return miss.withColumn("severity", F.when(now >= F.col("due_at"), "warning").otherwise("normal"))


def rescued_data(text: DataFrame, text_col: str, known: Sequence[str]) -> DataFrame:
    """Top-level JSON fields outside the declared columns, kept as a JSON
    object in ``_rescued_data`` (NULL when there are none)."""
    known_arr = F.array(*[F.lit(k) for k in known])
    fields = F.from_json(F.col(text_col), "map<string,string>")
    extra = F.map_filter(fields, lambda k, v: ~F.array_contains(known_arr, k))
    return text.withColumn("_rescued_data", F.when(F.size(extra) > 0, F.to_json(extra)))


def read_sheet_export(spark: SparkSession, path: str, key_col: str) -> DataFrame:
    """One workbook sheet exported as CSV: all-string seed columns, footnote
    and blank rows (no key) dropped."""
    df = read_seed_csv(spark, path)
    return df.where(F.col(key_col).isNotNull() & (F.trim(F.col(key_col)) != ""))


def catalog_columns(spark: SparkSession, exclude_prefix: str = "_") -> DataFrame:
    """Columns × tables of the current catalog (name, type, nullable),
    internal names (``exclude_prefix``) left out.  Catalog metadata is small
    and lives on the driver, so the listing is built there."""
    rows = []
    for t in spark.catalog.listTables():
        if t.name.startswith(exclude_prefix):
            continue
        for c in spark.catalog.listColumns(t.name):
            if not c.name.startswith(exclude_prefix):
                rows.append((t.name, c.name, c.dataType, bool(c.nullable)))
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, nullable boolean")
