"""Several tables published as one version.

``target/data/<id>/<table>`` holds the Parquet files of a version, written
and checked before anyone can see them.  ``target/manifest/<number>.json``
names the version's tables.  The manifest is written under another name and
renamed into its place, without overwriting: that one rename publishes all
tables together, and of two publishers of the same number one fails.
Readers take the highest number, so a writer that dies or a rule that fails
between two tables leaves them on the version they had.

The store must rename a file atomically (HDFS and local folders do).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sitewise.session import drop_path, path_exists


class PublishConflict(Exception):
    """Another writer has published in the meantime."""


class NothingPublished(Exception):
    """There is no version to read, or not the one asked for."""


@dataclass(frozen=True)
class Published:
    """One version; its tables stay the same whatever is published later."""

    spark: SparkSession
    number: int
    tables: Mapping[str, Mapping[str, object]]

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise NothingPublished(f"version {self.number} has no table {name}")
        entry = self.tables[name]
        return self.spark.read.schema(StructType.fromJson(entry["schema"])).parquet(entry["path"])


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifest(target: str, number: int) -> str:
    return f"{target}/manifest/{number:012d}.json"


def versions(spark: SparkSession, target: str) -> list[int]:
    """Numbers of the published versions, oldest first."""
    if not path_exists(spark, f"{target}/manifest"):
        return []
    p, fs = _hadoop(spark, f"{target}/manifest")
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")


def current(spark: SparkSession, target: str, number: int | None = None) -> Published:
    """The newest version, or the one asked for."""
    known = versions(spark, target)
    if not known or (number is not None and number not in known):
        raise NothingPublished(f"no version {number or ''} in {target}")
    number = known[-1] if number is None else number
    p, fs = _hadoop(spark, _manifest(target, number))
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return Published(spark, number, json.loads(text)["tables"])


def _switch(spark: SparkSession, target: str, number: int, content: str) -> None:
    temp, fs = _hadoop(spark, f"{target}/manifest/.{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, False)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    final, _ = _hadoop(spark, _manifest(target, number))
    jvm = spark._jvm
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(temp.toUri(), spark._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(fs.makeQualified(temp), fs.makeQualified(final), keep)
    except Py4JJavaError as e:
        fs.delete(temp, False)
        if "FileAlreadyExists" in str(e.java_exception):
            raise PublishConflict(f"version {number} of {target} was published by another writer") from e
        raise


def publish(spark: SparkSession, target: str, tables: Mapping[str, DataFrame],
            check: Callable[[dict[str, DataFrame]], None] | None = None) -> Published:
    """Writes ``tables``, runs ``check`` on what was written and publishes
    them as the next version.  An error of a write or of ``check`` (which
    raises to forbid the version) removes what was written and changes
    nothing for readers."""
    target = target.rstrip("/")
    number = (versions(spark, target) or [0])[-1] + 1
    base = f"{target}/data/{number:012d}-{uuid.uuid4().hex}"
    try:
        staged = {}
        for name, df in tables.items():
            df.write.parquet(f"{base}/{name}")
            staged[name] = spark.read.schema(df.schema).parquet(f"{base}/{name}")
        if check:
            check(staged)
        entries = {name: {"path": f"{base}/{name}", "schema": json.loads(df.schema.json())} for name, df in staged.items()}
        _switch(spark, target, number, json.dumps({"number": number, "published": time.time(), "tables": entries}))
    except (Exception, KeyboardInterrupt):
        drop_path(spark, base)
        raise
    return current(spark, target, number)


def collect(spark: SparkSession, target: str, keep: int = 2, grace_s: float = 86_400) -> list[str]:
    """Deletes the data of all but the newest ``keep`` versions, and of
    versions never published, once older than ``grace_s``: a reader may still
    hold an old version, and a writer may still be at work.  Manifests of
    deleted versions go first, so none names missing files."""
    target = target.rstrip("/")
    known = versions(spark, target)
    live = set()
    for number in known[-keep:]:
        live |= {str(e["path"]).rsplit("/", 2)[1] for e in current(spark, target, number).tables.values()}
    if not path_exists(spark, f"{target}/data"):
        return []
    p, fs = _hadoop(spark, f"{target}/data")
    old = [s for s in fs.listStatus(p) if s.getPath().getName() not in live and s.getModificationTime() / 1000 < time.time() - grace_s]
    names = {s.getPath().getName() for s in old}
    for number in known[:-keep]:
        if {str(e["path"]).rsplit("/", 2)[1] for e in current(spark, target, number).tables.values()} <= names:
            drop_path(spark, _manifest(target, number))
    for s in old:
        fs.delete(s.getPath(), True)
    return sorted(names)

