"""Tables with versions: whole new versions and keyed write-backs that take effect at once or not at all.

A table is a folder with one folder of Parquet files per version and a log of entries, one
small file per version.  A version's files are complete before its entry is made, and readers
go by the log alone; so a write that fails, or is lost with its executors, leaves the version
before it as it was.  Two writers that start from the same version want the same entry: one
gets it, the other is refused and may start again.  Paths are opened by Spark's file systems.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class VersionConflict(RuntimeError):
    """Another writer has made a version since the one that this write began from."""


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _entries(spark: SparkSession, root: str) -> list[int]:
    at, fs = _files(spark, f"{root}/_log")
    return sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(at) if s.getPath().getName().endswith(".json")) if fs.exists(at) else []


def _entry(spark: SparkSession, root: str, version: int) -> dict:
    return json.loads(spark.read.text(f"{root}/_log/{version:08d}.json", wholetext=True).first()[0])


def latest(spark: SparkSession, root: str) -> int:
    """The current version, from 1; 0 for a table that has none yet."""
    return max(_entries(spark, root), default=0)


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    version = latest(spark, root) if version is None else version
    if version not in _entries(spark, root):
        raise ValueError(f"{root} has no version {version}")
    found = _entry(spark, root, version)
    return spark.read.schema(found["schema"]).parquet(f"{root}/{found['folder']}")


def write(df: DataFrame, root: str, base: int | None = None, note: str = "") -> int:
    """Makes df the next version after `base`, by default the current one; returns its number."""
    spark = df.sparkSession
    base = latest(spark, root) if base is None else base
    folder = f"v-{uuid.uuid4().hex}"
    try:
        df.write.parquet(f"{root}/{folder}")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        _publish(spark, root, base + 1, json.dumps({"folder": folder, "schema": schema, "note": note}))
    except BaseException:
        at, fs = _files(spark, f"{root}/{folder}")
        fs.delete(at, True)
        raise
    return base + 1


def _publish(spark: SparkSession, root: str, version: int, text: str) -> None:
    """Makes the entry: its text goes to a file of its own, which takes the entry's name unless that is there."""
    jvm = spark._jvm
    draft, fs = _files(spark, f"{root}/_log/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    entry, _ = _files(spark, f"{root}/_log/{version:08d}.json")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(entry.toUri() if entry.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    never = spark._sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, entry, never)
    except Exception as error:
        fs.delete(draft, False)
        if fs.exists(entry):
            raise VersionConflict(f"version {version} of {root} is there already") from error
        raise


def upsert(changes: DataFrame, root: str, keys: Sequence[str], note: str = "") -> int:
    """Writes the changed columns of `changes` back into the rows with its keys and adds rows for new ones; a new version.

    Columns that `changes` lacks stay, columns that the table lacks are null in other rows;
    a null in `changes` is a value.  Keys that are null or stand twice in `changes` are refused.
    """
    spark = changes.sparkSession
    base = latest(spark, root)
    if not base:
        return write(changes, root, 0, note)
    wrong = changes.groupBy(*keys).agg(F.count("*").alias("_n")).filter(" or ".join(["_n > 1", *(f"`{k}` is null" for k in keys)]))
    if wrong.limit(1).count():
        raise ValueError(f"rows to write back have keys {list(keys)} that are null or stand twice")
    old = read(spark, root, base)
    news = [c for c in changes.columns if c not in keys]
    both = old.withColumn("_old", F.lit(True)).join(changes.select(*keys, F.struct(F.lit(True).alias("_new"), *news).alias("_change")), list(keys), "full_outer")
    names = [*old.columns, *(c for c in news if c not in old.columns)]
    merged = both.select(*(F.col(c) if c not in news else F.when(F.col("_change").isNotNull(), F.col(f"_change.{c}")).otherwise(F.col(c) if c in old.columns else F.lit(None)).alias(c) for c in names))
    return write(merged, root, base, note)


def drop_old(spark: SparkSession, root: str, keep: int = 1) -> list[int]:
    """Deletes all versions but the last `keep`, and folders of writes that never became one; returns the numbers that are left."""
    entries = _entries(spark, root)
    kept = entries[-max(1, keep) :]
    folders = {_entry(spark, root, v)["folder"] for v in kept}
    for v in entries[: len(entries) - len(kept)]:
        at, fs = _files(spark, f"{root}/_log/{v:08d}.json")
        fs.delete(at, False)
    at, fs = _files(spark, root)
    for s in fs.listStatus(at):
        name = s.getPath().getName()
        if name.startswith("v-") and name not in folders:
            fs.delete(s.getPath(), True)
    return kept
