"""The shared folder, written tables, joins that stand hot keys, and small summaries that several operators use."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an Arrow batch that goes to a Python task. Spark's own 64 MB would be held several times over in each task.
BATCH_BYTES = 4 << 20
#: A key with more rows than this is hot where there are few such keys; else the `MOST_HOT` part of all rows is the bound.
HOT_ROWS = 4096
MOST_HOT = 20_000


def lean(spark: SparkSession) -> SparkSession:
    """Bounds the session's Arrow batches to `BATCH_BYTES` unless it has a bound of its own; results don't depend on it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(BATCH_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`. Only on one machine a folder of its own stands in where it is unset; a cluster without it is refused."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir isn't set: executors and driver need a folder that they share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table of the shared folder and reads it back: later steps read whole files even if executors are lost."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Deletes written tables that no later step reads."""
    for t in tables:
        path = getattr(t, "_folder", None)
        if path:
            jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
            t._folder = None


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of steps that are over. It does so when the driver has collected their plans, which may be long in coming."""
    gc.collect()
    spark._jvm.System.gc()


def small(df: DataFrame, rows: int) -> bool:
    """True if df has at most so many rows; the count that stands before every broadcast here."""
    return df.limit(rows + 1).count() <= rows


def semi(df: DataFrame, ids: DataFrame, on: str | list[str], rows: int = 500_000) -> DataFrame:
    """Rows of df whose key is in ids: by broadcast up to `rows` keys, else by a shuffle join; the rows are the same."""
    return df.join(F.broadcast(ids) if small(ids, rows) else ids, on, "left_semi")


def semi_anti(df: DataFrame, ids: DataFrame, on: str | list[str], rows: int = 500_000) -> DataFrame:
    """Rows of df whose key is not in ids; as `semi`."""
    return df.join(F.broadcast(ids) if small(ids, rows) else ids, on, "left_anti")


def spread_join(rows: DataFrame, one: DataFrame, on: str, how: str = "inner", counts: DataFrame | None = None) -> DataFrame:
    """Joins `rows` with `one`, which has one row per key, so that no key sends more than `HOT_ROWS` rows to a task.

    Hot keys are counted first. Their rows meet `one` by broadcast, the others by a
    shuffle. At most `MOST_HOT` keys are broadcast: where more are over `HOT_ROWS`,
    only those with more than a `MOST_HOT`-th of the hot rows are, of which there
    can't be more. `rows` and `one` are read twice and should be written tables.
    counts: the key and `_rows` of all keys with more than `HOT_ROWS`, where they are known.
    """
    counts = rows.groupBy(on).agg(F.count("*").alias("_rows")) if counts is None else counts.select(on, "_rows")
    hot = written(counts.filter(F.col("_rows") > HOT_ROWS), "hot")
    n, total = hot.agg(F.count("*"), F.sum("_rows")).first()
    if not n:
        return rows.join(one, on, how)
    keys = hot.filter(F.col("_rows") > (total // MOST_HOT if n > MOST_HOT else 0)).select(on)
    few = F.broadcast(keys.join(one.withColumn("_met", F.lit(True)), on, "left"))
    own = rows.join(few, on)
    own = own.filter("_met") if how == "inner" else own
    return own.drop("_met").unionByName(rows.join(F.broadcast(keys), on, "left_anti").join(one, on, how))


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores before it where df has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
