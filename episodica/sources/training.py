"""Training data sets: folders of chunked frames with episodes, tasks, statistics and an info document.

    <set>/data/chunk-000/file-000.parquet ...   frames, in order of their index
    <set>/meta/episodes/chunk-000/file-000.parquet
    <set>/meta/tasks.parquet, stats.json, info.json

A folder is a data set if it has an info document and episodes; since the document comes
last, what a failed write leaves is none.  Frames and episodes are written by a Spark data
source in two phases: tasks stage their files, the commit gives them their names.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..operators import assembly as asm
from ..operators import moments as mo
from ..operators.checks import Rule, evaluate
from .mcap import opened

#: Frames that a task writes, about; of small chunks it takes many, since a task costs more than a file.
WRITTEN = 20_000
#: Tasks that list the folders of a data set. Spark's own choice is one for each folder.
LISTERS = 32
DATA_PATH = "data/chunk-{chunk_index:03d}/file-{file_index:03d}.parquet"


@dataclass
class Pieces(WriterCommitMessage):
    files: list[tuple[int, int, str]]  # chunk, first place, where it is


class ChunkWriter(DataSourceArrowWriter):
    """Rows with a chunk and a place in it; within a task they come in order of both. Of a chunk that several tasks write each has a file, numbered by first place."""

    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.job = options["path"].rstrip("/"), uuid.uuid4().hex
        self.chunk, self.place = options.get("chunk", "chunk_index"), options.get("place", "index")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Pieces:
        fs, path = opened(self.path)
        stage = f"{path}/_staged-{self.job}/{uuid.uuid4().hex}"
        fs.create_dir(stage, recursive=True)
        files, out, now = [], None, None
        for batch in iterator:
            chunks, places = batch.column(self.chunk).to_numpy(zero_copy_only=False), batch.column(self.place).to_numpy(zero_copy_only=False)
            rest = batch.drop_columns([self.chunk])
            at = 0
            while at < len(chunks):
                to = at
                while to < len(chunks) and chunks[to] == chunks[at]:
                    to += 1
                if chunks[at] != now:
                    if out is not None:
                        out.close()
                    now = chunks[at]
                    files.append((int(now), int(places[at]), f"{stage}/{len(files)}.parquet"))
                    out = pq.ParquetWriter(files[-1][2], rest.schema, filesystem=fs)
                out.write_batch(rest.slice(at, to - at))
                at = to
        if out is not None:
            out.close()
        return Pieces(files)

    def commit(self, messages: list[Pieces | None]) -> None:
        fs, path = opened(self.path)
        number: dict[int, int] = {}
        for chunk, _, at in sorted(f for m in messages if m is not None for f in m.files):
            k = number[chunk] = number.get(chunk, -1) + 1
            fs.create_dir(f"{path}/chunk-{chunk:03d}", recursive=True)
            fs.move(at, f"{path}/chunk-{chunk:03d}/file-{k:03d}.parquet")
        self.abort(messages)

    def abort(self, messages: list[Pieces | None]) -> None:
        fs, path = opened(self.path)
        if fs.get_file_info(f"{path}/_staged-{self.job}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{path}/_staged-{self.job}")


class ChunkedParquet(DataSource):
    """Write only; what it writes is read as Parquet."""

    @classmethod
    def name(cls) -> str:
        return "chunked_parquet"

    def writer(self, schema: T.StructType, overwrite: bool) -> ChunkWriter:
        return ChunkWriter(self.options, schema)


def _put(path: str, raw: bytes) -> None:
    """A small document under its name, whole or not at all."""
    fs, at = opened(path)
    draft = f"{at}.{uuid.uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        out.write(raw)
    fs.move(draft, at)


def write_training_set(frames: DataFrame, episodes: DataFrame, tasks: DataFrame, counts: DataFrame, moments: DataFrame, path: str, fps: float, chunk_size: int, extra: dict | None = None) -> dict:
    """Writes a data set and returns its info document.

    frames: chunk_index, index and more, features as columns; episodes: a written table of a
    row per episode with episode_index, tasks, length, data/chunk_index, chunks; tasks:
    task_index, task; counts: feature, value, n, from which a merge takes quantiles;
    moments: of parts, by feature.  Tasks and statistics come to the driver: a row per task
    and feature.
    """
    spark = frames.sparkSession
    fs, at = opened(path)
    if fs.get_file_info(f"{at}/meta/info.json").type != pafs.FileType.NotFound:
        raise ValueError(f"{path} is a data set already")
    spark.dataSource.register(ChunkedParquet)
    n, total, chunks = episodes.agg(F.count("*"), F.sum("length"), F.max(F.col("data/chunk_index") + F.col("chunks"))).first()
    writers = max(1, min(chunks or 1, -(-(total or 0) // WRITTEN), 4096))
    frames.repartition(writers, "chunk_index").sortWithinPartitions("chunk_index", "index").write.format("chunked_parquet").mode("append").option("place", "index").save(f"{path}/data")
    rows = episodes.drop("chunks").withColumn("chunk_index", F.lit(0)).orderBy("episode_index")
    rows.write.format("chunked_parquet").mode("append").option("place", "episode_index").save(f"{path}/meta/episodes")
    counts.write.parquet(f"{path}/meta/values")
    stats = _stats_table(moments, spark.read.schema(counts.schema).parquet(f"{path}/meta/values"))
    known = tasks.orderBy("task_index").toArrow()
    with fs.open_output_stream(f"{at}/meta/tasks.parquet") as out:
        pq.write_table(known, out)
    features = {r["feature"]: {k: r[k] for k in stats.columns if k != "feature"} for r in stats.collect()}
    _put(f"{path}/meta/stats.json", json.dumps(features, sort_keys=True).encode())
    kinds = {c: {"dtype": k, "shape": [1], "names": None} for c, k in frames.dtypes if c != "chunk_index"}
    info = {
        "codebase_version": "v3.0", "fps": fps, "total_episodes": n, "total_frames": total or 0, "total_tasks": known.num_rows, "total_videos": 0, "total_chunks": chunks or 0, "chunks_size": chunk_size,
        "splits": {"train": f"0:{n}"}, "data_path": DATA_PATH, "video_path": "videos/{video_key}/chunk-{chunk_index:03d}/file-{file_index:03d}.mp4", "features": kinds, **(extra or {}),
    }
    _put(f"{path}/meta/info.json", json.dumps(info, sort_keys=True).encode())
    return info


def plain(path: Column) -> Column:
    """Addresses of local files in one form; Spark's readers use several."""
    return F.regexp_replace(path, "^file:/+", "file:///")


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """Readers that are opened within list many folders in few tasks; the session's own setting comes back after."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    old = spark.conf.get(name)
    spark.conf.set(name, str(LISTERS))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def _holds(fs: pafs.FileSystem, folder: str) -> bool:
    """Whether there is a Parquet file somewhere below."""
    within = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return any(f.type == pafs.FileType.File and f.base_name.endswith(".parquet") for f in within) or any(f.type == pafs.FileType.Directory and _holds(fs, f.path) for f in within)


def _sets(fs: pafs.FileSystem, folder: str) -> Iterator[str]:
    """Folders of data sets. The frames and episodes of one aren't walked, however many chunks they have."""
    within = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    found = fs.get_file_info(f"{folder}/meta/info.json").type == pafs.FileType.File
    if found and _holds(fs, f"{folder}/meta/episodes"):
        yield folder
    for f in within:
        if f.type == pafs.FileType.Directory and not (found and f.base_name in ("data", "meta")):
            yield from _sets(fs, f.path)


def find_training_sets(spark: SparkSession, root: str) -> DataFrame:
    """set (its folder), info (the document's text) of all data sets under a folder: those that have an info document and episodes, in order. Names of sets come to the driver."""
    fs, at = opened(root)
    at = at.rstrip("/")
    base = re.sub("^file:/+", "file:///", root.rstrip("/") if ":" in root.split("/")[0] else f"file://{at}")
    found = [base + path[len(at) :] for path in _sets(fs, at)]
    if not found:
        return spark.createDataFrame([], "set string, info string")
    infos = spark.read.text([f"{s}/meta/info.json" for s in found], wholetext=True)
    return infos.select(F.regexp_extract(plain(F.col("_metadata.file_path")), "^(.*)/meta/info[.]json$", 1).alias("set"), F.col("value").alias("info")).orderBy("set")


def unwrapped(tasks: Column, kind: T.DataType) -> Column:
    """The first task of a cell, however deep its lists are."""
    while isinstance(kind, T.ArrayType):
        tasks, kind = F.get(tasks, 0), kind.elementType
    return tasks.cast("string")


def read_training_sets(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """sets (set, info), episodes (set, task and more), frames (set and more) of all data sets under a folder; as of `read_set_episodes`."""
    sets, known, episodes = _read(spark, root)
    return sets, episodes, _part(spark, known, "data")


def read_set_episodes(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """sets (set, info), episodes (set, task and more) of all data sets under a folder; chunks of frames aren't looked at.

    Features that don't agree in name and kind are refused.  Names of sets come to the driver.
    """
    sets, _, episodes = _read(spark, root)
    return sets, episodes


def _part(spark: SparkSession, known: list[str], part: str) -> DataFrame:
    with listing(spark):
        return spark.read.option("recursiveFileLookup", True).parquet(*(f"{s}/{part}" for s in known)).withColumn("set", F.regexp_extract(plain(F.col("_metadata.file_path")), f"^(.*)/{part}/", 1))


def _read(spark: SparkSession, root: str) -> tuple[DataFrame, list[str], DataFrame]:
    sets = find_training_sets(spark, root)
    known = sets.select("set", F.get_json_object("info", "$.features").alias("features")).collect()
    if not known:
        raise ValueError(f"no data set under {root}: none has both an info document and episodes")
    kinds = [{k: (v["dtype"], tuple(v.get("shape") or ())) for k, v in json.loads(r["features"]).items() if v["dtype"] != "video"} for r in known]
    for r, own in zip(known, kinds, strict=True):
        if own != kinds[0]:
            raise ValueError(f"features of {r['set']} differ from those of {known[0]['set']}: {sorted(set(own.items()) ^ set(kinds[0].items()))}")
    names = [r["set"] for r in known]
    episodes = _part(spark, names, "meta/episodes")
    if "tasks" in episodes.columns:
        episodes = episodes.withColumn("task", unwrapped(F.col("tasks"), episodes.schema["tasks"].dataType)).drop("tasks")
    return sets, names, episodes


def _kept(df: DataFrame, path: str) -> DataFrame:
    """df as a table of the set's work folder: later steps read it instead of making it again."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _clear(path: str) -> None:
    fs, at = opened(path)
    fs.delete_dir(f"{at}/_work")


AGGREGATES = ("min", "max", "mean", "std", "count")


def _lookup(episodes: DataFrame, chunk_size: int, length: str = "length") -> DataFrame:
    """Look-up rows: index range, first chunk and file, beside what the episodes have. episodes: of `running_offsets`."""
    chunks = asm.pack_chunks(episodes, "episode_index", length, chunk_size).withColumnRenamed("chunk_index", "data/chunk_index")
    return episodes.withColumnsRenamed({"from_index": "dataset_from_index", "to_index": "dataset_to_index"}).join(chunks.select("episode_index", "data/chunk_index", "chunks"), "episode_index").withColumn("data/file_index", F.lit(0))


def _stats_table(parts: DataFrame, counts: DataFrame) -> DataFrame:
    pooled = mo.deviations(mo.merged(parts)).drop("m2")
    return pooled.join(mo.quantiles(counts, {"q01": 0.01, "q99": 0.99}), "feature", "left")


def _finish(frames: DataFrame, rows: DataFrame, drop: list[str], counts: DataFrame, moments: DataFrame, path: str, fps: float, chunk_size: int, extra: dict | None) -> dict:
    tasks = rows.select(F.col("task_index").cast("long").alias("task_index"), "task").distinct()
    info = write_training_set(frames, rows.withColumn("tasks", F.array(F.array("task"))).drop("task", "task_index", *drop), tasks, counts, moments, path, fps, chunk_size, extra)
    _clear(path)
    return info


def export_training_set(frames: DataFrame, episodes: DataFrame, features: list[str], key: str, order: str, path: str, fps: float = 30.0, chunk_size: int = 1000, extra: dict | None = None) -> dict:
    """Numbers, chunks and writes episodes as a data set, with statistics of the whole and of every episode.

    frames: key, order, features; episodes: key (numeric, gives the order), task.
    """
    wide = _kept(mo.wide_moments(frames, features, [key], "length"), f"{path}/_work/moments")
    moments = mo.long_moments(wide, features, [key])
    stats = [F.col(f"`{f}/{a}`").alias(f"stats/{f}/{a}") for f in features for a in AGGREGATES]
    ep = _kept(asm.running_offsets(episodes.join(wide.select(key, "length", *stats), key), key), f"{path}/_work/episodes")
    codes = asm.first_seen_codes(ep, "task", "episode_index", "task_index")
    rows = _kept(_lookup(ep, chunk_size).join(codes.select("task", "task_index"), "task"), f"{path}/_work/rows")
    place = F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1
    long = frames.withColumn("frame_index", place.cast("long")).join(rows.select(key, "episode_index", "dataset_from_index", "task_index", "length", F.col("data/chunk_index").alias("_c")), key)
    chunk = F.col("_c") + F.when(F.col("length") > chunk_size, F.floor(F.col("frame_index") / chunk_size)).otherwise(0)
    long = long.select((F.col("dataset_from_index") + F.col("frame_index")).alias("index"), "frame_index", "episode_index", F.col("task_index").cast("long").alias("task_index"), (F.col("frame_index") / fps).cast("float").alias("timestamp"), *features, chunk.cast("int").alias("chunk_index"))
    counts = mo.value_counts(frames, features)
    return _finish(long, rows, [key], counts, moments, path, fps, chunk_size, extra)


def merge_training_sets(spark: SparkSession, root: str, path: str, chunk_size: int = 1000, must_agree: tuple[str, ...] = ("robot_type",)) -> dict:
    """Joins all data sets under `root`, in order of their folders, to one at `path`; returns its info document.

    Frames are read once, to be renumbered and written; statistics come from those of the
    sets: moments of their documents and counted values.  Differing features and differing
    values of `must_agree` are refused.
    """
    sets, episodes, frames = read_training_sets(spark, root)
    known = [json.loads(r["info"]) | {"set": r["set"]} for r in sets.collect()]
    for name in must_agree:
        if len({str(i.get(name)) for i in known}) > 1:
            raise ValueError(f"data sets differ in {name}: {sorted({str(i.get(name)) for i in known})}")
    offsets, at, ep = [], 0, 0
    for k, i in enumerate(known):
        offsets.append((i["set"], k, at, ep))
        at, ep = at + i["total_frames"], ep + i["total_episodes"]
    base = F.broadcast(spark.createDataFrame(offsets, "set string, _k int, _index long, _episode long"))  # a row per set
    episodes = episodes.join(base, "set").withColumn("episode_index", F.col("episode_index") + F.col("_episode"))
    episodes = episodes.withColumns({"from_index": F.col("dataset_from_index") + F.col("_index"), "to_index": F.col("dataset_to_index") + F.col("_index")}).drop("set", "_k", "_index", "_episode", "dataset_from_index", "dataset_to_index", "data/chunk_index", "data/file_index")
    rows = _lookup(episodes, chunk_size)
    codes = asm.first_seen_codes(rows, "task", "episode_index", "task_index")
    rows = _kept(rows.join(codes.select("task", "task_index"), "task"), f"{path}/_work/rows")
    per = rows.select("episode_index", F.col("task_index").cast("long").alias("_task"), "length", F.col("data/chunk_index").alias("_c"))
    long = frames.join(base, "set").withColumns({"index": F.col("index") + F.col("_index"), "episode_index": F.col("episode_index") + F.col("_episode")}).drop("set", "_k", "_index", "_episode").join(per, "episode_index")
    chunk = F.col("_c") + F.when(F.col("length") > chunk_size, F.floor(F.col("frame_index") / chunk_size)).otherwise(0)
    names = [c for c in frames.columns if c != "set"]
    long = long.withColumn("task_index", F.col("_task")).select(*names, chunk.cast("int").alias("chunk_index"))
    parts = spark.read.text([f"{i['set']}/meta/stats.json" for i in known], wholetext=True).select(F.explode(F.from_json("value", "map<string, struct<count:bigint,mean:double,std:double,min:double,max:double>>")).alias("feature", "s")).select("feature", "s.*")
    parts = parts.withColumn("m2", F.col("std") ** 2 * F.col("count"))
    counts = mo.added(spark.read.parquet(*(f"{i['set']}/meta/values" for i in known)))
    extra = {k: known[0].get(k) for k in must_agree}
    return _finish(long, rows, [], counts, parts, path, known[0]["fps"], chunk_size, extra)


#: What a data set's documents and tables must hold; fixed values of the format.
REQUIRED_FILES = ("meta/info.json", "meta/stats.json", "meta/tasks.parquet", "meta/episodes/chunk-000/file-000.parquet")
REQUIRED_COLUMNS = ("timestamp", "frame_index", "episode_index", "index", "task_index")
REQUIRED_EPISODE_COLUMNS = ("episode_index", "tasks", "length", "data/chunk_index", "data/file_index", "dataset_from_index", "dataset_to_index")
STATISTICS = ("min", "max", "mean", "std", "count", "q01", "q99")
VIDEO_FACTS = ("video.fps", "video.codec", "video.pix_fmt", "video.height", "video.width", "video.channels", "video.is_depth_map")

EXPORT_RULES = [
    Rule("layout", "layout", "present", "name", "place"),
    Rule("info_version", "info", "codebase_version = 'v3.0'", "codebase_version"),
    Rule("info_data_path", "info", "contains(data_path, '{chunk_index:03d}')", "data_path"),
    Rule("info_video_path", "info", "contains(video_path, '{video_key}')", "video_path"),
    Rule("info_splits", "info", "splits like '{%}'", "splits"),
    Rule("info_total_frames", "info", "total_frames = rows", "concat(total_frames, ' and ', rows, ' rows')"),
    Rule("info_total_episodes", "info", "total_episodes = episodes", "concat(total_episodes, ' and ', episodes, ' rows')"),
    Rule("info_total_chunks", "info", "total_chunks = chunks", "concat(total_chunks, ' and ', chunks, ' folders')"),
    Rule("info_total_videos", "info", "(total_videos > 0) = (videos > 0)", "concat(total_videos, ' and ', videos, ' video features')"),
    Rule("features", "features", "true", "feature", needs_rows=True),
    Rule("stats_keys", "features", "is_video or (in_features and in_stats)", "concat(feature, if(in_stats, ' only in statistics', ' without statistics'))"),
    Rule("stats_complete", "features", "is_video or not in_stats or stats_complete", "feature"),
    Rule("video_facts", "features", "not is_video or video_complete", "feature"),
    Rule("columns", "columns", "present", "name", "place"),
    Rule("index_range", "info", "rows = 0 or (low = 0 and high = rows - 1 and places = rows)", "concat(low, ' to ', high, ', ', places, ' of ', rows)"),
    Rule("timestamps", "frames", "abs(timestamp - frame_index / fps) <= 1e-3", "concat('index ', index, ': ', timestamp)", "index"),
    Rule("frame_places", "frames", "frame_index = index - dataset_from_index and index < dataset_to_index", "concat('index ', index, ' of episode ', episode_index)", "index"),
    Rule("episode_numbers", "episodes", "episode_index = expected_index", "episode_index", "episode_index"),
    Rule("episode_starts", "episodes", "dataset_from_index = expected_from", "concat(episode_index, ': ', dataset_from_index, ' and not ', expected_from)", "episode_index"),
    Rule("episode_ends", "episodes", "dataset_to_index = dataset_from_index + length", "concat(episode_index, ': ', dataset_to_index)", "episode_index"),
]


def export_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables that `EXPORT_RULES` are about, of the data set at a folder; what is missing gives rows that say so."""
    with listing(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        frames = spark.read.option("recursiveFileLookup", True).parquet(f"{path}/data")
        episodes = spark.read.option("recursiveFileLookup", True).parquet(f"{path}/meta/episodes")
    listed = files.select(F.regexp_extract(plain(F.col("path")), r"((?:meta|data)/.*)$", 1).alias("name"))
    required = spark.createDataFrame([(k, n) for k, n in enumerate((*REQUIRED_FILES, "data/"))], "place int, name string")
    there = listed.select(F.when(F.col("name").startswith("data/"), "data/").otherwise(F.col("name")).alias("name")).distinct().withColumn("_there", F.lit(True))
    layout = required.join(there, "name", "left").select("place", "name", F.coalesce("_there", F.lit(False)).alias("present"))
    text = lambda name: spark.read.text(f"{path}/meta/{name}", wholetext=True).first()[0]
    info, stats = json.loads(text("info.json")), json.loads(text("stats.json"))
    kinds = info.get("features", {})
    facts = lambda f: set(kinds.get(f, {}).get("info", {})) >= set(VIDEO_FACTS)
    rows = [(f, f in kinds, kinds.get(f, {}).get("dtype") == "video", f in stats, set(stats.get(f, {})) >= set(STATISTICS), facts(f)) for f in sorted({*kinds, *stats}) if f not in REQUIRED_COLUMNS or f in stats]
    features = spark.createDataFrame(rows, "feature string, in_features boolean, is_video boolean, in_stats boolean, stats_complete boolean, video_complete boolean")
    names = [(n, n in have) for have, need in ((frames.columns, REQUIRED_COLUMNS), (episodes.columns, (*REQUIRED_EPISODE_COLUMNS, *(f"stats/{f}/{a}" for f in stats for a in AGGREGATES)))) for n in need]
    columns = spark.createDataFrame([(k, n, h) for k, (n, h) in enumerate(names)], "place int, name string, present boolean")
    chunks = listed.filter("name like 'data/%'").select(F.regexp_extract("name", "^data/([^/]*)/", 1)).distinct().count()
    total = frames.agg(F.count("*").alias("rows"), F.min("index").alias("low"), F.max("index").alias("high"), F.count_distinct("index").alias("places"))
    own = ("codebase_version", "data_path", "video_path", "total_frames", "total_episodes", "total_chunks", "total_videos")
    facts_row = total.select("*", F.lit(episodes.count()).alias("episodes"), F.lit(chunks).alias("chunks"), F.lit(sum(v.get("dtype") == "video" for v in kinds.values())).alias("videos"), F.lit(json.dumps(info["splits"]) if isinstance(info.get("splits"), dict) else None).cast("string").alias("splits"), *(F.lit(info.get(k)).alias(k) for k in own))
    numbered = asm.running_offsets(episodes.withColumn("_n", F.col("episode_index")).drop("episode_index"), "_n").withColumnsRenamed({"episode_index": "expected_index", "from_index": "expected_from", "_n": "episode_index"}).drop("to_index")
    fps = F.col("fps") if "fps" in episodes.columns else F.lit(float(info.get("fps", 30.0)))
    placed = frames.join(episodes.select("episode_index", "dataset_from_index", "dataset_to_index", fps.alias("fps")), "episode_index", "left")
    return {"layout": layout, "info": facts_row, "features": features, "columns": columns, "frames": placed, "episodes": numbered}


def validate_training_set(spark: SparkSession, path: str) -> DataFrame:
    """check, level, rows, bad, ok, details of every rule about the data set at a folder."""
    return evaluate(export_tables(spark, path), EXPORT_RULES)
