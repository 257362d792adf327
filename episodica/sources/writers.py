"""Sinks: nested documents, chunked training tables, dataset metadata, message logs, manifests, and a result cache."""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def nested_documents(episodes: DataFrame, frames: DataFrame, segments: DataFrame, key: str = "episode_id") -> DataFrame:
    """One JSON document per episode with its frames and segments in order."""
    f = frames.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("frame_idx", *[c for c in frames.columns if c not in (key, "frame_idx")]))).alias("frames"))
    s = segments.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start_time", *[c for c in segments.columns if c not in (key, "start_time")]))).alias("segments"))
    doc = episodes.join(f, key, "left").join(s, key, "left")
    return doc.select(key, F.to_json(F.struct(*doc.columns)).alias("value"))


def write_documents(docs: DataFrame, path: str) -> None:
    docs.select("value").write.mode("overwrite").text(path)


def write_training(frames: DataFrame, path: str, chunk: str = "chunk_index", order: str = "index") -> None:
    """Frame table with one file per chunk: rows meet by chunk, are sorted in it, and chunks are folders."""
    frames.repartition(chunk).sortWithinPartitions(chunk, order).write.mode("overwrite").partitionBy(chunk).parquet(path)


def write_flat(frames: DataFrame, path: str) -> None:
    frames.write.mode("overwrite").parquet(f"{path}/parquet")
    frames.write.mode("overwrite").json(f"{path}/json")


def dataset_info(stats: DataFrame, episodes: DataFrame, fps: float, chunk_size: int) -> str:
    """The dataset's info document: totals, features with pooled statistics. Reads two aggregates of a few rows."""
    total = episodes.agg(F.count("*").alias("episodes"), F.sum("length").alias("frames"), F.count_distinct("task").alias("tasks")).first()
    features = {r["feature"]: {k: r[k] for k in stats.columns if k != "feature"} for r in stats.collect()}
    return json.dumps({"total_episodes": total["episodes"], "total_frames": total["frames"], "total_tasks": total["tasks"], "fps": fps, "chunks_size": chunk_size, "features": features}, sort_keys=True)


#: Of this library's own framing; no public log format is meant.
MAGIC = b"EPLOG1\r\n"


def message_log(frames: DataFrame, key: str, order: str, time: str, payload: Column, topic: str = "/frames", most: int = 10_000) -> DataFrame:
    """Binary logs of an episode, each of at most `most` records (part, from 0): magic, then records of length, topic, nanoseconds and payload in order, and the magic again."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        name, parts = topic.encode(), [MAGIC]
        rows = pdf.sort_values("_place")
        for t, body in zip(rows[time], rows["_payload"], strict=True):
            record = struct.pack("<H", len(name)) + name + struct.pack("<Q", round(t * 1e9)) + body.encode()
            parts.append(struct.pack("<I", len(record)) + record)
        return pd.DataFrame({key: [pdf[key].iloc[0]], "part": [pdf["part"].iloc[0]], "content": [b"".join([*parts, MAGIC])], "messages": [len(pdf)]})

    kinds = dict(frames.dtypes)
    df = frames.select(key, order, time, payload.cast("string").alias("_payload")).withColumn("_place", F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1)
    return df.withColumn("part", F.floor(F.col("_place") / most)).groupBy(key, "part").applyInPandas(pack, f"{key} {kinds[key]}, part long, content binary, messages long")


def read_message_log(logs: DataFrame, key: str, most: int = 10_000) -> DataFrame:
    """key, topic, nanoseconds, payload of every record; a log without its magic gives no rows. A task holds `most` records at once, however many logs come to it together."""
    names = [key, "topic", "nanoseconds", "payload"]

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k, raw in zip(pdf[key], pdf["content"], strict=True):
                raw = bytes(raw)
                at, end = len(MAGIC), len(raw) - len(MAGIC)
                if not (raw.startswith(MAGIC) and raw.endswith(MAGIC)):
                    continue
                while at < end:
                    (n,) = struct.unpack_from("<I", raw, at)
                    (m,) = struct.unpack_from("<H", raw, at + 4)
                    rows.append((k, raw[at + 6 : at + 6 + m].decode(), struct.unpack_from("<Q", raw, at + 6 + m)[0], raw[at + 14 + m : at + 4 + n].decode()))
                    at += 4 + n
                    if len(rows) == most:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
            yield pd.DataFrame(rows, columns=names)

    kinds = dict(logs.dtypes)
    return logs.select(key, "content").mapInPandas(unpack, f"{key} {kinds[key]}, topic string, nanoseconds long, payload string")


def cached(keys: DataFrame, cache: DataFrame | None, key: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Results for all keys: those of the cache, and new ones for keys that it lacks (an anti-join)."""
    if cache is None:
        return compute(keys)
    return cache.join(keys.select(key), key, "left_semi").unionByName(compute(keys.join(cache.select(key), key, "left_anti")))
