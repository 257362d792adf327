"""Readers and sinks by round trips."""

import json

import pytest
from pyspark.sql import functions as F

from episodica.sources import readers, writers


def test_old_and_new_documents(spark, tmp_path):
    doc = {"episode_id": "a", "num_frames": 2, "frames": [{"frame_idx": 0, "timestamp": 0.0, "left_contact": True, "left_grasp": "open"}, {"frame_idx": 1, "timestamp": 0.1, "left_contact": {"in_contact": True}, "left_grasp": {"type": "hook"}}],
           "segments": [{"name": "grasp", "start_time": 0.0, "end_time": 0.1, "hand_used": "both"}]}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    episodes, frames, segments = readers.read_episodes(spark, str(tmp_path / "a.json"))
    assert episodes.count() == 1
    assert [(r["left_contact"], r["left_grasp"]) for r in frames.orderBy("frame_idx").collect()] == [(True, "open"), (True, "hook")]
    assert segments.first()["hands"] == ["left", "right"]


def test_truth_needs_its_columns(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("video_id,frame_idx\na,1\n")
    with pytest.raises(ValueError, match="lacks"):
        readers.read_truth(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "ok.csv").write_text(",".join(readers.TRUTH_COLUMNS) + "\na,1,0.5,cup,left,1,open,\nb,2,x,cup,left,0,hook,\n")
    df = readers.read_truth(spark, str(tmp_path / "ok.csv"), "a")
    assert df.count() == 1 and df.first()["timestamp_sec"] == 0.5


def test_joint_tables(spark, tmp_path):
    (tmp_path / "r.xml").write_text('<robot name="arm"><joint name="j1" type="revolute"><limit lower="-1.5" upper="2" velocity="2.1"/></joint><joint name="f" type="fixed"></joint></robot>')
    assert [tuple(r) for r in readers.read_joints(spark, str(tmp_path / "r.xml")).collect()] == [("arm", "j1", -1.5, 2.0, 2.1)]


def test_chunks_are_folders_with_one_file(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 3).alias("chunk_index"), F.col("id").alias("index"))
    writers.write_training(df, str(tmp_path / "data"))
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in (tmp_path / "data").glob("chunk_index=*"))
    assert readers.read_training(spark, str(tmp_path / "data")).count() == 100


def test_message_log_round_trip(spark):
    df = spark.createDataFrame([(1, 1, 0.5, "b"), (1, 0, 0.25, "a"), (2, 0, 0.0, "ü")], "e int, i int, t double, body string")
    logs = writers.message_log(df, "e", "i", "t", F.col("body"), most=1)
    assert {(r["part"], r["messages"]) for r in logs.filter("e = 1").collect()} >= {(0, 1)} and logs.agg(F.max("messages")).first()[0] == 1
    got = sorted((r["e"], r["nanoseconds"], r["payload"]) for r in writers.read_message_log(logs, "e").collect())
    assert got == [(1, 250_000_000, "a"), (1, 500_000_000, "b"), (2, 0, "ü")]
    broken = spark.createDataFrame([(1, bytearray(b"nothing"))], "e int, content binary")
    assert writers.read_message_log(broken, "e").count() == 0


def test_nested_documents_and_cache(spark):
    ep = spark.createDataFrame([("a", "task")], "episode_id string, task string")
    fr = spark.createDataFrame([("a", 1, 0.1), ("a", 0, 0.0)], "episode_id string, frame_idx int, t double")
    sg = spark.createDataFrame([("a", 0.0, "grasp")], "episode_id string, start_time double, name string")
    doc = json.loads(writers.nested_documents(ep, fr, sg).first()["value"])
    assert [f["frame_idx"] for f in doc["frames"]] == [0, 1] and doc["segments"][0]["name"] == "grasp"
    keys, done = spark.createDataFrame([("x",), ("y",)], "k string"), spark.createDataFrame([("x", "old")], "k string, v string")
    assert sorted(map(tuple, writers.cached(keys, done, "k", lambda d: d.withColumn("v", F.lit("new"))).collect())) == [("x", "old"), ("y", "new")]
