"""Versioned tables, data sets written, found, refused and merged, mergeable statistics, rules."""

import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.operators import checks, moments
from episodica.sources import training, versions


def test_write_back_takes_effect_at_once_or_not_at_all(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    assert versions.latest(spark, root) == 0
    rows = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], "id long, name string, x double")
    assert versions.write(rows, root) == 1
    change = spark.createDataFrame([(2, None, True), (4, 4.0, False)], "id long, x double, verified boolean")
    assert versions.upsert(change, root, ["id"]) == 2
    want = [(1, "a", 1.0, None), (2, "b", None, True), (3, "c", None, None), (4, None, 4.0, False)]
    assert sorted(tuple(r) for r in versions.read(spark, root).collect()) == want
    assert sorted(tuple(r) for r in versions.read(spark, root, 1).collect()) == [tuple(r) for r in rows.collect()]
    with pytest.raises(Exception, match="lost"):  # a task fails
        versions.upsert(change.withColumn("x", F.when(F.col("id") == 4, F.raise_error(F.lit("lost")).cast("double")).otherwise(0.0)), root, ["id"])
    assert versions.latest(spark, root) == 2 and sorted(tuple(r) for r in versions.read(spark, root).collect()) == want
    for bad in (change.unionByName(change), spark.createDataFrame([(None, 1.0)], "id long, x double")):
        with pytest.raises(ValueError, match="null or stand twice"):
            versions.upsert(bad, root, ["id"])
    assert versions.write(rows, root, base=2) == 3
    with pytest.raises(versions.VersionConflict):  # began from the same version as another
        versions.write(rows, root, base=2)
    assert versions.drop_old(spark, root) == [3] and versions.read(spark, root).count() == 3
    assert len([p for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")]) == 1
    with pytest.raises(ValueError, match="no version 1"):
        versions.read(spark, root, 1)


def episodes_of(spark, seed, n, task):
    rng = np.random.default_rng(seed)
    rows = [(e * 7, t, float(rng.integers(0, 20)), float(rng.normal())) for e in range(n) for t in range(int(rng.integers(1, 9)))]
    frames = spark.createDataFrame(rows, "e long, t long, q double, x double")
    return frames, spark.createDataFrame([(e * 7, task if e % 2 else "pick up") for e in range(n)], "e long, task string")


def test_export_merge_and_statistics(spark, tmp_path):
    root, out = f"file://{tmp_path}/sets", f"file://{tmp_path}/merged"
    rows = []
    for k in range(3):
        frames, eps = episodes_of(spark, k, 5 + k, f"task {k}")
        info = training.export_training_set(frames, eps, ["q", "x"], "e", "t", f"{root}/s{k}/set", chunk_size=6, extra={"robot_type": "arm"})
        got = sorted((r["e"], r["t"], r["q"], r["x"]) for r in frames.collect())
        rows.append((got, [r["task"] for r in eps.orderBy("e").collect()]))
        assert info["total_frames"] == len(got) and (tmp_path / f"sets/s{k}/set/data/chunk-000/file-000.parquet").exists()
    # what isn't whole is no data set
    (tmp_path / "sets/half/meta/episodes").mkdir(parents=True)
    (tmp_path / "sets/other/meta").mkdir(parents=True)
    (tmp_path / "sets/other/meta/info.json").write_text("{}")
    assert [Path(r["set"]).parent.name for r in training.find_training_sets(spark, root).collect()] == ["s0", "s1", "s2"]
    info = training.merge_training_sets(spark, root, out, chunk_size=10)
    every = [f for fs, _ in rows for f in fs]
    assert (info["total_episodes"], info["total_frames"], info["total_tasks"], info["robot_type"]) == (18, len(every), 4, "arm")
    sets, eps, frames = training.read_training_sets(spark, out)
    got = frames.orderBy("index").collect()
    assert [r["index"] for r in got] == list(range(len(every))) and [(r["q"], r["x"]) for r in got] == [(q, x) for _, _, q, x in every]
    assert all(abs(r["timestamp"] - r["frame_index"] / 30) < 1e-5 for r in got)
    ep = eps.orderBy("episode_index").collect()
    assert [r["task"] for r in ep] == [t for _, ts in rows for t in ts] and [r["episode_index"] for r in ep] == list(range(18))
    names = [r["task"] for r in spark.read.parquet(f"{out}/meta/tasks.parquet").orderBy("task_index").collect()]
    assert names == ["pick up", "task 0", "task 1", "task 2"]
    at, chunk, filled = 0, 0, 0
    for r in ep:
        assert (r["dataset_from_index"], r["dataset_to_index"]) == (at, at + r["length"])
        own = [x for x in got if x["episode_index"] == r["episode_index"]]
        assert [x["frame_index"] for x in own] == list(range(r["length"])) and {names[x["task_index"]] for x in own} == {r["task"]}
        assert r["stats/q/mean"] == pytest.approx(np.mean([x["q"] for x in own])) and r["stats/x/count"] == r["length"]
        chunk, filled = (chunk + 1, r["length"]) if filled and filled + r["length"] > 10 else (chunk, filled + r["length"])
        assert r["data/chunk_index"] == chunk
        at += r["length"]
    assert len(list((tmp_path / "merged/data").iterdir())) == info["total_chunks"] == chunk + 1
    report = {r["check"]: r for r in training.validate_training_set(spark, out).collect()}
    assert len(report) == len(training.EXPORT_RULES) and all(r["ok"] for r in report.values()), [r for r in report.values() if not r["ok"]]
    # merged from the sets' statistics, equal to those of all frames
    stats = json.loads((tmp_path / "merged/meta/stats.json").read_text())
    for f, col in (("q", 2), ("x", 3)):
        v = np.array([r[col] for r in every])
        want = {"min": v.min(), "max": v.max(), "mean": v.mean(), "std": v.std(), "count": len(v), "q01": np.quantile(v, 0.01), "q99": np.quantile(v, 0.99)}
        assert stats[f] == pytest.approx(want)


def test_sets_that_do_not_fit_are_refused(spark, tmp_path):
    frames, eps = episodes_of(spark, 1, 2, "a")
    training.export_training_set(frames, eps, ["q", "x"], "e", "t", f"{tmp_path}/r/a", extra={"robot_type": "arm"})
    with pytest.raises(ValueError, match="already"):
        training.export_training_set(frames, eps, ["q", "x"], "e", "t", f"{tmp_path}/r/a")
    training.export_training_set(frames, eps, ["q", "x"], "e", "t", f"{tmp_path}/r/b", extra={"robot_type": "leg"})
    with pytest.raises(ValueError, match="differ in robot_type"):
        training.merge_training_sets(spark, f"{tmp_path}/r", f"{tmp_path}/m")
    training.export_training_set(frames, eps, ["q"], "e", "t", f"{tmp_path}/r/c", extra={"robot_type": "arm"})
    with pytest.raises(ValueError, match="features of"):
        training.read_training_sets(spark, f"{tmp_path}/r")
    with pytest.raises(ValueError, match="no data set"):
        training.read_training_sets(spark, f"{tmp_path}/r/a/data")
    bad = frames.withColumn("x", F.when(F.col("e") == 7, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="lost"):
        training.export_training_set(bad, eps, ["q", "x"], "e", "t", f"{tmp_path}/f/a")
    (tmp_path / "f").mkdir(exist_ok=True)
    assert training.find_training_sets(spark, f"{tmp_path}/r").count() == 3 and not list((tmp_path / "f").rglob("info.json"))


def test_moments_of_parts_and_the_whole(spark):
    rng = np.random.default_rng(9)
    rows = [(int(k), float(1e6 + v), None if v > 2 else float(v)) for k, v in zip(rng.integers(0, 5, 400), rng.normal(size=400), strict=True)]
    df = spark.createDataFrame(rows, "part int, big double, gaps double").withColumn("none", F.lit(None).cast("double"))
    names = ["big", "gaps", "none"]
    both = {r["feature"]: r for r in moments.deviations(moments.merged(moments.moments(df, names, ["part"]))).collect()}
    for f, col in (("big", 1), ("gaps", 2)):
        v = np.array([r[col] for r in rows if r[col] is not None])
        assert (both[f]["count"], both[f]["min"], both[f]["max"]) == (len(v), v.min(), v.max())
        assert both[f]["mean"] == pytest.approx(v.mean(), rel=1e-12) and both[f]["std"] == pytest.approx(v.std(), rel=1e-9)
    assert (both["none"]["count"], both["none"]["mean"]) == (0, None)
    counts = moments.added(moments.value_counts(df.withColumn("big", F.round("big", 1)), names, ["part"]))
    q = {r["feature"]: r["m"] for r in moments.quantiles(counts, {"m": 0.37}).collect()}
    assert q["big"] == pytest.approx(np.quantile(np.round([r[1] for r in rows], 1), 0.37))


def test_rules(spark):
    frames = spark.createDataFrame([(i, i / 30 + (0.5 if i in (3, 7, 8, 9) else 0.0), None if i == 2 else i) for i in range(12)], "i int, t double, k int")
    rules = [
        checks.Rule("clock", "frames", "abs(t - i / 30.0) < 1e-3", "concat('row ', i)", "i"),
        checks.Rule("known", "frames", "k >= 0", "i", "i", level="warning"),
        checks.Rule("some", "empty", "true", "''", needs_rows=True),
        checks.Rule("none", "empty", "false", "''"),
    ]
    got = {r["check"]: r for r in checks.evaluate({"frames": frames, "empty": frames.limit(0)}, rules).collect()}
    assert (got["clock"]["bad"], got["clock"]["ok"], got["clock"]["details"]) == (4, False, ["row 3", "row 7", "row 8"])
    assert (got["known"]["bad"], got["known"]["details"], got["known"]["level"]) == (1, ["2"], "warning")
    assert (got["some"]["ok"], got["none"]["ok"], got["none"]["rows"]) == (False, True, 0)
    assert not checks.passed(checks.evaluate({"frames": frames}, rules[:2])) and checks.passed(checks.evaluate({"frames": frames}, rules[1:2]))


def test_export_rules_find_what_is_wrong(spark, tmp_path):
    frames, eps = episodes_of(spark, 4, 6, "a")
    at = tmp_path / "s"
    training.export_training_set(frames, eps, ["q", "x"], "e", "t", f"file://{at}", chunk_size=8)
    info, stats = (json.loads((at / f"meta/{n}.json").read_text()) for n in ("info", "stats"))
    info |= {"codebase_version": "v2", "data_path": "data/file.parquet", "splits": None, "total_frames": 1, "total_videos": 2}
    info["features"] |= {"camera": {"dtype": "video", "info": {"video.fps": 30}}, "lost": {"dtype": "float"}}
    (at / "meta/info.json").write_text(json.dumps(info))
    (at / "meta/stats.json").write_text(json.dumps({"q": {k: v for k, v in stats["q"].items() if k != "q01"}, "x": stats["x"]}))
    (at / "meta/tasks.parquet").unlink()
    chunk = sorted((at / "data").rglob("*.parquet"))[-1]
    table = spark.read.parquet(str(chunk)).toPandas()
    table.loc[0, "timestamp"] = 9.0
    table.loc[len(table) - 1, "index"] += 3
    table.to_parquet(chunk)
    own = at / "meta/episodes/chunk-000/file-000.parquet"
    rows = spark.read.parquet(str(own)).toPandas()
    rows.loc[2, "dataset_from_index"] += 1
    rows.drop(columns=["stats/x/std"]).to_parquet(own)
    bad = {r["check"]: (r["bad"], r["details"]) for r in training.validate_training_set(spark, f"file://{at}").collect() if not r["ok"]}
    assert set(bad) == {"layout", "info_version", "info_data_path", "info_splits", "info_total_frames", "stats_keys", "stats_complete", "video_facts", "columns", "index_range", "timestamps", "frame_places", "episode_starts", "episode_ends"}
    assert bad["layout"] == (1, ["meta/tasks.parquet"]) and bad["stats_keys"] == (1, ["lost without statistics"]) and bad["columns"] == (1, ["stats/x/std"]) and bad["video_facts"] == (1, ["camera"])
    assert bad["timestamps"][0] == 1 and bad["episode_starts"][0] == 1


def test_sets_are_found_without_walking_their_chunks(spark, tmp_path, monkeypatch):
    """Folders that are looked into, and tasks that write, don't grow with the number of chunks."""
    frames = spark.range(300).select(F.floor(F.col("id") / 3).alias("e"), (F.col("id") % 3).alias("t"), F.col("id").cast("double").alias("q"))
    eps = spark.range(100).select(F.col("id").alias("e"), F.lit("a").alias("task"))
    root = f"file://{tmp_path}/w"
    info = training.export_training_set(frames, eps, ["q"], "e", "t", f"{root}/a/set", chunk_size=3)
    assert info["total_chunks"] == 100 and len(list((tmp_path / "w/a/set/data").iterdir())) == 100
    asked, real = [], training.pafs.FileSelector
    monkeypatch.setattr(training.pafs, "FileSelector", lambda folder, **how: asked.append(folder) or real(folder, **how))
    sets, eps = training.read_set_episodes(spark, root)
    assert [r["set"] for r in sets.collect()] == [f"{root}/a/set"] and eps.count() == 100
    assert not [f for f in asked if "/data" in f]
    rows = training.read_training_sets(spark, root)[2]
    assert rows.count() == 300 and [r[0] for r in rows.select("set").distinct().collect()] == [f"{root}/a/set"]
