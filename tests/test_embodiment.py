"""Finger and wrist maps, scales there and back, calibrated travel, summaries of results."""

import math

import pytest
from pyspark.sql import functions as F

from episodica.functions import embodiment as em
from episodica.operators import stats


def test_finger_joints_keep_their_limits(spark):
    df = spark.createDataFrame([(0.0, 0.2), (1.0, 1.0), (9.0, 9.0)], "c double, o double")
    joints = em.finger_joints(dict.fromkeys(em.FINGERS, F.col("c")), F.col("c"), F.col("o"))
    rows = [r.asDict() for r in df.select(*(v.alias(k) for k, v in joints.items())).collect()]
    assert len(joints) == 16 and rows[0]["thumb0"] == pytest.approx(0.22) and rows[1]["index1"] == 1.25 and rows[1]["ring3"] == 0.85 and rows[1]["thumb2"] == 0.95
    assert max(rows[2].values()) == 1.6 and rows[2]["middle0"] == 0.0
    got = df.select(*em.closing_joints(F.col("c"), (0.0, 0.5), (1.0, -1.0))).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.5, 0.0), (1.0, -0.2, 0.9), (1.0, -0.2, 0.9)]


def test_wrists_over_a_table(spark):
    rows = [(1, 0.1 * i, 0.0, 0.0, True, i == 4) for i in range(5)] + [(1, 9.0, 9.0, 9.0, False, False), (2, 0.0, 0.0, 0.0, False, False)]
    df = spark.createDataFrame(rows, "e long, x0 double, y0 double, z0 double, ok boolean, held boolean").selectExpr("*", "x0 * 0.0 as shift_x", "0.0 as shift_y", "0.0 as x5", "0.0 as y5", "1.0 as x17", "0.0 as y17")
    got = em.wrist_over_table(df, ["e"], F.col("ok"), F.col("held")).orderBy("e", "x0").collect()
    assert [r["wy"] for r in got[:5]] == pytest.approx([0.09, 0.045, 0, -0.045, -0.09]) and got[4]["wz"] == pytest.approx(0.17) and got[0]["wz"] == pytest.approx(0.2)
    for r in got[5:]:
        assert (r["wx"], r["wy"], r["wz"], r["wqx"], r["wqw"]) == (0.5, 0.0, 0.2, 1.0, 0.0)
    moved = em.about_anchor(df.select("e", "x0", "ok"), ["e"], ["x0"], F.col("ok"), (1.0,)).orderBy("e", "x0").collect()
    assert [r["x0"] for r in moved if r["e"] == 1] == pytest.approx(sorted([0.9, 0.95, 1.0, 1.05, 1.1, 1.16])) and moved[-1]["e"] == 2 and moved[-1]["x0"] == 1.0


def test_scales_there_and_back(spark):
    df = spark.createDataFrame([(i, float(i * i), 3.0) for i in range(9)], "i int, a double, flat double")
    s = stats.feature_stats(df, ["a", "flat"])
    there = stats.normalise(df, s, ["a", "flat"])
    assert abs(there.agg(F.avg("a")).first()[0]) < 1e-12 and there.agg(F.max("flat")).first()[0] == 0
    back = stats.unnormalise(there, s, ["a", "flat"]).orderBy("i").collect()
    assert [(r["a"], r["flat"]) for r in back] == [(pytest.approx(i * i), 3.0) for i in range(9)]


def test_travel_and_results(spark):
    rows = [(1, 0, 0.0, 0.2, True), (1, 1, 0.1, 0.2, True), (1, 2, 5.0, 0.2, False), (1, 3, 0.2, 0.2, True), (1, 4, 0.6, 0.2, True), (2, 0, 1.0, None, None)]
    df = spark.createDataFrame(rows, "e long, f int, x double, palm double, ok boolean")
    got = {r["e"]: r for r in stats.calibrated_travel(df, ["e"], "f", ["x"], F.col("palm"), "ok").collect()}
    assert (got[1]["scale"], got[1]["travel_x"], got[1]["path_length"]) == (pytest.approx(0.45), pytest.approx(0.27), pytest.approx(0.045))
    assert (got[2]["scale"], got[2]["travel_x"], got[2]["path_length"]) == (pytest.approx(0.9), 0.0, 0.0)
    rows = [(1, True, False, False, 2.0, 5.0, "pinch"), (1, False, True, True, math.nan, 99.0, "curl"), (1, False, True, False, None, 99.0, None), (1, True, True, False, 4.0, 7.0, "pinch")]
    r = stats.retarget_summary(spark.createDataFrame(rows, "e long, ok boolean, fb boolean, co boolean, res double, ms double, how string"), ["e"], "ok", "fb", "co", "res", "ms", "how").first()
    assert (r["frames"], r["n_reachable"], r["pct_reachable"], r["n_fallback"], r["n_collision"], r["mean_residual"], r["mean_solve_ms"], r["methods"]) == (4, 2, 50.0, 3, 1, 3.0, 6.0, {"pinch": 2, "curl": 1})
