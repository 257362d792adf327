"""Turns and poses against numpy versions of their rules."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.functions import geometry as g
from episodica.operators import poses
from episodica.operators import timeseries as ts

TURN = ["qx", "qy", "qz", "qw"]


def quats(rng, n, step=0.2):
    v = np.cumsum(rng.normal(size=(n, 3)) * step, axis=0)
    a = np.linalg.norm(v, axis=1, keepdims=True)
    return np.concatenate([v / a * np.sin(a / 2), np.cos(a / 2)], 1)


def frame(spark, q, ok, signs=None):
    q = q if signs is None else q * signs[:, None]
    return spark.createDataFrame([(1, i, *map(float, r), bool(o)) for i, (r, o) in enumerate(zip(q, ok, strict=True))], "e long, f int, qx double, qy double, qz double, qw double, ok boolean")


def turns_of(df, cols=TURN):
    return np.array([[r[c] for c in cols] for r in df.orderBy("f").collect()], float)


def same_turn(a, b, tol=1e-9):
    return np.abs(np.abs((a * b).sum(1)) - 1).max() < tol


def fitted(block, window, degree):
    n = len(block)
    k = min(window, n if n % 2 else n - 1)
    if n < 3 or k <= degree + 1:
        return block
    out = np.empty_like(block)
    for i in range(n):
        a = min(max(i - k // 2, 0), n - k)
        x = np.arange(a, a + k) - i
        out[i] = np.linalg.lstsq(np.vander(x, degree + 1, increasing=True), block[a : a + k], rcond=None)[0][0]
    return out


def smooth_by_hand(q, ok, shortest):
    q, out, i = q.copy(), q.copy(), 0
    while i < len(q):
        j = i
        while j < len(q) and ok[j]:
            j += 1
        if j - i >= 3:
            b = q[i:j].copy()
            for k in range(1, len(b)):
                b[k] *= -1 if b[k] @ b[k - 1] < 0 else 1
            if shortest:
                b *= np.where(b[:, 3:] < 0, -1, 1)
            n = np.linalg.norm(b[:, :3], axis=1, keepdims=True)
            v = fitted(b[:, :3] / n * 2 * np.arctan2(n, b[:, 3:]), 9, 2)
            a = np.linalg.norm(v, axis=1, keepdims=True)
            out[i:j] = np.concatenate([v / a * np.sin(a / 2), np.cos(a / 2)], 1)
        i = max(j, i + 1)
    return out


@pytest.mark.parametrize("shortest", [True, False])
def test_smoothing_of_turns(spark, shortest):
    rng = np.random.default_rng(1)
    q, ok = quats(rng, 60), rng.random(60) > 0.12
    signs = np.where(rng.random(60) < 0.5, -1, 1)
    df = frame(spark, q, ok, signs)
    got = turns_of(poses.smooth_turns(df, TURN, F.col("ok"), ["e"], "f", shortest=shortest))
    want = smooth_by_hand(q * signs[:, None], ok, shortest)
    assert same_turn(got, want)
    assert np.allclose(got[~ok], (q * signs[:, None])[~ok])
    if shortest:  # the sign that a row came with changes nothing
        assert np.allclose(np.abs(got), np.abs(turns_of(poses.smooth_turns(frame(spark, q, ok), TURN, F.col("ok"), ["e"], "f"))))


def test_smoothing_runs_on_past_half_a_turn(spark):
    angle = np.linspace(2.0, 6.0, 40)
    q = np.stack([np.sin(angle / 2), 0 * angle, 0 * angle, np.cos(angle / 2)], 1)
    q *= np.where(q[:, 3:] < 0, -1, 1)
    got = turns_of(poses.smooth_turns(frame(spark, q, np.ones(40)), TURN, F.col("ok"), ["e"], "f", shortest=False))
    assert same_turn(got, q)  # a steady turn is left as it is


def test_rows_without_a_turn_break_runs(spark):
    q, ok = quats(np.random.default_rng(2), 12), np.ones(12, bool)
    q[5] = 0
    df = frame(spark, q, ok)
    got = turns_of(poses.smooth_turns(df, TURN, F.col("ok"), ["e"], "f"))
    assert np.allclose(got[5], 0) and same_turn(np.delete(got, 5, 0), np.delete(smooth_by_hand(q, np.arange(12) != 5, True), 5, 0))
    assert poses.smooth_turns(df.limit(0), TURN, F.col("ok"), ["e"], "f").count() == 0


def test_least_run_of_a_second_pass(spark):
    rows = [(1, i, float(i * i % 7), i not in (3, 8)) for i in range(14)]
    df = spark.createDataFrame(rows, "e long, f int, v double, ok boolean")
    v = np.array([r[2] for r in rows])
    for least, last in ((5, fitted(v[9:, None], 9, 2)[:, 0]), (6, v[9:])):
        got = [r["v"] for r in ts.savgol_runs(df, ["v"], F.col("ok"), ["e"], "f", least=least).orderBy("f").collect()]
        assert np.allclose(got, np.concatenate([v[:9], last]))


def test_resampling_by_kind(spark):
    rng = np.random.default_rng(3)
    q = quats(rng, 7)
    rows = spark.createDataFrame([(1, i, float(i * i), i % 2 == 0, f"r{i}", *map(float, r)) for i, r in enumerate(q)] + [(2, 0, 5.0, True, "only", 0.0, 0.0, 0.0, 1.0)], "e long, f int, v double, seen boolean, why string, qx double, qy double, qz double, qw double")
    grid, ticked = poses.slowed_grid(rows, ["e"], "f", 2, 1)
    got = poses.resample(grid, ticked, ["e"], "tick", {"v": "linear", "seen": "nearest", "why": "previous"}, [TURN]).orderBy("e", "i").collect()
    assert [r["e"] for r in got] == [1] * 14 + [2] * 2
    for r in got[:14]:
        at = r["i"] * 6 / 13
        a, s = int(at + 1e-12), at - int(at + 1e-12)
        b = min(a + 1, 6)
        assert math.isclose(r["v"], a * a + (b * b - a * a) * s, abs_tol=1e-9)
        assert (r["seen"], r["why"]) == ((a if s <= 0.5 else b) % 2 == 0, f"r{a}")
        d = min(1.0, abs(q[a] @ q[b]))
        assert math.isclose(abs(np.array([r[c] for c in TURN]) @ q[a]), math.cos(s * math.acos(d)), abs_tol=1e-9)
    assert [(r["v"], r["why"], r["qw"]) for r in got[14:]] == [(5.0, "only", 1.0)] * 2


def test_resampling_beyond_the_ends_and_halfway(spark):
    rows = spark.createDataFrame([(1, 10, 1.0, "a"), (1, 20, 3.0, "b")], "e long, t long, v double, n string")
    grid = spark.createDataFrame([(1, t) for t in (0, 10, 15, 16, 20, 99)] + [(9, 5)], "e long, t long")
    got = poses.resample(grid, rows, ["e"], "t", {"v": "linear", "n": "nearest"}).orderBy("e", "t").collect()
    assert [(r["v"], r["n"]) for r in got] == [(1.0, "a"), (1.0, "a"), (2.0, "a"), (2.2, "b"), (3.0, "b"), (3.0, "b"), (None, None)]


def test_bridges(spark):
    n, ok = 130, np.zeros(130, bool)
    ok[[5, 6, 20, 100]] = True
    q = quats(np.random.default_rng(4), n)
    rows = [(1, i, float(i), *map(float, q[i]), bool(ok[i])) for i in range(n)] + [(2, i, 7.0, 0.0, 0.0, 0.0, 1.0, False) for i in range(3)]
    df = spark.createDataFrame(rows, "e long, f int, x double, qx double, qy double, qz double, qw double, ok boolean")
    got = poses.bridge_poses(df, ["x"], TURN, F.col("ok"), ["e"], "f", home=(0.5,)).orderBy("e", "f").collect()
    x, turn = [r["x"] for r in got], np.array([[r[c] for c in TURN] for r in got])
    assert x[:6] == [5.0] * 6 and x[100:130] == [100.0] * 30 and x[130:] == [0.5] * 3
    ease = lambda t: t**3 * (10 + t * (-15 + 6 * t))
    for f in range(7, 20):
        s = ease((f - 6) / 14)
        assert math.isclose(x[f], 6 + 14 * s) and math.isclose(abs(turn[f] @ q[6]), math.cos(s * math.acos(abs(q[6] @ q[20]))), abs_tol=1e-9)
    assert x[21:55] == [20.0] * 34  # 79 rows: the ramp takes the last 45
    assert all(math.isclose(x[f], 20 + 80 * ease((f - 54) / 46)) for f in range(55, 100))
    assert [r["bridged"] for r in got[:130]] == (~ok).tolist()


def test_nearest_rotation_is_the_polar_factor(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=(50, 3, 3))
    m[np.linalg.det(m) < 0] *= -1
    names = [f"m{i}{j}" for i in range(3) for j in range(3)]
    rows = [(1, i, *map(float, x.ravel())) for i, x in enumerate(m)] + [(1, 50, None, *([0.0] * 8)), (1, 51, float("inf"), *([0.0] * 8))]
    df = spark.createDataFrame(rows, "e long, f int, " + ", ".join(f"{c} double" for c in names))
    got = turns_of(poses.nearest_rotation(df, names))
    assert np.isnan(got[50:]).all()
    for x, (a, b, c, d) in zip(m, got[:50], strict=True):
        u, _, vt = np.linalg.svd(x)
        r = np.array([[1 - 2 * (b * b + c * c), 2 * (a * b - c * d), 2 * (a * c + b * d)], [2 * (a * b + c * d), 1 - 2 * (a * a + c * c), 2 * (b * c - a * d)], [2 * (a * c - b * d), 2 * (b * c + a * d), 1 - 2 * (a * a + b * b)]])
        assert np.allclose(r, u @ vt, atol=1e-9)
    assert poses.nearest_rotation(df.limit(0), names).count() == 0


def test_six_numbers_and_half_turns(spark):
    df = spark.createDataFrame([(0.0,) * 6, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0), (1.0, 0.0, 0.0, 2.0, 0.0, 0.0), (-1.0, 0.0, 0.0, 0.0, -1.0, 0.0)], ", ".join(f"r{k} double" for k in range(6)))
    q = g.facing(g.quaternion_of_six([F.col(f"r{k}") for k in range(6)]))
    assert [[round(v, 9) for v in r] for r in df.select(*q).collect()] == [[0, 0, 0, 1], [0, 0, 0, 1], [0, 0, 0, 1], [0, 0, 1, 0]]
