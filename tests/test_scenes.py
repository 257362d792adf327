"""Tracks, masks and depth medians against plain versions of their rules."""

import random

import pytest

from episodica.operators import masks, tracks

BOX = ["x0", "y0", "x1", "y1"]


def plain_tracks(seen, keyframes, n, pad, hold):
    """Every frame in turn: the keyframes around it, then each name."""
    out = {}
    for i in range(n):
        left, right = max((k for k in keyframes if k <= i), default=None), min((k for k in keyframes if k >= i), default=None)
        for name in {s[1] for s in seen}:
            a, b = seen.get((left, name)), seen.get((right, name))
            if a and b and left != right:
                t = (i - left) / (right - left)
                m = [x + t * (y - x) for x, y in zip(a, b, strict=True)]
                p = pad * ((m[2] - m[0]) + (m[3] - m[1])) / 2
                out[i, name] = [m[0] - p, m[1] - p, m[2] + p, m[3] + p]
            elif a or (b and hold):
                out[i, name] = list(a or b)
    return out


@pytest.mark.parametrize(("pad", "hold"), [(0.0, True), (0.15, False)])
def test_tracks(spark, pad, hold):
    rng = random.Random(1)
    keyframes, n = [3, 10, 11, 20, 33], 40
    seen = {(k, name): tuple(rng.random() + j // 2 for j in range(4)) for k in keyframes for name in "abc" if rng.random() < 0.6}
    rows = [(7, k, name, *b) for (k, name), b in seen.items()] + [(7, 4, "a", 9.0, 9.0, 9.0, 9.0), (7, 10, None, 1.0, 1.0, 1.0, 1.0)]
    s = spark.createDataFrame(rows, "e long, f int, name string, x0 double, y0 double, x1 double, y1 double")
    kf = spark.createDataFrame([(7, k) for k in keyframes] * 2 + [(8, 0)], "e long, f int")
    parts = tracks.between_keyframes(s, kf, ["e"], "name", "f")
    assert parts.count() <= 2 * len(seen)
    want = plain_tracks(seen, keyframes, n, pad, hold)
    got = tracks.tracks(parts, spark.createDataFrame([(7, n), (8, 5)], "e long, n long"), ["e"], "f", pad=pad, hold_right=hold)
    assert {(r["f"], r["name"]): pytest.approx([r[c] for c in BOX]) for r in got.collect()} == want
    reads = spark.createDataFrame([(7, f, name, i) for i, (f, name) in enumerate((f, m) for f in range(n) for m in "abz")] + [(9, 1, "a", -1)], "e long, f int, name string, tag int")
    at = {(r["f"], r["name"]): None if r["x0"] is None else [r[c] for c in BOX] for r in tracks.tracks_at(parts, kf, reads, ["e"], "name", "f", pad=pad, hold_right=hold).collect() if r["e"] == 7}
    assert len(at) == 3 * n and all(v is None if k not in want else v == pytest.approx(want[k]) for k, v in at.items())


def painted(rows):
    on = {}
    for m, a, n in rows:
        on.setdefault(m, set()).update(range(a, a + n))
    return on


def test_mask_algebra(spark):
    rng = random.Random(2)
    rows = [(m, rng.randrange(60), rng.randrange(1, 12)) for m in "abcd" for _ in range(5)]
    df = spark.createDataFrame([(1, *r) for r in rows], "i long, m string, start long, length long")
    on = painted(rows)
    pairs = spark.createDataFrame([(1, "a", "b"), (1, "c", "d"), (1, "a", "a"), (1, "a", "none")], "i long, a string, b string")
    for r in masks.overlaps(df, pairs, ["i"], "m").collect():
        x, y = on.get(r["a"], set()), on.get(r["b"], set())
        assert (r["common"], r["either"]) == (len(x & y), len(x | y)) and r["iou"] == pytest.approx(len(x & y) / len(x | y))
    assert painted([("u", r["start"], r["length"]) for r in masks.combine(df, ["i"]).collect()])["u"] == set().union(*on.values())
    single = masks.combine(df, ["i", "m"])
    common = masks.combine(single, ["i"], 4).collect()
    assert painted([("u", r["start"], r["length"]) for r in common]).get("u", set()) == set.intersection(*on.values())
    # coded and read back, runs that touch made one
    counts = masks.encode_counts(df.selectExpr("*", "80 as size"), ["i", "m"], "size")
    assert all(sum(r["counts"]) == 80 for r in counts.collect())
    back = masks.decode_counts(counts.selectExpr("*", "8 as height", "10 as width"), ["i", "m"]).collect()
    assert painted([(r["m"], r["start"], r["length"]) for r in back]) == on
    assert sorted((r["m"], r["start"]) for r in back) == sorted((r["m"], r["start"]) for r in single.collect())


def test_counts_that_do_not_fit_are_refused(spark):
    df = spark.createDataFrame([(1, [2, 3, 1], 2, 3), (2, [0, 6], 2, 3), (3, [6], 2, 3)], "i long, counts array<int>, height int, width int")
    assert sorted((r["i"], r["start"], r["length"]) for r in masks.decode_counts(df, ["i"]).collect()) == [(1, 2, 3), (2, 0, 6)]
    for counts in ([1, 2], [7, -1], [3, None, 3], None):
        with pytest.raises(Exception, match="run lengths of mask 9"):
            masks.decode_counts(spark.createDataFrame([(9, counts, 2, 3)], df.schema), ["i"]).collect()


def test_depth_medians(spark):
    inf, nan = float("inf"), float("nan")
    pixels = spark.createDataFrame([(1, u * 4 + v, u, v, z) for (u, v), z in {(0, 0): 5.0, (0, 1): nan, (1, 0): 2.0, (1, 1): -1.0, (2, 2): inf, (2, 1): 3.0, (3, 3): 9.0, (1, 2): None}.items()], "i long, at long, u int, v int, z double")
    points = spark.createDataFrame([(1, "a", 1, 1), (1, "b", 0, 0), (1, "c", 3, 3), (1, "d", 9, 9), (2, "e", 0, 0)], "i long, p string, u int, v int")
    assert {r["p"]: r["z"] for r in masks.patch_medians(points, pixels, ["i"], ["p"]).collect()} == {"a": 3.0, "b": 3.5, "c": 9.0, "d": None, "e": None}
    runs = spark.createDataFrame([(1, 0, 0, 5), (1, 0, 3, 3), (1, 1, 10, 1)], "i long, m int, start long, length long")
    got = {r["m"]: (r["u"], r["v"], r["z"]) for r in masks.mask_medians(runs, pixels, ["i"], "m", 4).collect()}
    assert got == {0: (pytest.approx(2 / 6), pytest.approx(7 / 6), 3.5), 1: (2.0, 2.0, None)}
