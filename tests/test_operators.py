"""Operators on hand-made episodes with answers known in advance, and against literal statements of their rules."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.plans import catalog
from episodica.functions import geometry as g
from episodica.functions import models, replies
from episodica.operators import assembly as asm
from episodica.operators import joins, stats
from episodica.operators import segments as sg
from episodica.operators import timeseries as ts
from episodica.operators.windows import mode_first_seen


def episode(spark, rows, schema, key=1):
    return spark.createDataFrame([(key, i, *r) for i, r in enumerate(rows)], "e int, i int, " + schema)


def values(df, col):
    return [r[col] for r in df.orderBy("e", "i").collect()]


def test_hysteresis_turns_after_three_rows(spark):
    df = episode(spark, [(x,) for x in (True, True, True, False, False, False)], "ev boolean")
    assert values(ts.hysteresis(df, "ev", ["e"], "i"), "state") == [False, False, True, True, True, False]


def test_hysteresis_is_the_state_machine(spark):
    rng = random.Random(3)
    rows = [(k, i, rng.random() < 0.5) for k in range(20) for i in range(40)]
    got = {(r["e"], r["i"]): r["state"] for r in ts.hysteresis(spark.createDataFrame(rows, "e int, i int, ev boolean"), "ev", ["e"], "i").collect()}
    for k in range(20):
        on, last = False, []
        for _, i, e in (r for r in rows if r[0] == k):
            last = [*last, e][-3:]
            on = True if last == [True] * 3 else False if last == [False] * 3 else on
            assert got[k, i] == on


def test_votes(spark):
    votes = lambda xs: values(ts.majority_vote(episode(spark, [(x, True) for x in xs], "label string, present boolean"), "label", "present", ["e"], "i"), "voted")
    assert votes(["wrap", "wrap", "open", "wrap", "wrap"]) == ["wrap"] * 5
    assert votes(["wrap", "unknown", "unknown", "wrap"]) == ["wrap"] * 4
    absent = ts.majority_vote(episode(spark, [("wrap", False)], "label string, present boolean"), "label", "present", ["e"], "i")
    assert values(absent, "voted") == [None] and values(absent, "inherited") == [False]


def test_gap_fill_respects_length_and_ends(spark):
    df = episode(spark, [(x,) for x in (None, 1.0, None, None, 4.0, *[None] * 6, 11.0, None)], "v double")
    assert values(ts.interpolate_gaps(df, "v", ["e"], "i"), "filled") == [None, 1.0, 2.0, 3.0, 4.0, *[None] * 6, 11.0, None]


def test_velocity_gate_lets_the_next_row_live(spark):
    df = episode(spark, [(0.0, True), (0.0, True), (0.5, True), (0.0, True)], "q double, ok boolean")
    assert values(ts.velocity_gate(df, "q", "ok", ["e"], "i", limit=2.0), "reachable") == [True, True, False, True]


def test_velocity_gate_is_the_loop(spark):
    rng = random.Random(5)
    rows = [(k, i, rng.choice([0.0, 0.01, 1.0]), rng.random() < 0.8) for k in range(20) for i in range(40)]
    got = {(r["e"], r["i"]): r["reachable"] for r in ts.velocity_gate(spark.createDataFrame(rows, "e int, i int, q double, ok boolean"), "q", "ok", ["e"], "i", limit=1.0).collect()}
    for k in range(20):
        own = [r for r in rows if r[0] == k]
        ok = [r[3] for r in own]
        for i in range(1, len(own)):
            if ok[i] and ok[i - 1] and abs(own[i][2] - own[i - 1][2]) * 30 > 0.9:
                ok[i] = False
        assert [got[k, i] for i in range(len(own))] == ok


def test_min_jerk_bridge_is_smooth(spark):
    df = episode(spark, [(float(i) / 100 if not 6 <= i <= 11 else None,) for i in range(20)], "v double")
    v = values(ts.min_jerk_bridge(df, "v", ["e"], "i"), "bridged")
    assert max(abs(a - b) for a, b in zip(v, v[1:], strict=False)) < 0.03
    none = ts.min_jerk_bridge(episode(spark, [(None,), (None,)], "v double"), "v", ["e"], "i", home=7.0)
    assert values(none, "bridged") == [7.0, 7.0]


def test_savgol_keeps_parabolas_and_short_episodes(spark):
    df = episode(spark, [(float(i * i),) for i in range(15)], "v double")
    assert values(ts.savgol(df, "v", ["e"], "i"), "smooth") == pytest.approx([float(i * i) for i in range(15)])
    assert values(ts.savgol(episode(spark, [(1.0,), (5.0,)], "v double"), "v", ["e"], "i"), "smooth") == [1.0, 5.0]


def test_rate_limit_holds_its_limits(spark):
    rng = random.Random(1)
    df = episode(spark, [(rng.uniform(-1, 1),) for _ in range(60)], "q double")
    q = values(ts.rate_limit(df, "q", ["e"], "i", low=-1, high=1, velocity=1.0), "limited")
    v = [(b - a) * 30 for a, b in zip(q, q[1:], strict=False)]
    assert max(map(abs, v)) <= 0.85 + 1e-9


def timeline(spark, states):
    return episode(spark, [(i / 30, c, "mug" if c else None, grasp) for i, (c, grasp) in enumerate(states)], "t double, in_contact boolean, object_name string, grasp string")


def test_segments_of_a_timeline(spark):
    states = [(False, "open")] * 30 + [(True, "precision_pinch")] * 30 + [(True, "power_wrap")] * 30 + [(False, "open")] * 30
    segs = sg.segments(timeline(spark, states), ["e"], "i", "t").orderBy("seg").collect()
    assert [(s["start_frame"], s["end_frame"], s["state"], s["grasp"]) for s in segs if s["end_frame"] - s["start_frame"] > 1] == [(0, 30, "no_contact", "none"), (30, 60, "contact", "precision_pinch"), (60, 90, "contact", "power_wrap"), (90, 120, "no_contact", "none")]


def test_short_pulse_is_absorbed(spark):
    states = [(False, "open")] * 30 + [(True, "open")] * 3 + [(False, "open")] * 87
    segs = sg.absorb_jitter(sg.segments(timeline(spark, states), ["e"], "i", "t", idle_sec=99), ["e"]).collect()
    assert len(segs) == 1 and segs[0]["start_frame"] == 0 and segs[0]["end_frame"] == 120


def test_merge_needs_state_object_and_grasp(spark):
    rows = [(1, 0, 10, 0.0, 1.0, "x", "contact", "open", "mug"), (1, 10, 20, 1.1, 2.0, "x", "contact", "unknown", "mug"), (1, 20, 30, 2.0, 3.0, "x", "contact", "hook", "cup")]
    segs = spark.createDataFrame(rows, "e int, start_frame int, end_frame int, start_time double, end_time double, transition string, state string, grasp string, object_name string")
    got = sg.merge_adjacent(segs, ["e"]).orderBy("start_frame").collect()
    assert [(r["start_frame"], r["end_frame"], r["grasp"], r["object_name"]) for r in got] == [(0, 20, "open", "mug"), (20, 30, "hook", "cup")]


def test_grasp_windows(spark):
    def windows(closed, n=30):
        df = episode(spark, [(True, 0.01 if i in closed else 0.08, 0.0) for i in range(n)], "ok boolean, grip double, d double")
        return [(r["run_start"], r["run_end"]) for r in sg.grasp_windows(df, ["e"], "i", "ok", "grip", "d").orderBy("run_start").collect()]

    assert windows(range(5, 15)) == [(5, 15)]
    assert windows(range(5, 8)) == []
    assert windows(range(5, 11)) == [(5, 11)]
    assert windows([i for i in range(30) if not 12 <= i < 16]) == [(0, 12), (16, 30)]


def test_interval_join_first_wins_at_the_border(spark):
    points = episode(spark, [(0.0,), (1.0,), (1.5,), (2.5,)], "t double")
    spans = spark.createDataFrame([(1, 0.0, 1.0, "a"), (1, 1.0, 2.0, "b")], "e int, s double, z double, name string")
    assert values(joins.interval_first(points, spans, ["e"], "t", "s", "z", "name"), "name") == ["a", "a", "b", None]


def test_suppression(spark):
    rows = [(1, 0, 0.0, 0.0, 1.0, 1.0, 0.9), (1, 1, 0.0, 0.0, 1.0, 0.9, 0.8), (1, 2, 2.0, 2.0, 3.0, 3.0, 0.1)]
    df = spark.createDataFrame(rows, "s int, id int, x0 double, y0 double, x1 double, y1 double, score double")
    assert sorted(r["id"] for r in joins.suppress(df, ["s"], "id").collect()) == [0, 2]


def test_mode_takes_the_first_seen(spark):
    df = episode(spark, [("b",), ("a",), ("a",), ("b",), (None,)], "x string")
    assert mode_first_seen(df, ["e"], "x", "i").first()["mode"] == "b"


def test_packing_and_offsets(spark):
    eps = spark.createDataFrame([(0, 6), (1, 8), (2, 5), (3, 25), (4, 2)], "ep long, length long")
    packed = {r["ep"]: (r["chunk_index"], r["chunks"]) for r in asm.pack_chunks(eps, "ep", size=10).collect()}
    assert packed == {0: (0, 1), 1: (1, 1), 2: (2, 1), 3: (3, 3), 4: (6, 1)}
    off = [(r["episode_index"], r["from_index"], r["to_index"]) for r in asm.running_offsets(eps, "ep", buckets=2).orderBy("ep").collect()]
    assert off == [(0, 0, 6), (1, 6, 14), (2, 14, 19), (3, 19, 44), (4, 44, 46)]


def test_geometry(spark):
    one = spark.range(1)
    box = [F.lit(v) for v in (0.4, 0.4, 0.6, 0.6)]
    d = one.select(g.box_distance(F.lit(0.5), F.lit(0.5), box), g.box_distance(F.lit(0.35), F.lit(0.5), box)).first()
    assert d[0] == 0 and d[1] == pytest.approx(0.05)
    x = one.select(*g.back_project(F.lit(24.0), F.lit(37.0), F.lit(1.0), 100, 100, 50, 50)).first()
    assert list(x) == pytest.approx([-0.26, -0.13, 1.0])
    assert list(one.select(*g.back_project(F.lit(24.0), F.lit(37.0), F.lit(-1.0), 100, 100, 50, 50)).first()) == [None] * 3
    z = [F.lit(0.0), F.lit(0.0), F.lit(1.0)]
    assert list(one.select(*g.rot6d(z)).first()) == pytest.approx([1, 0, 0, 0, 1, 0])
    turned = one.select(*g.quaternion_of([[F.lit(float(r == c)) for c in range(3)] for r in range(3)])).first()
    assert list(turned) == pytest.approx([0, 0, 0, 1])
    assert one.select(g.instruction(F.lit("grasp"), F.lit("unknown"), F.lit("left"))).first()[0] == "grasp an unidentified object with left hand"


def test_replies(spark):
    one = spark.createDataFrame([('prose ```json\n[{"name": "cup"}]\n``` end',), ("nothing",), (None,)], "t string")
    got = [r[0] for r in one.select(replies.salvage(F.col("t"), "array<struct<name:string>>")).collect()]
    assert got[0][0]["name"] == "cup" and got[1] is None and got[2] is None
    secs = spark.createDataFrame([("12",), ("1:30.5",), ("1:00:01",), ("x",), ("1:2:3:4",)], "t string").select(replies.seconds(F.col("t")))
    assert [r[0] for r in secs.collect()] == [12.0, 90.5, 3601.0, 0.0, 0.0]
    assert spark.range(1).select(replies.caption(F.lit(' "**Lifts** the cup" '))).first()[0] == "Lifts the cup"


def test_objects_of_replies(spark):
    texts = ['{"n": 1, "objects": [{"label": "Cup", "location_description": "left", "touched": true}, {"x": 1}]}', "name: 'mug', location: shelf, touched: True\nbroken {", "- Knife: on the board (touched: true)\n* Bowl: in the sink", "", None]
    got = [[tuple(o) for o in r[0]] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(replies.objects_of(F.col("t"))).collect()]
    assert got == [[("Cup", "left", True), ("unknown", "unknown", False)], [("mug", "shelf", True)], [("Knife", "on the board", True), ("Bowl", "in the sink", False)], [], []]


def test_segments_of_replies(spark):
    texts = ['[{"name": "pour", "start_time": "0:02", "hand_used": "Left"}, {}]', "0:01 ~ 0:03.5: pick up the red cup with left hand\n0:04 - 0:06 place it on the wooden table, gently", "none", None]
    got = [[tuple(s)[:5] for s in r[0]] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(replies.segments_of(F.col("t"))).collect()]
    assert got[0] == [("pour", 2.0, 10.0, "unknown", "left"), ("manipulate", 0.0, 10.0, "unknown", "right")]
    assert got[1] == [("pick", 1.0, 3.5, "unknown", "left"), ("place", 4.0, 6.0, "table", "right")]
    assert got[2:] == [[], []]


def test_numbered_lines_are_all_wanted(spark):
    df = spark.createDataFrame([("Segment 1: a\nsegment 3: c\nSegment 1: b", 3), ("only this", 1), ("Segment 1:\nSegment 2: x", 2), ("", 0)], "t string, n int")
    lines = replies.described(F.col("t"), F.col("n"))
    got = df.select(lines.alias("l"), replies.missing(lines).alias("m")).collect()
    assert [(r["l"], r["m"]) for r in got] == [(["b", None, "c"], [2]), (["only this"], []), ([None, "x"], [1]), ([], [])]
    assert df.filter("n = 1").select(replies.required(lines)).first()[0] == ["only this"]
    with pytest.raises(Exception, match="no line for 2"):
        df.filter("n = 3").select(replies.required(lines)).collect()


def test_nearest_names(spark):
    df = spark.createDataFrame([(" CUP ",), ("coffee mugs",), ("zzz",), (None,), ("cup",)], "x string")
    got = sorted(((r["x"], r["canonical"]) for r in replies.nearest_name(df, "x", ["cup", "coffee mug"]).collect()), key=str)
    assert got == sorted([(" CUP ", "cup"), ("coffee mugs", "coffee mug"), ("zzz", "zzz"), (None, None), ("cup", "cup")], key=str)


def test_savgol_of_blocks_is_a_fit_of_each(spark):
    rng = random.Random(7)
    rows = [(rng.uniform(0, 9), i not in (2, 3, 9, 16, 17, 18)) for i in range(40)]
    got = values(ts.savgol_blocks(episode(spark, rows, "v double, ok boolean"), "v", "ok", ["e"], "i"), "smooth")
    want = [v for v, _ in rows]
    for lo, hi in ((4, 9), (10, 16), (19, 40)):
        size = min(9, (hi - lo) - (hi - lo + 1) % 2)
        for i in range(lo, hi):
            start = min(max(lo, i - size // 2), hi - size)
            x = np.arange(start, start + size) - i
            want[i] = np.polyfit(x, [rows[k][0] for k in range(start, start + size)], 2)[-1]
    assert got == pytest.approx(want)


def test_slerp_ends_and_middle(spark):
    a, b = (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 1.0, 0.0)
    cols = lambda q: [F.lit(v) for v in q]
    at = lambda p, q, t: list(spark.range(1).select(*g.slerp(cols(p), cols(q), F.lit(t))).first())
    assert at(a, b, 0.0) == pytest.approx(a) and at(a, b, 1.0) == pytest.approx(b)
    assert at(a, b, 0.5) == pytest.approx([0, 0, 0.5**0.5, 0.5**0.5])
    assert at(a, [-v for v in a], 0.5) == pytest.approx(a)


def test_merge_refuses_and_warns(spark):
    eps = spark.createDataFrame([("x", 30), ("x", 25)], "robot string, fps int")
    assert asm.require(asm.gate(eps, ["robot"], ["fps"])) == ["fps"]
    with pytest.raises(ValueError, match="fps"):
        asm.require(asm.gate(eps, ["robot", "fps"]))


def test_human_rows_without_a_hand(spark):
    points = ", ".join(f"{a}{i} double" for i in range(21) for a in "xyz")
    hand = [float(k % 7) / 10 for k in range(63)]
    df = spark.createDataFrame([(1, 0, True, *hand), (1, 1, False, *hand), (1, 2, True, *hand)], f"e int, i int, present boolean, {points}")
    rows = asm.human_rows(df, ["e"], "i").orderBy("i").collect()
    assert [rows[1][f"s{k}"] for k in range(24)] == [0, 0, 0, 1, 0, 0, 0, 1, 0, 1] + [0] * 14
    assert [rows[0][f"a{k}"] for k in range(9)] == [0] * 9 and [rows[2][f"a{k}"] for k in range(3)] == [0] * 3
    assert [rows[2][f"a{k}"] for k in range(3, 9)] == pytest.approx([rows[2][f"s{k}"] - rows[1][f"s{k}"] for k in range(3, 9)])


def test_quantiles_are_exact(spark):
    rng = random.Random(11)
    cols = {"a": [rng.gauss(0, 1) for _ in range(500)] + [1e9], "b": [3.0] * 40, "c": [float(rng.randrange(5)) for _ in range(77)], "d": [2.5]}
    rows = [(k, v) for k, vs in cols.items() for v in vs] + [("a", None), ("e", None)]
    shares = {"low": 0.01, "mid": 0.5, "high": 0.99}
    got = {r["f"]: [r[c] for c in shares] for r in stats.exact_quantiles(spark.createDataFrame(rows, "f string, v double"), "f", "v", shares, bins=16).collect()}
    assert set(got) == set(cols)
    for k, vs in cols.items():
        assert got[k] == pytest.approx(list(np.quantile(vs, list(shares.values()))))


@pytest.mark.parametrize("name", ["zero_phase_ema", "ema_reset", "leaky_cumulative_sum", "sanitize_trajectory", "debounced_gripper", "rate_limited_trajectory", "identity_continuity", "jitter_absorb", "segment_merge"])
def test_state_is_carried_across_batches(spark, name):
    """Batches of three rows, several to an episode, give what whole episodes give."""
    rows = lambda: sorted(map(tuple, catalog.QUERIES[name](spark, "/root/testdata/sf0.001").collect()), key=str)
    want = rows()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert rows() == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_carry_keeps_episodes_apart(spark):
    """Null keys and null values: an episode without a key is one of its own; a null value holds the sum."""
    df = spark.createDataFrame([(None, 0, 1.0), (None, 1, None), (1, 0, 5.0), (1, 1, 1.0), (2, 0, None), (2, 1, 2.0)], "e int, i int, v double")
    got = {(r["e"], r["i"]): r["s"] for r in ts.leaky_sum(df, "v", ["e"], "i", leak=0.5, out="s").collect()}
    assert got == {(None, 0): 1.0, (None, 1): 1.0, (1, 0): 5.0, (1, 1): 3.5, (2, 0): 0.0, (2, 1): 2.0}
    assert ts.leaky_sum(df.limit(0), "v", ["e"], "i").count() == 0


def test_percentile_normalise_against_numpy(spark):
    rng = random.Random(5)
    sets = {1: [rng.gauss(0, 3) for _ in range(60)], 2: [4.0, 4.0], 3: [1.5], 4: [rng.gauss(9, 1) for _ in range(9)]}
    rows = [(k, i, v) for k, vs in sets.items() for i, v in enumerate(vs)] + [(1, 99, None), (5, 0, None)]
    got = {(r["e"], r["i"]): r["normalised"] for r in stats.percentile_normalise(spark.createDataFrame(rows, "e int, i int, v double"), "v", ["e"], 0.1, 0.9).collect()}
    for k, vs in sets.items():
        lo, hi = np.quantile(vs, [0.1, 0.9])
        half = (hi - lo) / 2 if (hi - lo) / 2 > 1e-6 else 1.0
        assert [got[k, i] for i in range(len(vs))] == pytest.approx([float(np.clip((v - (lo + hi) / 2) / half, -1, 1)) for v in vs])
    assert got[1, 99] is None and got[5, 0] is None and len(got) == len(rows)


def test_checks_and_models(spark):
    c = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "k string, passed boolean")
    assert {r["k"]: r["passed"] for r in stats.all_passed(c, ["k"]).collect()} == {"a": False, "b": True}
    ids = spark.range(5).withColumnRenamed("id", "image_id")
    first, again = (models.apply(ids, "stub_detector").orderBy("image_id").collect() for _ in range(2))
    assert first == again and len(first) == 5
    with pytest.raises(KeyError):
        models.apply(ids, "none")
