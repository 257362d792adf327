"""Frames with two hands against a plain walk over them."""

import random

from episodica.operators import two_hands as th

SCHEMA = "e long, f int, t double, " + ", ".join(f"{s}_present boolean, {s}_in_contact boolean, {s}_object string, {s}_grasp string, {s}_guessed boolean" for s in ("right", "left"))


def test_two_hands_on_one_box(spark):
    rows = [(1, i, i / 10, True, 30 <= i < 60, "box" if 30 <= i < 60 else None, "power_wrap", False, True, 30 <= i < 60, "box" if 30 <= i < 60 else None, "power_wrap", False) for i in range(90)]
    got = th.two_hand_segments(spark.createDataFrame(rows, SCHEMA), ["e"], "f", "t").orderBy("seg").collect()
    (box,) = [r for r in got if r["state"] == "contact"]
    assert (box["start_frame"], box["end_frame"], box["hands"], box["hand_used"], box["object_name"], box["grasp"]) == (30, 60, ["left", "right"], "both", "box", "power_wrap")


def test_objects_touched_seldom_are_not_eligible(spark):
    touch = {3: ("a", "b"), 4: ("a", None), 5: ("b", "a"), 6: (None, "c"), 7: ("unknown", None), 8: ("unknown", None), 9: ("unknown", None)}
    rows = [(1, i, i / 10, True, bool(touch.get(i, (None, None))[0]), touch.get(i, (None, None))[0], "hook", False, True, bool(touch.get(i, (None, None))[1]), touch.get(i, (None, None))[1], None, False) for i in range(12)]
    got = th.two_hand_segments(spark.createDataFrame(rows, SCHEMA), ["e"], "f", "t", idle_sec=9).orderBy("seg").collect()
    named = {r["start_frame"]: (r["object_name"], r["hand_used"], r["transition"]) for r in got}
    assert named[3] == ("a", "both", "object_change")  # b is touched twice only
    assert named[4] == ("a", "right", "object_change") and named[5] == ("a", "both", "object_change") and named[6] == (None, "left", "object_change") and named[7] == (None, "right", "contact_off")


def test_loss_near_seen_hands(spark):
    rng = random.Random(1)
    rows = [(1, i, i / 10, i < 20 and rng.random() < 0.5, False, None, None, i % 9 == 0, i < 20, False, None, "open" if i < 3 else None, False) for i in range(60)]
    r = th.two_hand_summary(spark.createDataFrame(rows, SCHEMA), ["e"], "f").first()
    lost = [not (x[3] and x[8]) for x in rows]
    assert r["loss_pct"] == 100 * sum(lost) / 60 and r["active_loss_pct"] == 100 * sum(lost[:30]) / 30 and r["guessed_pct"] == 100 * 7 / 60 and r["left_open"] == 3
    assert th.leading_hand(spark.createDataFrame(rows, SCHEMA), ["e"], "right").first()["hand"] == "right" and th.leading_hand(spark.createDataFrame(rows, SCHEMA), ["e"]).first()["hand"] == "left"
