"""What speaks against an episode: each issue with an episode that has it and one that hasn't."""

import pytest
from pyspark.sql import functions as F

from episodica.operators import plausible


def touches(spark, **episodes):
    rows = [(e, i, c == "x" or c == "o", "cup" if c == "x" else None) for e, line in episodes.items() for i, c in enumerate(line)]
    df = spark.createDataFrame(rows, "e string, f int, touch boolean, name string").withColumn("touch", F.when(F.col("f") != 99, F.col("touch")))
    return {r["e"]: r for r in plausible.contact_findings(df, ["e"], "f", "touch", "name").collect()}


def test_runs_of_contact(spark):
    got = touches(spark, none="....", fine="..xxx..xxxx.", all="xxxxx", jitter="x.x.xxxx", half="x..xx..", bare="..ooxxx", bare30="..oooxxxxxxx")
    issues = {e: r["issues"] for e, r in got.items()}
    assert issues == {"none": [], "fine": [], "all": ["whole"], "jitter": ["short", "unstable"], "half": ["short"], "bare": ["nameless"], "bare30": []}
    assert (got["fine"]["events"], got["fine"]["shortest"], got["fine"]["longest"], got["fine"]["mean"], got["fine"]["frames"]) == (2, 3, 4, 3.5, 12)
    assert (got["none"]["events"], got["none"]["longest"], got["none"]["nameless_pct"]) == (0, None, 0.0)


@pytest.mark.parametrize(
    ("text", "body"),
    [("Gripping the person.", True), ("a hand, then a cup", True), ("this face", True), ("hand touches the cup", False), ("the handle", False), ("the left hand", False), ("an,arm", True), ("", False), ("bathe person", False), ("the\tHEAD", True)],
)
def test_a_body_part_as_a_thing(spark, text, body):
    assert spark.createDataFrame([(text,)], "t string").select(plausible.has_body_part(F.col("t"))).first()[0] is body


def test_captions_and_objects(spark):
    rows = [("ok", "lift the Cup", "cup", None)] * 4 + [("ok", "lift it", "cup", "")] + [("ok", None, "cup", None), ("ok", "  ", None, "pan")]
    rows += [("off", "lift the cup", "pan", "pot")] * 2 + [("off", "lift the pan", "pan", None)] * 2 + [("off", "put away", None, None)] * 4
    rows += [("empty", "hold a face", None, ""), ("empty", "hold a face ", None, None), ("empty", "x", "x", None)]
    df = spark.createDataFrame(rows, "e string, said string, l string, r string")
    got = {r["e"]: r for r in plausible.caption_findings(df, ["e"], "said", ["l", "r"]).collect()}
    assert (got["ok"]["n_named"], got["ok"]["n_mismatch"], got["ok"]["captions"], got["ok"]["issues"]) == (7, 1, 3, [])
    assert (got["off"]["n_null"], got["off"]["n_named"], got["off"]["n_mismatch"], got["off"]["issues"]) == (4, 4, 2, ["disconnected"])
    assert (got["empty"]["body_captions"], got["empty"]["issues"]) == (1, ["no_objects", "body_part"])


def test_segments(spark):
    segs = {
        "fine": [(0.0, 1.0, "reach", "to it"), (1.0, 2.0, "hold", "it")], "whole": [(0.0, 1.97, "hold", None)], "one": [(0.0, 0.9, "hold", "a"), (1.0, 1.9, "hold", "b")],
        "text": [(0.0, 0.9, "hold", "a"), (1.0, 1.9, "lift", "a")], "short": [(0.0, 0.1, None, "a"), (0.1, 1.5, "lift", "b")], "missing": [(None, 1.0, "a", "b"), (1.0, None, "b", "c")],
    }
    df = spark.createDataFrame([(e, *s) for e, rows in segs.items() for s in rows], "e string, a double, b double, label string, said string")
    episodes = spark.createDataFrame([(e, 2.0) for e in [*segs, "nothing"]], "e string, length double")
    got = {r["e"]: r["issues"] for r in plausible.segment_findings(df, episodes, ["e"], "a", "b", "label", "said", "length").collect()}
    assert got == {"fine": [], "whole": ["whole", "one_label"], "one": ["one_label"], "text": ["one_description"], "short": ["short"], "missing": ["short"], "nothing": ["none"]}
