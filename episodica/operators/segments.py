"""Segmentation: change points, intervals, jitter absorption, merging, runs and windows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import groupby, islice
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .windows import before, island, ordered

Keys = Sequence[str]
WILD = ("none", "unknown")


def frame_states(df: DataFrame) -> DataFrame:
    """Adds contact (in contact with a named object) and grip (the grasp while in contact, else none)."""
    contact = F.col("in_contact") & F.col("object_name").isNotNull()
    return df.withColumns({"contact": contact, "grip": F.when(contact, F.col("grasp")).otherwise("none")})


def change_points(df: DataFrame, keys: Keys, order: str) -> DataFrame:
    """Adds change: start, contact_on, contact_off, object_change, grasp_change or null, by this priority."""
    w = ordered(keys, order)
    was = {c: F.lag(c).over(w) for c in ("contact", "object_name", "grip")}
    change = (
        F.when(F.row_number().over(w) == 1, "start")
        .when(F.col("contact") != was["contact"], F.when(F.col("contact"), "contact_on").otherwise("contact_off"))
        .when(F.col("contact") & ~F.col("object_name").eqNullSafe(was["object_name"]), "object_change")
        .when(F.col("contact") & (F.col("grip") != was["grip"]), "grasp_change")
    )
    return df.withColumn("change", change)


def mark_idle(df: DataFrame, keys: Keys, order: str, time: str, idle_sec: float) -> DataFrame:
    """Adds idle_edge: rows where a run without contact of `idle_sec` or longer begins or ends (its last row where the episode ends). Windows of one partitioning, no join."""
    w = ordered(keys, order)
    df = island(df, F.col("contact"), w, "_run").withColumns({"_next": F.coalesce(F.lead(time).over(w), F.col(time)), "_is_last": F.lead(order).over(w).isNull()})
    run = Window.partitionBy(*keys, "_run")
    df = df.withColumns({"_long": ~F.col("contact") & (F.max("_next").over(run) - F.min(time).over(run) >= idle_sec), "_first": F.col(order) == F.min(order).over(run)})
    after_long = F.coalesce(F.lag("_long").over(w), F.lit(False))
    return df.withColumn("idle_edge", (F.col("_first") & (F.col("_long") | after_long)) | (F.col("_long") & F.col("_is_last"))).drop("_run", "_next", "_is_last", "_long", "_first")


def idle_boundaries(df: DataFrame, keys: Keys, order: str, time: str, idle_sec: float) -> DataFrame:
    return mark_idle(df, keys, order, time, idle_sec).filter("idle_edge").select(*keys, order)


def segments(df: DataFrame, keys: Keys, order: str, time: str, idle_sec: float = 1.0) -> DataFrame:
    """Half-open intervals between change points and idle boundaries. Between two of them contact, grasp and object stay the same, so any row of a segment has them."""
    df = mark_idle(change_points(frame_states(df), keys, order), keys, order, time, idle_sec)
    df = df.withColumn("_type", F.coalesce("change", F.when(F.col("idle_edge"), "idle")))
    df = df.withColumn("seg", F.sum(F.col("_type").isNotNull().cast("int")).over(before(ordered(keys, order))))
    built = df.groupBy(*keys, "seg").agg(
        F.min(order).alias("start_frame"), (F.max(order) + 1).alias("end_frame"), F.min(time).alias("start_time"), F.max(time).alias("last_time"), F.max("_type").alias("_type"),
        F.when(F.first("contact"), "contact").otherwise("no_contact").alias("state"), F.first("grip").alias("grasp"), F.max(F.when(F.col("contact"), F.col("object_name"))).alias("object_name"),
    )
    v = Window.partitionBy(*keys).orderBy("seg")
    return built.select(*keys, "seg", "start_frame", "end_frame", "start_time", F.coalesce(F.lead("start_time").over(v), "last_time").alias("end_time"), F.coalesce(F.lead("_type").over(v), F.lit("end")).alias("transition"), "state", "grasp", "object_name")


_SEGMENT = ["start_frame", "end_frame", "start_time", "end_time", "transition", "state", "grasp", "object_name"]


def _numbered(rows: Iterator[dict]) -> Iterator[tuple[int, dict]]:
    """Rows with the number of their episode; one begins at place 1."""
    n = 0
    for r in rows:
        n += r["_place"] == 1
        yield n, r


def _fold_segments(segs: DataFrame, keys: Keys, step: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """step: the segments of one episode in order to those that come of them. Both are read as they come, so an episode may have any number."""
    schema = T.StructType([segs.schema[c] for c in (*keys, *_SEGMENT)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (r for pdf in batches for r in pdf.astype(object).where(pdf.notna(), None).to_dict("records"))
        made = (s for _, group in groupby(_numbered(rows), itemgetter(0)) for s in step(r for _, r in group))
        while some := list(islice(made, 4096)):
            yield pd.DataFrame(some, columns=schema.names)

    w = ordered(keys, "start_frame")
    return segs.select(*keys, *_SEGMENT).withColumn("_place", F.row_number().over(w)).sortWithinPartitions(*keys, "_place").mapInPandas(run, schema)


def _joined(a: dict, b: dict, grasp: str) -> dict:
    return a | {"end_frame": b["end_frame"], "end_time": b["end_time"], "grasp": grasp, "object_name": a["object_name"] or b["object_name"]}


def absorb_jitter(segs: DataFrame, keys: Keys, min_sec: float = 0.2) -> DataFrame:
    """A short segment joins an earlier one of its state; a short pulse between two of one state joins both; others stay."""

    def step(rows: Iterator[dict]) -> Iterator[dict]:
        last, s = None, next(rows, None)
        while s is not None:
            after = next(rows, None)
            short = last is not None and s["end_time"] - s["start_time"] < min_sec
            if short and last["state"] == s["state"]:
                last = _joined(last, s, last["grasp"] if last["grasp"] != "unknown" else s["grasp"])
            elif short and after is not None and last["state"] == after["state"]:
                last = _joined(last, after, last["grasp"] if last["grasp"] != "unknown" else after["grasp"])
                after = next(rows, None)
            else:
                if last is not None:
                    yield last
                last = s
            s = after
        yield last

    return _fold_segments(segs, keys, step)


def merge_adjacent(segs: DataFrame, keys: Keys, gap_sec: float = 0.3) -> DataFrame:
    """Joins neighbours of one state and object whose grasps agree, none and unknown agreeing with any, if the gap is short."""

    def step(rows: Iterator[dict]) -> Iterator[dict]:
        last = next(rows)
        for s in rows:
            grasp = last["grasp"] == s["grasp"] or last["grasp"] in WILD or s["grasp"] in WILD
            if last["state"] == s["state"] and grasp and last["object_name"] == s["object_name"] and s["start_time"] - last["end_time"] <= gap_sec:
                last = _joined(last, s, s["grasp"] if s["grasp"] not in WILD else last["grasp"])
            else:
                yield last
                last = s
        yield last

    return _fold_segments(segs, keys, step)


def collapsed(df: DataFrame, segs: DataFrame, keys: Keys, order: str, transitions: int = 5) -> DataFrame:
    """Episodes with many contact changes but one segment."""
    w = ordered(keys, order)
    flips = frame_states(df).withColumn("_flip", (F.col("contact") != F.lag("contact").over(w)).cast("int")).groupBy(*keys).agg(F.coalesce(F.sum("_flip"), F.lit(0)).alias("transitions"))
    counts = segs.groupBy(*keys).agg(F.count("*").alias("segments"))
    return flips.join(counts, list(keys)).withColumn("collapsed", (F.col("transitions") >= transitions) & (F.col("segments") == 1))


def runs(df: DataFrame, flag: Column, keys: Keys, order: str, min_rows: int = 1) -> DataFrame:
    """Maximal runs where `flag` holds: run_start, run_end (exclusive), n."""
    w = ordered(keys, order)
    df = island(df.withColumn("_ok", F.coalesce(flag, F.lit(False))), F.col("_ok"), w, "_run").filter("_ok")
    found = df.groupBy(*keys, "_run").agg(F.min(order).alias("run_start"), (F.max(order) + 1).alias("run_end"), F.count("*").alias("n"))
    return found.filter(F.col("n") >= min_rows).drop("_run")


def grasp_windows(df: DataFrame, keys: Keys, order: str, reachable: str, opening: str, distance: str, close: float = 0.03, near: float = 0.09, min_rows: int = 6) -> DataFrame:
    """Runs of reachable rows with a closed gripper near the object; the first row grasps."""
    found = runs(df, F.col(reachable) & (F.col(opening) < close) & (F.col(distance) < near), keys, order, min_rows)
    return found.withColumn("grasp_frame", F.col("run_start"))
