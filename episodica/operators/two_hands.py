"""Segments and summaries of frames with two hands: left_ and right_ present, in_contact, object, grasp, guessed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .segments import mark_idle
from .stats import share
from .windows import before, ordered, whole

Keys = Sequence[str]
SIDES = ("right", "left")


def _yes(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def two_hand_states(df: DataFrame) -> DataFrame:
    """Adds objects (names that a hand touches, the right hand's first), contact (there is one) and grip (the right hand's grasp while it touches anything, else the left's, else none)."""
    named = [F.when(_yes(f"{s}_in_contact"), F.col(f"{s}_object")) for s in SIDES]
    grip = F.lit("none")
    for s in reversed(SIDES):
        grip = F.when(_yes(f"{s}_in_contact") & F.col(f"{s}_grasp").isNotNull(), F.col(f"{s}_grasp")).otherwise(grip)
    df = df.withColumn("objects", F.array_compact(F.array(*named)))
    return df.withColumns({"contact": F.size("objects") > 0, "grip": grip})


def two_hand_segments(df: DataFrame, keys: Keys, order: str, time: str, idle_sec: float = 1.0, least: int = 3) -> DataFrame:
    """Half-open intervals between changes of contact, of the set of touched objects, of the grip, and idle boundaries.

    An interval's state and grip are those of its middle row; its object is the one touched
    most in it, of equals the first, among those that the episode's hands touch in `least`
    rows or more, counted by hand; `hands` are those in contact with anything, right where
    none is.  Rows of an episode are numbered from 0 by `order`.
    """
    w = ordered(keys, order)
    df = two_hand_states(df)
    was = {c: F.lag(c).over(w) for c in ("contact", "objects", "grip")}
    sets = lambda c: F.array_sort(F.array_distinct(c))
    change = (
        F.when(F.row_number().over(w) == 1, "start").when(F.col("contact") != was["contact"], F.when(F.col("contact"), "contact_on").otherwise("contact_off"))
        .when(F.col("contact") & (sets(F.col("objects")) != sets(was["objects"])), "object_change").when(F.col("contact") & (F.col("grip") != was["grip"]), "grasp_change")
    )
    df = mark_idle(df.withColumn("change", change), keys, order, time, idle_sec)
    df = df.withColumn("_type", F.coalesce("change", F.when(F.col("idle_edge"), "idle"))).withColumn("seg", F.sum(F.col("_type").isNotNull().cast("int")).over(before(w)))
    v = Window.partitionBy(*keys, "seg")
    df = df.withColumns({"_lo": F.min(order).over(v), "_hi": F.max(order).over(v) + 1, "_end": F.max(order).over(whole(w))})
    middle = F.col(order) == F.least(F.floor((F.col("_lo") + F.col("_hi")) / 2), F.col("_end"))
    built = df.groupBy(*keys, "seg").agg(
        F.min(order).alias("start_frame"), (F.max(order) + 1).alias("end_frame"), F.min(time).alias("start_time"), F.max(time).alias("_last"), F.max("_type").alias("_type"),
        F.first("contact").alias("_contact"), F.max(F.when(middle, F.col("contact"))).alias("_mid"), F.max(F.when(middle, F.col("grip"))).alias("_grip"), *(F.max(_yes(f"{s}_in_contact")).alias(f"_{s}") for s in SIDES),
    )
    # the middle of a segment of one row is the row after it, in the next segment
    n = Window.partitionBy(*keys).orderBy("seg")
    first = df.filter(F.col(order) == F.col("_lo")).select(*keys, "seg", F.col("contact").alias("_c0"), F.col("grip").alias("_g0"))
    built = built.join(first, [*keys, "seg"]).withColumns({"_c": F.coalesce("_mid", F.lead("_c0").over(n), "_c0"), "_g": F.coalesce("_grip", F.lead("_g0").over(n), "_g0")})
    touched = df.select(*keys, "seg", order, F.posexplode("objects").alias("_p", "object_name"))
    steady = touched.groupBy(*keys, "object_name").agg(F.count("*").alias("_n")).filter((F.col("_n") >= least) & (F.col("object_name") != "unknown")).drop("_n")
    counted = touched.join(steady, [*keys, "object_name"]).groupBy(*keys, "seg", "object_name").agg(F.count("*").alias("_n"), F.min(F.struct(order, "_p")).alias("_seen"))
    top = counted.groupBy(*keys, "seg").agg(F.max_by("object_name", F.struct("_n", -F.col(f"_seen.{order}"), -F.col("_seen._p"))).alias("object_name"))
    hands = F.when(F.col("_left") & F.col("_right"), F.array(F.lit("left"), F.lit("right"))).when(F.col("_left"), F.array(F.lit("left"))).otherwise(F.array(F.lit("right")))
    out = built.join(top, [*keys, "seg"], "left").withColumn("hands", hands)
    return out.select(
        *keys, "seg", "start_frame", "end_frame", "start_time", F.coalesce(F.lead("start_time").over(n), "_last").alias("end_time"), F.coalesce(F.lead("_type").over(n), F.lit("end")).alias("transition"),
        F.when(F.col("_c"), "contact").otherwise("no_contact").alias("state"), F.col("_g").alias("grasp"), "object_name", "hands", F.when(F.size("hands") > 1, "both").otherwise(F.get("hands", F.lit(0))).alias("hand_used"),
    )


def two_hand_summary(df: DataFrame, keys: Keys, order: str, reach: int = 10, grasps: Sequence[str] = ("precision_pinch", "power_wrap", "hook", "open", "unknown")) -> DataFrame:
    """Per key rows, contact and grasps of either hand, the share of rows that lack a hand, the same among rows within `reach` of a seen hand, and the share with a guessed hand."""
    either = _yes("left_present") | _yes("right_present")
    lost = ~(_yes("left_present") & _yes("right_present"))
    df = df.withColumn("_active", F.max(either).over(ordered(keys, order).rowsBetween(-reach, reach)))
    n = F.count(F.lit(1))
    counts = [F.count_if(F.col(f"{s}_grasp") == g).alias(f"{s}_{g}") for s in SIDES for g in grasps]
    contact = [c for s in SIDES for c in (F.count_if(_yes(f"{s}_in_contact")).alias(f"{s}_contact_frames"), share(F.count_if(_yes(f"{s}_in_contact")), n).alias(f"{s}_contact_ratio"))]
    return df.groupBy(*keys).agg(
        n.alias("frames"), *contact, *counts, share(F.count_if(lost), n, 100.0).alias("loss_pct"), share(F.count_if(lost & F.col("_active")), F.count_if("_active"), 100.0).alias("active_loss_pct"),
        share(F.count_if(_yes("left_guessed") | _yes("right_guessed")), n, 100.0).alias("guessed_pct"),
    )


def leading_hand(df: DataFrame, keys: Keys, preferred: str = "auto", fall_back: bool = True) -> DataFrame:
    """keys, n_left, n_right, hand: the preferred hand where it is seen at all, else the other if `fall_back`; without a preference the one seen more, right on a tie; none where none is seen."""
    counts = df.groupBy(*keys).agg(F.count_if(_yes("left_present")).alias("n_left"), F.count_if(_yes("right_present")).alias("n_right"))
    more = F.when(F.col("n_left") > F.col("n_right"), "left").otherwise("right")
    if preferred in SIDES:
        other = SIDES[1 - SIDES.index(preferred)]
        more = F.when(F.col(f"n_{preferred}") > 0, preferred).when(F.lit(fall_back) & (F.col(f"n_{other}") > 0), other).otherwise(preferred)
    return counts.withColumn("hand", F.when((F.col("n_left") == 0) & (F.col("n_right") == 0), "none").otherwise(more))
