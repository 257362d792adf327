"""Maps from a hand to an embodiment: finger joints and a wrist held over a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .geometry import clip, quaternion_product

# Gains of a finger's joints by its curl (the first joint spreads), and of the thumb's by opposition and curl.
FINGERS = ("index", "middle", "ring")
FINGER_GAINS = (0.0, 1.25, 1.15, 0.85)
THUMB_OPPOSITION, THUMB_GAINS = 1.1, (0.5, 0.95, 0.85)
#: Further joints of a hand that is driven by one number follow it by this share.
FOLLOW = 0.9
# Fixed values of the wrist over a table: gains, bounds of the move on each axis, lift, and the share of the palm's turn.
DEPTH_GAIN, RISE_GAIN, SIDE_GAIN, LIFT_GAIN, YAW_SHARE = 0.45, 0.18, 0.45, 0.38, 0.35
MOVE_X, MOVE_Y, MOVE_Z = (-0.14, 0.16), (-0.22, 0.22), (-0.06, 0.18)
HELD_LOWER, HELD_FLOOR, FREE_FLOOR = 0.03, 0.02, 0.05
#: Share of a motion about the anchor and its bound on each axis, by kind of robot.
ANCHOR_MOTION = {"humanoid": (0.35, 0.10), "arm": (0.50, 0.16)}


def finger_joints(curls: Mapping[str, Column], thumb: Column, opposition: Column, low: float = -0.2, high: float = 1.6) -> dict[str, Column]:
    """Joint angles of three fingers and the thumb from curls of 0 to 1, within the joints' limits."""
    out = {f"{f}{j}": clip(gain * curls[f], low, high) for f in FINGERS for j, gain in enumerate(FINGER_GAINS)}
    angles = [THUMB_OPPOSITION * opposition, *(gain * thumb for gain in THUMB_GAINS)]
    return out | {f"thumb{j}": clip(a, low, high) for j, a in enumerate(angles)}


def closing_joints(grip: Column, opened: Sequence[float], closed: Sequence[float], low: float = -0.2, high: float = 1.6) -> list[Column]:
    """Joint angles on the way from an open to a closed hand by one number of 0 to 1, and last the angle of the joints that follow."""
    share = clip(grip, 0, 1)
    return [*(clip(a + share * (b - a), low, high) for a, b in zip(opened, closed, strict=True)), clip(FOLLOW * share, low, high)]


def wrist_over_table(df: DataFrame, keys: Sequence[str], valid: Column, held: Column, anchor: Sequence[float] = (0.5, 0.0, 0.2), table: float = 0.02) -> DataFrame:
    """Adds wx, wy, wz and the quaternion wqx to wqw: the wrist's move about its median, without the camera's, in the robot's axes about `anchor`.

    df: x0, y0, z0, the camera's shift_x and shift_y, and points 5 and 17 (x, y).  A wrist that
    holds something is lowered, none comes below the table; rows that aren't valid stay at
    the anchor, looking down.  The median is exact, over the valid rows of a key.
    """
    ok = F.coalesce(valid, F.lit(False))
    df = df.withColumns({"_ok": ok, "_x": F.col("x0") - F.col("shift_x"), "_y": F.col("y0") - F.col("shift_y")})
    middle = df.filter("_ok").groupBy(*keys).agg(*(F.percentile(c, F.lit(0.5)).alias(m) for c, m in (("_x", "_mx"), ("_y", "_my"), ("z0", "_mz"))))
    df = df.join(middle, list(keys), "left")
    dx, dy, dz = F.col("_x") - F.col("_mx"), F.col("_y") - F.col("_my"), F.col("z0") - F.col("_mz")
    x = anchor[0] + clip(-dz * DEPTH_GAIN - dy * RISE_GAIN, *MOVE_X)
    y = anchor[1] + clip(-dx * SIDE_GAIN, *MOVE_Y)
    z = anchor[2] + clip(-dy * LIFT_GAIN, *MOVE_Z)
    z = F.when(held, F.greatest(F.lit(table + HELD_FLOOR), z - HELD_LOWER)).otherwise(F.greatest(F.lit(table + FREE_FLOOR), z))
    half = F.atan2(F.col("y17") - F.col("y5"), F.col("x17") - F.col("x5")) * YAW_SHARE / 2
    down = [F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)]
    turned = quaternion_product([F.lit(0.0), F.lit(0.0), F.sin(half), F.cos(half)], down)
    out = {n: F.when(F.col("_ok"), c).otherwise(float(a)) for n, c, a in zip(("wx", "wy", "wz"), (x, y, z), anchor, strict=True)}
    out |= {f"wq{a}": F.when(F.col("_ok"), c).otherwise(d) for a, c, d in zip("xyzw", turned, down, strict=True)}
    return df.withColumns(out).drop("_ok", "_x", "_y", "_mx", "_my", "_mz")


def about_anchor(df: DataFrame, keys: Sequence[str], point: Sequence[str], valid: Column, anchor: Sequence[float], kind: str = "arm") -> DataFrame:
    """Replaces a point by the anchor and its bounded share of the way from the median of a key's valid rows; the anchor itself where a key has none."""
    gain, most = ANCHOR_MOTION[kind]
    middle = df.filter(valid).groupBy(*keys).agg(*(F.percentile(c, F.lit(0.5)).alias(f"_m{k}") for k, c in enumerate(point)))
    df = df.join(middle, list(keys), "left")
    move = {c: float(a) + F.when(F.col(f"_m{k}").isNull(), 0.0).otherwise(clip((F.col(c) - F.col(f"_m{k}")) * gain, -most, most)) for k, (c, a) in enumerate(zip(point, anchor, strict=True))}
    return df.withColumns(move).drop(*(f"_m{k}" for k in range(len(point))))
