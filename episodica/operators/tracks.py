"""Boxes of named objects between keyframes, without a grid of frames and objects.

A keyframe has sightings of some objects; between two neighbouring keyframes an object is
known from the left one, the right one or both.  That is one row per object and pair of
neighbours, so its rows grow with the sightings; frames are made only where they are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import before, ordered

Keys = Sequence[str]
BOX = ("x0", "y0", "x1", "y1")


def between_keyframes(sightings: DataFrame, keyframes: DataFrame, keys: Keys, name: str, order: str, box: Sequence[str] = BOX) -> DataFrame:
    """keys, name, start, stop, left, right: per object and pair of neighbouring keyframes its box at either; start is -1 before the first keyframe, stop null after the last.

    Of repeated sightings of a name at a keyframe the largest box in order of its numbers
    counts; sightings off the keyframes and those without a name don't.
    """
    w = ordered(keys, order)
    near = keyframes.select(*keys, order).distinct().withColumns({"_before": F.coalesce(F.lag(order).over(w), F.lit(-1)), "_next": F.lead(order).over(w)})
    seen = sightings.filter(F.col(name).isNotNull()).join(near, [*keys, order]).withColumn("_box", F.struct(*box))
    sides = seen.select(*keys, name, F.explode(F.array(
        F.struct(F.col(order).alias("start"), F.col("_next").alias("stop"), F.col("_box").alias("left"), F.lit(None).cast(seen.schema["_box"].dataType).alias("right")),
        F.struct(F.col("_before").alias("start"), F.col(order).alias("stop"), F.lit(None).cast(seen.schema["_box"].dataType).alias("left"), F.col("_box").alias("right")),
    )).alias("_s")).select(*keys, name, "_s.*")
    return sides.groupBy(*keys, name, "start", "stop").agg(F.max("left").alias("left"), F.max("right").alias("right"))


def _at(order: str, box: Sequence[str], pad: float, hold_right: bool) -> dict[str, Column]:
    """The box at `order` of a row that has start, stop, left, right; null where there is none."""
    share = (F.col(order) - F.col("start")) / F.nullif(F.col("stop") - F.col("start"), F.lit(0))
    later = F.col(order) > F.col("start")
    both = F.col("left").isNotNull() & F.col("right").isNotNull() & later
    mixed = [F.col(f"left.{c}") + (F.col(f"right.{c}") - F.col(f"left.{c}")) * share for c in box]
    more = pad * ((mixed[2] - mixed[0]) + (mixed[3] - mixed[1])) / 2
    return {c: F.when(both, mixed[k] + (more if k >= 2 else -more)).when(F.col("left").isNotNull(), F.col(f"left.{c}")).when(later & F.lit(hold_right), F.col(f"right.{c}")) for k, c in enumerate(box)}


def tracks(parts: DataFrame, lengths: DataFrame, keys: Keys, order: str, box: Sequence[str] = BOX, pad: float = 0.0, hold_right: bool = True) -> DataFrame:
    """keys, name, order, box of every frame that has one: linear between keyframes that both have the object, widened by `pad` of its mean side; held where only one has.

    parts: of `between_keyframes`; lengths: keys, n (frames of the episode).  `hold_right`
    holds a box of the right keyframe back to the left one; without it the object isn't
    there yet.  After the last keyframe its boxes hold to the end.
    """
    first = F.when(F.col("left").isNotNull(), F.col("start")).otherwise(F.col("start") + 1)
    last = F.coalesce("stop", "n") - 1
    name = [c for c in parts.columns if c not in (*keys, "start", "stop", "left", "right")]
    df = parts.join(lengths.select(*keys, "n"), list(keys)).withColumn("_last", last).filter(first <= F.col("_last"))
    df = df.withColumn(order, F.explode(F.sequence(first.cast("int"), F.col("_last").cast("int"))))
    return df.withColumns(_at(order, box, pad, hold_right)).filter(F.col("left").isNotNull() | F.lit(hold_right)).select(*keys, *name, order, *box)


def tracks_at(parts: DataFrame, keyframes: DataFrame, reads: DataFrame, keys: Keys, name: str, order: str, box: Sequence[str] = BOX, pad: float = 0.0, hold_right: bool = True) -> DataFrame:
    """`tracks` at the rows of `reads` (keys, name, order and more), null where the object has no box; nothing is made for other frames."""
    own = [c for c in reads.columns if c not in (*keys, order)]
    marks = keyframes.select(*keys, order).distinct().select(*keys, order, F.lit(0).alias("_side"), *(F.lit(None).cast(reads.schema[c].dataType).alias(c) for c in own))
    both = reads.select(*keys, order, F.lit(1).alias("_side"), *own).unionByName(marks)
    w = before(ordered(keys, [order, "_side"]))
    at = both.withColumn("start", F.coalesce(F.last(F.when(F.col("_side") == 0, F.col(order)), ignorenulls=True).over(w), F.lit(-1))).filter("_side = 1").drop("_side")
    met = at.join(parts, [*keys, name, "start"], "left")
    return met.withColumns(_at(order, box, pad, hold_right)).select(*reads.columns, *box)
