"""Masks as runs of pixels in column order: coding, algebra and depth medians without painting whole images.

A run is (start, length) of neighbouring pixels of a mask; runs of a mask may overlap or
touch.  A sweep over the ends of runs tells how many cover a place, so unions,
intersections and overlaps cost a sort of the ends, whatever the image's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import before, ordered, whole

Keys = Sequence[str]


def decode_counts(masks: DataFrame, keys: Keys, counts: str = "counts", height: str = "height", width: str = "width") -> DataFrame:
    """keys, start, length of every run of the mask. counts: lengths of runs off, on, off and so on; the job fails where they don't add up to the image, or are null or negative."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(-(1 << 40))))
    wrong = F.concat_ws(" ", F.lit("run lengths of mask"), *(F.col(k).cast("string") for k in keys), F.lit("add up to"), total.cast("string"), F.lit("and not to"), (F.col(height) * F.col(width)).cast("string"))
    fits = F.coalesce((total == F.col(height).cast("long") * F.col(width)) & ~F.exists(counts, lambda x: x < 0), F.lit(False))
    checked = masks.withColumn(counts, F.when(fits, F.col(counts)).otherwise(F.raise_error(wrong).cast(masks.schema[counts].dataType)))
    ends = F.transform(counts, lambda x, i: F.struct(i.alias("i"), x.cast("long").alias("length"), F.aggregate(F.slice(counts, 1, i), F.lit(0).cast("long"), lambda a, y: a + y).alias("start")))
    return checked.select(*keys, F.explode(F.filter(ends, lambda r: (r["i"] % 2 == 1) & (r["length"] > 0))).alias("_r")).select(*keys, "_r.start", "_r.length")


def combine(runs: DataFrame, keys: Keys, least: int = 1) -> DataFrame:
    """keys, start, length of the places that at least `least` runs cover: 1 for the union; the number of masks, each without overlaps of its own, for their intersection."""
    ends = runs.select(*keys, F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct((F.col("start") + F.col("length")).alias("at"), F.lit(-1).alias("d")))).alias("_e"))
    steps = ends.groupBy(*keys, F.col("_e.at").alias("at")).agg(F.sum("_e.d").alias("d"))
    w = ordered(keys, "at")
    steps = steps.withColumn("_on", F.sum("d").over(before(w)) >= least).withColumn("_was", F.coalesce(F.lag("_on").over(w), F.lit(False))).filter("_on <> _was")
    return steps.withColumn("_stop", F.lead("at").over(w)).filter("_on").select(*keys, F.col("at").alias("start"), (F.col("_stop") - F.col("at")).alias("length"))


def encode_counts(runs: DataFrame, keys: Keys, size: str) -> DataFrame:
    """keys, counts: run lengths off, on, off and so on of every mask. size: column with the number of pixels."""
    merged = combine(runs, keys).join(runs.groupBy(*keys).agg(F.max(size).alias("_size")), list(keys))
    w = ordered(keys, "start")
    gap = F.col("start") - F.coalesce(F.lag(F.col("start") + F.col("length")).over(w), F.lit(0))
    last = F.lead("start").over(w).isNull()
    tail = F.col("_size") - F.col("start") - F.col("length")
    pieces = merged.select(*keys, "start", F.when(last & (tail > 0), F.array(gap, F.col("length"), tail)).otherwise(F.array(gap, F.col("length"))).alias("_p"))
    return pieces.groupBy(*keys).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "_p"))), lambda x: x["_p"])).alias("counts"))


def overlaps(runs: DataFrame, pairs: DataFrame, keys: Keys, mask: str) -> DataFrame:
    """keys, a, b, common, either, iou of the pairs (keys, a, b) of masks of one image, by one sweep over the ends of their runs."""
    merged = combine(runs, [*keys, mask])
    sides = pairs.select(*keys, "a", "b", F.explode(F.array(F.struct(F.col("a").alias("m"), F.lit(1).alias("x"), F.lit(0).alias("y")), F.struct(F.col("b").alias("m"), F.lit(0).alias("x"), F.lit(1).alias("y")))).alias("_s")).select(*keys, "a", "b", F.col("_s.m").alias(mask), "_s.x", "_s.y")
    met = sides.join(merged, [*keys, mask], "left")
    ends = met.filter("length > 0").select(*keys, "a", "b", F.explode(F.array(F.struct(F.col("start").alias("at"), F.col("x"), F.col("y")), F.struct((F.col("start") + F.col("length")).alias("at"), (-F.col("x")).alias("x"), (-F.col("y")).alias("y")))).alias("_e")).select(*keys, "a", "b", "_e.*")
    w = ordered([*keys, "a", "b"], "at")
    steps = ends.groupBy(*keys, "a", "b", "at").agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    steps = steps.withColumns({"_x": F.sum("x").over(before(w)), "_y": F.sum("y").over(before(w)), "_n": F.coalesce(F.lead("at").over(w) - F.col("at"), F.lit(0))})
    sums = steps.groupBy(*keys, "a", "b").agg(F.sum(F.when((F.col("_x") > 0) & (F.col("_y") > 0), F.col("_n")).otherwise(0)).alias("common"), F.sum(F.when((F.col("_x") > 0) | (F.col("_y") > 0), F.col("_n")).otherwise(0)).alias("either"))
    out = pairs.select(*keys, "a", "b").join(sums, [*keys, "a", "b"], "left")
    return out.select(*keys, "a", "b", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("common", "either")), F.coalesce(F.col("common") / F.nullif(F.col("either"), F.lit(0)), F.lit(0.0)).alias("iou"))


def usable(z: str) -> Column:
    return (F.col(z) > 0) & (F.col(z) < float("inf"))


def patch_medians(points: DataFrame, pixels: DataFrame, keys: Keys, id_: Keys, reach: int = 1) -> DataFrame:
    """Adds z: the median of the usable depths around every point; null where there are none.

    points: keys (the image), id_, u, v (its pixel); pixels: keys, u, v, z.  A point asks
    for its few places by key; images are neither grouped nor sorted.
    """
    steps = [(du, dv) for du in range(-reach, reach + 1) for dv in range(-reach, reach + 1)]
    asked = points.select(*keys, *id_, F.explode(F.array(*(F.struct((F.col("u") + du).cast("int").alias("u"), (F.col("v") + dv).cast("int").alias("v")) for du, dv in steps))).alias("_p")).select(*keys, *id_, "_p.u", "_p.v")
    near = asked.join(pixels.filter(usable("z")).select(*keys, F.col("u").cast("int").alias("u"), F.col("v").cast("int").alias("v"), "z"), [*keys, "u", "v"])
    z = near.groupBy(*keys, *id_).agg(F.array_sort(F.collect_list("z")).alias("_z"))
    mid = lambda k: F.element_at("_z", F.floor(k).cast("int"))
    n = F.size("_z")
    return points.join(z.select(*keys, *id_, ((mid((n + 1) / 2) + mid((n + 2) / 2)) / 2).alias("z")), [*keys, *id_], "left")


def mask_medians(runs: DataFrame, pixels: DataFrame, keys: Keys, mask: str, height: int) -> DataFrame:
    """keys, mask, u, v (mean place of all its pixels), z (exact median of its usable depths, null without). pixels: keys, at (place in column order), z. Ranks come of a mask's sorted depths, which may spill."""
    places = combine(runs, [*keys, mask]).select(*keys, mask, F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at"))
    met = places.join(pixels.select(*keys, F.col("at").cast("long").alias("at"), "z"), [*keys, "at"], "left")
    met = met.withColumn("z", F.when(usable("z"), F.col("z")))
    w = ordered([*keys, mask], "z")
    met = met.withColumns({"_n": F.count("z").over(whole(w)), "_rank": F.sum(F.col("z").isNotNull().cast("int")).over(before(w))})
    mid = F.col("z").isNotNull() & ((F.col("_rank") == F.floor((F.col("_n") + 1) / 2)) | (F.col("_rank") == F.floor((F.col("_n") + 2) / 2)))
    return met.groupBy(*keys, mask).agg(F.avg(F.floor(F.col("at") / height)).alias("u"), F.avg(F.col("at") % height).alias("v"), F.avg(F.when(mid, F.col("z"))).alias("z"))
