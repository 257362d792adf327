"""What a hand touches: evidence at the objects' boxes held over time, else nearness, else a closed pinch where nothing has a box."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions.replies import is_body_term
from .timeseries import hysteresis, trailing_mean

Keys = Sequence[str]
#: Names that say nothing about what a pinch holds, and what it is called then; fixed values.
NO_NAMES = ("person", "hand", "arm", "unknown")
HELD = "manipulated_object"
#: Ratios of thumb to index and thumb to middle finger, in palms, below which a finger takes part in a pinch, and the one below which there is a pinch; fixed values.
PINCH, PINCH_INDEX, PINCH_MIDDLE = 0.42, 0.45, 0.48


def _flat(i: int, j: int) -> Column:
    return F.sqrt((F.col(f"x{i}") - F.col(f"x{j}")) ** 2 + (F.col(f"y{i}") - F.col(f"y{j}")) ** 2)


def contact_states(hands: DataFrame, objects: DataFrame, keys: Keys, order: str, side: str = "side", object_id: str = "object_id", near: float = 25 / 224, least: float = 0.3, n: int = 3, carried: Sequence[str] = ()) -> DataFrame:
    """kind (held, near, pinch or null), in_contact, object_name, fingers, confidence of every hand, beside its `carried` columns.

    hands: keys, order, side and landmarks x0 to z20, a row per tracked hand.  objects:
    keys, order, object_id (the same for an object in all frames), name and a box x0, y0,
    x1, y1, which may be null.  Objects with a name of a body part are passed over.

    held: an object whose box had two tips inside (one, if it is the only object) at a
    depth score of `least` for `n` sightings, until `n` without; of several the one with
    most tips inside, the nearer to the wrist on ties, then the smaller id.  near: the
    object with the highest share of near tips (a tip inside counts whole, one within
    `near` half), if that times the depth score reaches `least`.  pinch: only in frames
    in which no object, body parts included, has a box; named by the first object with a
    usable name.  confidence is the mean over the last three rows of a hand, 0 without
    contact.

    Objects meet hands by frame; then all is in order by hand, so one shuffle by
    (keys, side) serves the states of objects, the choice and the mean.
    """
    frame, hand = [*keys, order], [*keys, side]
    boxes = objects.select(*frame, F.col(object_id).alias("_id"), F.col("name").alias("_name"), *(F.col(c).cast("double").alias(f"_b{c}") for c in ("x0", "y0", "x1", "y1")))
    box = [F.col(f"_b{c}") for c in ("x0", "y0", "x1", "y1")]
    tips = [(F.col(f"_x{t}"), F.col(f"_y{t}")) for t in g.TIPS]
    palm = F.greatest(_flat(9, 0), F.lit(0.04))
    used = {"_depth": g.depth_score([F.col(f"z{t}").cast("double") for t in g.TIPS]), "_index": _flat(4, 8) / palm, "_middle": _flat(4, 12) / palm} | {f"_{a}{i}": F.col(f"{a}{i}").cast("double") for i in (0, *g.TIPS) for a in "xy"}
    hands = hands.select(*frame, side, *carried, *(c.alias(k) for k, c in used.items()))
    count = lambda flags: F.size(F.filter(flags, lambda f: f))
    df = hands.join(boxes, frame, "left").repartition(*hand)

    boxed = sum((c.isNull().cast("int") for c in box), F.lit(0)) == 0
    body = F.coalesce(is_body_term(F.col("_name")), F.lit(False))
    df = df.withColumns({"_boxed": boxed, "_usable": boxed & ~body})
    here = Window.partitionBy(*frame, side)
    df = df.withColumns({
        "_alone": F.count_if("_usable").over(here) == 1,
        "_in": F.array(*(F.coalesce(x.between(box[0], box[2]) & y.between(box[1], box[3]), F.lit(False)) for x, y in tips)),
        "_by": F.array(*(F.coalesce(g.box_distance(x, y, box) <= near, F.lit(False)) for x, y in tips)),
    })
    df = df.withColumn("_evidence", F.col("_usable") & (count("_in") >= F.when(F.col("_alone"), 1).otherwise(2)) & (F.col("_depth") >= least))
    df = hysteresis(df, "_evidence", [*hand, "_id", "_usable"], order, n, "_on")

    away = F.hypot((box[0] + box[2]) / 2 - F.col("_x0"), (box[1] + box[3]) / 2 - F.col("_y0"))
    close = (count("_in") + 0.5 * (count("_by") - count("_in"))) / F.nullif(count("_by"), F.lit(0))
    first = lambda what, when, *by: F.min_by(what, F.when(when, F.struct(*by)))
    told = F.length(F.coalesce("_name", F.lit(""))) > 0
    agg = df.groupBy(*hand, order).agg(
        *(F.first(c).alias(c) for c in (*carried, "_depth", "_index", "_middle")),
        first(F.struct("_name", F.col("_in").alias("_f"), F.lit(1.0).alias("_c")), F.col("_on") & F.col("_usable"), away - 10.0 * count("_in"), F.col("_id")).alias("_held"),
        first(F.struct("_name", F.col("_by").alias("_f"), close.alias("_c")), F.col("_usable") & (count("_by") > 0), -close, F.col("_id")).alias("_near"),
        first(F.col("_name"), told & ~F.lower("_name").isin(*NO_NAMES), F.col("_id")).alias("_first"),
        F.max("_boxed").alias("_any"),
    )
    index, middle = F.col("_index"), F.col("_middle")
    pinch = F.struct(F.coalesce("_first", F.lit(HELD)).alias("_name"), F.array(F.lit(True), index < PINCH_INDEX, middle < PINCH_MIDDLE, F.lit(False), F.lit(False)).alias("_f"), g.clip(1 - F.least(index, middle), 0.55, 0.85).alias("_c"))
    kind = F.when(F.col("_held").isNotNull(), "held").when(F.col("_near._c") * F.col("_depth") >= least, "near").when(~F.col("_any") & ((index < PINCH) | (middle < PINCH)), "pinch")
    agg = agg.withColumn("kind", kind).withColumn("_s", F.when(F.col("kind") == "held", F.col("_held")).when(F.col("kind") == "near", F.col("_near")).when(F.col("kind") == "pinch", pinch))
    agg = agg.withColumns({"in_contact": F.col("kind").isNotNull(), "object_name": F.col("_s._name"), "fingers": F.coalesce("_s._f", F.array(*[F.lit(False)] * 5))})
    agg = trailing_mean(agg, F.coalesce(F.col("_s._c") * F.col("_depth"), F.lit(0.0)), hand, order, 3, "_mean")
    return agg.withColumn("confidence", F.when(F.col("in_contact"), F.col("_mean")).otherwise(0.0)).drop("_depth", "_held", "_near", "_first", "_any", "_s", "_mean", "_index", "_middle")
