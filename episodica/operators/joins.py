"""Joins that equality alone doesn't express: intervals, nearest intervals, boxes, schema differences, evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import before

Keys = Sequence[str]


def interval_first(points: DataFrame, spans: DataFrame, keys: Keys, time: str, start: str, stop: str, value: str) -> DataFrame:
    """Left join of points to the first span (by start) that holds their time, both ends closed.

    Spans may overlap and nest: a span counts from where those that start before it have
    all ended, and not at all where that is behind its own end.  What is left touches at
    most, so the first span that holds a time is either the last one that begins before
    it or the one that begins at it: one union and one window do instead of a range join.
    Of spans with one start the one with the least `value` is first.
    """
    earlier = Window.partitionBy(*keys).orderBy(start, value).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(*keys, start, stop, value).withColumn("_upto", F.max(stop).over(earlier)).filter(F.col("_upto").isNull() | (F.col("_upto") < F.col(stop)))
    spans = spans.withColumn(start, F.greatest(start, "_upto")).drop("_upto")
    cols = [c for c in points.columns if c not in (*keys, time)]
    lhs = points.select(*keys, F.col(time).alias("_t"), F.lit(1).alias("_side"), *cols, F.lit(None).cast(spans.schema[stop].dataType).alias("_stop"), F.lit(None).cast("string").alias("_value"))
    rhs = spans.select(*keys, F.col(start).alias("_t"), F.lit(2).alias("_side"), *(F.lit(None).cast(points.schema[c].dataType).alias(c) for c in cols), F.col(stop).alias("_stop"), F.col(value).alias("_value"))
    both = lhs.unionByName(rhs.withColumn("_side", F.lit(2)))
    # spans that start strictly before the time are preferred; one that starts at the time comes next
    w = before(Window.partitionBy(*keys).orderBy("_t", "_side"))
    early = F.last(F.when(F.col("_side") == 2, F.struct("_stop", "_value")), ignorenulls=True).over(w)
    late = before(Window.partitionBy(*keys).orderBy("_t", F.desc("_side")))
    same = F.last(F.when(F.col("_side") == 2, F.struct("_stop", "_value")), ignorenulls=True).over(late)
    both = both.withColumn("_early", early).withColumn("_same", same).filter("_side = 1")
    hit = F.when(F.col("_early._stop") >= F.col("_t"), F.col("_early._value")).when(F.col("_same._stop") >= F.col("_t"), F.col("_same._value"))
    return both.select(*keys, F.col("_t").alias(time), *cols, hit.alias(value))


def ranges_of(df: DataFrame, keys: Keys, time: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(time).alias("start"), F.max(time).alias("stop"))


def nearest_interval(spans: DataFrame, truth: DataFrame, keys: Keys, ids: Keys, name: str) -> DataFrame:
    """For every span (start_time, end_time) the true range (start, stop) of its key with the least sum of distances; by name on ties; nulls without any."""
    both = spans.join(truth, list(keys), "left")
    both = both.withColumns({"start_error": F.abs(F.col("start_time") - F.col("start")), "end_error": F.abs(F.col("end_time") - F.col("stop"))})
    by = F.struct(F.round(F.col("start_error") + F.col("end_error"), 9).alias("d"), F.col(name), "start_error", "end_error")
    return both.groupBy(*keys, *ids).agg(F.min(by).alias("m")).select(*keys, *ids, F.col(f"m.{name}").alias(name), "m.start_error", "m.end_error")


def evaluate(df: DataFrame, keys: Keys, truth: str, predicted: str, true_label: str, label: str) -> DataFrame:
    """Accuracy, precision and recall (0 where undefined), and accuracy of labels where one is predicted."""
    t, p = F.col(truth), F.coalesce(F.col(predicted), F.lit(False))
    share = lambda a, b: F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))
    tp = F.count_if(t & p)
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), share(F.count_if(t == p), F.count("*")).alias("accuracy"), share(tp, F.count_if(p)).alias("precision"), share(tp, F.count_if(t)).alias("recall"),
        share(F.count_if(F.col(label) == F.col(true_label)), F.count(label)).alias("grasp_accuracy"),
    )


def overlap(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Intersection over union of boxes x0, y0, x1, y1; 0 for an empty union."""
    inter = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0])) * F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return F.when(union > 0, inter / union).otherwise(0.0)


def box_of(prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1")]


def best_overlap(left: DataFrame, right: DataFrame, keys: Keys, left_id: str, right_id: str, least: float = 0.3) -> DataFrame:
    """For every left box of a key the right box that overlaps most, above `least`; the smaller id on ties; null else."""
    r = right.select(*keys, F.col(right_id).alias("_rid"), *(F.col(c).alias(f"r_{c}") for c in ("x0", "y0", "x1", "y1")))
    both = left.join(r, list(keys), "left").withColumn("iou", overlap(box_of(), box_of("r_")))
    hit = F.when(F.col("iou") > least, F.struct(F.round("iou", 9).alias("iou"), -F.col("_rid")))
    return both.groupBy(*keys, left_id).agg(F.max(hit).alias("m")).select(*keys, left_id, (-F.col("m.col2")).alias("match"), F.col("m.iou").alias("iou"))


def suppress(df: DataFrame, keys: Keys, box_id: str, most: float = 0.5) -> DataFrame:
    """Greedy non-maximum suppression: by score, a box stays if it overlaps no staying box of its key by more than `most`. The fold runs over one key's boxes as an array."""
    one = F.struct((-F.col("score")).alias("s"), F.col(box_id).alias("id"), "x0", "y0", "x1", "y1")
    lists = df.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("b"))

    def fields(s: Column) -> list[Column]:
        return [s[c] for c in ("x0", "y0", "x1", "y1")]

    kept = F.aggregate("b", F.slice("b", 1, 0), lambda acc, x: F.when(F.exists(acc, lambda y: overlap(fields(x), fields(y)) > most), acc).otherwise(F.concat(acc, F.array(x))))
    return lists.select(*keys, F.explode(kept).alias("k")).select(*keys, F.col("k.id").alias(box_id), (-F.col("k.s")).alias("score"))


def schema_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Features (feature, dtype, shape) that only one side has or that differ: side is a, b or both."""
    x, y = a.select("feature", "dtype", "shape"), b.select("feature", F.col("dtype").alias("dtype_b"), F.col("shape").alias("shape_b"))
    full = x.join(y, "feature", "full")
    side = F.when(F.col("dtype_b").isNull(), "a").when(F.col("dtype").isNull(), "b").otherwise("both")
    return full.withColumn("side", side).filter((F.col("side") != "both") | (F.col("dtype") != F.col("dtype_b")) | (F.col("shape") != F.col("shape_b")))


def limit_check(joints: DataFrame, known: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Joints whose limits differ from the known ones by more than the tolerance."""
    both = joints.join(known.select("joint", F.col("lower").alias("known_lower"), F.col("upper").alias("known_upper")), "joint")
    off = F.greatest(F.abs(F.col("lower") - F.col("known_lower")), F.abs(F.col("upper") - F.col("known_upper")))
    return both.withColumn("off", off).filter(F.col("off") > tolerance)


def last_of(df: DataFrame, keys: Keys, order: str) -> DataFrame:
    """The last row of every key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def first_of(df: DataFrame, keys: Keys, *order: str | Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def joint_roles(joints: DataFrame, gripper: Column) -> DataFrame:
    """Adds role and rest to a joint table: a moving joint for which `gripper` holds is the gripper's, another revolute one the arm's, rest being the middle of its range; all others have neither."""
    moves = F.col("kind").isin("revolute", "prismatic")
    role = F.when(moves & gripper, "gripper").when(F.col("kind") == "revolute", "arm")
    return joints.withColumn("role", role).withColumn("rest", F.when(F.col("role") == "arm", (F.col("lower") + F.col("upper")) / 2))


def robots_of(joints: DataFrame, keys: Keys, known: DataFrame) -> DataFrame:
    """Per robot the joints of its arm and gripper, how wide that opens (the sum of its upper limits), and limits that differ from the known ones (keys, joint, lower, upper): by over 0.001 m for prismatic joints, 0.005 rad else, each bound by itself."""
    told = known.select(*keys, "joint", F.col("lower").alias("_lower"), F.col("upper").alias("_upper"))
    most = F.when(F.col("kind") == "prismatic", 0.001).otherwise(0.005)
    off = sum((F.coalesce((F.abs(F.col(c) - F.col(f"_{c}")) > most).cast("int"), F.lit(0)) for c in ("lower", "upper")), F.lit(0))
    both = joints.join(told, [*keys, "joint"], "left")
    wide = F.coalesce(F.sum(F.when(F.col("role") == "gripper", F.col("upper"))), F.lit(0.0))
    return both.groupBy(*keys).agg(F.count_if(F.col("role") == "arm").alias("arm_joints"), F.count_if(F.col("role") == "gripper").alias("gripper_joints"), wide.alias("opening"), F.sum(off).alias("warnings"))
