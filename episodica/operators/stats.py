"""Pooled statistics, summaries, audits and roll-ups as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import ordered, whole

Keys = Sequence[str]


def share(part: Column, of: Column, scale: float = 1.0) -> Column:
    """part / of, 0 where undefined."""
    return F.coalesce(scale * part / F.nullif(of, F.lit(0)), F.lit(0.0))


#: Names up to which tables of a row per name and rank are broadcast; more of them are joined by a shuffle.
FEW_NAMES = 50_000


def exact_quantiles(df: DataFrame, name: str, value: str, shares: dict[str, float], bins: int = 4096, weight: str | None = None) -> DataFrame:
    """Exact quantiles of finite values, linear between neighbours, for a few names (columns of a data set) with any number of rows each.

    Rows are counted per distinct value first.  Then a rank is looked for among `bins`
    equal parts of a name's range, among `bins` parts of that one, and among the values
    of that, so no task sees all values of a name.  What is broadcast are rows per name
    and rank, where a count finds few names.  A row counts `weight` times, once without.
    """
    rows = df.filter(F.col(value).isNotNull()).groupBy(name, F.col(value).alias("_v")).agg((F.count("*") if weight is None else F.sum(weight)).alias("_n"))
    few = df.select(name).distinct().limit(FEW_NAMES + 1).count() <= FEW_NAMES
    sent = F.broadcast if few else (lambda t: t)
    ends = rows.groupBy(name).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("_n").alias("_all"))
    at = F.coalesce((F.col("_v") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0)), F.lit(0.0)) * bins
    part = lambda x: F.least(F.floor(x), F.lit(bins - 1)).cast("int")
    rows = rows.join(sent(ends), name).withColumn("_b", part(at)).withColumn("_f", part((at - F.col("_b")) * bins)).select(name, "_v", "_n", "_b", "_f")
    places = {c: (F.col("_all") - 1) * q for c, q in shares.items()}
    ranks = F.array_distinct(F.array(*(f(x).cast("long") for x in places.values() for f in (F.floor, F.ceil))))
    wanted = ends.select(name, F.explode(ranks).alias("_rank")).withColumn("_base", F.lit(0).cast("long"))
    by = [name]
    for col in ("_b", "_f", "_v"):
        near = rows if col == "_b" else rows.join(sent(wanted.select(*by).distinct()), by, "left_semi")
        upto = near.groupBy(*by, col).agg(F.sum("_n").alias("_n")).withColumn("_to", F.sum("_n").over(ordered(by, col).rowsBetween(Window.unboundedPreceding, 0)))
        start = F.col("_base") + F.col("_to") - F.col("_n")
        hit = (F.col("_rank") >= start) & (F.col("_rank") < F.col("_base") + F.col("_to"))
        wanted = upto.join(sent(wanted), by).filter(hit).select(*by, col, "_rank", start.alias("_base"))
        by = [*by, col]
    found = wanted.groupBy(name).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_m"))
    get = lambda x, f: F.element_at("_m", f(x).cast("long"))
    lerp = lambda x: get(x, F.floor) + (get(x, F.ceil) - get(x, F.floor)) * (x - F.floor(x))
    return ends.join(sent(found), name).select(name, *(lerp(x).alias(c) for c, x in places.items()))


def feature_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Per feature min, max, mean, population deviation, count, q01 and q99 over all rows, never averaged per episode; quantiles are null without values."""
    wide = df.unpivot([], [F.col(f).cast("double").alias(f) for f in features], "feature", "v")
    rest = wide.groupBy("feature").agg(F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.count("v").alias("count"))
    return rest.join(F.broadcast(exact_quantiles(wide, "feature", "v", {"q01": 0.01, "q99": 0.99})), "feature", "left")  # a row per column of the table


def percentile_normalise(df: DataFrame, value: str, keys: Keys, low: float = 0.01, high: float = 0.99, out: str = "normalised") -> DataFrame:
    """(x - centre) / half range of the percentiles of a key, clipped to -1 to 1; a range near 0 counts as 1. Null values count for nothing and stay null. Ranks come of the sorted rows of a key, which may spill, so no map of a key's values is held."""
    w = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last())
    all_ = whole(w)
    df = df.withColumns({"_rank": F.row_number().over(w) - 1, "_known": F.count(value).over(all_)})

    def at(share: float) -> Column:
        place = (F.col("_known") - 1) * share
        near = lambda rank: F.max(F.when(F.col("_rank") == rank, F.col(value))).over(all_)
        return near(F.floor(place)) + (near(F.ceil(place)) - near(F.floor(place))) * (place - F.floor(place))

    df = df.withColumns({"_lo": at(low), "_hi": at(high)})
    half = F.when((F.col("_hi") - F.col("_lo")) / 2 > 1e-6, (F.col("_hi") - F.col("_lo")) / 2).otherwise(1.0)
    x = (F.col(value) - (F.col("_hi") + F.col("_lo")) / 2) / half
    return df.withColumn(out, F.when(x.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)))).drop("_rank", "_known", "_lo", "_hi")


def _with_scales(df: DataFrame, stats: DataFrame, features: Sequence[str]) -> DataFrame:
    """Adds <feature>_mean and <feature>_scale; the scale is the deviation, or half the percentile range where that is near 0."""
    scale = F.when(F.col("std") > 1e-8, F.col("std")).otherwise(F.greatest((F.col("q99") - F.col("q01")) / 2, F.lit(1e-8)))
    one = stats.groupBy().pivot("feature", list(features)).agg(F.first("mean").alias("mean"), F.first(scale).alias("scale"))
    return df.crossJoin(F.broadcast(one))  # one row: the dataset's statistics


def normalise(df: DataFrame, stats: DataFrame, features: Sequence[str]) -> DataFrame:
    """(x - mean) / scale per feature. stats: of `feature_stats`."""
    kept = [c for c in df.columns if c not in features]
    return _with_scales(df, stats, features).select(*kept, *(((F.col(f) - F.col(f"{f}_mean")) / F.col(f"{f}_scale")).alias(f) for f in features))


def unnormalise(df: DataFrame, stats: DataFrame, features: Sequence[str]) -> DataFrame:
    """x * scale + mean per feature: what `normalise` took away."""
    kept = [c for c in df.columns if c not in features]
    return _with_scales(df, stats, features).select(*kept, *((F.col(f) * F.col(f"{f}_scale") + F.col(f"{f}_mean")).alias(f) for f in features))


def calibrated_travel(df: DataFrame, keys: Keys, order: str, wrist: Sequence[str], palm: Column, tracked: str, reference: float = 0.09, default: float = 0.1, cap: float = 0.15) -> DataFrame:
    """Per key the scale that makes the mean palm `reference` long (tracked rows with a palm over 1e-4, else `default`), the wrist's range on each axis and the path of steps under `cap` between neighbouring tracked rows, all scaled."""
    w = ordered(keys, order)
    here = F.coalesce(F.col(tracked), F.lit(False))
    mean = F.avg(F.when(here & (palm > 1e-4), palm)).over(whole(w))
    df = df.withColumn("_scale", reference / F.coalesce(mean, F.lit(default)))
    step = F.sqrt(sum(((F.col(c) - F.lag(c).over(w)) ** 2 for c in wrist), F.lit(0.0))) * F.col("_scale")
    df = df.withColumn("_step", F.when(here & F.lag(here).over(w), step))
    own = [F.when(here, F.col(c)) for c in wrist]
    travel = [(F.coalesce(F.max(c) - F.min(c), F.lit(0.0)) * F.first("_scale")).alias(f"travel_{n}") for c, n in zip(own, wrist, strict=True)]
    return df.groupBy(*keys).agg(F.first("_scale").alias("scale"), *travel, F.coalesce(F.sum(F.when(F.col("_step") < cap, F.col("_step"))), F.lit(0.0)).alias("path_length"))


def retarget_summary(df: DataFrame, keys: Keys, reachable: str, fallback: str, collision: str, residual: str, solve_ms: str, method: str) -> DataFrame:
    """Per key rows, reachable ones and their share, fallbacks, collisions, mean residual (nulls and NaN left out), mean time of rows that were solved or reached, and rows by method."""
    n = F.count("*")
    sums = df.groupBy(*keys).agg(
        n.alias("frames"), F.count_if(reachable).alias("n_reachable"), share(F.count_if(reachable), n, 100.0).alias("pct_reachable"), F.count_if(fallback).alias("n_fallback"), F.count_if(collision).alias("n_collision"),
        F.avg(F.nanvl(F.col(residual).cast("double"), F.lit(None).cast("double"))).alias("mean_residual"), F.avg(F.when(~F.col(fallback) | F.col(reachable), F.col(solve_ms))).alias("mean_solve_ms"),
    )
    by = df.filter(F.col(method).isNotNull()).groupBy(*keys, method).agg(F.count("*").alias("_n"))
    return sums.join(by.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(method, "_n")))).alias("methods")), list(keys), "left")


def episode_summary(df: DataFrame, keys: Keys) -> DataFrame:
    """Counts and shares of contact, loss and grasps."""
    n = F.count("*")
    grasps = [F.count_if(F.col("grasp") == g).alias(f"n_{g}") for g in ("precision_pinch", "power_wrap", "hook", "open", "unknown")]
    return df.groupBy(*keys).agg(n.alias("frames"), F.count_if("in_contact").alias("contact_frames"), share(F.count_if("in_contact"), n).alias("contact_ratio"), share(F.count_if(~F.col("present")), n, 100.0).alias("loss_pct"), *grasps)


def dwell_counts(df: DataFrame, keys: Keys, contact: str, name: str, least: int = 3) -> DataFrame:
    """Frames in contact per object, and whether they are enough to be eligible."""
    return df.filter(F.col(contact) & F.col(name).isNotNull()).groupBy(*keys, name).agg(F.count("*").alias("dwell")).withColumn("eligible", F.col("dwell") >= least)


def dedupe_preferring(df: DataFrame, keys: Keys, preferred: Column, order: str) -> DataFrame:
    """One row per key: the first preferred one, else the first."""
    cols = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*cols), F.struct(F.when(preferred, 0).otherwise(1), order)).alias("_m"))
    return best.select(*keys, "_m.*")


def hardware_audit(df: DataFrame, keys: Keys, order: str, value: str, residual_mm: str, collision: Column, limit_hit: Column, velocity: float, fps: float = 30.0) -> DataFrame:
    """Compliance, jerk, teleports, a score of 0 to 100 and a verdict per key."""
    w = ordered(keys, order)
    n = F.row_number().over(w)
    df = df.withColumn("_v", (F.col(value) - F.lag(value).over(w)) * fps)
    df = df.withColumn("_a", (F.col("_v") - F.lag("_v").over(w)) * fps)
    df = df.withColumns({"_j": (F.col("_a") - F.lag("_a").over(w)) * fps, "_n": n})
    ok = lambda c, most: F.coalesce(100 * F.count_if(F.abs(c) <= most) / F.nullif(F.count(c), F.lit(0)), F.lit(100.0))
    agg = df.groupBy(*keys).agg(
        F.count("*").alias("frames"), F.coalesce(F.max(F.abs("_v")), F.lit(0.0)).alias("max_velocity"), ok(F.col("_v"), 1.02 * velocity).alias("velocity_pct"), F.coalesce(F.max(F.abs("_a")), F.lit(0.0)).alias("max_acceleration"),
        ok(F.col("_a"), 1.05 * 8 * velocity).alias("acceleration_pct"), F.coalesce(F.sqrt(F.avg(F.col("_j") * F.col("_j"))), F.lit(0.0)).alias("rms_jerk"), F.count_if(F.abs("_v") > 1.25 * velocity).alias("teleports"),
        F.avg(residual_mm).alias("mean_residual"), F.percentile(residual_mm, F.lit(0.95)).alias("p95_residual"), F.count_if(collision).alias("collisions"), F.count_if(limit_hit).alias("limit_events"),
    )
    lost = (
        F.greatest(F.lit(0.0), (F.col("mean_residual") - 15) * 0.35) + (100 - F.col("velocity_pct")) * 1.5 + (100 - F.col("acceleration_pct")) * 0.8
        + F.least(F.lit(25.0), F.col("collisions") * 0.5) + F.least(F.lit(20.0), F.col("limit_events") * 0.2) + F.least(F.lit(30.0), F.col("teleports") * 5.0)
    )
    agg = agg.withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100 - lost)))
    verdict = F.when((F.col("score") >= 88) & (F.col("teleports") == 0) & (F.col("collisions") == 0), "production").when((F.col("score") >= 75) & (F.col("teleports") == 0), "low_gain").otherwise("needs_filtering")
    return agg.withColumn("verdict", verdict)


def all_passed(checks: DataFrame, keys: Keys) -> DataFrame:
    """passed: there are checks and all hold."""
    return checks.groupBy(*keys).agg(F.count("*").alias("checks"), F.coalesce(F.every("passed"), F.lit(False)).alias("passed"))


def exit_codes(stages: DataFrame, keys: Keys, status: str = "status", allow_partial: bool = False) -> DataFrame:
    """0 if all stages went well, 2 if one is degraded, 1 if one failed; 2 for that too where parts are allowed."""
    rank = F.when(F.col(status) == "failed", 2).when(F.col(status) == "degraded", 1).otherwise(0)
    return stages.groupBy(*keys).agg(F.element_at(F.array(F.lit(0), F.lit(2), F.lit(2 if allow_partial else 1)), F.max(rank) + 1).alias("exit_code"))


def jitter(df: DataFrame, keys: Keys, order: str, before: str, after: str) -> DataFrame:
    """Mean and largest step before and after smoothing, and the reduction in percent."""
    w = ordered(keys, order)
    df = df.withColumns({"_b": F.abs(F.col(before) - F.lag(before).over(w)), "_a": F.abs(F.col(after) - F.lag(after).over(w))})
    return df.groupBy(*keys).agg(F.avg("_b").alias("mean_before"), F.avg("_a").alias("mean_after"), F.max("_b").alias("max_before"), F.max("_a").alias("max_after")).withColumn("reduction_pct", share(100 * (F.col("mean_before") - F.col("mean_after")), F.col("mean_before")))


def driving_hand(df: DataFrame, keys: Keys, left: Column, right: Column) -> DataFrame:
    """The hand that is tracked in more rows; right on a tie, none without any."""
    counts = df.groupBy(*keys).agg(F.count_if(left).alias("n_left"), F.count_if(right).alias("n_right"))
    return counts.withColumn("hand", F.when((F.col("n_left") == 0) & (F.col("n_right") == 0), "none").when(F.col("n_left") > F.col("n_right"), "left").otherwise("right"))


def histogram(df: DataFrame, keys: Keys, value: str) -> DataFrame:
    return df.groupBy(*keys, value).agg(F.count("*").alias("n"))


def trend_check(df: DataFrame, keys: Keys, order: str, value: str, n: int = 10, most: float = 0.9) -> DataFrame:
    """improved: the mean of the last n rows is under `most` times that of the first n."""
    w = ordered(keys, order)
    df = df.withColumns({"_i": F.row_number().over(w), "_m": F.count(F.lit(1)).over(whole(w))})
    first, last = F.avg(F.when(F.col("_i") <= n, F.col(value))), F.avg(F.when(F.col("_i") > F.col("_m") - n, F.col(value)))
    return df.groupBy(*keys).agg(first.alias("first_mean"), last.alias("last_mean"), (last < most * first).alias("improved"))
