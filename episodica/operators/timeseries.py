"""Ordered time-series operators: gap fill, hysteresis, votes, smoothing, gates, derivatives.

Each is a DataFrame transformation in window functions; operators whose state feeds
back into later rows pass over an episode in Arrow batches and carry the few numbers of
their state from one to the next (`carry`), so an episode may have any length.
Thresholds default to the values the engine's users have today.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .windows import after, before, between, bfill, ffill, island, neighbours, ordered, whole

Keys = Sequence[str]


def placed(df: DataFrame, keys: Keys, order: str) -> DataFrame:
    """Adds _place (from 1) and _left (down to 1) of every row of a key; what `carry` needs."""
    w = ordered(keys, order)
    return df.withColumns({"_place": F.row_number().over(w), "_left": F.count(F.lit(1)).over(whole(w))}).withColumn("_left", F.col("_left") - F.col("_place") + 1)


def carry(df: DataFrame, keys: Keys, step: Callable[[object, pd.DataFrame], tuple[dict[str, np.ndarray], object]], out: dict[str, T.DataType], backward: bool = False) -> DataFrame:
    """Adds columns that one pass over every key's rows makes, from the first to the last or `backward`.

    df: of `placed`, whose windows bring a key's rows into one task; here they are only
    sorted there.  step: the state after the rows before (None at the start) and some
    rows of one key to new columns and the next state.  A key's rows come in batches,
    so what a task holds doesn't grow with them.
    """
    schema = T.StructType([*(f for f in df.schema.fields if f.name not in out), *(T.StructField(n, t) for n, t in out.items())])
    kept, start = [n for n in schema.names if n not in out], "_left" if backward else "_place"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            pdf, parts = batch.to_pandas(), []
            first = (pdf[start] == 1).to_numpy()
            cuts = sorted({0, *np.flatnonzero(first).tolist(), len(pdf)})
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                made, state = step(None if first[lo] else state, pdf.iloc[lo:hi])
                parts.append(made)
            if parts:
                new = [pa.array(np.concatenate([m[n] for m in parts]), from_pandas=True) for n in out]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in kept), *new], schema.names)

    return df.sortWithinPartitions(*keys, F.desc("_place") if backward else "_place").mapInArrow(run, schema)


def hysteresis(df: DataFrame, evidence: str, keys: Keys, order: str, n: int = 3, out: str = "state") -> DataFrame:
    """On after `n` rows of evidence, off after `n` rows without; off at first."""
    w = ordered(keys, order)
    last = w.rowsBetween(-(n - 1), 0)
    yes = F.sum(F.coalesce(F.col(evidence), F.lit(False)).cast("int")).over(last)
    full = F.count(F.lit(1)).over(last) == n
    df = df.withColumn("_flip", F.when(full & (yes == n), True).when(full & (yes == 0), False))
    return df.withColumn(out, F.coalesce(ffill(F.col("_flip"), w), F.lit(False))).drop("_flip")


def dilate(df: DataFrame, flag: str, keys: Keys, order: str, reach: int = 10, out: str = "active") -> DataFrame:
    """True within `reach` rows of a true flag."""
    return df.withColumn(out, F.max(flag).over(ordered(keys, order).rowsBetween(-reach, reach)))


def interpolate_gaps(df: DataFrame, value: str, keys: Keys, order: str, max_gap: int | None = 5, out: str = "filled") -> DataFrame:
    """Linear fill of inner null runs of at most `max_gap` rows (any length if None), flagged; edges stay null."""
    w = ordered(keys, order)
    df = neighbours(df, value, order, w)
    fits = (F.col("_ni") - F.col("_pi") - 1 <= max_gap) if max_gap is not None else F.lit(True)
    inner = F.col(value).isNull() & F.col("_pi").isNotNull() & F.col("_ni").isNotNull() & fits
    lerp = F.col("_pv") + (F.col("_nv") - F.col("_pv")) * between(F.col(order))
    return df.withColumns({out: F.when(inner, lerp).otherwise(F.col(value)), "interpolated": inner}).drop("_pi", "_pv", "_ni", "_nv")


def fill_both_ways(df: DataFrame, value: str, keys: Keys, order: str, out: str = "filled") -> DataFrame:
    """Head from the first known value, tail from the last, linear inside."""
    df = neighbours(df, value, order, ordered(keys, order))
    lerp = F.col("_pv") + (F.col("_nv") - F.col("_pv")) * F.coalesce(between(F.col(order)), F.lit(0.0))
    return df.withColumn(out, F.coalesce(lerp, "_pv", "_nv")).drop("_pi", "_pv", "_ni", "_nv")


def _there_and_back(df: DataFrame, keys: Keys, name: str, alpha: float, passes: int) -> DataFrame:
    """Exponential averages of a column in its place, from the first row to the last and back to the first, `passes` times. df: of `placed`."""

    def step(last: float | None, pdf: pd.DataFrame) -> tuple[dict[str, np.ndarray], float]:
        run = pdf[name].to_numpy(float).copy()
        for i, value in enumerate(run):
            run[i] = last = value if last is None else alpha * value + (1 - alpha) * last
        return {name: run}, last

    for turn in range(2 * passes):
        df = carry(df, keys, step, {name: T.DoubleType()}, backward=turn % 2 == 1)
    return df


def zero_phase_ema(df: DataFrame, value: str, keys: Keys, order: str, alpha: float = 0.35, passes: int = 2, out: str = "smooth") -> DataFrame:
    """`passes` exponential averages, each forward and backward. No nulls are expected."""
    df = placed(df, keys, order).withColumn(out, F.col(value).cast("double"))
    return _there_and_back(df, keys, out, alpha, passes).drop("_place", "_left")


def trailing_mean(df: DataFrame, value: Column, keys: Keys, order: str, n: int = 3, out: str = "mean") -> DataFrame:
    return df.withColumn(out, F.avg(value).over(ordered(keys, order).rowsBetween(-(n - 1), 0)))


def majority_vote(df: DataFrame, label: str, present: str, keys: Keys, order: str, reach: int = 2, unknown: str = "unknown") -> DataFrame:
    """Adds voted, inherited: the most frequent known label within `reach` rows of the same present run, first seen on ties; else the next, else the previous known label of the run."""
    w = ordered(keys, order)
    df = island(df, F.col(present), w, "_run").withColumn("_known", F.when(F.col(present) & (F.col(label) != unknown), F.col(label)))
    v = ordered([*keys, "_run"], order)
    near = F.collect_list("_known").over(v.rowsBetween(-reach, reach))
    df = df.withColumn("_near", near)
    best = F.aggregate(
        F.array_distinct("_near"),
        F.struct(F.lit(None).cast("string").alias("label"), F.lit(0).alias("n")),
        lambda acc, x: F.when(F.size(F.filter("_near", lambda y: y == x)) > acc["n"], F.struct(x.alias("label"), F.size(F.filter("_near", lambda y: y == x)).alias("n"))).otherwise(acc),
    )
    df = df.withColumn("_vote", best["label"])
    heir = F.coalesce(F.first("_known", ignorenulls=True).over(after(v)), F.last("_known", ignorenulls=True).over(before(v)))
    df = df.withColumn("_heir", heir)
    return df.withColumns({"voted": F.when(F.col(present), F.coalesce("_vote", "_heir")), "inherited": F.col(present) & F.col("_vote").isNull() & F.col("_heir").isNotNull()}).drop("_run", "_known", "_near", "_vote", "_heir")


def ema_with_reset(df: DataFrame, value: str, valid: str, keys: Keys, order: str, rest: float, alpha: float = 0.3, out: str = "ema") -> DataFrame:
    """y = (1 - alpha) x + alpha y'; rows that aren't valid give `rest` and start anew from it; values stay in 0 to rest."""

    def step(last: float | None, pdf: pd.DataFrame) -> tuple[dict[str, np.ndarray], float]:
        y = np.empty(len(pdf))
        for i, (x, ok) in enumerate(zip(pdf[value].to_numpy(float), pdf[valid].to_numpy(bool), strict=True)):
            y[i] = last = rest if not ok else min(max(x if last is None else (1 - alpha) * x + alpha * last, 0.0), rest)
        return {out: y}, last

    return carry(placed(df, keys, order), keys, step, {out: T.DoubleType()}).drop("_place", "_left")


def leaky_sum(df: DataFrame, value: str, keys: Keys, order: str, leak: float = 0.96, out: str = "leaky") -> DataFrame:
    """s = leak s' + d; null rows hold."""

    def step(total: float | None, pdf: pd.DataFrame) -> tuple[dict[str, np.ndarray], float]:
        y, total = np.empty(len(pdf)), total or 0.0
        for i, d in enumerate(pdf[value].to_numpy(float)):
            y[i] = total = total if np.isnan(d) else leak * total + d
        return {out: y}, total

    return carry(placed(df, keys, order), keys, step, {out: T.DoubleType()}).drop("_place", "_left")


def velocity_gate(df: DataFrame, value: str, ok: str, keys: Keys, order: str, limit: float, dt: float = 1 / 30, out: str = "reachable") -> DataFrame:
    """A reachable row whose step from a row that is still reachable is too fast becomes unreachable: in a run of such rows every other one."""
    w = ordered(keys, order)
    fast = F.abs(F.col(value) - F.lag(value).over(w)) / dt > 0.9 * limit
    df = df.withColumn("_bad", F.coalesce(F.col(ok) & F.lag(ok).over(w) & fast, F.lit(False)))
    df = island(df, F.col("_bad"), w, "_run")
    place = F.row_number().over(ordered([*keys, "_run"], order))
    return df.withColumn(out, F.col(ok) & ~(F.col("_bad") & (place % 2 == 1))).drop("_bad", "_run")


def source_gate(df: DataFrame, value: str, interpolated: str, ok: str, keys: Keys, order: str, out: str = "held") -> DataFrame:
    """Interpolated rows become unreachable and hold the last value of a row that isn't; the first row keeps its own."""
    w = ordered(keys, order)
    own = F.when(~F.col(interpolated) | (F.row_number().over(w) == 1), F.col(value))
    df = df.withColumn("_own", own)
    return df.withColumns({out: ffill(F.col("_own"), w), "reachable": F.col(ok) & ~F.col(interpolated)}).drop("_own")


def hold_last_valid(df: DataFrame, value: str, valid: str, keys: Keys, order: str, start: float = 0.0, out: str = "held") -> DataFrame:
    return df.withColumn(out, F.coalesce(ffill(F.when(F.col(valid), F.col(value)), ordered(keys, order)), F.lit(start)))


def path_length(df: DataFrame, xyz: Sequence[str], tracked: str, keys: Keys, order: str, scale: float = 1.0, cap: float = 0.15, out: str = "path_length") -> DataFrame:
    """Per key the sum of steps below `cap` between neighbouring tracked rows."""
    w = ordered(keys, order)
    step = F.sqrt(sum((F.col(c) - F.lag(c).over(w)) ** 2 for c in xyz)) * scale
    df = df.withColumn("_step", F.when(F.col(tracked) & F.lag(tracked).over(w), step))
    return df.groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col("_step") < cap, F.col("_step"))), F.lit(0.0)).alias(out), F.count(F.when(F.col("_step") >= cap, 1)).alias("jumps"))


def derivatives(df: DataFrame, value: str, keys: Keys, order: str, dt: float = 1 / 30) -> DataFrame:
    """Adds vel, acc, jerk: successive differences by dt, zero before there are enough rows."""
    w = ordered(keys, order)
    df = df.withColumn("_n", F.row_number().over(w))
    for k, (name, of) in enumerate((("vel", value), ("acc", "vel"), ("jerk", "acc")), 1):
        df = df.withColumn(name, F.when(F.col("_n") > k, (F.col(of) - F.lag(of).over(w)) / dt).otherwise(0.0))
    return df.drop("_n")


def action_chunks(df: DataFrame, value: str, keys: Keys, order: str, horizon: int = 16) -> DataFrame:
    """One row per step ahead: h from 0, and the value at h rows ahead; the episode's last value where it ends."""
    w = ordered(keys, order)
    ahead = F.collect_list(value).over(w.rowsBetween(0, horizon - 1))
    df = df.withColumn("_ahead", ahead).withColumn("_last", F.last(value).over(whole(w)))
    padded = F.concat("_ahead", F.array_repeat("_last", F.lit(horizon) - F.size("_ahead")))
    return df.select(*keys, order, F.posexplode(padded).alias("h", "action"))


def lead_target(df: DataFrame, value: str, keys: Keys, order: str, out: str = "action") -> DataFrame:
    return df.withColumn(out, F.coalesce(F.lead(value).over(ordered(keys, order)), F.col(value)))


def savgol_matrix(window: int = 9, degree: int = 2) -> np.ndarray:
    """Rows: for each place in the window, the weights of the fitted polynomial's value there."""
    x = np.arange(window) - window // 2
    a = np.vander(x, degree + 1, increasing=True).astype(float)
    return a @ np.linalg.pinv(a)


def _local_fits(df: DataFrame, values: Sequence[str], block: Keys, order: str, windows: Sequence[int], degree: int, out: Sequence[str], least: int) -> DataFrame:
    """Fits every row's value within its block by the largest of `windows` that the block holds; blocks under `least` rows or any window keep their values.

    A row's window never reaches further than the window less one to either side, so
    the rows around it are read by one window, whatever the block's length.
    """
    w, reach = ordered(block, order), max(windows) - 1
    near = {f"_near{k}_{o + reach}": F.lag(v, -o).over(w) if o < 0 else F.lead(v, o).over(w) for k, v in enumerate(values) for o in range(-reach, reach + 1)}
    # one row of weights over all rows around for every window and place in it
    rows, first = [], {}
    for window in sorted(windows, reverse=True):
        first[window] = len(rows) + 1
        for p, m in enumerate(savgol_matrix(window, degree)):
            rows.append([float(m[o + p]) if 0 <= o + p < window else 0.0 for o in range(-reach, reach + 1)])
    df = df.withColumns({"_i": F.row_number().over(w), "_n": F.count(F.lit(1)).over(whole(w)), **near})
    i, n = F.col("_i"), F.col("_n").cast("int")
    at = F.when(n < least, 0)
    for window, row in first.items():
        half = window // 2
        at = at.when(n >= window, F.when(i <= half, row + i - 1).when(n - i < half, row + window - 1 - n + i).otherwise(row + half))
    df = df.withColumn("_at", at.otherwise(0)).withColumn("_weights", F.element_at(F.array(*(F.array(*map(F.lit, r)) for r in rows)), F.greatest("_at", F.lit(1))))
    weight = [F.element_at("_weights", o + 1) for o in range(2 * reach + 1)]
    for k, (v, name) in enumerate(zip(values, out, strict=True)):
        fit = sum((F.when(x == 0, 0.0).otherwise(x * F.col(f"_near{k}_{o}")) for o, x in enumerate(weight)), F.lit(0.0))
        df = df.withColumn(name, F.when(F.col("_at") == 0, F.col(v)).otherwise(fit))
    return df.drop("_i", "_n", "_at", "_weights", *near)


def savgol(df: DataFrame, value: str, keys: Keys, order: str, window: int = 9, degree: int = 2, out: str = "smooth") -> DataFrame:
    """Least-squares polynomial smoothing; the edges use the first and the last full window. Shorter episodes stay as they are."""
    return _local_fits(df, [value], keys, order, [window], degree, [out], window)


def savgol_runs(df: DataFrame, values: Sequence[str], valid: Column, keys: Keys, order: str, window: int = 9, degree: int = 2, least: int = 3, out: Sequence[str] | None = None) -> DataFrame:
    """`savgol` of several columns within every run of valid rows; a shorter run has the largest odd window that fits. Rows that aren't valid (false or null), runs under `least` rows and those that a window of more than `degree` + 1 rows doesn't fit keep their values."""
    df = df.withColumn("_ok", F.coalesce(valid, F.lit(False)))
    df = island(df, F.col("_ok"), ordered(keys, order), "_block")
    names = [f"_fit{k}" for k in range(len(values))]
    df = _local_fits(df, values, [*keys, "_block"], order, range(window, degree + 1, -2), degree, names, least)
    chosen = {o: F.when(F.col("_ok"), F.col(n)).otherwise(F.col(v)) for o, n, v in zip(out or values, names, values, strict=True)}
    return df.withColumns(chosen).drop("_ok", "_block", *names)


def savgol_blocks(df: DataFrame, value: str, valid: str, keys: Keys, order: str, window: int = 9, degree: int = 2, out: str = "smooth") -> DataFrame:
    return savgol_runs(df, [value], F.col(valid), keys, order, window, degree, out=[out])


def mean_edge_padded(df: DataFrame, value: str, keys: Keys, order: str, reach: int = 2, out: str = "mean") -> DataFrame:
    """Mean over `reach` rows to both sides; beyond an end its value counts again."""
    w = ordered(keys, order)
    i, n = F.row_number().over(w), F.count(F.lit(1)).over(whole(w))
    left, right = F.greatest(F.lit(0), reach - i + 1), F.greatest(F.lit(0), i + reach - n)
    total = F.sum(value).over(w.rowsBetween(-reach, reach)) + left * F.first(value).over(whole(w)) + right * F.last(value).over(whole(w))
    return df.withColumn(out, total / (2 * reach + 1))


def ends(df: DataFrame, keys: Keys, order: str) -> DataFrame:
    """Adds is_first, is_last, is_terminal."""
    w = ordered(keys, order)
    last = F.row_number().over(w) == F.count(F.lit(1)).over(whole(w))
    return df.withColumns({"is_first": F.row_number().over(w) == 1, "is_last": last, "is_terminal": last})


def attach_and_rest(df: DataFrame, value: str, grasped: str, keys: Keys, order: str, start: float = 0.0, out: str = "object") -> DataFrame:
    """The value while grasped, and the last such value after."""
    return hold_last_valid(df, value, grasped, keys, order, start, out)


def min_jerk_bridge(df: DataFrame, value: str, keys: Keys, order: str, max_bridge: int = 45, home: float = 0.0, out: str = "bridged") -> DataFrame:
    """Bridges null runs with a quintic ease: head and tail hold; a run longer than `max_bridge` holds first and ramps in its last rows."""
    df = neighbours(df, value, order, ordered(keys, order))
    gap = F.col("_ni") - F.col("_pi") - 1
    ramp = F.least(F.lit(max_bridge), gap)
    tau = F.greatest(F.lit(0.0), (F.col(order) - (F.col("_ni") - ramp) + 1) / (ramp + 1))
    s = tau * tau * tau * (10 + tau * (-15 + 6 * tau))
    eased = F.when(gap < 0, F.col("_pv")).otherwise((1 - s) * F.col("_pv") + s * F.col("_nv"))
    return df.withColumn(out, F.coalesce(F.col(value), F.when(F.col("_pi").isNotNull() & F.col("_ni").isNotNull(), eased), "_pv", "_nv", F.lit(home))).drop("_pi", "_pv", "_ni", "_nv")


def keyframe_lerp(df: DataFrame, value: str, keyframe: str, keys: Keys, order: str, out: str = "lerped") -> DataFrame:
    """Between keyframes linear, beyond them held."""
    df = neighbours(df, value, order, ordered(keys, order), F.col(keyframe) & F.col(value).isNotNull())
    lerp = F.col("_pv") + (F.col("_nv") - F.col("_pv")) * F.coalesce(between(F.col(order)), F.lit(0.0))
    return df.withColumn(out, F.coalesce(lerp, "_pv", "_nv")).drop("_pi", "_pv", "_ni", "_nv")


def keyframes(df: DataFrame, value: str, keys: Keys, order: str, every: int = 15, jump: float = 12.0) -> DataFrame:
    """Rows that are first, every n-th, last, or differ from the row before by more than `jump`."""
    w = ordered(keys, order)
    i, n = F.row_number().over(w) - 1, F.count(F.lit(1)).over(whole(w))
    keep = (i % every == 0) | (i == n - 1) | F.coalesce(F.abs(F.col(value) - F.lag(value).over(w)) > jump, F.lit(False))
    return df.withColumn("_keep", keep).filter("_keep").drop("_keep")


def sanitize(df: DataFrame, value: str, ok: str, keys: Keys, order: str, low: float, high: float, velocity: float, dt: float = 1 / 30, tolerance: float = 1e-3) -> DataFrame:
    """Adds q, reachable, reason.

    Rows that aren't `ok` (input) or lie beyond a limit (joint_limit) hold the q before
    them; at the start that is their own value, or 0 beyond a limit.  Others come as near
    to their value as nine tenths of the velocity allow from the q before; where that
    isn't all the way, the reason is joint_velocity.
    """
    most = 0.9 * velocity * dt

    def step(last: float | None, pdf: pd.DataFrame) -> tuple[dict[str, np.ndarray], float]:
        x, good = pdf[value].to_numpy(float), pdf[ok].to_numpy(bool)
        beyond = (x < low - tolerance) | (x > high + tolerance)
        stays = ~good | beyond
        q, late = np.where(good & beyond, 0.0, x), ~stays & np.isnan(x)
        for i in range(len(q)):
            if last is not None:
                way = x[i] - last  # compared itself: last + most may miss a value that is just so far
                late[i] = not (stays[i] or abs(way) <= most)
                q[i] = last if stays[i] else last + np.sign(way) * most if late[i] else x[i]
            last = q[i]
        return {"q": q, "reachable": ~(stays | late), "reason": np.select([~good, beyond, late], ["input", "joint_limit", "joint_velocity"], "ok").astype(object)}, last

    return carry(placed(df, keys, order), keys, step, {"q": T.DoubleType(), "reachable": T.BooleanType(), "reason": T.StringType()}).drop("_place", "_left")


def debounced_switch(df: DataFrame, value: str, keys: Keys, order: str, start: float = 0.08, threshold: float = 0.03, min_rows: int = 5, out: str = "switched") -> DataFrame:
    """Follows the value on its side of the threshold; changes sides only after `min_rows` rows there."""

    def step(side: tuple[float, int] | None, pdf: pd.DataFrame) -> tuple[dict[str, np.ndarray], tuple[float, int]]:
        y, (state, held) = np.empty(len(pdf)), side or (start, 0)
        for i, x in enumerate(pdf[value].to_numpy(float)):
            if (x < threshold) == (state < threshold):
                state, held = x, held + 1
            elif held >= min_rows:
                state, held = x, 0
            else:
                held += 1
            y[i] = state
        return {out: y}, (state, held)

    return carry(placed(df, keys, order), keys, step, {out: T.DoubleType()}).drop("_place", "_left")


#: Shares of the velocity that a limited trajectory may use, and its acceleration as a multiple of that; fixed values.
VELOCITY_SHARE, ACCELERATION_SCALE = 0.85, 5.0


def rate_limit(df: DataFrame, value: str, keys: Keys, order: str, low: float, high: float, velocity: float, dt: float = 1 / 30, acc_scale: float = ACCELERATION_SCALE, alpha: float = 0.45, passes: int = 3) -> DataFrame:
    """Adds smooth (zero-phase averages of the value within its limits) and limited.

    `limited` follows `smooth` by a velocity for each row: the one that would reach it,
    brought into three intervals, of which a later one wins where they don't meet: what
    the velocity and acceleration limits allow, what keeps the position within low and
    high, and, from the third row on, what the acceleration limit allows by itself.
    """
    v_most = VELOCITY_SHARE * velocity
    change = v_most * acc_scale * dt

    def step(moving: tuple[float, float, int] | None, pdf: pd.DataFrame) -> tuple[dict[str, np.ndarray], tuple[float, float, int]]:
        smooth = pdf["smooth"].to_numpy(float)
        at, (here, v, done) = smooth.copy(), moving or (0.0, 0.0, 0)
        for i in range(len(at)):
            if done:
                near = (v - change, v + change)
                intervals = [(max(-v_most, near[0]), min(v_most, near[1])), ((low - here) / dt, (high - here) / dt), near]
                v = (smooth[i] - here) / dt
                for least, most in intervals if done > 1 else intervals[:2]:
                    v = min(max(v, least), most)
                at[i] = here + v * dt
            here, done = at[i], min(done + 1, 2)
        return {"limited": at}, (here, v, done)

    df = placed(df, keys, order).withColumn("smooth", F.least(F.greatest(F.col(value).cast("double"), F.lit(float(low))), F.lit(float(high))))
    return carry(_there_and_back(df, keys, "smooth", alpha, passes), keys, step, {"limited": T.DoubleType()}).drop("_place", "_left")


def bfill_value(df: DataFrame, value: str, keys: Keys, order: str, out: str = "filled") -> DataFrame:
    return df.withColumn(out, bfill(F.col(value), ordered(keys, order)))
