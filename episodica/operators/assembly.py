"""Dataset assembly: union and renumbering, encoding, chunk packing, look-up rows, gates and validators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as g
from .timeseries import carry, placed
from .windows import ordered

Keys = Sequence[str]


def first_seen_codes(df: DataFrame, value: str, order: str, out: str = "code") -> DataFrame:
    """Codes 0, 1, ... for values by first appearance, of equals by value. Values may be many: they are numbered by ranges of their first appearance."""
    firsts = df.groupBy(value).agg(F.min(order).alias("first_seen")).withColumn("_one", F.lit(1))
    return running_offsets(firsts, "first_seen", "_one", ties=[value]).select(value, "first_seen", F.col("episode_index").cast("int").alias(out))


#: Rows of a range of `running_offsets`, and the most ranges (rows of a broadcast).
RANGE, MOST_RANGES = 10_000, 4_096


def ranges_of(df: DataFrame, order: str, ranges: int) -> Callable[[Column], Column]:
    """A column that says which of about `ranges` ranges of a numeric column, with about as many rows each, a value lies in; ranges ascend."""
    bounds = np.unique(np.array(df.approxQuantile(order, [k / ranges for k in range(1, ranges)], 1 / (4 * ranges)), float)) if ranges > 1 else np.zeros(0)

    @F.pandas_udf("int")
    def place(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, x.to_numpy(float), "right").astype(np.int32))

    return place if len(bounds) else (lambda _: F.lit(0))


def running_offsets(episodes: DataFrame, order: str, length: str = "length", buckets: int | None = None, ties: Sequence[str] = ()) -> DataFrame:
    """Adds episode_index and the global index range from_index, to_index of every episode.

    A prefix sum without one window over everything: episodes are cut into ranges of
    `order` with about `RANGE` episodes each, whatever its values; sums of ranges are
    prefixed first, then each range runs its own window. `order` is numeric; equal ones
    are in order of `ties`.
    """
    n = episodes.count()
    cut = episodes.withColumn("_b", ranges_of(episodes, order, buckets or max(1, min(MOST_RANGES, n // RANGE)))(F.col(order)))
    sums = cut.groupBy("_b").agg(F.count("*").alias("_n"), F.sum(length).alias("_s"))
    w = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("_b", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_s").over(w), F.lit(0)).alias("_s0"))
    v = Window.partitionBy("_b").orderBy(order, *ties)
    done = cut.join(F.broadcast(base), "_b")  # a row per range
    upto = F.sum(length).over(v.rowsBetween(Window.unboundedPreceding, 0)) + F.col("_s0")
    return done.withColumns({"episode_index": F.row_number().over(v) - 1 + F.col("_n0"), "to_index": upto, "from_index": upto - F.col(length)}).drop("_b", "_n0", "_s0")


def renumber(frames: DataFrame, offsets: DataFrame, key: str, order: str) -> DataFrame:
    """Adds episode_index and a contiguous global index to frames; one shuffle by episode."""
    w = Window.partitionBy(key).orderBy(order)
    return frames.join(offsets.select(key, "episode_index", "from_index"), key).withColumn("index", F.col("from_index") + F.row_number().over(w) - 1).drop("from_index")


def pack_chunks(episodes: DataFrame, order: str, length: str = "length", size: int = 1000, group: Sequence[str] = ()) -> DataFrame:
    """Greedy packing in order: a chunk takes episodes while they fit; a longer episode gets chunks of its own.

    Each episode gets its first chunk (chunk_index) and how many it takes (chunks).
    Where a chunk ends depends on all before it, so each `group` (a source or a data
    set) is one pass, over its lengths alone and with two numbers carried along.
    """

    def step(state: tuple[int, int] | None, pdf: pd.DataFrame) -> tuple[dict[str, np.ndarray], tuple[int, int]]:
        at, parts, (chunk, filled) = np.empty(len(pdf), np.int64), np.ones(len(pdf), np.int64), state or (0, 0)
        for i, n in enumerate(pdf[length].to_numpy(np.int64).tolist()):
            chunk += filled > 0 and filled + n > size
            at[i] = chunk
            if n > size:
                parts[i] = -(-n // size)
                chunk, filled = chunk + int(parts[i]), 0
            else:
                filled = n if filled + n > size else filled + n
        return {"chunk_index": at, "chunks": parts}, (chunk, filled)

    df = placed(episodes.select(*group, order, F.col(length).cast("long").alias(length)), group, order)
    return carry(df, group, step, {"chunk_index": T.LongType(), "chunks": T.LongType()}).select(*group, order, "chunk_index", "chunks")


def gate(episodes: DataFrame, columns: Keys, warned: Keys = ()) -> DataFrame:
    """One row per column: check, n_values, ok, and level: more than one value of `columns` is an error, of `warned` a warning. A null is a value."""
    names = [*columns, *warned]
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0"))
    counts = episodes.agg(*(F.count_distinct(value(c)).alias(c) for c in names)).unpivot([], names, "check", "n_values")
    bad = F.when(F.col("check").isin(*columns), "error").otherwise("warning")
    return counts.withColumns({"ok": F.col("n_values") <= 1, "level": F.when(F.col("n_values") <= 1, "ok").otherwise(bad)})


def require(checks: DataFrame) -> list[str]:
    """Refuses checks of `gate` with errors by a ValueError that names them; else the names of those with warnings. A row per column comes to the driver."""
    rows = checks.filter("level <> 'ok'").collect()
    if wrong := sorted(r["check"] for r in rows if r["level"] == "error"):
        raise ValueError(f"more than one value of {', '.join(wrong)}")
    return sorted(r["check"] for r in rows)


def human_rows(df: DataFrame, keys: Keys, order: str, present: str = "present") -> DataFrame:
    """Adds s0 to s23 and a0 to a23 to frames with points x0, y0, z0 to x20, y20, z20.

    State: the wrist in half units, the palm's turn in six numbers, openness, the first
    14 bends. Action: the wrist's move since the frame before (tenfold, within -1 to 1;
    0 unless both have a hand), the change of the six numbers (0 at first), all 15 bends.
    A frame without a hand has wrist and bends 0, the identity turn and openness 1.
    """
    w, here = ordered(keys, order), F.col(present)
    kept = df.columns
    df = df.withColumns(dict(zip(("_nx", "_ny", "_nz"), g.palm_normal(), strict=True)))
    state = [*(c * 0.5 for c in g.p(0)), *g.rot6d([F.col(c) for c in ("_nx", "_ny", "_nz")]), g.openness(), *g.hand_pose()]
    rest = [0, 0, 0, 1, 0, 0, 0, 1, 0, 1] + [0] * 15
    df = df.withColumns({f"_s{k}": F.when(here, c).otherwise(float(r)) for k, (c, r) in enumerate(zip(state, rest, strict=True))})
    both = here & F.lag(here).over(w)
    move = [F.when(both, g.clip((F.col(f"{a}0") - F.lag(f"{a}0").over(w)) * 10, -1, 1)).otherwise(0.0) for a in "xyz"]
    turn = [F.coalesce(F.col(f"_s{k}") - F.lag(f"_s{k}").over(w), F.lit(0.0)) for k in range(3, 9)]
    action = [*move, *turn, *(F.col(f"_s{k}") for k in range(10, 25))]
    return df.select(*kept, *(F.col(f"_s{k}").alias(f"s{k}") for k in range(24)), *(c.alias(f"a{k}") for k, c in enumerate(action)))


def validate_frames(frames: DataFrame, fps: float = 30.0, slack: float = 1e-3) -> DataFrame:
    """Checks on an assembled frame table (episode_index, frame_index, index, timestamp): check, bad, ok."""
    total = frames.agg(
        F.count("*").alias("rows"), F.count_if(F.abs(F.col("timestamp") - F.col("frame_index") / fps) > slack).alias("timestamp"),
        (F.count("*") - F.count_distinct("index")).alias("index_unique"), (F.max("index") - F.min("index") + 1 - F.count_distinct("index")).alias("index_contiguous"), F.min("index").alias("index_start"),
    )
    per = frames.groupBy("episode_index").agg(F.count("*").alias("n"), F.max("frame_index").alias("m"), F.min("index").alias("lo"), F.max("index").alias("hi"))
    episodes = per.agg(F.count_if(F.col("n") != F.col("m") + 1).alias("frame_index"), F.count_if(F.col("hi") - F.col("lo") + 1 != F.col("n")).alias("episode_range"))
    both = total.drop("rows").crossJoin(episodes)  # one row each
    return both.unpivot([], both.columns, "check", "bad").withColumn("ok", F.col("bad") == 0)


def ordered_distinct(df: DataFrame, value: str, order: str) -> DataFrame:
    return df.groupBy(value).agg(F.min(order).alias("first_seen"))


def evenly_spaced(df: DataFrame, keys: Keys, order: str, k: int) -> DataFrame:
    """k rows of every key at places floor(i (n - 1) / (k - 1))."""
    w = Window.partitionBy(*keys).orderBy(order)
    df = df.withColumns({"_i": F.row_number().over(w) - 1, "_n": F.count(F.lit(1)).over(Window.partitionBy(*keys))})
    places = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * (F.col("_n") - 1) / (k - 1)).cast("int"))
    return df.filter(F.array_contains(places, F.col("_i"))).drop("_i", "_n")
