"""Positions and turns of ordered episodes: smoothing, resampling by column kind, bridging, nearest rotations."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as g
from .timeseries import Keys, savgol_runs
from .windows import after, before, island, ordered, whole

#: Names of a quaternion's columns: x, y, z, w.
Turn = Sequence[str]


def align_signs(df: DataFrame, turn: Turn, keys: Keys, order: str) -> DataFrame:
    """Gives every quaternion the sign nearer to the one before it.

    The sign of a row is the product of all changes before it, and so a parity of a
    running sum; no row waits for another's result.
    """
    w = ordered(keys, order)
    df = df.withColumn("_flip", F.coalesce((g.dot([F.col(c) for c in turn], [F.lag(c).over(w) for c in turn]) < 0).cast("int"), F.lit(0)))
    df = df.withColumn("_sign", F.when(F.sum("_flip").over(before(w)) % 2 == 1, -1.0).otherwise(1.0))
    return df.withColumns({c: F.col(c) * F.col("_sign") for c in turn}).drop("_flip", "_sign")


def smooth_turns(df: DataFrame, turn: Turn, valid: Column, keys: Keys, order: str, window: int = 9, degree: int = 2, least: int = 3, shortest: bool = True) -> DataFrame:
    """Smooths quaternions within runs of valid rows: signs aligned, rotation vectors fitted, turned back and normalised.

    Runs under `least` rows and rows that aren't valid, or whose quaternion has no length,
    keep theirs.  `shortest` takes vectors of at most half a turn, as trainers of today
    expect; without it vectors run on from half a turn to a whole one, so none jumps there.
    """
    length = g.norm([F.col(c) for c in turn])
    df = df.withColumn("_good", F.coalesce(valid & (length > 1e-9), F.lit(False)))
    df = island(df, F.col("_good"), ordered(keys, order), "_run")
    size = F.count(F.lit(1)).over(whole(ordered([*keys, "_run"], order)))
    df = df.withColumns({**{f"_q{k}": F.col(c) / F.when(F.col("_good"), length) for k, c in enumerate(turn)}, "_size": size})
    unit = [f"_q{k}" for k in range(4)]
    df = align_signs(df, unit, [*keys, "_run"], order)
    df = df.withColumns({f"_v{k}": c for k, c in enumerate(g.rotation_vector([F.col(c) for c in unit], shortest))})
    df = savgol_runs(df, ["_v0", "_v1", "_v2"], F.col("_good"), keys, order, window, degree, least)
    back = g.turn_by([F.col(f"_v{k}") for k in range(3)])
    kept = F.col("_good") & (F.col("_size") >= least)
    return df.withColumns({c: F.when(kept, b).otherwise(F.col(c)) for c, b in zip(turn, back, strict=True)}).drop("_good", "_run", "_size", *unit, "_v0", "_v1", "_v2")


def slowed_grid(df: DataFrame, keys: Keys, order: str, slower: int, than: int) -> tuple[DataFrame, DataFrame]:
    """A grid of n * slower div than places from the first to the last row of n, and the rows; both with `tick`, in which they meet exactly.

    Rows are numbered from 0 by `order`.
    """
    n = F.count(F.lit(1))
    sizes = df.groupBy(*keys).agg(n.alias("_n")).withColumn("_m", F.greatest(F.lit(1), F.expr(f"_n * {slower} div {than}")))
    grid = sizes.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1)).alias("i"), "_n").withColumn("tick", F.col("i") * (F.col("_n") - 1)).drop("_n")
    w = ordered(keys, order)
    rows = df.withColumn("_n", F.count(F.lit(1)).over(whole(w)))
    tick = (F.row_number().over(w) - 1).cast("long") * (F.greatest(F.lit(1), F.expr(f"_n * {slower} div {than}")) - 1)
    return grid, rows.withColumn("tick", tick).drop("_n")


def resample(grid: DataFrame, rows: DataFrame, keys: Keys, time: str, kinds: Mapping[str, str], turns: Sequence[Turn] = ()) -> DataFrame:
    """Adds to every grid row the columns of `rows` at its time, each by its kind.

    kinds: `linear`, `nearest` (the earlier row half way) or `previous` of a column;
    turns: quaternions, by the shorter arc.  Beyond the ends the end's row holds.  One
    union and one window find both neighbours of all columns; work grows with the rows.
    Times of `rows` are distinct within a key and compared with the grid's exactly.
    """
    taken = [*kinds, *(c for t in turns for c in t)]
    own = [c for c in grid.columns if c not in (*keys, time)]
    null = lambda schema, c: F.lit(None).cast(schema[c].dataType)
    left = grid.select(*keys, time, F.lit(1).alias("_side"), *own, *(null(rows.schema, c).alias(f"_r_{c}") for c in taken))
    right = rows.select(*keys, time, F.lit(0).alias("_side"), *(null(grid.schema, c).alias(c) for c in own), *(F.col(c).alias(f"_r_{c}") for c in taken))
    w = ordered(keys, [time, "_side"])
    mark = F.when(F.col("_side") == 0, F.struct(F.col(time).alias("t"), *(F.col(f"_r_{c}").alias(c) for c in taken)))
    both = left.unionByName(right).withColumns({"_a": F.last(mark, ignorenulls=True).over(before(w)), "_b": F.first(mark, ignorenulls=True).over(after(w))})
    at, first, then = F.col(time), F.col("_a.t"), F.col("_b.t")
    share = F.when(first.isNull(), 1.0).when(then.isNull() | (first == at), 0.0).otherwise((at - first) / (then - first).cast("double"))
    both = both.filter("_side = 1").withColumn("_share", share)
    s = F.col("_share")
    blend = {
        "linear": lambda a, b: F.when((s == 0) | b.isNull(), a).when((s == 1) | a.isNull(), b).otherwise(a + (b - a) * s),
        "nearest": lambda a, b: F.when(s <= 0.5, a).otherwise(b),
        "previous": lambda a, b: F.when(F.col("_a").isNull(), b).otherwise(a),
    }
    out = {c: blend[kind](F.col(f"_a.{c}"), F.col(f"_b.{c}")) for c, kind in kinds.items()}
    for t in turns:
        a, b = ([F.col(f"{side}.{c}") for c in t] for side in ("_a", "_b"))
        arc = g.slerp(a, b, s)
        out |= {c: F.when((s == 0) | b[k].isNull(), a[k]).when((s == 1) | a[k].isNull(), b[k]).otherwise(arc[k]) for k, c in enumerate(t)}
    return both.select(*keys, time, *own, *(c.alias(n) for n, c in out.items()))


def bridge_poses(df: DataFrame, position: Sequence[str], turn: Turn, valid: Column, keys: Keys, order: str, max_bridge: int = 45, home: Sequence[float] = (0.0, 0.0, 0.0), home_turn: Sequence[float] = (0.0, 0.0, 0.0, 1.0)) -> DataFrame:
    """Replaces rows that aren't valid by a quintic ease from the valid row before to the one after, turns along the shorter arc.

    Before the first and after the last valid row its pose holds; a gap of more than
    `max_bridge` rows holds the pose before it and eases in its last `max_bridge` rows; an
    episode without a valid row stays at `home`.  Adds `bridged`.
    """
    w, ok = ordered(keys, order), F.coalesce(valid, F.lit(False))
    unit = g.unit([F.col(c) for c in turn], 1e-8, home_turn)
    df = df.withColumns({"_place": F.row_number().over(w), "_ok": ok, **{f"_u{k}": c for k, c in enumerate(unit)}})
    mark = F.when(F.col("_ok"), F.struct(F.col("_place").alias("at"), *(F.col(c).cast("double").alias(f"p{k}") for k, c in enumerate(position)), *(F.col(f"_u{k}").alias(f"q{k}") for k in range(4))))
    df = df.withColumns({"_a": F.last(mark, ignorenulls=True).over(before(w)), "_b": F.first(mark, ignorenulls=True).over(after(w))})
    gap = F.col("_b.at") - F.col("_a.at") - 1
    ramp = F.least(F.lit(max_bridge), gap)
    df = df.withColumn("_s", g.quintic(F.greatest(F.lit(0.0), (F.col("_place") - (F.col("_b.at") - ramp) + 1) / F.nullif(ramp + 1, F.lit(0)))))
    s = F.col("_s")
    none_before, none_after = F.col("_a").isNull(), F.col("_b").isNull()

    def pick(eased: Column, field: str, rest: float, own: Column) -> Column:
        a, b = F.col(f"_a.{field}"), F.col(f"_b.{field}")
        return F.when(F.col("_ok"), own).when(none_before & none_after, F.lit(rest)).when(none_before, b).when(none_after, a).otherwise(eased)

    out = {c: pick((1 - s) * F.col(f"_a.p{k}") + s * F.col(f"_b.p{k}"), f"p{k}", float(home[k]), F.col(c).cast("double")) for k, c in enumerate(position)}
    arc = g.slerp([F.col(f"_a.q{k}") for k in range(4)], [F.col(f"_b.q{k}") for k in range(4)], s)
    out |= {c: pick(arc[k], f"q{k}", float(home_turn[k]), F.col(f"_u{k}")) for k, c in enumerate(turn)}
    return df.withColumns({**out, "bridged": ~F.col("_ok")}).drop("_place", "_ok", "_a", "_b", "_s", *(f"_u{k}" for k in range(4)))


def nearest_rotation(df: DataFrame, matrix: Sequence[str], out: Turn = ("qx", "qy", "qz", "qw")) -> DataFrame:
    """Adds the quaternion of the rotation nearest to a 3x3 matrix (nine columns by rows, in any norm that rotations keep); null where an entry is null or not finite.

    It is the eigenvector of the largest eigenvalue of a symmetric 4x4 matrix in the nine
    entries; a whole Arrow batch is solved at once.  The largest component is positive.
    """
    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.DoubleType()) for c in out)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in matrix], 1).reshape(-1, 3, 3)
            ok = np.isfinite(m).all((1, 2))
            (a, b, c), (d, e, f), (h, i, j) = (np.moveaxis(np.where(ok[:, None, None], m, 0), 0, -1)[r] for r in range(3))
            k = np.moveaxis(np.array([[a - e - j, b + d, c + h, i - f], [b + d, e - a - j, f + i, c - h], [c + h, f + i, j - a - e, d - b], [i - f, c - h, d - b, a + e + j]]), -1, 0)
            q = np.linalg.eigh(k)[1][:, :, 3] if len(m) else np.zeros((0, 4))
            q = q * np.sign(q[np.arange(len(q)), np.abs(q).argmax(1)])[:, None]
            q[~ok] = np.nan
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(q[:, n], from_pandas=True) for n in range(4))], schema.names)

    return df.mapInArrow(run, schema)
