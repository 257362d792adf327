"""Window primitives that the ordered-episode operators share.

Every operator takes `keys` (the episode) and `order` (the place in it).  All windows
of one chain use the same specification, so Spark sorts an episode once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def ordered(keys: Sequence[str], order: Sequence[str] | str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*([order] if isinstance(order, str) else order))


def before(w: WindowSpec, inclusive: bool = True) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)


def after(w: WindowSpec, inclusive: bool = True) -> WindowSpec:
    return w.rowsBetween(0 if inclusive else 1, Window.unboundedFollowing)


def whole(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def ffill(value: Column, w: WindowSpec) -> Column:
    return F.last(value, ignorenulls=True).over(before(w))


def bfill(value: Column, w: WindowSpec) -> Column:
    return F.first(value, ignorenulls=True).over(after(w))


def neighbours(df: DataFrame, value: str, index: str, w: WindowSpec, known: Column | None = None) -> DataFrame:
    """Adds _pi, _pv, _ni, _nv: place and value of the nearest known rows at or before, and at or after."""
    known = F.col(value).isNotNull() if known is None else known
    return df.withColumns({
        "_pi": ffill(F.when(known, F.col(index)), w), "_pv": ffill(F.when(known, F.col(value)), w),
        "_ni": bfill(F.when(known, F.col(index)), w), "_nv": bfill(F.when(known, F.col(value)), w),
    })


def between(index: Column) -> Column:
    """Share of the way from the row at _pi to the row at _ni."""
    return (index - F.col("_pi")) / F.nullif(F.col("_ni") - F.col("_pi"), F.lit(0))


def island(df: DataFrame, flag: Column, w: WindowSpec, out: str = "island") -> DataFrame:
    """Numbers maximal runs of equal `flag`, from 1 in every episode."""
    df = df.withColumn("_flag", flag)
    change = F.lag("_flag").over(w).eqNullSafe(F.col("_flag")) & (F.row_number().over(w) > 1)
    df = df.withColumn("_new", F.when(change, 0).otherwise(1))
    return df.withColumn(out, F.sum("_new").over(before(w))).drop("_flag", "_new")


def mode_first_seen(df: DataFrame, keys: Sequence[str], value: str, order: str, out: str = "mode") -> DataFrame:
    """Per key the most frequent non-null value; of equals the one seen first."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"), F.min(order).alias("_at"))
    return counts.groupBy(*keys).agg(F.max_by(value, F.struct("_n", -F.col("_at"))).alias(out), F.max("_n").alias("votes"))


def asof_pair(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str, values: Sequence[str]) -> DataFrame:
    """For every left row the right rows at or before (`prev_*`) and at or after (`next_*`) its time.

    One union and one window instead of a range join: work grows with the rows, not with
    their pairs.  Times of `right` are distinct within a key.
    """
    cols = [c for c in left.columns if c not in (*keys, time)]
    lhs = left.select(*keys, time, *cols, *(F.lit(None).cast(right.schema[v].dataType).alias(f"_{v}") for v in values), F.lit(None).cast(right.schema[time].dataType).alias("_t"), F.lit(1).alias("_side"))
    rhs = right.select(*keys, time, *(F.lit(None).cast(left.schema[c].dataType).alias(c) for c in cols), *(F.col(v).alias(f"_{v}") for v in values), F.col(time).alias("_t"), F.lit(0).alias("_side"))
    both = lhs.unionByName(rhs)
    back = Window.partitionBy(*keys).orderBy(time, "_side")
    ahead = Window.partitionBy(*keys).orderBy(time, F.desc("_side"))
    mark = F.when(F.col("_side") == 0, F.struct("_t", *(f"_{v}" for v in values)))
    both = both.withColumn("_prev", F.last(mark, ignorenulls=True).over(before(back))).withColumn("_next", F.first(mark, ignorenulls=True).over(after(ahead)))
    named = [F.col(f"{s}.{c}").alias(f"{n}_{c.lstrip('_') if c != '_t' else time}") for s, n in (("_prev", "prev"), ("_next", "next")) for c in ("_t", *(f"_{v}" for v in values))]
    return both.filter("_side = 1").select(*keys, time, *cols, *named)
