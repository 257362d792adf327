"""Statistics that add up: moments and counted values of parts, from which those of the whole come without its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stats import exact_quantiles

Keys = Sequence[str]


def moments(df: DataFrame, features: Sequence[str], by: Keys = ()) -> DataFrame:
    """by, feature, count, mean, m2 (sum of squared deviations), min, max of non-null values; a feature without values has count 0."""
    wide = df.unpivot(list(by), [F.col(f).cast("double").alias(f) for f in features], "feature", "v")
    return wide.groupBy(*by, "feature").agg(F.count("v").alias("count"), F.avg("v").alias("mean"), (F.var_pop("v") * F.count("v")).alias("m2"), F.min("v").alias("min"), F.max("v").alias("max"))


def wide_moments(df: DataFrame, features: Sequence[str], by: Keys, n: str) -> DataFrame:
    """by, n (rows), and f/count, f/mean, f/m2, f/min, f/max, f/std of every feature f: a row per key by one shuffle of the table itself."""

    def of(f: str) -> list[Column]:
        v = F.col(f).cast("double")
        parts = {"count": F.count(v), "mean": F.avg(v), "m2": F.var_pop(v) * F.count(v), "min": F.min(v), "max": F.max(v)}
        return [c.alias(f"{f}/{a}") for a, c in parts.items()]

    wide = df.groupBy(*by).agg(F.count("*").alias(n), *(c for f in features for c in of(f)))
    return wide.withColumns({f"{f}/std": F.sqrt(F.col(f"`{f}/m2`") / F.nullif(F.col(f"`{f}/count`"), F.lit(0))) for f in features})


def long_moments(wide: DataFrame, features: Sequence[str], by: Keys) -> DataFrame:
    """Rows of `moments` from those of `wide_moments`."""
    rows = F.array(*(F.struct(F.lit(f).alias("feature"), *(F.col(f"`{f}/{a}`").alias(a) for a in ("count", "mean", "m2", "min", "max", "std"))) for f in features))
    return wide.select(*by, F.explode(rows).alias("_f")).select(*by, "_f.*")


def merged(parts: DataFrame, by: Keys = ()) -> DataFrame:
    """Moments of the union of parts: each part's deviations, and its mean's from the common mean, count times. parts: rows of `moments`, more than one per by and feature."""
    on = [*by, "feature"]
    some = parts.filter("count > 0")
    whole = some.groupBy(*on).agg((F.sum(F.col("count") * F.col("mean")) / F.sum("count")).alias("_mean"))
    sums = some.join(whole, on).groupBy(*on, "_mean").agg(F.sum("count").alias("count"), F.sum(F.col("m2") + F.col("count") * (F.col("mean") - F.col("_mean")) ** 2).alias("m2"), F.min("min").alias("min"), F.max("max").alias("max"))
    return parts.select(*on).distinct().join(sums, on, "left").select(*on, F.coalesce("count", F.lit(0)).alias("count"), F.col("_mean").alias("mean"), "m2", "min", "max")


def deviations(rows: DataFrame) -> DataFrame:
    """Adds std, the population's."""
    return rows.withColumn("std", F.sqrt(F.col("m2") / F.nullif(F.col("count"), F.lit(0))))


def value_counts(df: DataFrame, features: Sequence[str], by: Keys = ()) -> DataFrame:
    """by, feature, value, n of every distinct value. Tables of parts add up by `added`; they are smaller than the rows as far as values repeat."""
    wide = df.unpivot(list(by), [F.col(f).cast("double").alias(f) for f in features], "feature", "value")
    return wide.filter("value is not null").groupBy(*by, "feature", "value").agg(F.count("*").alias("n"))


def added(parts: DataFrame, by: Keys = ()) -> DataFrame:
    return parts.groupBy(*by, "feature", "value").agg(F.sum("n").alias("n"))


def quantiles(counts: DataFrame, shares: dict[str, float]) -> DataFrame:
    """feature and exact quantiles of counted values, linear between neighbours. A count stands for so many rows; no row is made of it."""
    return exact_quantiles(counts, "feature", "value", shares, weight="n")
