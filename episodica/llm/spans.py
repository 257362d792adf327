"""Text spans: one form for all span finders, and the columns derived from it."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN_SQL = "array<struct<kind:string,start:long,stop:long,base:boolean>>"
SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("base", pa.bool_())]))


def ordered(spans: list[tuple[str, int, int, bool]], kinds: list[str]) -> list[dict]:
    """By start, then by the order of kinds, then by end."""
    rank = {k: i for i, k in enumerate(kinds)}
    return [dict(zip(("kind", "start", "stop", "base"), s, strict=True)) for s in sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))]


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def digest(found: DataFrame, kinds: list[str]) -> DataFrame:
    """doc_id, a count of base spans per kind, a digest of base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in kinds]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
