"""Rules as data: each names a check, the table it is about, what must hold, and what to say of a row where it doesn't."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    check: str
    table: str
    #: SQL that is true where a row is right; null counts as wrong.
    holds: str
    #: SQL of a text about a wrong row.
    detail: str
    #: SQL by which wrong rows are put in order.
    order: str = "1"
    #: Whether a table without rows fails the check.
    needs_rows: bool = False
    level: str = "error"


def findings(table: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """check, place, detail of every wrong row, all rules in one pass over the table."""
    each = [F.when(~F.coalesce(F.expr(r.holds), F.lit(False)), F.struct(F.lit(r.check).alias("check"), F.expr(r.order).cast("double").alias("place"), F.coalesce(F.expr(r.detail).cast("string"), F.lit("null")).alias("detail"))) for r in rules]
    return table.select(F.explode(F.array_compact(F.array(*each))).alias("_f")).select("_f.*")


def evaluate(tables: Mapping[str, DataFrame], rules: Sequence[Rule], first: int = 3) -> DataFrame:
    """check, level, rows, bad, ok, details (of the first wrong rows, in order) of every rule.

    A table is read once for its findings and once for its number of rows, whatever the
    number of rules.  Of a check's wrong rows a task passes on `first`.
    """
    parts, counts = [], []
    for name in dict.fromkeys(r.table for r in rules):
        own = [r for r in rules if r.table == name]
        parts.append(findings(tables[name], own))
        counts.append(tables[name].agg(F.count("*").alias("rows")).withColumn("table", F.lit(name)))
    found, rows = parts[0], counts[0]
    for p, c in zip(parts[1:], counts[1:], strict=True):
        found, rows = found.unionByName(p), rows.unionByName(c)
    bad = found.groupBy("check").agg(F.count("*").alias("bad"))
    w = Window.partitionBy("check").orderBy("place", "detail")
    top = found.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= first).groupBy("check").agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", "detail"))), lambda x: x["detail"]).alias("details"))
    known = found.sparkSession.createDataFrame([(r.check, r.table, r.level, r.needs_rows) for r in rules], "check string, table string, level string, needs_rows boolean")
    out = known.join(rows, "table").join(bad, "check", "left").join(top, "check", "left")
    n = F.coalesce("bad", F.lit(0))
    return out.select("check", "level", "rows", n.alias("bad"), ((n == 0) & ~(F.col("needs_rows") & (F.col("rows") == 0))).alias("ok"), F.coalesce("details", F.array().cast("array<string>")).alias("details"))


def passed(report: DataFrame) -> bool:
    """Whether no error is left; a row comes to the driver."""
    return report.filter("not ok and level = 'error'").limit(1).count() == 0
