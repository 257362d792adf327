"""Streaming forms of the ordered operators.

`stream_hysteresis` keeps its few rows of state per key across micro-batches; a bounded
input gives the same rows as the batch operator.  `windowed_counts` and `sessions` are
event-time aggregations with a watermark for late rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream_hysteresis(df: DataFrame, key: str, order: str, evidence: str, n: int = 3) -> DataFrame:
    """key, order, state: on after n rows of evidence, off after n without. Rows of one trigger are put in order; a key's triggers follow each other in order."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        on, run, last = state.get if state.exists else (False, 0, False)
        pdf = pd.concat(list(batches)).sort_values(order)  # a key's rows of a trigger come in several batches
        out = []
        for e in pdf[evidence].fillna(False).astype(bool):
            run = run + 1 if e == last and run else 1
            last = e
            if run >= n:
                on = e
            out.append(on)
        yield pd.DataFrame({key: pdf[key], order: pdf[order], "state": out})
        state.update((bool(on), int(run), bool(last)))

    kinds = dict(df.dtypes)
    return df.groupBy(key).applyInPandasWithState(step, f"{key} {kinds[key]}, {order} {kinds[order]}, state boolean", "on boolean, run int, last boolean", "append", GroupStateTimeout.NoTimeout)


def windowed_counts(df: DataFrame, time: str, kind: str, value: str, width: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Count and sum per tumbling window and kind. `time` is a timestamp."""
    return df.withWatermark(time, late).groupBy(F.window(time, width), kind).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), kind, "n", "total")


def sessions(df: DataFrame, time: str, key: str, gap: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of a key: rows no more than `gap` apart."""
    return df.withWatermark(time, late).groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")
