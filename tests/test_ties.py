"""Values that lie just at a limit, or halfway between two roundings."""

from decimal import Decimal

import numpy as np
import pandas as pd

from episodica.operators import timeseries as ts
from episodica.plans import adapters, catalog, extras


def rows(spark, values, **more):
    cols = list(more)
    return spark.createDataFrame([(1, i, x, *(more[c][i] for c in cols)) for i, x in enumerate(values)], "e int, i int, x double" + "".join(f", {c} boolean" for c in cols))


def test_sanitize_reaches_what_lies_just_at_the_way(spark):
    """29.42 - 11.42 is 18.0, but 29.42 - 18.0 isn't 11.42."""
    at = [(a / 100, b / 100) for a in range(2300, 7900) for b in (a - 1800,) if abs(b / 100 - a / 100) <= 18.0 and np.clip(b / 100, a / 100 - 18.0, a / 100 + 18.0) != b / 100]
    assert at
    a, b = at[0]
    df = rows(spark, [a, b, 50.0], ok=[True, True, True])
    got = ts.sanitize(df, "x", "ok", ["e"], "i", low=5.0, high=80.0, velocity=600.0).orderBy("i").collect()
    assert [(r["q"], r["reachable"], r["reason"]) for r in got[:2]] == [(a, True, "ok"), (b, True, "ok")]
    assert got[2]["reason"] == "joint_velocity" and got[2]["q"] == b + 18.0


def test_a_detection_as_near_to_both_wrists_is_the_right_one(spark, tmp_path):
    """Wrists at 1.00 (left, first) and 1.25; 1.125 is as near to both."""
    ev = pd.DataFrame({"event_id": range(3), "ts": pd.date_range("2024-01-01", periods=3, freq="s"), "user_id": 1, "event_type": "view", "value": [100.0, 125.0, 112.5], "props": ['{"k": 1}', '{"k": 2}', '{"k": 3}']})
    ev["ts"] = ev["ts"].astype("datetime64[us]")
    ev.to_parquet(tmp_path / "events.parquet", index=False)
    got = [r["side"] for r in extras.identity_continuity(spark, str(tmp_path)).orderBy("frame_idx").collect()]
    assert got == ["left", "right", "right"]


def test_hardware_audit_rounds_as_its_sql(spark, tmp_path):
    """The mean of 640 residuals ends in seven decimals, the last a five; values are steps of just the velocity that isn't a teleport."""
    import duckdb

    texts = lambda v: float(Decimal(repr(v)).quantize(Decimal("0.000001"), "ROUND_HALF_UP"))
    total = next(t for t in range(20_001, 60_000, 2) if texts(t / 640) != np.floor(t / 640 * 1e6 + 0.5) / 1e6)
    k = [total // 640 + (i < total % 640) for i in range(640)]
    ev = pd.DataFrame({"event_id": range(640), "ts": pd.date_range("2024-01-01", periods=640, freq="s").astype("datetime64[us]"), "user_id": 1, "event_type": "view", "value": [10.07 + 62.5 * (i % 2) for i in range(640)], "props": [f'{{"k": {x}}}' for x in k]})
    ev.to_parquet(tmp_path / "events.parquet", index=False)
    got = catalog.QUERIES["hardware_audit"](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{tmp_path}/events.parquet'")
    assert tuple(got.first()) == con.sql(f"select {', '.join(got.columns)} from ({catalog.ORACLES['hardware_audit']})").fetchall()[0]


def test_rounding_is_that_of_the_sql(spark):
    import duckdb

    values = [n / 100 / 128 for n in range(4, 8000, 8)] + [-0.0000005, -2.5, float("nan"), 49.0015625]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select(adapters.rounded("v", 6).alias("r"), "i").orderBy("i").select("r").collect()]
    want = [r[0] for r in duckdb.connect().sql("select round(v, 6) from (values " + ", ".join(f"({i}, '{v!r}'::double)" for i, v in enumerate(values)) + ") t(i, v) order by i").fetchall()]
    assert np.array_equal(got, want, equal_nan=True)
