"""Interfaces for models that no relational operator can stand for: detectors, language models, depth, kinematics, physics.

A model is a factory that a Python worker calls once; it takes a pandas batch and returns
one.  The registry has deterministic stand-ins, so pipelines run and can be tested
without weights; real models are registered under other names by their users.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

Batch = Callable[[pd.DataFrame], pd.DataFrame]
_MODELS: dict[str, tuple[Callable[[], Batch], str]] = {}


def register(name: str, factory: Callable[[], Batch], schema: str) -> None:
    """factory: made once per worker; schema: of the columns that it returns."""
    _MODELS[name] = (factory, schema)


def names() -> list[str]:
    return sorted(_MODELS)


def apply(df: DataFrame, name: str) -> DataFrame:
    """Runs a registered model over df in Arrow batches."""
    if name not in _MODELS:
        raise KeyError(f"no model {name!r}; registered: {names()}")
    factory, schema = _MODELS[name]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for pdf in batches:
            yield model(pdf)

    return df.mapInPandas(run, schema)


def per_episode(df: DataFrame, key: str, solve: Batch, schema: str) -> DataFrame:
    """Models with state over an episode (trackers, kinematics, physics): one call per episode."""
    return df.groupBy(key).applyInPandas(solve, schema)


def _unit(*parts: object) -> float:
    return int.from_bytes(hashlib.sha256("\0".join(map(str, parts)).encode()).digest()[:6], "big") / 2**48


def _detector() -> Batch:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for i in pdf["image_id"]:
            x, y = _unit(i, "x") * 0.7, _unit(i, "y") * 0.7
            rows.append((i, "object", x, y, x + 0.3, y + 0.3, _unit(i, "score")))
        return pd.DataFrame(rows, columns=["image_id", "label", "x0", "y0", "x1", "y1", "score"])

    return run


def _captioner() -> Batch:
    return lambda pdf: pd.DataFrame({"image_id": pdf["image_id"], "caption": [f"handles object {int(_unit(i, 'c') * 10)}" for i in pdf["image_id"]]})


def _depth() -> Batch:
    return lambda pdf: pd.DataFrame({"image_id": pdf["image_id"], "depth": [0.5 + _unit(i, "d") for i in pdf["image_id"]]})


register("stub_detector", _detector, "image_id long, label string, x0 double, y0 double, x1 double, y1 double, score double")
register("stub_captioner", _captioner, "image_id long, caption string")
register("stub_depth", _depth, "image_id long, depth double")
