"""All queries of the library with their SQL, gathered from the plan modules."""

from __future__ import annotations

from . import both_hands, contacts, dataset, delivery, documents, extras, findings, poses, robots, scenes, segmentation, shapes, signals, streams, texts  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
