"""The engine's operators bound to the warehouse tables, each beside an independent SQL statement."""

from __future__ import annotations

from marram.bindings import data, evaluation, monitoring, requests, training  # noqa: F401
from marram.bindings.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
