"""Every operator as a runnable query over the test tables, next to the SQL it must equal."""

from __future__ import annotations

from benchsuite import events, instances, jobs, points, raw, scans, state, streams  # noqa: F401
from benchsuite.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
