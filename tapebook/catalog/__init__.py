"""Registered queries over the driver's tables, each next to its SQL equivalent."""

from . import health, jobs, joins, landing, maintenance, market, scans, streams, versions  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
