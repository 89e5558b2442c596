"""Registered queries with their oracles: each maps given tables onto an operator's inputs."""

from bedside.queries import cohorts, datasets, files, signals, timeline, values
from bedside.queries.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cohorts", "datasets", "files", "signals", "timeline", "values"]
