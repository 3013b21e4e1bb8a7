"""Registered queries over the given tables, each with its SQL check where SQL can say it."""

from __future__ import annotations

from .base import ORACLE, QUERIES  # noqa: F401
from . import aggregates, functions, graphs, ingest, joins, recommender, report_jobs, stage_profiles, windows_sets  # noqa: F401,E402
