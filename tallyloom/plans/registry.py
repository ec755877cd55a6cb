"""All queries of the core, by name."""

from __future__ import annotations

from . import problems, q_calls, q_reads, q_sources, q_stats, q_streams, q_tables

_MODULES = [problems, q_reads, q_tables, q_calls, q_stats, q_sources, q_streams]

QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
SQL = {k: s for m in _MODULES for k, s in m.SQL.items()}
