"""All queries of the ledger operators with their SQL."""

from __future__ import annotations

from . import q_close, q_history, q_ledger, q_routing, q_similarity, q_year

MODULES = [q_ledger, q_history, q_similarity, q_routing, q_close, q_year]

QUERIES: dict = {name: f for m in MODULES for name, f in m.Q.items()}
ORACLE_SQL: dict = {name: sql for m in MODULES for name, sql in m.SQL.items()}
