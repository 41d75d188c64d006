"""Registered queries: each with a Spark form and, where SQL can say it, a SQL form."""

from __future__ import annotations

from orderloom.catalog import contract, current, flows, inventory, report, scalars

_MODULES = (current, contract, scalars, inventory, report, flows)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: text for module in _MODULES for name, text in module.SQL.items()}
