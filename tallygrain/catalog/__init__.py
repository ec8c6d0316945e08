"""All registered queries and the SQL that checks them."""

from __future__ import annotations

from tallygrain.catalog import customers, facts, models, profiling, transactions

MODULES = [customers, transactions, models, facts, profiling]


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for module in MODULES for name, text in module.SQL.items()}
