"""Registered queries on the given tables, each with the SQL it has to agree with."""

from __future__ import annotations

from catalogue import cleaning, columns, evaluation, models, profiles, samples, trees

MODULES = (columns, cleaning, samples, profiles, models, trees, evaluation)


def queries() -> dict:
    return {name: run for module in MODULES for name, (run, _) in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, (_, sql) in module.QUERIES.items() if sql}
