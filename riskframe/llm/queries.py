"""The registered queries of this package, each with its SQL where there is one."""

from __future__ import annotations

from riskframe.llm import binary_codes, cotraining, decontaminate, dialogue_repair, jaccard_join, licenses, merkle, mixture, quote_links, secret_scan, suffix_dedup, token_lattice, training_order

MODULES = (quote_links, binary_codes, suffix_dedup, jaccard_join, decontaminate, cotraining, token_lattice, secret_scan, training_order, mixture, merkle, licenses, dialogue_repair)


def queries() -> dict:
    return {name: run for module in MODULES for name, (run, _) in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, (_, sql) in module.QUERIES.items() if sql}
