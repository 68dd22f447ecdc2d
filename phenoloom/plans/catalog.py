"""All registered queries."""

from __future__ import annotations

from importlib import import_module

from phenoloom.plans.registry import ORACLE, QUERIES

MODULES = ["phenotype_queries", "variant_queries", "result_queries", "source_queries"]


def _load() -> None:
    for module in MODULES:
        import_module(f"phenoloom.plans.{module}")


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
