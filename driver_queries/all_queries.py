"""Loads every binding module; importing one registers its queries."""

from importlib import import_module

from driver_queries.registry import ORACLE, QUERIES

MODULES = [
    "q_sources",
    "q_writing",
    "q_quality",
    "q_cleaning",
    "q_dimensions",
    "q_facts",
    "q_measures",
    "q_dashboard",
    "q_kpi",
    "q_questions",
    "q_scenario",
]

for module in MODULES:
    import_module(f"driver_queries.{module}")

__all__ = ["ORACLE", "QUERIES"]
