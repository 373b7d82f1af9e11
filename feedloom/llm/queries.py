"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Module -> its queries.
_NAMES = {
    "capping": ["p1_found"],
    "neardup": ["p2_found", "p2_groups"],
    "boilerplate": ["p3_found", "p3_articles", "p3_slots"],
    "proportions": ["p4_found", "p4_sample", "p4_report"],
    "history": ["p5_found", "p5_nearest"],
    "packing": ["p6_found", "p6_packed", "p6_report"],
    "mixing": ["p7_found", "p7_mixture", "p7_report"],
    "subjects": ["p8_found", "p8_composition"],
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: getattr(import_module(f"feedloom.llm.{m}"), name) for m, names in _NAMES.items() for name in names}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _NAMES for k, v in getattr(import_module(f"feedloom.llm.{m}"), "SQL", {}).items()}
