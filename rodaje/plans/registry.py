"""All named queries of the core."""

from __future__ import annotations

from collections.abc import Callable
from types import ModuleType

from pyspark.sql import DataFrame, SparkSession

from rodaje.plans import analytics, composites, domain, extras, forms, general, loads, matches, models, relational, scalars

Query = Callable[[SparkSession, str], DataFrame]

MODULES: list[ModuleType] = [general, relational, analytics, scalars, composites, domain, extras, matches, forms, models, loads]


def queries() -> dict[str, Query]:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
