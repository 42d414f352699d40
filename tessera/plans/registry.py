"""Registry of query keys -> (Spark builder, oracle SQL or None)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}

PLAN_MODULES = (
    "tessera.plans.facts",
    "tessera.plans.quality",
    "tessera.plans.ops",
    "tessera.plans.conform",
    "tessera.plans.relations",
    "tessera.plans.hierarchy",
    "tessera.plans.entities",
    "tessera.plans.textsources",
    "tessera.plans.readers",
    "tessera.plans.writes",
    "tessera.plans.streams",
    "tessera.plans.governance",
)


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key`` with its oracle SQL."""
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key!r}")
        REGISTRY[key] = (fn, sql.strip() if sql else None)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    for m in PLAN_MODULES:
        importlib.import_module(m)
    return REGISTRY
