"""Named queries: each pairs a Spark plan with its independent DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from flowlens.plans.views import oracle_with


@dataclass(frozen=True)
class QuerySpec:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    views: tuple[str, ...]


REGISTRY: dict[str, QuerySpec] = {}


def query(name: str, oracle: str | None = None, views: tuple[str, ...] = ()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``oracle`` is DuckDB SQL over the base tables and the listed views;
    ``None`` marks operators checked by row count only (randomised or
    iterative fits).
    """

    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = QuerySpec(name, fn, oracle_with(oracle, views) if oracle else None,
                                   tuple(views))
        return fn

    return deco


def load_all() -> dict[str, QuerySpec]:
    # importing the catalogue modules fills REGISTRY
    from flowlens.plans import (  # noqa: F401
        q_evaluate, q_io, q_model, q_monitor, q_profile, q_project, q_clean,
        q_split, q_stream,
    )
    return REGISTRY
