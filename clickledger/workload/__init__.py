"""The registered queries: each reads the given tables, runs one job and has a SQL check where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..oracle import statement
from ..session import prepare
from . import dimensions, incremental, loading, marketing, sales, streams  # noqa: F401
from .registry import REGISTRY

__all__ = ["REGISTRY", "checks", "queries"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(job):
        return lambda spark, sf_dir: job(prepare(spark), sf_dir)

    return {name: runner(entry.job) for name, entry in REGISTRY.items()}


def checks() -> dict[str, str]:
    return {name: statement(entry.check) for name, entry in REGISTRY.items() if entry.check}
