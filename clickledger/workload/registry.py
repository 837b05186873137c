from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import written
from ..sources.shapes import table

Job = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    job: Job
    check: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, check: str | None = None):
    """Register a job under a name, with the name of its SQL check."""

    def keep(job: Job) -> Job:
        REGISTRY[name] = Entry(job, check)
        return job

    return keep


class Tables:
    """Input tables of one data folder by attribute, and steps that several later steps read."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._steps: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        # one DataFrame per table; __getattr__ is asked only once per name
        frame = table(self._spark, self._dir, name)
        setattr(self, name, frame)
        return frame

    def step(self, name: str, make: Callable[[Tables], DataFrame]) -> DataFrame:
        """A step written once and shared, as the warehouse keeps it as a table."""
        if name not in self._steps:
            self._steps[name] = written(make(self), name, "zstd")
        return self._steps[name]
