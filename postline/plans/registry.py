"""The registered queries: one Spark callable each, most with an equal SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    build: Build
    oracle: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, oracle: str | None = None) -> Callable[[Build], Build]:
    """Register a query. `covers` lists the ids of the operators it shows."""

    def add(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = Query(name, tuple(covers.split()), build, oracle)
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
