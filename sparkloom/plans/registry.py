"""The register of queries: each over the test tables, with its DuckDB counterpart where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sparkloom.session import scratch

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registered:
    run: Query
    sql: str | None


REGISTRY: dict[str, Registered] = {}


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def scratch(self, name: str) -> str:
        """A new folder that every executor can read and write."""
        return scratch(self.spark, name)

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    def keep(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        REGISTRY[f.__name__] = Registered(lambda spark, sf_dir: f(Tables(spark, sf_dir)), sql)
        return f

    return keep
