"""How plan modules register a query beside its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry:
    """queries and oracles by the plan function's name; a plan gets a loader of tables."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, oracle: str | None = None):
        def register(plan: Callable[[Callable[[str], DataFrame]], DataFrame]):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return plan(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

            run.__name__ = plan.__name__
            self.queries[plan.__name__] = run
            if oracle:
                self.oracles[plan.__name__] = oracle
            return plan

        return register
