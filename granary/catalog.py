"""Every query of the engine by name, and its oracle for another SQL engine."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from .operators.relational import cut, ranked
from .plans import batch, cleansing, commits, files, history, oracles, records, resolution, semantic, surveillance

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _view(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    return semantic.run(spark, view, read(spark, sf_dir, *semantic.TABLES))


def profitability_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every party's place by annual value among all, without all of them in one task."""
    return ranked(cut(_view(spark, sf_dir, "crv_total").select("segment", "party_id", "crv")), "crv", "party_id")


QUERIES: dict[str, Query] = {view: partial(_view, view=view) for view in semantic.QUERIES} | {"profitability_rank": profitability_rank}
ORACLES: dict[str, str] = dict(oracles.ORACLES)
for _module in (batch, cleansing, commits, files, records, history, resolution, surveillance):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
