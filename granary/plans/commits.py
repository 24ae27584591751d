"""The snapshot store's ways of writing, on the driver's orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import relational, store
from .registry import Registry

_r = Registry()
QUERIES, ORACLES, add = _r.queries, _r.oracles, _r.add

_SQL = "SELECT o_orderkey, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders"


def _rows(t) -> DataFrame:
    return t("orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))


def _empty(t) -> store.Table:
    spark = t("orders").sparkSession
    return store.Table(spark, relational.work_folder(spark, "orders"))


def _table(t) -> store.Table:
    table = _empty(t)
    table.create(_rows(t), ["status"], "B1")
    return table


@add(f"SELECT o_orderkey, status, CASE WHEN status = 'F' THEN cents * 2 ELSE cents END AS cents FROM ({_SQL}) o WHERE status <> 'F' OR o_orderkey % 2 = 0")
def commit_partitions(t):
    """Only the partitions that the new rows are of are replaced."""
    table = _table(t)
    table.overwrite_partitions(_rows(t).where("status = 'F' AND o_orderkey % 2 = 0").withColumn("cents", F.col("cents") * 2), "B2")
    return table.read()


@add(f"SELECT o_orderkey, status, cents FROM ({_SQL}) o WHERE status <> 'F'")
def commit_empty_day(t):
    """A partition that is written again without rows loses those it had."""
    table = _table(t)
    table.replace_partitions({"status": "F"}, _rows(t).where("false"), "B2")
    return table.read()


@add(f"SELECT 'now' AS version, status AS key, count(*) AS orders FROM ({_SQL}) o GROUP BY status UNION ALL SELECT 'then', CAST(o_orderkey % 10 AS VARCHAR), count(*) FROM ({_SQL}) o GROUP BY 2")
def commit_replace(t):
    """A new schema from here on; the version before it keeps its own."""
    table = _table(t)
    table.replace(_rows(t).groupBy(F.col("status").alias("key")).agg(F.count("*").alias("orders")), batch="B2")
    before = table.read(version=0).groupBy((F.col("o_orderkey") % 10).cast("string").alias("key")).agg(F.count("*").alias("orders"))
    return table.read().select(F.lit("now").alias("version"), "key", "orders").unionByName(before.select(F.lit("then").alias("version"), "key", "orders"))


@add(f"SELECT o_orderkey, status, cents FROM ({_SQL}) o WHERE status = 'O' UNION ALL SELECT o_orderkey, status, cents FROM ({_SQL}) o WHERE status IN ('F', 'O')")
def commit_append(t):
    """A table that is made only where it isn't there, then rows added twice."""
    table = _empty(t)
    for _ in range(2):
        table.ensure("o_orderkey long, status string, cents long", ["status"])
    table.append(_rows(t).where("status = 'O'"), "B1")
    table.append(_rows(t).where("status IN ('F', 'O')"), "B2")
    return table.read()


@add(f"SELECT o_orderkey, status, CASE WHEN o_orderkey % 10 = 3 THEN 0 ELSE cents END AS cents FROM ({_SQL}) o WHERE o_orderkey % 10 <> 4")
def commit_rows(t):
    """Rows of a condition deleted and others put in their place; folders without such rows stay."""
    table = _table(t)
    table.replace_rows("o_orderkey % 10 IN (3, 4)", _rows(t).where("o_orderkey % 10 = 3").withColumn("cents", F.lit(0).cast("bigint")), "B2")
    return table.read()


@add(f"SELECT 'equal' AS read_by, status, count(*) AS orders FROM ({_SQL}) o WHERE status = 'P' GROUP BY status UNION ALL SELECT 'between', status, count(*) FROM ({_SQL}) o WHERE status BETWEEN 'G' AND 'Z' GROUP BY status UNION ALL SELECT 'values', status, 0 FROM ({_SQL}) o GROUP BY status")
def pruned_read(t):
    """Partitions picked from the log before Spark plans."""
    table = _table(t)
    counted = lambda df, name: df.groupBy("status").agg(F.count("*").alias("orders")).select(F.lit(name).alias("read_by"), "status", "orders")
    values = [("values", v, 0) for v in table.partition_values("status")]
    out = counted(table.read(partitions={"status": "P"}), "equal").unionByName(counted(table.read(between=("status", "G", "Z")), "between"))
    return out.unionByName(out.sparkSession.createDataFrame(values, "read_by string, status string, orders long"))
