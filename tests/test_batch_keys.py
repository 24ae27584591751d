"""The batch's landing at keys beyond those of the small tables."""

import duckdb
import pytest
from pyspark.sql import functions as F
from test_catalog import plain

from granary.functions import standard
from granary.plans import batch


def test_every_key_has_a_pan_of_its_own(spark):
    keys = spark.range(0, 3_000_000, 1009).unionByName(spark.range(10**9, 2 * 10**12, 10**9 + 7)).toDF("c_custkey")
    found = keys.select("c_custkey", F.expr(batch._PERSON["pan"]).alias("pan")).select(standard.pan(F.col("pan")).alias("pan"))
    assert found.where("pan IS NULL").count() == 0 and found.distinct().count() == keys.count()


@pytest.fixture(scope="module")
def large_keys(spark, sf_dir, tmp_path_factory):
    """sf_dir's tables twice more, with keys that share dates of birth."""
    folder = tmp_path_factory.mktemp("large-keys")
    for t, keys in {"nation": [], "region": [], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "orders": ["o_orderkey", "o_custkey"]}.items():
        rows = spark.read.parquet(f"{sf_dir}/{t}.parquet")
        if keys:
            rows = rows.crossJoin(spark.range(3).select((F.col("id") * 20_000 + F.sign("id").cast("long") * 280_000).alias("_by"))).withColumns({k: F.col(k) + F.col("_by") for k in keys}).drop("_by")
        rows.coalesce(1).write.parquet(f"file://{folder}/{t}.parquet")
    return str(folder)


def test_quarantine_needs_no_stage_after_bronze(spark, large_keys):
    """Every query of the batch waited for all of its stages."""
    batch._houses.pop((spark.sparkContext.applicationId, large_keys), None)
    batch.QUERIES["batch_quarantine"](spark, large_keys).collect()
    house = next(h if not isinstance(h, tuple) else h[0] for (_, folder), h in batch._houses.items() if folder == large_keys)
    assert house.table("bronze", "cbs_customer").exists and not house.table("silver", "cbs_customer").exists


@pytest.mark.parametrize("name", ["batch_bridge", "batch_deposit_fact", "batch_dimensions", "batch_parties", "batch_quarantine", "batch_silver"])
def test_large_keys(spark, large_keys, name):
    con = duckdb.connect()
    for t in ("nation", "region", "customer", "supplier", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{large_keys}/{t}.parquet/*.parquet')")
    found = con.execute(batch.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert plain(batch.QUERIES[name](spark, large_keys).select(*columns).collect()) == plain(found.fetchall())
