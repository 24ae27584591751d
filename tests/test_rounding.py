"""Amounts that stand between two cents, where engines round doubles differently."""

import os
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F
from test_catalog import plain

from granary.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["profitability_rank"])
def test_fees_between_cents(spark, sf_dir, tmp_path, name):
    tables = "region nation customer part lineitem".split()
    for t in tables:
        shutil.copy(f"{sf_dir}/{t}.parquet", tmp_path / f"{t}.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumns({"o_totalprice": F.element_at(F.array(*map(F.lit, (145.0, 1025.0, 4015.0))), (F.col("o_orderkey") % 3 + 1).cast("int")), "o_orderdate": F.lit("1998-01-01").cast("timestamp")})
    orders.coalesce(1).write.parquet(f"file://{tmp_path}/orders.parquet")
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{os.path.join(tmp_path, 'orders.parquet')}/*.parquet')")
    found = con.execute(ORACLES[name])
    columns = [c[0] for c in found.description]
    for t in ("supplier",):
        shutil.copy(f"{sf_dir}/{t}.parquet", tmp_path / f"{t}.parquet")
    assert plain(QUERIES[name](spark, str(tmp_path)).select(*columns).collect()) == plain(found.fetchall())
